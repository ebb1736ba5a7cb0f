"""DuckDB SQL for the registered queries (the correctness oracle).

Every statement starts from the driver's tables with the same stand-in views
as ``sources.fixtures`` and recomputes the operator in plain SQL, so a match
checks the Spark operator against an independent formulation.
"""

from __future__ import annotations

DF = ["DF1", "DF2", "DF3", "DF4"]
PF = ["PF1", "PF2", "PF3", "PF4"]
SEED = 1072002


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def _fill(strategy: str) -> str:
    if strategy == "zero":
        return ("d_fill AS (SELECT " + ", ".join(f"0.0::DOUBLE AS f_{c}" for c in DF) + "),\n")
    agg = "avg" if strategy == "mean" else "median"
    return "d_fill AS (SELECT " + ", ".join(f"{agg}({c}) AS f_{c}" for c in DF) + " FROM fx_demands),\n"


def _scaled(src: str, feats: list[str], par: str) -> str:
    return ", ".join(f"({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END) AS {c}" for c in feats)


BASE = """
fx_costs AS (
  SELECT o_custkey AS demand_id, l_suppkey AS plant_id,
         CASE WHEN min(l_quantity) = 1 THEN NULL ELSE avg(l_extendedprice / l_quantity) END AS cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_suppkey),
fx_demands AS (
  SELECT c_custkey AS demand_id, c_mktsegment AS segment, c_acctbal AS DF1,
         CASE WHEN c_acctbal >= 0 THEN avg(o_totalprice) END AS DF2,
         CAST(count(o_orderkey) AS DOUBLE) AS DF3,
         CAST(c_nationkey AS DOUBLE) AS DF4
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_mktsegment, c_acctbal, c_nationkey),
fx_plants AS (
  SELECT s_suppkey AS plant_id, n_name AS region, s_acctbal AS PF1,
         CAST(s_nationkey AS DOUBLE) AS PF2, avg(l_quantity) AS PF3, avg(l_discount) AS PF4
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN lineitem ON l_suppkey = s_suppkey
  GROUP BY s_suppkey, n_name, s_acctbal, s_nationkey),
fx_folds AS (
  SELECT CAST(l_linenumber AS INTEGER) AS combo_idx, CAST(month(l_shipdate) AS INTEGER) AS fold,
         avg(l_extendedprice) AS fold_rmse
  FROM lineitem GROUP BY 1, 2),
"""


def prelude(strategy: str = "mean") -> str:
    fit_fill = "mean" if strategy == "mean" else "median"
    fit_agg = "avg" if fit_fill == "mean" else "median"
    s = "WITH " + BASE
    s += _fill(strategy)
    s += ("d_imp AS (SELECT demand_id, segment, "
          + ", ".join(f"coalesce({c}, f_{c}) AS {c}" for c in DF) + " FROM fx_demands, d_fill),\n")
    s += ("d_fitfill AS (SELECT " + ", ".join(f"{fit_agg}({c}) AS g_{c}" for c in DF) + " FROM fx_demands),\n")
    s += ("d_fit AS (SELECT " + ", ".join(f"coalesce({c}, g_{c}) AS {c}" for c in DF)
          + " FROM fx_demands, d_fitfill),\n")
    s += ("d_par AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in DF)
          + " FROM d_fit),\n")
    s += "d_std AS (SELECT demand_id, segment, " + _scaled("d_imp", DF, "d_par") + " FROM d_imp, d_par),\n"
    s += ("p_par AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in PF)
          + " FROM fx_plants),\n")
    s += "p_std AS (SELECT plant_id, region, " + _scaled("fx_plants", PF, "p_par") + " FROM fx_plants, p_par),\n"
    s += """pstats AS (
  SELECT plant_id, median(cost) AS median_cost, avg(cost) AS mean_cost, count(cost) AS n_costs
  FROM fx_costs WHERE plant_id IS NOT NULL GROUP BY plant_id),
thr AS (SELECT quantile_cont(median_cost, 0.75) AS threshold FROM pstats),
flags AS (SELECT plant_id, median_cost, median_cost <= threshold AS is_good FROM pstats, thr),
good AS (SELECT plant_id FROM flags WHERE is_good),
costs_f AS (
  SELECT demand_id, plant_id, cost FROM fx_costs
  WHERE cost IS NOT NULL AND demand_id IN (SELECT demand_id FROM fx_demands)
    AND plant_id IN (SELECT plant_id FROM good)),
combined_all AS (
  SELECT c.demand_id AS Demand_ID, c.plant_id AS Plant_ID,
         d.DF1, d.DF2, d.DF3, d.DF4, p.PF1, p.PF2, p.PF3, p.PF4, c.cost AS Cost
  FROM costs_f c JOIN d_std d ON c.demand_id = d.demand_id
  JOIN (SELECT * FROM p_std WHERE plant_id IN (SELECT plant_id FROM good)) p ON c.plant_id = p.plant_id),
combined AS (
  SELECT * FROM combined_all
  WHERE DF1 IS NOT NULL AND DF2 IS NOT NULL AND DF3 IS NOT NULL AND DF4 IS NOT NULL
    AND PF1 IS NOT NULL AND PF2 IS NOT NULL AND PF3 IS NOT NULL AND PF4 IS NOT NULL AND Cost IS NOT NULL),
grp AS (SELECT DISTINCT Demand_ID FROM combined),
grp_r AS (
  SELECT Demand_ID, row_number() OVER (ORDER BY md5(CAST(Demand_ID AS VARCHAR) || ':1072002'), Demand_ID) AS rn,
         count(*) OVER () AS n
  FROM grp),
split AS (SELECT Demand_ID, rn <= ceil(n * CAST(0.05 AS DOUBLE)) AS is_test FROM grp_r),
valid_costs AS (SELECT demand_id, plant_id, cost FROM fx_costs WHERE cost IS NOT NULL),
plant_tot AS (SELECT plant_id, sum(cost) AS tot, count(cost) AS n FROM valid_costs GROUP BY plant_id),
pred AS (
  SELECT v.demand_id AS Demand_ID, v.plant_id AS Plant_ID, v.cost AS Cost,
         CASE WHEN t.n > 1 THEN (t.tot - v.cost) / (t.n - 1) END AS prediction
  FROM valid_costs v JOIN plant_tot t ON v.plant_id = t.plant_id),
seg_rows AS (SELECT v.*, d.segment FROM valid_costs v JOIN fx_demands d ON v.demand_id = d.demand_id),
seg_tot AS (SELECT plant_id, segment, sum(cost) AS tot, count(cost) AS n FROM seg_rows GROUP BY 1, 2),
pred_seg AS (
  SELECT r.demand_id AS Demand_ID, r.plant_id AS Plant_ID, r.cost AS Cost,
         CASE WHEN t.n > 1 THEN (t.tot - r.cost) / (t.n - 1) END AS prediction
  FROM seg_rows r JOIN seg_tot t ON r.plant_id = t.plant_id AND r.segment = t.segment),
"""
    s += _scenario_cte("scen", "pred") + ",\n" + _scenario_cte("scen_seg", "pred_seg") + ",\n"
    s += """pred_groups AS (SELECT DISTINCT Demand_ID FROM pred),
pred_grp_r AS (
  SELECT Demand_ID, row_number() OVER (ORDER BY md5(CAST(Demand_ID AS VARCHAR) || ':1072002'), Demand_ID) AS rn,
         count(*) OVER () AS n
  FROM pred_groups),
pred_test AS (SELECT Demand_ID FROM pred_grp_r WHERE rn <= ceil(n * CAST(0.05 AS DOUBLE))),
fold_sum AS (
  SELECT combo_idx, sqrt(avg(fold_rmse * fold_rmse)) AS mean_rmse, stddev_pop(fold_rmse) AS std_rmse,
         count(fold_rmse) AS n_folds
  FROM fx_folds GROUP BY combo_idx),
board AS (
  SELECT *, CAST(row_number() OVER (ORDER BY mean_rmse ASC NULLS LAST, combo_idx) AS INTEGER) AS rank
  FROM fold_sum)
"""
    return s


def _scenario_cte(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT Demand_ID,
         arg_min(Plant_ID, CASE WHEN prediction IS NOT NULL AND NOT isnan(prediction)
                                THEN (prediction, Plant_ID) END) AS Model_Selected_Plant,
         arg_min(Plant_ID, (Cost, Plant_ID)) AS Oracle_Selected_Plant,
         arg_min(Cost, CASE WHEN prediction IS NOT NULL AND NOT isnan(prediction)
                            THEN (prediction, Plant_ID) END) AS Model_Selected_Cost,
         min(Cost) AS Oracle_Cost
  FROM {src} WHERE Cost IS NOT NULL GROUP BY Demand_ID)"""


def _stats(src: str, err: str = "Selection_Error") -> str:
    return f"""SELECT round(coalesce(avg({err}), 0), 6) AS mean, round(coalesce(median({err}), 0), 6) AS median,
       round(coalesce(stddev_pop({err}), 0), 6) AS std, round(coalesce(min({err}), 0), 6) AS min,
       round(coalesce(max({err}), 0), 6) AS max, round(coalesce(sqrt(avg({err} * {err})), 0), 6) AS rmse,
       count({err}) AS count
FROM {src} WHERE {err} IS NOT NULL"""


SCEN_COLS = ("Demand_ID, Model_Selected_Plant, Oracle_Selected_Plant, round(Model_Selected_Cost, 6) AS "
             "Model_Selected_Cost, round(Oracle_Cost, 6) AS Oracle_Cost, "
             "round(Model_Selected_Cost - Oracle_Cost, 6) AS Selection_Error")


def _hist(src: str, col: str, bins: int) -> str:
    return f"""
, hv AS (SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL),
hb AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
              CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM hv),
he AS (SELECT CAST(b AS INTEGER) AS bin, CAST(b AS DOUBLE) * ((hi - lo) / {bins}) + lo AS bin_lo,
              CASE WHEN b = {bins} - 1 THEN hi ELSE CAST(b + 1 AS DOUBLE) * ((hi - lo) / {bins}) + lo END AS bin_hi
       FROM range({bins}) r(b), hb WHERE lo IS NOT NULL),
hc AS (SELECT bin, count(*) AS n FROM hv JOIN he ON v >= bin_lo AND (v < bin_hi OR bin = {bins} - 1) GROUP BY bin)
SELECT he.bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, coalesce(hc.n, 0) AS count
FROM he LEFT JOIN hc ON he.bin = hc.bin"""


def _two_pred_errors() -> str:
    return """
, errs AS (
  SELECT 'baseline' AS model, 'test' AS evaluation, Model_Selected_Cost - Oracle_Cost AS e FROM scen
    WHERE Demand_ID IN (SELECT Demand_ID FROM pred_test)
  UNION ALL SELECT 'baseline', 'all', Model_Selected_Cost - Oracle_Cost FROM scen
  UNION ALL SELECT 'optimized', 'test', Model_Selected_Cost - Oracle_Cost FROM scen_seg
    WHERE Demand_ID IN (SELECT Demand_ID FROM pred_test)
  UNION ALL SELECT 'optimized', 'all', Model_Selected_Cost - Oracle_Cost FROM scen_seg)"""


SERVE_D = "1000.0 + 0.5 * DF1 + (-2.0) * DF2 + 1.5 * DF3 + 0.25 * DF4"
SERVE_P = "0.0 + 3.0 * PF1 + (-1.0) * PF2 + (-4.0) * PF3 + 2.0 * PF4"
SERVE_ALL = ("1000.0 + 0.5 * DF1 + (-2.0) * DF2 + 1.5 * DF3 + 0.25 * DF4 + 3.0 * PF1 + (-1.0) * PF2"
             " + (-4.0) * PF3 + 2.0 * PF4")


def _gram_select() -> str:
    feats = DF + PF
    cols = ["CAST(count(*) AS DOUBLE) AS n", "sum(Cost) AS sy", "sum(Cost * Cost) AS syy"]
    cols += [f"sum({f}) AS sx_{i}" for i, f in enumerate(feats)]
    cols += [f"sum({f} * Cost) AS sxy_{i}" for i, f in enumerate(feats)]
    cols += [f"sum({a} * {b}) AS sxx_{i}_{j}" for i, a in enumerate(feats) for j, b in enumerate(feats) if j >= i]
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    inner = "SELECT Demand_ID AS \"Group\", " + ", ".join(cols) + " FROM combined GROUP BY Demand_ID"
    sig = ("CASE WHEN {n} = 0 THEN 0.0 ELSE round({n} / pow(10.0, floor(log10(abs({n})))), 8)"
           " * pow(10.0, floor(log10(abs({n})))) END AS {n}")
    return "SELECT \"Group\", " + ", ".join(sig.format(n=n) for n in names) + f" FROM ({inner})"


def queries() -> dict[str, str]:
    p = prelude()
    q = {}
    q["ingest_report"] = p + """SELECT 'demand' AS table_name, count(*) AS n_rows FROM fx_demands
UNION ALL SELECT 'plants', count(*) FROM fx_plants
UNION ALL SELECT 'costs', count(*) FROM fx_costs"""
    for strat in ("mean", "median", "zero"):
        q[f"impute_{strat}"] = prelude(strat) + "SELECT demand_id, " + ", ".join(
            _r(c, c) for c in DF) + " FROM d_imp"
    q["standardize_demands"] = p + "SELECT demand_id, " + ", ".join(_r(c, c) for c in DF) + " FROM d_std"
    q["standardize_plants"] = p + "SELECT plant_id, " + ", ".join(_r(c, c) for c in PF) + " FROM p_std"
    q["preprocess_summary"] = p + """SELECT 4 AS demand_features_count, 4 AS plant_features_count,
  CAST(count_if(is_good IS NOT NULL) AS BIGINT) AS total_plants_before,
  CAST(count_if(is_good) AS BIGINT) AS good_plants_count,
  CAST(count_if(NOT is_good) AS BIGINT) AS filtered_plants_count,
  round((SELECT threshold FROM thr), 6) AS cost_threshold,
  CAST(75.0 AS DOUBLE) AS plant_filter_percentile, 'mean' AS missing_value_strategy
FROM flags"""
    stats_sql = p + """SELECT plant_id, round(median_cost, 6) AS median_cost, round(mean_cost, 6) AS mean_cost,
  n_costs FROM pstats"""
    q["plant_cost_stats"] = stats_sql
    q["plant_cost_stats_sorted"] = stats_sql
    q["plant_threshold"] = p + "SELECT round(threshold, 6) AS threshold FROM thr"
    q["plant_good_flag"] = p + "SELECT plant_id, round(median_cost, 6) AS median_cost, is_good FROM flags"
    q["filter_plants"] = p + ("SELECT plant_id, region, " + ", ".join(_r(c, c) for c in PF)
                              + " FROM p_std WHERE plant_id IN (SELECT plant_id FROM good)")
    q["filter_costs"] = p + "SELECT demand_id, plant_id, round(cost, 6) AS cost FROM costs_f"
    q["combined_dataset"] = p + ("SELECT Demand_ID, Plant_ID, " + ", ".join(_r(c, c) for c in DF + PF)
                                 + ", round(Cost, 6) AS Cost FROM combined")
    q["combined_counts"] = p + """SELECT count(*) AS n_rows, count(DISTINCT Demand_ID) AS n_demands,
  count(DISTINCT Plant_ID) AS n_plants, (SELECT count(*) FROM combined_all) - count(*) AS n_dropped
FROM combined"""
    q["group_key"] = p + """SELECT c_name AS demand_text,
  TRY_CAST(NULLIF(regexp_extract(c_name, '(\\d+)', 1), '') AS BIGINT) AS group_key FROM customer"""
    q["group_split"] = p + "SELECT Demand_ID, is_test FROM split"
    q["split_counts"] = p + """SELECT s.is_test, count(*) AS n_rows, count(DISTINCT c.Demand_ID) AS n_groups
FROM combined c JOIN split s ON c.Demand_ID = s.Demand_ID GROUP BY s.is_test"""
    q["logo_folds"] = p + """SELECT CAST(row_number() OVER (ORDER BY Demand_ID) AS INTEGER) AS Fold,
  Demand_ID AS "Group" FROM grp"""
    q["logo_first_folds"] = p + """SELECT Fold, "Group" FROM (
  SELECT CAST(row_number() OVER (ORDER BY Demand_ID) AS INTEGER) AS Fold, Demand_ID AS "Group" FROM grp)
WHERE Fold <= 100"""
    q["logo_folds_text"] = """WITH ids AS (SELECT CASE WHEN c_acctbal < 0 THEN translate(c_name, '0123456789', 'abcdefghij')
    ELSE c_name END AS k FROM customer),
g AS (SELECT DISTINCT coalesce(CAST(TRY_CAST(NULLIF(regexp_extract(k, '(\\d+)', 1), '') AS BIGINT) AS VARCHAR), k) AS "Group"
      FROM ids WHERE k IS NOT NULL)
SELECT CAST(row_number() OVER (ORDER BY TRY_CAST("Group" AS BIGINT) NULLS LAST, "Group") AS INTEGER) AS Fold, "Group" FROM g"""
    q["orphan_counts"] = p + """SELECT count(*) AS cost_rows,
  count(*) FILTER (WHERE demand_id NOT IN (SELECT demand_id FROM fx_demands WHERE DF1 >= 0)) AS no_demand,
  count(*) FILTER (WHERE plant_id NOT IN (SELECT plant_id FROM fx_plants WHERE PF1 >= 0)) AS no_plant
FROM fx_costs"""
    money = "CAST(round(c_acctbal * 100) AS BIGINT)"
    q["ingest_rejects"] = f"""SELECT c_custkey AS demand_id, 'DF1' AS "column", '(' || -{money} || ' cents)' AS raw
FROM customer WHERE {money} < 0"""
    q["ingest_clean"] = f"""SELECT c_custkey AS demand_id, c_mktsegment, CASE WHEN {money} >= 0 THEN CAST({money} AS DOUBLE) END AS DF1,
  CAST(c_nationkey AS DOUBLE) AS DF4 FROM customer"""
    q["first_row_in_file"] = """SELECT line, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY n) AS nth FROM (
    SELECT l_orderkey || '-' || l_linenumber AS line, l_partkey, l_suppkey, l_extendedprice, row_number() OVER () AS n FROM lineitem))
WHERE nth = 1"""
    q["fit_on_train"] = "WITH " + BASE + f"""hashed AS (SELECT demand_id, md5(demand_id || ':{SEED}') AS h, count(*) OVER () AS n FROM fx_demands),
test AS (SELECT demand_id FROM (SELECT *, row_number() OVER (ORDER BY h, demand_id) AS i FROM hashed) WHERE i <= ceil(n * 0.05)),
seen AS (SELECT * FROM fx_demands WHERE demand_id NOT IN (SELECT demand_id FROM test)),
means AS (SELECT avg(DF1) AS a1, avg(DF2) AS a2, avg(DF3) AS a3, avg(DF4) AS a4 FROM seen),
filled AS (SELECT coalesce(DF1, a1) AS DF1, coalesce(DF2, a2) AS DF2, coalesce(DF3, a3) AS DF3, coalesce(DF4, a4) AS DF4 FROM seen, means),
meds AS (SELECT plant_id, median(cost) AS m FROM fx_costs WHERE demand_id IN (SELECT demand_id FROM seen) GROUP BY plant_id),
cut AS (SELECT round(quantile_cont(m, 0.75), 6) AS threshold FROM meds)
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, any_value(threshold) AS threshold FROM filled, cut"
                         for c in DF)
    q["fill_from_fit"] = p + "SELECT demand_id, " + ", ".join(_r(f"s.{c}", c) for c in DF) + """ FROM d_std s
JOIN fx_demands f USING (demand_id) WHERE f.DF1 < 0"""
    q["mean_lines"] = p + """SELECT round((SELECT avg(cost) FROM fx_costs), 6) AS mean_cost,
  round((SELECT avg(Model_Selected_Cost - Oracle_Cost) FROM scen), 6) AS mean_regret"""
    q["scenario_table"] = p + f"SELECT {SCEN_COLS} FROM scen"
    q["selection_regret"] = p + "SELECT Demand_ID, round(Model_Selected_Cost - Oracle_Cost, 6) AS Selection_Error FROM scen"
    q["error_stats"] = p + ", se AS (SELECT Model_Selected_Cost - Oracle_Cost AS Selection_Error FROM scen)\n" + _stats("se")
    q["regret_rmse"] = p + """SELECT d.segment, round(sqrt(avg((s.Model_Selected_Cost - s.Oracle_Cost)
  * (s.Model_Selected_Cost - s.Oracle_Cost))), 6) AS rmse, count(*) AS n_demands
FROM scen s JOIN fx_demands d ON s.Demand_ID = d.demand_id GROUP BY d.segment"""
    q["selection_quality"] = p + """, se AS (SELECT Model_Selected_Cost - Oracle_Cost AS e FROM scen),
cnt AS (SELECT CAST(count_if(e = 0) AS BIGINT) AS perfect, CAST(count_if(e <= 1 AND e <> 0) AS BIGINT) AS near_perfect,
               CAST(count_if(e > 1) AS BIGINT) AS suboptimal, count(*) AS total FROM se)
SELECT 'perfect' AS category, perfect AS n_demands, round(perfect * 100.0 / total, 6) AS pct FROM cnt
UNION ALL SELECT 'near_perfect', near_perfect, round(near_perfect * 100.0 / total, 6) FROM cnt
UNION ALL SELECT 'suboptimal', suboptimal, round(suboptimal * 100.0 / total, 6) FROM cnt"""
    q["cumulative_rmse"] = p + """, se AS (SELECT Demand_ID, Model_Selected_Cost - Oracle_Cost AS e FROM scen
  WHERE Model_Selected_Cost IS NOT NULL),
f AS (SELECT CAST(row_number() OVER (ORDER BY Demand_ID) AS INTEGER) AS Fold, e FROM se)
SELECT Fold, round(e, 6) AS Selection_Error,
  round(sqrt(sum(e * e) OVER (ORDER BY Fold ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / Fold), 6)
  AS cumulative_rmse FROM f"""
    board = "SELECT combo_idx, round(mean_rmse, 6) AS mean_rmse, round(std_rmse, 6) AS std_rmse, n_folds, rank FROM board"
    q["leaderboard_rank"] = p + board
    q["leaderboard_top10"] = p + board + " WHERE rank <= 10"
    q["best_combo"] = p + ("SELECT combo_idx, round(mean_rmse, 6) AS mean_rmse, round(std_rmse, 6) AS std_rmse "
                           "FROM board WHERE rank = 1")
    q["improvement_pct"] = p + _two_pred_errors() + """,
r AS (SELECT model, evaluation, sqrt(avg(e * e)) AS rmse FROM errs GROUP BY 1, 2)
SELECT b.evaluation, round(b.rmse, 6) AS baseline_rmse, round(o.rmse, 6) AS optimized_rmse,
  round(CASE WHEN b.rmse <> 0 THEN (b.rmse - o.rmse) * 100.0 / b.rmse END, 6) AS improvement_pct
FROM r b JOIN r o ON b.evaluation = o.evaluation AND b.model = 'baseline' AND o.model = 'optimized'"""
    q["model_comparison"] = p + _two_pred_errors() + """,
st AS (SELECT model, evaluation, coalesce(avg(e), 0) AS mean, coalesce(median(e), 0) AS median,
         coalesce(stddev_pop(e), 0) AS std, coalesce(min(e), 0) AS min, coalesce(max(e), 0) AS max,
         coalesce(sqrt(avg(e * e)), 0) AS rmse, CAST(count(e) AS DOUBLE) AS count
       FROM errs WHERE e IS NOT NULL GROUP BY 1, 2),
lng AS (UNPIVOT st ON mean, median, std, min, max, rmse, count INTO NAME metric VALUE value),
imp AS (SELECT 'improvement' AS model, b.evaluation, 'rmse_improvement_pct' AS metric,
          CASE WHEN b.rmse <> 0 THEN (b.rmse - o.rmse) * 100.0 / b.rmse END AS value
        FROM st b JOIN st o ON b.evaluation = o.evaluation AND b.model = 'baseline' AND o.model = 'optimized')
SELECT model, evaluation, metric, round(value, 6) AS value FROM lng
UNION ALL SELECT model, evaluation, metric, round(value, 6) FROM imp"""
    q["plant_performance"] = p + """SELECT plant_id, round(avg(cost), 6) AS mean_cost, round(median(cost), 6) AS median_cost,
  round(stddev_samp(cost), 6) AS std_cost, count(cost) AS n_costs
FROM fx_costs WHERE plant_id IS NOT NULL GROUP BY plant_id"""
    q["cheapest_plants"] = p + """, perf AS (SELECT plant_id, avg(cost) AS mean_cost, median(cost) AS median_cost,
  stddev_samp(cost) AS std_cost, count(cost) AS n_costs FROM fx_costs WHERE plant_id IS NOT NULL GROUP BY plant_id)
SELECT plant_id, round(mean_cost, 6) AS mean_cost, round(median_cost, 6) AS median_cost,
  round(std_cost, 6) AS std_cost, n_costs
FROM perf WHERE median_cost IS NOT NULL ORDER BY median_cost, plant_id LIMIT 10"""
    q["boxplot_stats"] = p + """, perf AS (SELECT plant_id, median(cost) AS m FROM fx_costs
  WHERE plant_id IS NOT NULL GROUP BY plant_id),
top AS (SELECT plant_id FROM perf WHERE m IS NOT NULL ORDER BY m, plant_id LIMIT 10),
rows_ AS (SELECT plant_id, cost FROM fx_costs WHERE cost IS NOT NULL AND plant_id IN (SELECT plant_id FROM top)),
q AS (SELECT plant_id, quantile_cont(cost, 0.25) AS q1, quantile_cont(cost, 0.5) AS median_cost,
        quantile_cont(cost, 0.75) AS q3 FROM rows_ GROUP BY plant_id),
fz AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT r.plant_id, round(fz.q1, 6) AS q1, round(fz.median_cost, 6) AS median_cost, round(fz.q3, 6) AS q3,
  round(min(CASE WHEN cost >= lo AND cost <= hi THEN cost END), 6) AS whisker_low,
  round(max(CASE WHEN cost >= lo AND cost <= hi THEN cost END), 6) AS whisker_high,
  CAST(count_if(NOT (cost >= lo AND cost <= hi)) AS BIGINT) AS n_outliers, count(cost) AS n_costs
FROM rows_ r JOIN fz ON r.plant_id = fz.plant_id
GROUP BY r.plant_id, fz.q1, fz.median_cost, fz.q3"""
    q["cost_histogram"] = p + _hist("fx_costs", "cost", 50)
    q["regret_histogram"] = p + ", se AS (SELECT Model_Selected_Cost - Oracle_Cost AS e FROM scen)" + _hist("se", "e", 30)
    q["residual_histogram"] = p + (", res AS (SELECT prediction - Cost AS residual FROM pred "
                                   "WHERE prediction IS NOT NULL)" + _hist("res", "residual", 50))
    q["prediction_pairs_bounds"] = p + """SELECT round(least(min(Cost), min(prediction)), 6) AS lo,
  round(greatest(max(Cost), max(prediction)), 6) AS hi, count(*) AS n_pairs,
  round(avg(Cost), 6) AS mean_actual, round(avg(prediction), 6) AS mean_predicted
FROM pred WHERE prediction IS NOT NULL"""
    q["position_lookup"] = p + """, pl AS (SELECT plant_id, row_number() OVER (ORDER BY plant_id) - 1 AS pos,
  count(*) OVER () AS n FROM fx_plants),
d AS (SELECT demand_id, CASE WHEN DF3 > 0 THEN DF1 / 100 END AS raw_prediction FROM fx_demands)
SELECT d.demand_id, round(d.raw_prediction, 6) AS raw_prediction, pl.plant_id AS selected_plant
FROM d LEFT JOIN pl ON d.raw_prediction IS NOT NULL
  AND pl.pos = greatest(0, least(CAST(round_even(d.raw_prediction, 0) AS BIGINT), pl.n - 1))"""
    q["serve_best_plant"] = p + f""", ds AS (SELECT demand_id, {SERVE_D} AS dscore FROM d_std),
ps AS (SELECT plant_id, region, {SERVE_P} AS pscore FROM p_std WHERE ({SERVE_P}) IS NOT NULL),
pairs AS (SELECT demand_id, plant_id, region, dscore + pscore AS pr FROM ds, ps)
SELECT demand_id, arg_min(plant_id, (pr, plant_id)) AS selected_plant, arg_min(region, (pr, plant_id)) AS region,
  round(min(pr), 6) AS raw_prediction, 8 AS feature_count
FROM pairs GROUP BY demand_id"""
    q["serve_best_plant_trees"] = p + """, pairs AS (
  SELECT demand_id, plant_id, region,
    CASE WHEN DF1 <= 3000 THEN CASE WHEN PF1 <= 4000 THEN 10 ELSE 14 END ELSE CASE WHEN PF3 <= 25.5 THEN 9 ELSE 13 END END
    + 0.5::DOUBLE * CASE WHEN PF1 <= 1000 THEN CASE WHEN DF3 <= 9 THEN 3 ELSE 7 END ELSE CASE WHEN PF1 <= 7000 THEN 5 ELSE 2 END END
    + 0.25::DOUBLE * CASE WHEN DF2 <= 150000 THEN CASE WHEN PF4 <= 0.05 THEN 1 ELSE 4 END ELSE CASE WHEN PF3 <= 25.4 THEN 6 ELSE 2.5 END END
    + 0.1::DOUBLE * CASE WHEN PF3 <= 25.6 THEN 0.5 ELSE 1.25 END AS pr
  FROM fx_demands, fx_plants
  WHERE DF1 IS NOT NULL AND DF2 IS NOT NULL AND DF3 IS NOT NULL AND PF1 IS NOT NULL AND PF3 IS NOT NULL AND PF4 IS NOT NULL),
picks AS (SELECT demand_id, arg_min(plant_id, (pr, plant_id)) AS selected_plant, arg_min(region, (pr, plant_id)) AS region,
  round(min(pr), 6) AS raw_prediction FROM pairs GROUP BY demand_id)
SELECT demand_id, selected_plant, region, raw_prediction FROM fx_demands LEFT JOIN picks USING (demand_id)"""
    q["serve_pair_cost"] = p + f"""SELECT c.demand_id, c.plant_id, round({SERVE_ALL}, 6) AS prediction
FROM fx_costs c JOIN d_std d ON c.demand_id = d.demand_id JOIN p_std p ON c.plant_id = p.plant_id"""
    pairs = """, pp AS (SELECT * FROM pred WHERE prediction IS NOT NULL),
b AS (SELECT least(min(Cost), min(prediction)) AS lo, greatest(max(Cost), max(prediction)) AS hi FROM pp)
"""
    cell = "CAST(least(greatest(floor(({0} - lo) / (hi - lo) * 50), 0), 49) AS INTEGER)"
    q["prediction_density"] = p + pairs + f"""SELECT bin_actual, bin_predicted, n_pairs, round(lo + bin_actual * ((hi - lo) / 50), 6) AS actual_from,
  round(lo + bin_predicted * ((hi - lo) / 50), 6) AS predicted_from
FROM (SELECT {cell.format("Cost")} AS bin_actual, {cell.format("prediction")} AS bin_predicted, count(*) AS n_pairs FROM pp, b GROUP BY 1, 2), b"""
    q["prediction_sample"] = p + pairs + """SELECT Demand_ID, Plant_ID, round(Cost, 6) AS Cost, round(prediction, 6) AS prediction
FROM pp ORDER BY md5(Demand_ID || '|' || Plant_ID || ':0'), Demand_ID, Plant_ID LIMIT 200"""
    q["set_overlap"] = """SELECT count_if(t) AS n_true, count_if(f) AS n_false, count(*) AS n_union, count_if(t AND f) AS n_both, count_if(t AND NOT f) AS n_only_true
FROM (SELECT l_partkey, bool_or(l_returnflag = 'R') AS t, bool_or(l_returnflag <> 'R') AS f FROM lineitem GROUP BY l_partkey)"""
    q["set_overlap"] = "SELECT " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("n_true", "n_false", "n_union", "n_both", "n_only_true")) + " FROM (" + q["set_overlap"] + ")"
    q["set_overlap_sketch"] = q["set_overlap"]
    q["demands_per_plant_sketch"] = p + """SELECT plant_id, count(DISTINCT demand_id) AS n_keys, (SELECT count(DISTINCT demand_id) FROM fx_costs) AS n_total
FROM fx_costs GROUP BY plant_id"""
    q["preprocessor_round_trip"], q["scenario_round_trip"], q["model_round_trip"] = q["filter_plants"], q["scenario_table"], q["serve_pair_cost"]
    q["group_gram"] = p + _gram_select()
    refit = "WITH " + BASE + """c AS (SELECT demand_id, plant_id, cost FROM fx_costs WHERE cost IS NOT NULL),
own AS (SELECT a.demand_id, a.plant_id, median(b.cost) AS m FROM c a LEFT JOIN c b ON a.plant_id = b.plant_id AND a.demand_id <> b.demand_id
  GROUP BY a.demand_id, a.plant_id),
med AS (SELECT plant_id, median(cost) AS m FROM c GROUP BY plant_id),
fold_med AS (SELECT d.demand_id, med.plant_id, own.demand_id IS NOT NULL AS held, CASE WHEN own.demand_id IS NULL THEN med.m ELSE own.m END AS m
  FROM fx_demands d CROSS JOIN med LEFT JOIN own ON own.demand_id = d.demand_id AND own.plant_id = med.plant_id),
cut AS (SELECT demand_id, quantile_cont(m, 0.75) AS threshold FROM fold_med GROUP BY demand_id)
"""
    scale = ", ".join(f"avg(o.{c}) AS a_{c}, var_pop(o.{c}) * count(o.{c}) / count(*) AS v_{c}" for c in DF)
    q["fold_parameters"] = refit + f""", par AS (SELECT d.demand_id, {scale} FROM fx_demands d JOIN fx_demands o ON o.demand_id <> d.demand_id GROUP BY d.demand_id)
SELECT demand_id, {", ".join(f"round(a_{c}, 6) AS {c}__mean, round(sqrt(v_{c}), 6) AS {c}__std" for c in DF)}, round(threshold, 6) AS threshold
FROM par JOIN cut USING (demand_id)"""
    q["fold_training_rows"] = refit + f""", fine AS (SELECT plant_id FROM fx_plants WHERE {" AND ".join(f"{c} IS NOT NULL" for c in PF)}),
size AS (SELECT plant_id, count(*) AS n FROM c WHERE demand_id IN (SELECT demand_id FROM fx_demands) AND plant_id IN (SELECT plant_id FROM fine)
  GROUP BY plant_id)
SELECT f.demand_id AS Demand_ID, round(any_value(threshold), 6) AS threshold,
  CAST(coalesce(sum(n - held::INT) FILTER (f.m <= threshold), 0) AS BIGINT) AS n_train,
  CAST(count(*) FILTER (f.m <= threshold AND held AND n IS NOT NULL) AS BIGINT) AS n_held_out
FROM fold_med f JOIN cut USING (demand_id) LEFT JOIN size USING (plant_id) GROUP BY f.demand_id"""
    return q
