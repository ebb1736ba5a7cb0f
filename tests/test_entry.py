import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as se  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())


def test_entry_runs_on_smallest_tables(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Demand_ID", "Model_Selected_Plant", "Oracle_Selected_Plant", "Model_Selected_Cost",
                          "Oracle_Cost", "Selection_Error"]
    assert all(r.Selection_Error is None or r.Selection_Error >= 0 for r in rows)


def test_scenario_query_and_oracle_agree_at_sf0001(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("customer", "supplier", "orders", "lineitem", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("scenario_table", "plant_cost_stats", "serve_best_plant"):
        spark_rows = sorted(tuple(r) for r in se.queries()[name](spark, SF).collect())
        duck = con.execute(se.oracle_sql()[name])
        cols = [d[0] for d in duck.description]
        sdf_cols = se.queries()[name](spark, SF).columns
        assert sorted(cols) == sorted(sdf_cols)
        order = [cols.index(c) for c in sdf_cols]
        duck_rows = sorted(tuple(r[i] for i in order) for r in duck.fetchall())
        assert spark_rows == duck_rows, name
