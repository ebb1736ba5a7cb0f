"""Exact order statistics per group by bracketed selection: no sort of the
rows, and no group held by one task.

1. One partially aggregated pass gives every group its count and a mergeable
   quantile sketch of fixed size (KLL). The sketch brackets each wanted
   quantile: two values between which it almost surely lies.
2. A second pass turns rows into cells: a value inside a bracket is its own
   cell, all values between two brackets share one. Cells are counted, with
   partial aggregation, so copies of a value are one cell.
3. Running counts over a group's cells give the value at every wanted rank.
   A group with more than ``CELLS`` cells is first cut at pivots (a
   sketch of its cells) into segments, of which only those that hold a wanted
   rank are kept, again until they are small.
4. If a sketch missed (the rank falls between brackets), the values of
   that gap become cells and step 3 runs for them. So the sketch decides how
   much is counted, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .reuse import beside, materialize, reusable

#: Size of the sketches, and half the width of a bracket as a share of the group: some
#: three times the rank error of a sketch of this size.
SKETCH_K, MARGIN = 400, 0.02
#: Cells that one window may order; pivots that cut a larger group.
CELLS, PIVOTS = 20_000, 63


def _sketch(value: str, k: int) -> Column:
    return F.expr(f"kll_sketch_agg_double({value}, {k})")


def _cell(pairs: list[tuple[Column, Column]]) -> Column:
    """Struct (v, gap): the value itself inside a bracket, else the end of the
    last bracket below it (null below all) and gap = true."""
    v = F.col("__v")
    inside = F.lit(False)
    for a, b in pairs:
        inside = inside | ((v >= a) & (v <= b))
    ends = [F.when(b < v, b) for _, b in pairs]
    last = F.greatest(*ends) if len(ends) > 1 else ends[0]
    return F.struct(F.when(inside, v).otherwise(last).alias("v"), (~inside).alias("gap"))


def _pick(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """tag, v, gap and off (rank inside the cell) of every wanted rank."""
    before = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first(), "gap")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cells.withColumn("before", before)
    hit = (F.col("r") >= F.col("before")) & (F.col("r") < F.col("before") + F.col("n"))
    return placed.join(wanted.hint("rebalance"), "g").filter(hit).select("tag", "v", "gap", (F.col("r") - F.col("before")).alias("off"))


def order_statistics(cells: DataFrame, wanted: DataFrame, limit: int = CELLS, k: int = SKETCH_K) -> DataFrame:
    """The cell (tag, v, gap, off) at each wanted rank. ``cells``: g, v, gap, n
    (one row per cell); ``wanted``: g, tag, r (0-based rank in the group)."""
    big = cells.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > limit).select("g")
    if big.isEmpty():
        return _pick(cells, wanted)
    big = materialize(big)
    few = _pick(cells.join(big.hint("rebalance"), "g", "left_anti"), wanted)
    ranks = ", ".join(f"{i / (PIVOTS + 1)}d" for i in range(1, PIVOTS + 1))
    low = F.coalesce("v", F.lit(float("-inf")))
    hot = cells.join(big.hint("rebalance"), "g", "left_semi").withColumn("low", low)
    pivots = hot.groupBy("g").agg(_sketch("low", k).alias("s")).select(
        "g", F.expr(f"array_distinct(kll_sketch_get_quantile_double(s, array({ranks})))").alias("pivots"))
    seg = F.size(F.filter("pivots", lambda p: p < F.col("low")))
    parts = materialize(hot.join(pivots.hint("rebalance"), "g").select("g", seg.alias("seg"), "v", "gap", "n"))
    sums = parts.groupBy("g", "seg").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("g").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    hit = (F.col("r") >= F.col("before")) & (F.col("r") < F.col("before") + F.col("n"))
    deeper = F.struct("g", "seg").alias("g")
    next_wanted = materialize(sums.join(wanted.hint("rebalance"), "g").filter(hit).select(deeper, "tag", (F.col("r") - F.col("before")).alias("r")))
    rest = parts.select(deeper, "v", "gap", "n").join(next_wanted.select("g").distinct().hint("rebalance"), "g", "left_semi")
    return few.unionByName(order_statistics(rest, next_wanted, limit, k))


def _found(df: DataFrame, keys: list[str], value: str, qs: list[float], targets: Column, limit: int, k: int,
           margin: float) -> DataFrame | None:
    """tag (g, n, name, side, frac) and v of every wanted rank that exists. ``targets``: an array of
    structs (name, side, frac, r) in terms of the group's count n; r should lie near one of ``qs``."""
    rows = reusable(df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull()))
    key = F.struct(*[F.col(c) for c in keys]) if keys else F.struct(F.lit(0).alias("__all"))
    rows = rows.select(key.alias("g"), "__v")
    # The sketch gives the values at q - margin and q + margin; a small group is one bracket.
    around = ", ".join(f"{min(max(q + d, 0.0), 1.0)!r}d" for q in qs for d in (-margin, margin))
    stats = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), _sketch("__v", k).alias("s")).select(
        "g", "n", F.expr(f"kll_sketch_get_quantile_double(s, array({around}))").alias("at"))
    edges = []
    for i, q in enumerate(qs):
        whole = F.col("n") * max(margin, 1e-9) < 4
        edges.append(F.when(whole | (q - margin <= 0), float("-inf")).otherwise(F.col("at")[2 * i]).alias(f"a{i}"))
        edges.append(F.when(whole | (q + margin >= 1), float("inf")).otherwise(F.col("at")[2 * i + 1]).alias(f"b{i}"))
    stats = materialize(stats.select("g", "n", *edges))
    if keys:
        pairs = [(F.col(f"a{i}"), F.col(f"b{i}")) for i in range(len(qs))]
        marked = rows.join(beside(stats.drop("n")), "g").select("g", "__v", _cell(pairs).alias("c"))
    else:
        one = stats.first()      # one row of bracket ends
        if one is None:
            return None
        marked = rows.select("g", "__v", _cell([(F.lit(one[f"a{i}"]), F.lit(one[f"b{i}"])) for i in range(len(qs))]).alias("c"))
    cells = materialize(marked.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n")).select("g", "c.*", "n"))
    wanted = stats.select("g", "n", F.explode(targets).alias("t")).filter("t.r >= 0 and t.r < n").select(
        "g", F.struct("g", "n", "t.name", "t.side", "t.frac").alias("tag"), F.col("t.r").alias("r"))
    found = materialize(order_statistics(cells, wanted, limit, k))
    missed = found.filter("gap")
    if missed.isEmpty():
        return found
    # The values of the gaps that hold a rank; g is now group and gap.
    inner = missed.select(F.struct("tag.g", F.col("v").alias("last")).alias("g"), "tag", F.col("off").alias("r"))
    values = marked.filter("c.gap").select(F.struct("g", F.col("c.v").alias("last")).alias("g"), F.col("__v").alias("v"))
    values = values.join(inner.select("g").distinct().hint("rebalance"), "g", "left_semi").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    again = order_statistics(materialize(values.select("g", "v", F.lit(False).alias("gap"), "n")), inner, limit, k)
    return found.filter("not gap").unionByName(again)


def selected_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float], limit: int = CELLS,
                       k: int = SKETCH_K, margin: float = MARGIN) -> DataFrame:
    """One row per group with one column per ``name -> q`` (linear
    interpolation); null values are skipped, null keys are a group."""
    names = list(qs)
    targets = []
    for name, q in qs.items():
        rank = (F.col("n") - 1).cast("double") * F.lit(float(q))
        for side, r in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            targets.append(F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), (rank - F.floor(rank)).alias("frac"), r.alias("r")))
    found = _found(df, keys, value, list(qs.values()), F.array(*targets), limit, k, margin)
    if found is None:
        return df.sparkSession.createDataFrame([], ", ".join(f"`{n}` double" for n in names))
    value_of = {s: F.max(F.when(F.col("tag.side") == s, F.col("v"))) for s in ("lo", "hi")}
    pair = found.groupBy(F.col("tag.g").alias("g"), F.col("tag.name").alias("name")).agg(
        value_of["lo"].alias("lo"), value_of["hi"].alias("hi"), F.max("tag.frac").alias("frac"))
    interp = pair.select("g", "name", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("q"))
    out = interp.groupBy("g").agg(*[F.max(F.when(F.col("name") == n, F.col("q"))).alias(n) for n in names])
    return out.select(*[F.col("g")[c].alias(c) for c in keys], *names)


def middle_values(df: DataFrame, keys: list[str], value: str, limit: int = CELLS, k: int = SKETCH_K,
                  margin: float = MARGIN) -> DataFrame:
    """One row per group of ``keys``: n, the number of non-null values, ``at``, the (lower) middle one in
    order, and ``below`` and ``above``, its neighbours in order (null where there is none). They
    tell the group's median, and the median without any one of its values."""
    mid = F.floor((F.col("n") - 1) / 2)
    targets = [F.struct(F.lit("m").alias("name"), F.lit(side).alias("side"), F.lit(0.0).alias("frac"), (mid + step).alias("r"))
               for side, step in (("below", -1), ("at", 0), ("above", 1))]
    found = _found(df, keys, value, [0.5], F.array(*targets), limit, k, margin)
    out = found.groupBy("tag.g").agg(F.max("tag.n").alias("n"), *[F.max(F.when(F.col("tag.side") == s, F.col("v"))).alias(s)
                                                                 for s in ("below", "at", "above")])
    return out.select(*[F.col("g")[c].alias(c) for c in keys], "n", "below", "at", "above")
