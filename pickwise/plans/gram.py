"""Lasso through sufficient statistics.

For rows ``(x, y)`` the statistics ``n, sum x, sum y, sum x x', sum x y,
sum y^2`` add up over rows. Over a whole table they are plain ``sum`` aggregates;
per group the rows are dealt by group (a large group is split), sorted, and
summed in Arrow tables, so that one row per group is shuffled again, not one
wide row per group and task. So

* one aggregate over the training rows gives the whole training system;
* one ``groupBy(group)`` gives every group's share, and *total minus share*
  is the exact system of a leave-one-group-out fold - no refit over the data
  per fold, and the work per fold does not grow with the number of rows.

The Lasso objective (scikit-learn's, with intercept) is
``1/(2n) ||y - b - X w||^2 + alpha ||w||_1``; on centred statistics
(``G = X'X - n xbar xbar'``, ``c = X'y - n xbar ybar``) coordinate descent
needs only ``G`` and ``c`` (p x p numbers), solved with numpy inside the tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stat_columns(p: int) -> list[str]:
    cols = ["n", "sy", "syy"] + [f"sx_{i}" for i in range(p)] + [f"sxy_{i}" for i in range(p)]
    cols += [f"sxx_{i}_{j}" for i in range(p) for j in range(i, p)]
    return cols


def stat_products(features: list[str], label: str, weight: Column) -> list[Column]:
    """What a row adds to each of ``stat_columns``, times its weight."""
    x, y, p = [F.col(f).cast("double") for f in features], F.col(label).cast("double"), len(features)
    return [c * weight for c in [F.lit(1.0), y, y * y, *x, *[v * y for v in x], *[x[i] * x[j] for i in range(p) for j in range(i, p)]]]


def widened(x: list[Column], sums: list[Column], p: int) -> list[Column]:
    """``stat_columns`` of x and p more features over rows that share x, from the rows' ``stat_columns`` of the p features."""
    n, sy, syy, sx, sxy, k = *sums[:3], sums[3:3 + p], sums[3 + p:3 + 2 * p], len(x)
    squares = {(i, j): sums[3 + 2 * p + at] for at, (i, j) in enumerate((i, j) for i in range(p) for j in range(i, p))}
    cross = [x[i] * x[j] * n if j < k else x[i] * sx[j - k] if i < k else squares[i - k, j - k] for i in range(k + p) for j in range(i, k + p)]
    return [n, sy, syy, *[v * n for v in x], *sx, *[v * sy for v in x], *sxy, *cross]


def stat_aggs(features: list[str], label: str) -> list[Column]:
    x = [F.col(f).cast("double") for f in features]
    y = F.col(label).cast("double")
    p = len(features)
    aggs = [F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(x[i]).alias(f"sx_{i}") for i in range(p)]
    aggs += [F.sum(x[i] * y).alias(f"sxy_{i}") for i in range(p)]
    aggs += [F.sum(x[i] * x[j]).alias(f"sxx_{i}_{j}") for i in range(p) for j in range(i, p)]
    return aggs


def gram_stats(df: DataFrame, features: list[str], label: str, group: str | None = None) -> DataFrame:
    """The statistics, over all rows or per ``group`` (one row per group)."""
    if not group:
        return df.agg(*stat_aggs(features, label))
    return sum_by_key(gram_parts(df, features, label, group), group)


#: Rows whose products one Arrow table holds (32,768 rows with 78 statistics: 20 MB).
CHUNK = 32_768


def _chunks(batches):
    """Arrow tables of at least CHUNK rows (the last: the rest) from record batches."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= CHUNK:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _running_sums(tables, key: str, columns: list[str]):
    """Sums per key of tables in order of the key: a key is given out when the next one begins."""
    last = None
    for t in tables:
        if last is not None:
            t = pa.concat_tables([last, t])
        t = t.group_by([key], use_threads=False).aggregate([(c, "sum") for c in columns])
        t = pa.table({n: t[n if n == key else f"{n}_sum"] for n in [key, *columns]})
        last = t.slice(t.num_rows - 1)
        yield from t.slice(0, t.num_rows - 1).to_batches()
    if last is not None:
        yield from last.to_batches()


def gram_parts(df: DataFrame, features: list[str], label: str, group: str, count: str | None = None,
               dealt: bool = False) -> DataFrame:
    """Statistics per group and task: the rows are dealt by group (adaptive execution splits a large one; not
    again if they are ``dealt``) and sorted, and sums are run over Arrow tables. ``count`` names one
    more column, the number of rows."""
    p = len(features)
    names = stat_columns(p) + ([count] if count else [])

    def products(t):
        x = [t[f"x{i}"] for i in range(p)]
        one, y = pa.array(np.ones(t.num_rows)), t["y"]
        cols = [one, y, pc.multiply(y, y), *x, *[pc.multiply(v, y) for v in x], *[pc.multiply(x[i], x[j]) for i in range(p) for j in range(i, p)]]
        return pa.table(dict(zip([group, *names], [t[group], *cols, *([one] if count else [])])))

    def run(batches):
        return _running_sums((products(t) for t in _chunks(batches)), group, names)

    kind = df.schema[group].dataType.simpleString()
    rows = df.select(group, F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    rows = rows if dealt else rows.hint("rebalance", F.col(group))
    return rows.sortWithinPartitions(group).mapInArrow(run, f"`{group}` {kind}, " + ", ".join(f"`{c}` double" for c in names))


def sum_by_key(parts: DataFrame, key: str) -> DataFrame:
    """One row per key with the sums of all other columns (doubles)."""
    columns = [c for c in parts.columns if c != key]

    def run(batches):
        return _running_sums(_chunks(batches), key, columns)

    return parts.repartition(key).sortWithinPartitions(key).mapInArrow(run, parts.schema)


def unpack(values: dict, p: int):
    """Statistics (mapping name -> number) to (n, sx, sy, Sxx, sxy, syy)."""
    n = float(values["n"])
    sx = np.array([values[f"sx_{i}"] for i in range(p)], dtype=np.float64)
    sxy = np.array([values[f"sxy_{i}"] for i in range(p)], dtype=np.float64)
    sxx = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            sxx[i, j] = sxx[j, i] = values[f"sxx_{i}_{j}"]
    return n, sx, float(values["sy"]), sxx, sxy, float(values["syy"])


def lasso_cd(gram: np.ndarray, corr: np.ndarray, n: float, alpha: float, w0: np.ndarray | None = None,
             max_iter: int = 10_000, tol: float = 1e-12) -> tuple[np.ndarray, int]:
    """Coordinate descent on centred statistics; returns (w, sweeps)."""
    p = gram.shape[0]
    w = np.zeros(p) if w0 is None else w0.copy()
    gw = gram @ w
    thr = n * alpha
    diag = np.diag(gram)
    for sweep in range(1, max_iter + 1):
        max_dw, max_w = 0.0, 0.0
        for j in range(p):
            if diag[j] <= 0.0:
                continue
            old = w[j]
            rho = corr[j] - gw[j] + diag[j] * old
            new = np.sign(rho) * max(abs(rho) - thr, 0.0) / diag[j]
            if new != old:
                gw += gram[:, j] * (new - old)
                w[j] = new
            max_dw = max(max_dw, abs(new - old))
            max_w = max(max_w, abs(new))
        if max_w == 0.0 or max_dw <= tol * max_w:
            return w, sweep
    return w, max_iter


def solve_lasso(n, sx, sy, sxx, sxy, alphas, max_iter=10_000, tol=1e-12):
    """Lasso fits for every alpha (warm-started from the largest alpha down).
    Returns {alpha: (intercept, w)}; a system without rows gives nothing."""
    if n <= 0:
        return {}
    xbar, ybar = sx / n, sy / n
    gram = sxx - n * np.outer(xbar, xbar)
    corr = sxy - n * xbar * ybar
    out, w = {}, None
    for a in sorted(alphas, reverse=True):
        w, _ = lasso_cd(gram, corr, n, float(a), w, max_iter, tol)
        out[a] = (float(ybar - xbar @ w), w.copy())
    return out


def total_stats(df: DataFrame, features: list[str], label: str) -> dict:
    """One aggregate job; brings (p+1)(p+2)/2 + p numbers to the driver."""
    return gram_stats(df, features, label).first().asDict()


def lasso_cd_batch(gram: np.ndarray, corr: np.ndarray, n: np.ndarray, alpha: float,
                   w0: np.ndarray | None = None, max_iter: int = 10_000, tol: float = 1e-12) -> np.ndarray:
    """Coordinate descent for a batch of systems at once: ``gram`` (B, p, p),
    ``corr`` (B, p), ``n`` (B,). Same updates as ``lasso_cd``; sweeps stop when
    every system has converged."""
    b, p = corr.shape
    w = np.zeros((b, p)) if w0 is None else w0.copy()
    # The systems that have not converged, moved together after every sweep that ends some.
    todo, g, c, x = np.arange(b), gram, corr, w.copy()
    gx = np.einsum("bij,bj->bi", g, x)
    diag, thr = np.diagonal(gram, axis1=1, axis2=2), n * alpha
    for _ in range(max_iter):
        if todo.size == 0:
            break
        max_dw, max_w = np.zeros(todo.size), np.zeros(todo.size)
        for j in range(p):
            d, old = diag[:, j], x[:, j].copy()
            rho = c[:, j] - gx[:, j] + d * old
            safe = np.where(d > 0, d, 1.0)
            new = np.where(d > 0, np.sign(rho) * np.maximum(np.abs(rho) - thr, 0.0) / safe, 0.0)
            delta = new - old
            gx += g[:, :, j] * delta[:, None]
            x[:, j] = new
            max_dw = np.maximum(max_dw, np.abs(delta))
            max_w = np.maximum(max_w, np.abs(new))
        done = (max_w == 0.0) | (max_dw <= tol * max_w)
        if done.any():
            w[todo[done]] = x[done]
            left = ~done
            todo, g, c, x, gx, diag, thr = (v[left] for v in (todo, g, c, x, gx, diag, thr))
    w[todo] = x
    return w


def fold_solutions(group_stats: DataFrame, totals: dict, p: int, alphas: list[float], group: str = "Group",
                   fold: str = "Fold", max_iter: int = 10_000, tol: float = 1e-12) -> DataFrame:
    """For every fold row (``fold``, ``group`` + that group's statistics):
    solve the fold's system = totals - group share, for every alpha.
    Runs per partition on Arrow batches, all folds of a batch solved together
    (vectorised coordinate descent, started from the whole table's solution,
    from which a fold's differs little); output one row per (fold, alpha)."""
    t = unpack(totals, p)
    sxx_cols = [(i, j) for i in range(p) for j in range(i, p)]
    gtype = group_stats.schema[group].dataType.simpleString()
    order = sorted((float(a) for a in alphas), reverse=True)
    whole = solve_lasso(t[0], t[1], t[2], t[3], t[4], order, max_iter, tol)

    def solve(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            n = t[0] - pdf["n"].to_numpy(dtype=np.float64)
            sx = t[1][None, :] - pdf[[f"sx_{i}" for i in range(p)]].to_numpy(dtype=np.float64)
            sy = t[2] - pdf["sy"].to_numpy(dtype=np.float64)
            sxy = t[4][None, :] - pdf[[f"sxy_{i}" for i in range(p)]].to_numpy(dtype=np.float64)
            sxx = np.repeat(t[3][None, :, :], len(pdf), axis=0)
            for i, j in sxx_cols:
                v = pdf[f"sxx_{i}_{j}"].to_numpy(dtype=np.float64)
                sxx[:, i, j] -= v
                if i != j:
                    sxx[:, j, i] -= v
            keep = n > 0
            safe_n = np.where(keep, n, 1.0)
            xbar, ybar = sx / safe_n[:, None], sy / safe_n
            gram = sxx - safe_n[:, None, None] * np.einsum("bi,bj->bij", xbar, xbar)
            corr = sxy - safe_n[:, None] * xbar * ybar[:, None]
            out = []
            for a in order:
                w = lasso_cd_batch(gram, corr, safe_n, a, np.repeat(whole[a][1][None, :], len(pdf), axis=0), max_iter, tol)
                intercept = ybar - np.einsum("bi,bi->b", xbar, w)
                part = pd.DataFrame({fold: pdf[fold].to_numpy(), group: pdf[group].to_numpy(),
                                     "alpha": a, "intercept": intercept, "coef": list(w.copy())})
                out.append(part[keep])
            yield pd.concat(out, ignore_index=True)

    schema = f"{fold} int, {group} {gtype}, alpha double, intercept double, coef array<double>"
    cols = [fold, group] + stat_columns(p)
    return group_stats.select(*cols).mapInPandas(solve, schema)


def linear_prediction(features: list[str], intercept: Column, coef: Column) -> Column:
    """``intercept + sum_i coef[i] * x_i`` as one JVM expression."""
    expr = intercept
    for i, f in enumerate(features):
        expr = expr + coef.getItem(i) * F.col(f).cast("double")
    return expr
