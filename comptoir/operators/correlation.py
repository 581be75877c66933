"""Correlation in long form ``(column1, column2, correlation)`` over pairwise-complete rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from comptoir.functions.columns import nan_to_null, numeric_columns, ref
from comptoir.operators import order
from comptoir.operators.order import distinct_estimates, fits_one_sort, fits_one_task, value_ranks
from comptoir.session import ensure_checkpoint_dir

_LONG = "column1 string, column2 string, correlation double"
_PAIRS_PER_TASK = 1_000_000  # distinct (x, y) pairs that one task of the Kendall count should hold
_CELLS = 4_000_000  # grid cells (distinct x times distinct y) that may be counted in one piece
_RANK_BYTES = 512  # of a value and its rank, on the driver and in a hashed table of every executor
_STRIPES = 999  # twice as many lanes on each side stay within that number of cells


def correlation_matrix(df: DataFrame, method: str = "pearson", columns: Sequence[str] | None = None) -> DataFrame:
    """All ordered pairs including the diagonal. NULL where a column is constant or a pair has no common rows."""
    names = numeric_columns(df) if columns is None else list(columns)
    upper = correlation_pairs(df, method, names)
    mirrored = upper.select(F.col("column2").alias("column1"), F.col("column1").alias("column2"), "correlation")
    return upper.unionByName(mirrored.filter(F.col("column1") != F.col("column2")))


def wide_matrix(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row and one column per variable."""
    return long.groupBy("column1").pivot("column2", list(names)).agg(F.first("correlation")).orderBy("column1")


def strong_correlations(
    df: DataFrame, threshold: float = 0.7, method: str = "pearson", columns: Sequence[str] | None = None
) -> DataFrame:
    """Pairs of different columns with ``abs(r) >= threshold``, strongest first."""
    names = numeric_columns(df) if columns is None else list(columns)
    pairs = correlation_pairs(df, method, names).filter(F.col("column1") != F.col("column2"))
    kept = pairs.filter(F.abs("correlation") >= threshold)
    return kept.orderBy(F.abs("correlation").desc(), "column1", "column2")


def correlation_pairs(df: DataFrame, method: str, names: Sequence[str]) -> DataFrame:
    """The upper triangle with the diagonal, in column order; NaN is missing, as NULL."""
    df = nan_to_null(df.select(*[ref(c) for c in names]))
    if method == "pearson":
        return _pearson(df, names)
    if method not in ("spearman", "kendall"):
        raise ValueError(f"unknown method: {method}")
    if not names:
        return df.sparkSession.createDataFrame([], _LONG)
    pairs = list(combinations(names, 2))
    if not pairs:
        return _diagonal(df, names)
    scores = _kendall_pairs(df, names, pairs) if method == "kendall" else _spearman_pairs(df, names, pairs)
    labels = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("column1"), F.lit(b).alias("column2"))
                       for i, (a, b) in enumerate(pairs)])
    named = df.sparkSession.range(1).select(F.inline(labels)).join(F.broadcast(scores), "pair", "left")
    return _diagonal(df, names).unionByName(named.drop("pair"))


def _counted_pairs(df: DataFrame, pairs: dict[int, tuple[str, str]]) -> DataFrame:
    """``pair, x, y, n``: the distinct complete value pairs of the given column pairs, counted in one job.

    The table is used several times, so its lineage is cut here.
    """
    ensure_checkpoint_dir(df.sparkSession)
    structs = [F.struct(F.lit(i).alias("pair"), ref(a).cast("double").alias("x"), ref(b).cast("double").alias("y"))
               for i, (a, b) in pairs.items()]
    long = df.select(F.inline(F.array(*structs))).dropna()
    return long.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("n")).checkpoint()


def _counted_scores(df: DataFrame, pairs: dict[int, tuple[str, str]], at_once: int, score) -> DataFrame:
    """``pair, correlation`` from the counted pairs, so many column pairs at a time: what is stored grows with the columns, not their pairs."""
    found, numbers = [], list(pairs)
    for start in range(0, len(numbers), at_once):
        batch = {i: pairs[i] for i in numbers[start:start + at_once]}
        found += [tuple(r) for r in score(_counted_pairs(df, batch)).collect()]  # one row per column pair
    return df.sparkSession.createDataFrame(found, "pair int, correlation double")


def _kendall_pairs(df: DataFrame, names: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return _counted_scores(df, dict(enumerate(pairs)), len(names), _kendall)


def _spearman_pairs(df: DataFrame, names: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson on average ranks.

    Columns with NULLs in the same rows have one set of complete rows, so each such column is ranked once, its
    ranks are attached to the rows, and one aggregate over the rows gives the moments of all these pairs. Only pairs of
    columns with NULLs in different rows are ranked pair by pair.
    """
    place = {c: i for i, c in enumerate(names)}
    typed = df.select(*[ref(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    facts = typed.agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(names))],
        *[F.count_if(F.col(f"v{place[a]}").isNull() != F.col(f"v{place[b]}").isNull()).alias(f"p{k}") for k, (a, b) in enumerate(pairs)],
    ).first()
    alike = {k: (place[a], place[b]) for k, (a, b) in enumerate(pairs) if facts[f"p{k}"] == 0 and facts[f"n{place[a]}"]}
    unlike = {k: pair for k, pair in enumerate(pairs) if facts[f"p{k}"]}
    parts = []
    if alike:
        parts.append(_rank_moments(typed, alike, {i: facts[f"n{i}"] for i in range(len(names))}))
    if unlike:
        parts.append(_counted_scores(df, unlike, len(names), _spearman))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], "pair int, correlation double")


def _rank_moments(typed: DataFrame, pairs: dict[int, tuple[int, int]], sizes: dict[int, int]) -> DataFrame:
    """``pair, correlation`` of columns v0, v1, .. that have their NULLs in the same rows, pair by pair."""
    used = sorted({i for pair in pairs.values() for i in pair})
    distinct = distinct_estimates(typed, [f"v{i}" for i in used])
    long = typed.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v")) for i in used])))
    ensure_checkpoint_dir(typed.sparkSession)
    ranks = value_ranks(long, "v", ["i"], small=fits_one_task(max(distinct.values())))
    ranks = ranks.select("i", "v", (F.col("before") + (F.col("n") + 1) / 2).alias("r")).checkpoint()
    if sum(distinct.values()) * _RANK_BYTES <= order.BROADCAST_BYTES:
        ranked = typed
        for i in used:
            own = ranks.filter(F.col("i") == i).select(F.col("v").alias(f"v{i}"), F.col("r").alias(f"r{i}"))
            ranked = ranked.join(F.broadcast(own), f"v{i}", "left")  # the size of all of them is checked above
    else:
        rows = typed.withColumn("row", F.monotonically_increasing_id())
        values = rows.select("row", F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v")) for i in used])))
        ranked = values.join(ranks, ["i", "v"]).groupBy("row").agg(*[F.max(F.when(F.col("i") == i, F.col("r"))).alias(f"r{i}") for i in used])
    off = {i: F.col(f"r{i}") - (sizes[i] + 1) / 2 for i in used}
    moments = ranked.agg(
        *[F.sum(off[i] * off[i]).alias(f"s{i}") for i in used], *[F.sum(off[i] * off[j]).alias(f"m{k}") for k, (i, j) in pairs.items()])
    scores = [F.struct(F.lit(k).alias("pair"), F.try_divide(F.col(f"m{k}"), F.sqrt(f"s{i}") * F.sqrt(f"s{j}")).alias("correlation"))
              for k, (i, j) in pairs.items()]
    return moments.select(F.inline(F.array(*scores)))


def _diagonal(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """1 for each column with at least two different values."""
    varied = df.agg(*[(F.min(ref(c)) != F.max(ref(c))).alias(f"v{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("column1"), F.lit(c).alias("column2"),
                     F.when(F.col(f"v{i}"), F.lit(1.0)).alias("correlation")) for i, c in enumerate(names)]
    return varied.select(F.inline(F.array(*rows)))


def _pearson(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every pair in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], _LONG)
    columns: list[Column] = []
    for i, (a, b) in enumerate(pairs):
        x = F.when(ref(b).isNotNull(), ref(a).cast("double"))
        y = F.when(ref(a).isNotNull(), ref(b).cast("double"))
        r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        # Rounding must not carry a pair beyond one; greatest and least would also hide a NULL.
        columns.append(F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias(f"r{i}"))
    rows = [F.struct(F.lit(a).alias("column1"), F.lit(b).alias("column2"),
                     F.when(F.col(f"r{i}").isNotNull(), F.lit(1.0) if a == b else F.col(f"r{i}")).alias("correlation"))
            for i, (a, b) in enumerate(pairs)]
    return df.agg(*columns).select(F.inline(F.array(*rows)))


def _spearman(counted: DataFrame) -> DataFrame:
    """Pearson on average ranks, per column pair; the mean rank is known, so deviations are taken from it."""
    most = counted.groupBy("pair").agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows")).first()[0] or 0
    ranked = _ranked_by_sort(counted) if fits_one_sort(most) else _ranked_by_join(counted)
    middle = counted.groupBy("pair").agg(((F.sum("n") + 1) / 2).alias("middle"))
    ranked = ranked.join(F.broadcast(middle), "pair")  # one row per pair of columns
    dx, dy, n = F.col("rx") - F.col("middle"), F.col("ry") - F.col("middle"), F.col("n")
    spread = F.sqrt(F.sum(n * dx * dx)) * F.sqrt(F.sum(n * dy * dy))
    return ranked.groupBy("pair").agg(F.try_divide(F.sum(n * dx * dy), spread).alias("correlation"))


def _ranked_by_sort(counted: DataFrame) -> DataFrame:
    """Average ranks where one task can sort the value pairs of one column pair."""
    ranks = {}
    for side in ("x", "y"):
        line = W.partitionBy("pair").orderBy(side)
        up_to = F.sum("n").over(line.rangeBetween(W.unboundedPreceding, W.currentRow))
        same = F.sum("n").over(line.rangeBetween(W.currentRow, W.currentRow))
        ranks[f"r{side}"] = up_to - (same - 1) / 2
    return counted.withColumns(ranks)


def _ranked_by_join(counted: DataFrame) -> DataFrame:
    """Average ranks of the distinct values of each side, joined back to the distinct pairs."""
    ranked = counted
    for side in ("x", "y"):
        ranks = value_ranks(counted, side, ["pair"], weight="n")
        ranks = ranks.select("pair", side, (F.col("before") + (F.col("n") + 1) / 2).alias(f"r{side}"))
        ranked = ranked.join(ranks, ["pair", side])
    return ranked


def _kendall(counted: DataFrame) -> DataFrame:
    """Tau-b per column pair: agreeing minus disagreeing pairs of rows over the tie-corrected total."""
    pairs_of = F.col("n").cast("double") * (F.col("n") - 1) / 2
    sums = counted.groupBy("pair").agg(F.sum("n").alias("n")).select("pair", pairs_of.alias("all"))
    for side in ("x", "y"):
        per_value = counted.groupBy("pair", side).agg(F.sum("n").alias("n"))
        sums = sums.join(per_value.groupBy("pair").agg(F.sum(pairs_of).alias(f"t{side}")), "pair")
    balance = _agreement(counted, ["pair"]).groupBy("pair").agg(F.sum("balance").alias("balance"))
    spread = F.sqrt(F.col("all") - F.col("tx")) * F.sqrt(F.col("all") - F.col("ty"))
    return sums.join(balance, "pair").select("pair", F.try_divide("balance", spread).alias("correlation"))


def _agreement(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts ``pair, balance`` of (agreeing - disagreeing) over all pairs of rows with equal keys.

    Both sides are cut into stripes of as many distinct pairs, a value with many pairs being a stripe of
    its own. Two rows in different stripes on both sides compare like their stripes: that part is the
    same problem on the counts per cell. Two rows in one y stripe but different x stripes compare by x
    stripe and y, inside the y stripe; two rows in one x stripe compare inside that. Stripes still too
    large for a task are cut again. No step looks at all pairs of rows.
    """
    keys = list(keys)
    per_key = counted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), (F.count_distinct("x") * F.count_distinct("y")).alias("cells")
    )
    most = per_key.agg(F.max(F.when(F.col("cells") > _CELLS, F.col("rows")))).first()[0] or 0
    if most <= _PAIRS_PER_TASK:
        return _count_inside(counted, keys)
    stripes = min(_STRIPES, -(-most // _PAIRS_PER_TASK) + 1)
    cut = counted
    for side in ("x", "y"):
        # Here a rank counts distinct pairs, so that stripes get equally many of them.
        ranks = value_ranks(counted, side, keys).join(per_key.select(*keys, "rows"), keys)
        width = F.col("rows") / stripes
        lane = F.floor(F.col("before") / width).cast("bigint") * 2 + (F.col("n") > width).cast("bigint")
        cut = cut.join(ranks.select(*keys, side, lane.alias(f"s{side}")), [*keys, side])
    cut = cut.checkpoint()  # used three times below
    cells = cut.groupBy(*keys, F.col("sx").alias("x"), F.col("sy").alias("y")).agg(F.sum("n").alias("n"))
    # An odd stripe holds a single value, so nothing inside it can differ on that side.
    light_y, light_x = cut.filter(F.col("sy") % 2 == 0), cut.filter(F.col("sx") % 2 == 0)
    level = f"stripe{len(keys)}"
    across = light_y.groupBy(*keys, F.col("sy").alias(level), F.col("sx").alias("x"), "y").agg(F.sum("n").alias("n"))
    within = light_x.select(*keys, F.col("sx").alias(level), "x", "y", "n")
    parts = [_count_inside(cells, keys), _agreement(across, [*keys, level]), _agreement(within, [*keys, level])]
    return reduce(DataFrame.unionByName, parts)


def _count_inside(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One task per key; the caller has checked the sizes."""
    schema = T.StructType([T.StructField("pair", T.IntegerType()), T.StructField("balance", T.DoubleType())])

    def count(group: pd.DataFrame) -> pd.DataFrame:
        x, y, n = (group[c].to_numpy() for c in ("x", "y", "n"))
        return pd.DataFrame({"pair": [int(group["pair"].iloc[0])], "balance": [_balance(x, y, n.astype(float))]})

    return df.groupBy(*keys).applyInPandas(count, schema)


def _balance(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """Weighted (agreeing - disagreeing) pairs, by merging halves of the x order bottom up."""
    x = np.unique(x, return_inverse=True)[1]
    y = np.unique(y, return_inverse=True)[1]
    order = np.lexsort((y, x))
    x, y, n = x[order], y[order], n[order]
    total = 0.0
    bits = int(x.max()).bit_length() if len(x) else 0
    # At each bit, pairs whose x agree above the bit and differ in it are compared by y.
    for bit in range(bits):
        block, side = x >> (bit + 1), (x >> bit) & 1
        by_y = np.lexsort((y, block))
        b, s, v, w = block[by_y], side[by_y], y[by_y], n[by_y]
        lower = np.where(s == 0, w, 0.0)
        running = np.cumsum(lower)
        starts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        base = np.repeat(np.r_[0.0, running][starts], np.diff(np.r_[starts, len(b)]))
        ends = np.r_[starts[1:], len(b)] - 1
        whole = np.repeat(running[ends], np.diff(np.r_[starts, len(b)])) - base
        ties = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (v[1:] != v[:-1])])
        lengths = np.diff(np.r_[ties, len(b)])
        below = np.repeat(np.r_[0.0, running][ties], lengths) - base
        up_to = np.repeat(running[np.r_[ties[1:], len(b)] - 1], lengths) - base
        total += float(np.sum(np.where(s == 1, w * (below - (whole - up_to)), 0.0)))
    return total
