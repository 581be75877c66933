"""Exact quantiles with linear interpolation.

Where a column has few distinct values (checked with a sketch), its values are counted first and Spark's
``percentile`` runs over the counts. Beyond that, whole-column quantiles are found by selection: sketched
pivots narrow the interval that holds the wanted rank, exact counts confirm it, and only the few values
left inside are gathered. No pass of it shuffles rows. Quantiles of large groups go the same way, for all
groups and columns at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from comptoir.functions.columns import ref
from comptoir.operators.order import distinct_estimates, fits_one_task, groups_fit_tasks, value_ranks
from comptoir.session import ensure_checkpoint_dir

_GATHER = 50_000  # values that one aggregate row may hold while finishing a selection
_ACCURACY = 10_000  # a sketched quantile of n rows is off by at most n / accuracy ranks
_ROUNDS = 40

Quantiles = dict[str, list[float | None]]


def exact_quantiles(
    df: DataFrame, wanted: dict[str, Sequence[float]], distinct: dict[str, int] | None = None
) -> Quantiles:
    """Quantiles of several columns as plain numbers; ``None`` where a column has no value.

    ``distinct`` may give upper estimates of the distinct values, which saves the sketch pass.
    """
    if not wanted:
        return {}
    distinct = distinct or distinct_estimates(df, list(wanted))
    small = {c: list(p) for c, p in wanted.items() if fits_one_task(distinct[c])}
    large = {c: list(p) for c, p in wanted.items() if c not in small}
    found = {**_counted_quantiles(df, small), **_select_quantiles(df, large)}
    return {c: found[c] for c in wanted}


def quantile_columns(
    df: DataFrame, wanted: dict[str, Sequence[float]], distinct: dict[str, int] | None = None
) -> dict[str, Column]:
    """The same as constant array columns, for use in any expression."""
    found = exact_quantiles(df, wanted, distinct)
    return {c: F.array(*[F.lit(v).cast("double") for v in values]) for c, values in found.items()}


def _percentile_of_counts(probabilities: Sequence[float]) -> Column:
    """Quantiles over rows ``value, n``."""
    return F.percentile("value", F.array(*[F.lit(float(p)) for p in probabilities]), F.col("n"))


def _counted_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> Quantiles:
    """One job for all columns: counts per (column, value) combine before the shuffle."""
    if not wanted:
        return {}
    names = list(wanted)
    every = sorted({p for probabilities in wanted.values() for p in probabilities})
    pairs = [F.struct(F.lit(i).alias("column"), ref(c).cast("double").alias("value")) for i, c in enumerate(names)]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = counts.groupBy("column").agg(_percentile_of_counts(every).alias("q")).collect()  # one row per column
    result: Quantiles = {c: [None] * len(p) for c, p in wanted.items()}
    for row in rows:
        at = dict(zip(every, row["q"]))
        result[names[row["column"]]] = [at[p] for p in wanted[names[row["column"]]]]
    return result


def group_quantiles(df: DataFrame, keys: Sequence[str], column: str, probabilities: Sequence[float]) -> DataFrame:
    """Per group an array ``q`` of exact quantiles; groups with only NULLs are absent."""
    by = [ref(k) for k in keys]
    valued = df.filter(ref(column).isNotNull())
    if groups_fit_tasks(valued, column, list(keys)):
        counts = valued.groupBy(*by, ref(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        return counts.groupBy(*by).agg(_percentile_of_counts(probabilities).alias("q"))
    return grouped_selection(valued, keys, [column], probabilities).filter(F.col("q")[0].isNotNull()).withColumn("q", F.col("q")[0])


def grouped_selection(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Per group ``q``, an array with the exact quantiles of each column (NULL for a column without values), for groups of any size.

    A sketch per group and column gives an interval around each wanted rank. One more pass counts the values inside
    the intervals, one row for each, and all values before an interval as one row; running counts of these few rows give the
    ranks. No row is ranked that is not near a quantile, and a large group's rows combine before the shuffle. Should a
    sketch be off by more than it promises, all distinct values are ranked instead.
    """
    by, wanted = [ref(k) for k in keys], sorted(set(probabilities))
    fractions = [_around(p) for p in wanted]
    every = sorted({f for pair in fractions for f in pair})
    ensure_checkpoint_dir(df.sparkSession)
    sketched = df.groupBy(*by).agg(*[
        F.struct(F.count(ref(c)).alias("n"), F.percentile_approx(ref(c).cast("double"), every, _ACCURACY).alias("at")).alias(f"_s{i}")
        for i, c in enumerate(columns)
    ]).checkpoint()

    def near(i: int, value: Column) -> Column:
        kept = F.lit(None).cast("struct<v: double, inside: boolean>")
        for low, high in reversed(fractions):
            a, b = (F.get(F.col(f"_s{i}.at"), F.lit(every.index(f))) for f in (low, high))
            kept = F.when(value < a, F.struct(a.alias("v"), F.lit(False).alias("inside"))).when(
                value <= b, F.struct(value.alias("v"), F.lit(True).alias("inside"))).otherwise(kept)
        return F.struct(F.lit(i).alias("_i"), F.when(value.isNotNull(), kept).alias("_e"))

    rows = df.select(*by, *[ref(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)]).join(sketched, list(keys))
    counted = (
        rows.select(*by, F.inline(F.array(*[near(i, F.col(f"_v{i}")) for i in range(len(columns))])))
        .filter(F.col("_e").isNotNull()).groupBy(*by, "_i", "_e.v", "_e.inside").agg(F.count(F.lit(1)).alias("n"))
    )
    line = W.partitionBy(*by, "_i").orderBy("v", "inside").rowsBetween(W.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("n").over(line), F.lit(0))).filter("inside")
    total = F.get(F.array(*[F.col(f"_s{i}.n") for i in range(len(columns))]), F.col("_i"))
    placed = placed.join(sketched.select(*by, *[f"_s{i}" for i in range(len(columns))]), list(keys)).withColumn("_total", total)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("v")))

    steps = []
    for p in probabilities:
        position = F.lit(float(p)) * (F.col("_total") - 1)
        weight = F.max(position - F.floor(position))
        steps.append(at(F.floor(position)) * (1 - weight) + at(F.ceil(position)) * weight)
    found = placed.groupBy(*by, "_i").agg(F.array(*steps).alias("_q"))
    per_column = found.groupBy(*by).agg(F.array(*[F.max(F.when(F.col("_i") == i, F.col("_q"))) for i in range(len(columns))]).alias("q"))
    result = sketched.join(per_column, list(keys), "left").checkpoint()
    missed = reduce(Column.__or__, [
        (F.col(f"_s{i}.n") > 0) & (F.col("q")[i].isNull() | F.exists(F.col("q")[i], lambda x: x.isNull())) for i in range(len(columns))])
    if result.filter(missed).limit(1).count():
        ranked = [_ranked_quantiles(df, keys, c, probabilities).withColumnRenamed("q", f"_q{i}") for i, c in enumerate(columns)]
        result = reduce(lambda a, b: a.join(b, list(keys), "left"), ranked, sketched).withColumn("q", F.array(*[f"_q{i}" for i in range(len(columns))]))
    return result.select(*by, "q")


def _ranked_quantiles(df: DataFrame, keys: Sequence[str], column: str, probabilities: Sequence[float]) -> DataFrame:
    """The same for one column from the ranks of all distinct values."""
    by = [ref(k) for k in keys]
    valued = df.filter(ref(column).isNotNull())
    ranks = value_ranks(valued, column, keys)
    sizes = valued.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    placed = ranks.join(sizes, list(keys))
    last = F.col("before") + F.col("n") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank <= last), ref(column).cast("double")))

    steps = []
    for p in probabilities:
        position = F.lit(float(p)) * (F.col("_size") - 1)
        low, high = F.floor(position), F.ceil(position)
        weight = F.max(position - low)
        steps.append(at(low) * (1 - weight) + at(high) * weight)
    return placed.groupBy(*by).agg(F.array(*steps).alias("q"))


class _Rank:
    """The value at one zero-based rank, and the open interval it is known to lie in (None: unbounded)."""

    def __init__(self, column: str, rank: int, total: int):
        self.column, self.rank = column, rank
        self.low: float | None = None
        self.high: float | None = None
        self.up_to_low, self.below_high = 0, total
        self.value: float | None = None

    @property
    def interval(self) -> tuple[str, float | None, float | None]:
        return self.column, self.low, self.high

    @property
    def inside(self) -> int:
        return self.below_high - self.up_to_low

    def narrow(self, pivot: float, below: int, up_to: int) -> None:
        """Use the exact numbers of rows ``< pivot`` and ``<= pivot``."""
        if below <= self.rank < up_to:
            self.value = pivot
        elif up_to <= self.rank:
            if self.low is None or pivot > self.low:
                self.low, self.up_to_low = pivot, up_to
        elif self.high is None or pivot < self.high:
            self.high, self.below_high = pivot, below


def _select_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> Quantiles:
    if not wanted:
        return {}
    names = list(wanted)
    # First pivots around the quantiles themselves, in the pass that counts the rows.
    every = {c: sorted({f for p in wanted[c] for f in _around(p)}) for c in names}
    first = df.agg(*[
        F.struct(F.count(ref(c)), F.percentile_approx(ref(c).cast("double"), every[c], _ACCURACY)).alias(f"s{i}")
        for i, c in enumerate(names)
    ]).first()
    totals = {c: first[i][0] for i, c in enumerate(names)}
    ranks: dict[tuple[str, int], _Rank] = {}
    for c in names:
        for p in wanted[c]:
            position = p * (totals[c] - 1)
            for k in (math.floor(position), math.ceil(position)):
                ranks.setdefault((c, k), _Rank(c, k, totals[c]))
    _place(df, list(ranks.values()), {(c, None, None): first[i][1] for i, c in enumerate(names)})

    for _ in range(_ROUNDS):
        open_ranks = [r for r in ranks.values() if r.value is None]
        if not open_ranks:
            break
        _gather(df, [r for r in open_ranks if r.inside <= _GATHER])
        open_ranks = [r for r in open_ranks if r.value is None]
        if open_ranks:
            _place(df, open_ranks, _pivots(df, open_ranks))
    for (c, _), r in ranks.items():
        if r.value is None:  # sketches that do not converge, never seen; ranks are exact without them
            spot = value_ranks(df, c).filter((F.col("before") <= r.rank) & (r.rank < F.col("before") + F.col("n")))
            r.value = float(spot.select(ref(c)).first()[0])

    result: Quantiles = {}
    for c in names:
        result[c] = []
        for p in wanted[c]:
            position = p * (totals[c] - 1)
            low, high = math.floor(position), math.ceil(position)
            a, b = ranks[c, low].value, ranks[c, high].value
            result[c].append(a if low == high else a + (b - a) * (position - low))
    return result


def _around(fraction: float) -> tuple[float, float]:
    """Two sketch positions around a fraction, on a grid, so that neighbouring ranks share them."""
    low, high = math.floor(fraction * _ACCURACY) - 2, math.ceil(fraction * _ACCURACY) + 2
    return max(0.0, low / _ACCURACY), min(1.0, high / _ACCURACY)


def _inside(interval: tuple[str, float | None, float | None]) -> Column:
    name, low, high = interval
    value = ref(name).cast("double")
    kept = F.lit(True)
    if low is not None:
        kept = kept & (value > low)
    if high is not None:
        kept = kept & (value < high)
    return F.when(kept, value)


def _by_interval(ranks: list[_Rank]) -> dict[tuple, list[_Rank]]:
    groups: dict[tuple, list[_Rank]] = {}
    for r in ranks:
        groups.setdefault(r.interval, []).append(r)
    return groups


def _held(interval: tuple[str, float | None, float | None]) -> Column:
    return F.sort_array(F.collect_list(_inside(interval)))


def _gather(df: DataFrame, ranks: list[_Rank]) -> None:
    """Read off ranks whose interval holds few enough values to sort in one row."""
    groups = _by_interval(ranks)
    if not groups:
        return
    picks = [F.array(*[F.get(_held(interval), F.lit(r.rank - r.up_to_low)) for r in members])
             for interval, members in groups.items()]
    row = df.agg(*[p.alias(f"v{i}") for i, p in enumerate(picks)]).first()
    for members, values in zip(groups.values(), row):
        for r, value in zip(members, values):
            r.value = float(value)


def _pivots(df: DataFrame, ranks: list[_Rank]) -> dict[tuple, list[float]]:
    """Sketched values around the ranks of each interval."""
    groups = _by_interval(ranks)
    sketches = []
    for interval, members in groups.items():
        fractions = {f for r in members for f in _around((r.rank - r.up_to_low + 0.5) / r.inside)}
        sketches.append(F.percentile_approx(_inside(interval), sorted(fractions), _ACCURACY))
    row = df.agg(*[s.alias(f"s{i}") for i, s in enumerate(sketches)]).first()
    return dict(zip(groups, row))


def _place(df: DataFrame, ranks: list[_Rank], pivots: dict[tuple, list[float]]) -> None:
    """Count rows around all pivots and narrow the ranks."""
    points = sorted({(interval[0], pivot) for interval, found in pivots.items() for pivot in found or ()})
    counts = df.agg(F.lit(0), *[
        F.struct(F.count_if(ref(c).cast("double") < p), F.count_if(ref(c).cast("double") <= p)).alias(f"c{i}")
        for i, (c, p) in enumerate(points)
    ]).first()[1:]
    for r in ranks:
        for (c, pivot), (below, up_to) in zip(points, counts):
            if c == r.column and r.value is None:
                r.narrow(pivot, below, up_to)
