"""Exact k-nearest-neighbour imputation without comparing all pairs of rows.

Equal feature vectors collapse first, so a value that fills a third of the table is one vector. A
bounded sample of the complete-enough vectors, in which each column has its share, then does two things: it
gives every missing coordinate of a vector an upper bound on the distance of its k-th neighbour, and it
splits the feature space into boxes. A vector visits only boxes closer than that bound that have donors for
the coordinate; a column with fewer than k donors in all brings visits to their boxes only. Boxes with many
donors are dealt to several tasks, and the k best of all are merged. The sample decides how evenly the work spreads, never the result.

The distance uses the coordinates both vectors have, scaled by all / shared; equal distances are
ordered by the neighbour's value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from comptoir.functions.columns import ref
from comptoir.session import ensure_checkpoint_dir

_MAX_SAMPLE = 100_000
_MIN_SAMPLE = 2_000
_VECTORS_PER_SAMPLED = 2_000  # one sampled vector for so many, within the two limits above
_SAMPLED_PER_BOX = 20
_BLOCK = 20_000  # incomplete vectors that one task compares with one box
_DONORS = 50_000  # complete-enough vectors of a box that one task holds
_PER_COLUMN = 400  # sampled vectors that have a column, at least, and eight times k
_MATRIX = 4_000_000  # distances held at once inside a task


def knn_impute(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """Fill each gap with the mean over the k nearest rows that have the value; without any, the column mean."""
    names = df.columns
    columns = list(columns)
    row = df.agg(*[F.avg(ref(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    means = [F.lit(row[i]).cast("double") for i in range(len(columns))]
    if len(columns) == 1:
        only = columns[0]
        return df.withColumn(only, F.coalesce(ref(only).cast("double"), means[0]))

    features = [f"_f{i}" for i in range(len(columns))]
    typed = df.withColumns({f: ref(c).cast("double") for f, c in zip(features, columns)})
    gap = reduce(Column.__or__, [F.col(f).isNull() for f in features])
    found = _neighbour_means(typed.select(*features), features, k)

    same = reduce(Column.__and__, [F.col(f).eqNullSafe(F.col(f"_r{i}")) for i, f in enumerate(features)])
    found = found.withColumnsRenamed({f: f"_r{i}" for i, f in enumerate(features)})
    filled = typed.filter(gap).join(found, same, "left").withColumns({
        c: F.coalesce(F.col(f), F.col(f"_v{i}"), means[i]) for i, (c, f) in enumerate(zip(columns, features))
    })
    whole = typed.filter(~gap).withColumns({c: F.col(f) for c, f in zip(columns, features)})
    return whole.select(*[ref(c) for c in names]).unionByName(filled.select(*[ref(c) for c in names]))


def _neighbour_means(vectors: DataFrame, features: list[str], k: int) -> DataFrame:
    """One row per incomplete vector with ``_v0.._vn``, NULL where no neighbour was found."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    known = reduce(Column.__add__, [F.col(f).isNotNull().cast("int") for f in features])
    distinct = (
        vectors.groupBy(*features).agg(F.count(F.lit(1)).alias("n"))
        .filter(known > 0)
        .checkpoint()
    )
    incomplete = distinct.filter(known < len(features)).drop("n")

    total, *present = distinct.agg(F.count(F.lit(1)), *[F.count(f) for f in features]).first()
    size = min(_MAX_SAMPLE, max(_MIN_SAMPLE, total // _VECTORS_PER_SAMPLED))

    def drawn(share: float, salt: int) -> Column:
        return F.pmod(F.xxhash64(*features, F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30))

    # Drawn by hash at a rate for all and a rate for each column, so that rare columns have neighbours in the sample too.
    rates = [min(1.0, max(_PER_COLUMN, 8 * k) / max(n, 1)) for n in present]
    kept = reduce(Column.__or__, [F.col(f).isNotNull() & drawn(rate, i) for i, (f, rate) in enumerate(zip(features, rates))], drawn(min(1.0, size / max(total, 1)), -1))
    sampled = distinct.select(*features).filter(kept)
    sample = np.array([list(r) for r in sampled.collect()], dtype=float).reshape(-1, len(features))
    boxes = spark.sparkContext.broadcast(_Boxes.split(sample))
    bound = spark.sparkContext.broadcast(sample)

    numbers = [T.StructField(f, T.DoubleType()) for f in features]
    visit_schema = T.StructType([*numbers, T.StructField("box", T.IntegerType())])
    placed_schema = T.StructType([*numbers, T.StructField("n", T.LongType()), T.StructField("box", T.IntegerType())])

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch[features].to_numpy(float)
            step = max(1, _MATRIX // max(1, len(bound.value), boxes.value.count))
            for start in range(0, len(points), step):
                part = points[start:start + step]
                rows, hit = boxes.value.within(part, _bounds(part, bound.value, k), having.value)
                yield pd.DataFrame(part[rows], columns=features).assign(box=hit.astype("int32"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(box=boxes.value.of(batch[features].to_numpy(float)).astype("int32"))

    # mapInPandas hands NULL over as NaN and gives NaN back; turn it into NULL again.
    def nulls(frame: DataFrame) -> DataFrame:
        return frame.withColumns({f: F.when(~F.isnan(f), F.col(f)) for f in features})

    placed = nulls(distinct.mapInPandas(place, placed_schema))
    # One row per box, and there are fewer boxes than sampled vectors.
    counts = placed.groupBy("box").agg(F.count(F.lit(1)), *[F.count(f) for f in features]).collect()
    held = np.zeros((boxes.value.count, len(features)), bool)
    for row in counts:
        held[row[0]] = [n > 0 for n in row[2:]]
    having = spark.sparkContext.broadcast(held)
    seekers = nulls(incomplete.mapInPandas(visits, visit_schema)).checkpoint()
    parts = {row[0]: -(-row[1] // _DONORS) for row in counts}
    per_box = [(r["box"], r["blocks"], parts.get(r["box"], 1)) for r in
               seekers.groupBy("box").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks")).collect()]

    def blocks() -> DataFrame:
        return F.broadcast(spark.createDataFrame(per_box, "box int, blocks int, parts int"))

    # A box with many donors is dealt out in parts, one with many seekers in blocks; every block meets every part.
    seekers = seekers.join(blocks(), "box").withColumns({
        "block": F.pmod(F.xxhash64(*features), F.col("blocks")).cast("int"), "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)),
    })
    donors = placed.join(blocks(), "box").withColumns({
        "part": F.pmod(F.xxhash64(F.lit(1), *features), F.col("parts")).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
    })
    near_schema = T.StructType([
        *numbers, T.StructField("target", T.IntegerType()), T.StructField("distance", T.DoubleType()),
        T.StructField("value", T.DoubleType()), T.StructField("n", T.LongType()),
    ])

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = _nearest(left[features].to_numpy(float), right[features].to_numpy(float), right["n"].to_numpy(), k)
        return pd.DataFrame(found, columns=near_schema.names).astype({"target": "int32", "n": "int64"})

    near = nulls(
        seekers.groupBy("box", "block", "part").cogroup(donors.groupBy("box", "block", "part")).applyInPandas(nearest, near_schema)
    )
    # At most k candidates per visited box and part: keep the k nearest rows over all boxes.
    line = W.partitionBy(*features, "target").orderBy("distance", "value").rowsBetween(W.unboundedPreceding, -1)
    taken = near.withColumn("n", F.least(F.col("n"), F.lit(k) - F.coalesce(F.sum("n").over(line), F.lit(0))))
    means = taken.filter(F.col("n") > 0).groupBy(*features, "target").agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean")
    )
    return means.groupBy(*features).agg(*[
        F.max(F.when(F.col("target") == i, F.col("mean"))).alias(f"_v{i}") for i in range(len(features))
    ])


def _distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances over shared coordinates, scaled by all / shared; infinite where none is shared."""
    total = np.zeros((len(points), len(others)))
    shared = np.zeros_like(total)
    for j in range(points.shape[1]):
        gap = points[:, j, None] - others[None, :, j]
        both = ~np.isnan(gap)
        total += np.where(both, gap * gap, 0.0)
        shared += both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, points.shape[1] / shared * total, np.inf)


def _bounds(points: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """k-th neighbour distance for each missing coordinate of each point, as seen in the sample; infinite with fewer than k, -1 where not missing."""
    distance = _distances(points, sample)
    bound = np.full(points.shape, -1.0)
    for j in range(points.shape[1]):
        lacking = np.isnan(points[:, j])
        donors = distance[np.ix_(lacking, ~np.isnan(sample[:, j]))]
        bound[lacking, j] = np.partition(donors, k - 1, axis=1)[:, k - 1] if donors.shape[1] >= k else np.inf
    return bound


def _nearest(points: np.ndarray, donors: np.ndarray, copies: np.ndarray, k: int) -> list[tuple]:
    """The first donors in (distance, value) order, up to k rows, per point and missing coordinate."""
    found: list[tuple] = []
    step = max(1, _MATRIX // max(1, len(donors)))
    for start in range(0, len(points), step):
        part = points[start:start + step]
        distance = _distances(part, donors)
        for j in range(points.shape[1]):
            having = np.flatnonzero(~np.isnan(donors[:, j]))
            if not len(having):
                continue
            for i in np.flatnonzero(np.isnan(part[:, j])):
                gaps = distance[i, having]
                if len(gaps) > k:
                    close = np.flatnonzero(gaps <= np.partition(gaps, k - 1)[k - 1])
                else:
                    close = np.arange(len(gaps))
                close = close[np.isfinite(gaps[close])]
                values = donors[having[close], j]
                left = k
                for c in np.lexsort((values, gaps[close]))[:k]:
                    if left <= 0:
                        break
                    n = int(copies[having[close[c]]])
                    found.append((*part[i], j, gaps[close[c]], values[c], n))
                    left -= n
    return found


class _Boxes:
    """A partition of vectors with gaps: every split sends them below, above or to "missing"."""

    def __init__(self, tree, low, high, present, missing):
        self.tree, self.low, self.high, self.present, self.missing = tree, low, high, present, missing
        self.count = len(low)

    @staticmethod
    def split(sample: np.ndarray) -> _Boxes:
        width = sample.shape[1]
        leaves: list[tuple] = []

        def grow(rows, low, high, present, missing):
            # Split where the sample has most distinct values, at their median.
            spread = [len(np.unique(rows[~np.isnan(rows[:, j]), j])) if not missing[j] else 0 for j in range(width)]
            axis = int(np.argmax(spread)) if len(rows) else 0
            if len(rows) <= _SAMPLED_PER_BOX or spread[axis] < 2:
                leaves.append((low, high, present, missing))
                return len(leaves) - 1
            values = rows[:, axis]
            cut = float(np.median(np.unique(values[~np.isnan(values)])))
            here = present.copy()
            here[axis] = True
            upper, lower = high.copy(), low.copy()
            upper[axis], lower[axis] = cut, cut
            below = grow(rows[values < cut], low, upper, here, missing)
            above = grow(rows[values >= cut], lower, high, here, missing)
            without = None
            if not present[axis]:
                gone = missing.copy()
                gone[axis] = True
                without = grow(rows[np.isnan(values)], low, high, present, gone)
            return axis, cut, below, above, without

        none = np.zeros(width, bool)
        tree = grow(sample, np.full(width, -np.inf), np.full(width, np.inf), none, none)
        return _Boxes(tree, *[np.array(part) for part in zip(*leaves)])

    def of(self, points: np.ndarray) -> np.ndarray:
        """Box number of each vector."""
        box = np.zeros(len(points), int)

        def descend(node, rows):
            if not len(rows):
                return
            if not isinstance(node, tuple):
                box[rows] = node
                return
            axis, cut, below, above, without = node
            values = points[rows, axis]
            descend(below, rows[values < cut])
            descend(above, rows[values >= cut])
            if without is not None:
                descend(without, rows[np.isnan(values)])

        descend(self.tree, np.arange(len(points)))
        return box

    def within(self, points: np.ndarray, bounds: np.ndarray, having: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (point, box) where the box has donors for a missing coordinate and can hold one at most that coordinate's bound away.

        ``having`` says which coordinates any vector of a box has.
        """
        total = np.zeros((len(points), self.count))
        shared = np.zeros_like(total)
        for j in range(points.shape[1]):
            x = points[:, j, None]
            known = ~np.isnan(x)
            gap = np.maximum(0.0, np.maximum(self.low[None, :, j] - x, x - self.high[None, :, j]))
            total += np.where(known & self.present[None, :, j], gap * gap, 0.0)
            shared += known & ~self.missing[None, :, j]
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(shared > 0, points.shape[1] / shared * total, np.inf)
        # The margin covers rounding; a box that shares no coordinate holds no neighbour.
        hit = np.zeros(least.shape, bool)
        for j in range(points.shape[1]):
            hit |= (least <= bounds[:, j, None] * (1 + 1e-9)) & having[None, :, j]
        return np.nonzero(hit & np.isfinite(least))
