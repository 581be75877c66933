"""Order-dependent work without a single-partition window.

Rows are split into value ranges by Spark's range partitioner; the range number is kept as a column
and the result is checkpointed, so that every later use (also after a lost executor) sees the same
ranges. A window then runs inside each range, and what a range must know about the earlier ones
travels in a table with at most one row per range boundary. A hot key is split over many ranges,
because the ranges follow key and value together; a hot value is one row after pre-aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from comptoir.functions.columns import as_list, ref
from comptoir.session import ensure_checkpoint_dir

# Sizes up to which a simpler plan is used. They are checked with sketches (5 % standard error).
SMALL_DISTINCT = 100_000  # distinct values of a column that one task may hold as a value-to-count map
SMALL_GROUP = 20_000  # the same within a group, as a task may hold the maps of many groups at once
SMALL_SORT = 2_000_000  # distinct values that one task may sort (it spills, so this is about time only)
BROADCAST_BYTES = 64 * 1024 * 1024  # estimated size of a table that is sent to all executors

_RANGE = "_range"


def distinct_estimates(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> dict[str, int]:
    """Distinct values per column (the largest over the groups when keys are given), by sketches in one pass."""
    columns = as_list(columns)
    sketches = [F.approx_count_distinct(ref(c)).alias(f"d{i}") for i, c in enumerate(columns)]
    if keys:
        per_key = df.groupBy(*[ref(k) for k in keys]).agg(*sketches)
        row = per_key.agg(*[F.max(f"d{i}").alias(f"d{i}") for i in range(len(columns))]).first()
    else:
        row = df.agg(*sketches).first()
    return {c: row[f"d{i}"] or 0 for i, c in enumerate(columns)}


def fits_one_task(distinct: int) -> bool:
    return distinct <= SMALL_DISTINCT


def fits_one_sort(distinct: int) -> bool:
    return distinct <= SMALL_SORT


def groups_fit_tasks(df: DataFrame, columns: str | Sequence[str], keys: Sequence[str]) -> bool:
    """Whether no group has too many distinct values of a column for one map; one pass for all columns."""
    return max(distinct_estimates(df, as_list(columns), keys).values()) <= SMALL_GROUP


def broadcastable(df: DataFrame, key: str, other_bytes: int = 64) -> bool:
    """Whether a table of one row per distinct key (its longest text and so many other bytes) may be broadcast."""
    width = F.max(F.octet_length(ref(key).cast("string")))
    distinct, longest = df.agg(F.approx_count_distinct(ref(key)), F.coalesce(width, F.lit(0))).first()
    return distinct <= SMALL_SORT and distinct * (longest + other_bytes) <= BROADCAST_BYTES


def split_by_range(df: DataFrame, *order: str) -> DataFrame:
    """Tag each row with its value range and cut the lineage there."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(ranges, *[ref(c) for c in order])
    return ranged.withColumn(_RANGE, F.spark_partition_id()).checkpoint()


def value_ranks(
    df: DataFrame, value: str, keys: Sequence[str] = (), weight: str | None = None, small: bool = False
) -> DataFrame:
    """One row per distinct non-NULL value (within its keys): ``n`` copies, ``before`` smaller rows, ``code`` smaller values.

    The average rank of a value is ``before + (n + 1) / 2`` and ``code`` is its zero-based dense rank.
    ``small`` says the caller has checked that the distinct values of a group fit one sort.
    """
    keys = list(keys)
    rows = F.sum(ref(weight)) if weight else F.count(F.lit(1))
    counts = df.filter(ref(value).isNotNull()).groupBy(*[ref(c) for c in (*keys, value)]).agg(rows.alias("n"))
    earlier = (W.unboundedPreceding, -1)
    if small:
        inside = W.partitionBy(*[ref(k) for k in keys]).orderBy(ref(value))
        return counts.withColumns({
            "before": F.coalesce(F.sum("n").over(inside.rowsBetween(*earlier)), F.lit(0)),
            "code": F.row_number().over(inside) - 1,
        })
    ranged = split_by_range(counts, *keys, value)
    group = [_RANGE, *[ref(k) for k in keys]]
    inside = W.partitionBy(*group).orderBy(ref(value))
    per_range = ranged.groupBy(*group).agg(F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    previous = W.partitionBy(*[ref(k) for k in keys]).orderBy(_RANGE).rowsBetween(*earlier)
    # Only a group that continues from an earlier range has an offset: at most one per range boundary.
    offsets = per_range.withColumns({
        "_rows": F.sum("_rows").over(previous), "_values": F.sum("_values").over(previous),
    }).filter(F.col("_rows").isNotNull())
    return (
        _join_offsets(ranged, offsets, keys)
        .withColumns({
            "before": F.coalesce(F.sum("n").over(inside.rowsBetween(*earlier)), F.lit(0))
            + F.coalesce(F.col("_rows"), F.lit(0)),
            "code": F.row_number().over(inside) - 1 + F.coalesce(F.col("_values"), F.lit(0)),
        })
        .drop("_rows", "_values", _RANGE)
    )


def fill_along_order(
    df: DataFrame, columns: str | Sequence[str], order_by: str | Sequence[str],
    partition_by: str | Sequence[str] = (), backward: bool = False,
) -> DataFrame:
    """Replace NULLs by the last earlier (``backward``: first later) non-NULL value in the given order.

    Rows are shuffled once, by ranges of key and order, sorted inside their range and kept so. A first pass over the
    kept ranges gives one small row each: its first and last key and the values it would hand on. From these follows what
    every range takes over, and a second pass fills the rows where they lie.
    """
    spark = df.sparkSession
    columns, order, keys = as_list(columns), as_list(order_by), as_list(partition_by)
    ensure_checkpoint_dir(spark)
    # Filling backward is filling forward in the opposite order.
    line = [ref(c).desc() if backward else ref(c).asc() for c in (*keys, *order)]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = df.repartitionByRange(ranges, *line).sortWithinPartitions(*line).withColumn(_RANGE, F.spark_partition_id()).checkpoint()
    types = {f.name: f.dataType for f in df.schema}
    edge_schema = T.StructType([T.StructField(_RANGE, T.IntegerType()), T.StructField("one", T.BooleanType())]
                               + [T.StructField(f"{side}{i}", types[k]) for side in ("first", "last") for i, k in enumerate(keys)]
                               + [T.StructField(f"value{i}", types[c]) for i, c in enumerate(columns)])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for at, batch, filled, fresh in _filled_batches(batches, columns, keys, {}):
            end = batch.slice(batch.num_rows - 1)
            one, first = found[at][:2] if at in found else (True, [batch.column(k).slice(0, 1) for k in keys])
            # the first row of a range begins its first key; any later beginning is another key
            found[at] = one and not fresh, first, [end.column(k) for k in keys], [f.slice(batch.num_rows - 1) for f in filled]
        for at, (one, first, last, values) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([one]), *first, *last, *values], names=edge_schema.names)

    carried = spark.sparkContext.broadcast(_carried(kept.select(_RANGE, *[ref(c) for c in dict.fromkeys((*keys, *columns))]).mapInArrow(edges, edge_schema).toArrow(), len(keys), len(columns)))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, batch, filled, _ in _filled_batches(batches, columns, keys, carried.value):
            by_name = dict(zip(columns, filled))
            yield pa.RecordBatch.from_arrays([by_name.get(c, batch.column(c)) for c in df_names], names=df_names)

    df_names = df.columns
    return kept.mapInArrow(fill, df.schema)


def _filled_batches(
    batches: Iterator[pa.RecordBatch], columns: list[str], keys: list[str], carried: dict[int, list[pa.Scalar]]
) -> Iterator[tuple[int, pa.RecordBatch, list[pa.Array], bool]]:
    """Per batch of sorted rows of one range: range, rows, filled columns, and whether a key begins after the range's first row."""
    at, last_key, values = None, None, []
    for whole in batches:
        numbers = whole.column(_RANGE).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            batch = whole.slice(begin, end - begin)
            n = batch.num_rows
            own = [batch.column(k) for k in keys]
            new = np.zeros(n, bool)
            for column in own:
                a, b = column.slice(1), column.slice(0, n - 1)
                differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b)))
                new[1:] |= differ.to_numpy(zero_copy_only=False)
            key = [c[0].as_py() for c in own]
            if at != numbers[begin]:
                at = int(numbers[begin])
                values = carried.get(at) or [pa.scalar(None, batch.column(c).type) for c in columns]
                new_first = False
            else:
                new_first = key != last_key
                new[0] = new_first
            place = np.arange(n)
            start = np.maximum.accumulate(np.where(new, place, -1))  # -1: the key that was open before these rows
            filled = []
            for j, name in enumerate(columns):
                column = batch.column(name)
                near = np.maximum.accumulate(np.where(column.is_valid().to_numpy(zero_copy_only=False), place, -1))
                gone = near < np.maximum(start, 0)
                taken = column.take(pa.array(np.where(gone, 0, near), mask=gone))
                if values[j].is_valid and (gone & (start < 0)).any():
                    taken = pc.if_else(pa.array(gone & (start < 0)), values[j], taken)
                filled.append(taken)
            values = [f[n - 1] for f in filled]
            last_key = [c[n - 1].as_py() for c in own]
            yield at, batch, filled, bool(new.any())


def _carried(edges: pa.Table, keys: int, columns: int) -> dict[int, list[pa.Scalar]]:
    """What each range takes over from those before it, where its first key is the last one there. One row per range."""
    edges = edges.sort_by(_RANGE).combine_chunks()
    found: dict[int, list[pa.Scalar]] = {}
    values: list[pa.Scalar] = []
    last = None
    for row in range(edges.num_rows):
        first = [edges.column(f"first{i}")[row].as_py() for i in range(keys)]
        own = [edges.column(f"value{j}")[row] for j in range(columns)]
        same = last is not None and first == last
        if same:
            found[edges.column(_RANGE)[row].as_py()] = values
        through = same and edges.column("one")[row].as_py()
        values = [v if v.is_valid or not through else before for v, before in zip(own, values or own)]
        last = [edges.column(f"last{i}")[row].as_py() for i in range(keys)]
    return found


def _join_offsets(ranged: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on range and keys (NULL keys match); the right side has fewer rows than there are ranges."""
    offsets = offsets.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)}).withColumnRenamed(_RANGE, "_at")
    same = F.col(_RANGE) == F.col("_at")
    for i, key in enumerate(keys):
        same = same & ref(key).eqNullSafe(F.col(f"_key{i}"))
    joined = ranged.join(F.broadcast(offsets), same, "left")
    return joined.drop("_at", *[f"_key{i}" for i in range(len(keys))])
