"""What the operators of this subpackage share: tables, hold-out folds, stored results, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.session import ensure_checkpoint_dir

#: Registered queries of this subpackage, and their SQL where there is any.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Spark's setting that deletes the shuffle files of an SQL execution at its end, not only when the driver collects its objects.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def query(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame, with the SQL that must agree with it."""
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder and read back, which cuts the lineage.

    The table lives as long as that folder: a lost executor rereads it instead of computing it again. What was
    shuffled to make it is of no further use and leaves the disks with the write.
    """
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(_SHUFFLES_GO, "false")
    conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text, without copying; one row is never cut."""
    for batch in batches:
        start = size = 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < len(lengths):
            yield batch.slice(start)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): component is the smallest node reachable.

    Alternates two steps until nothing changes: each node hands its larger neighbours, then its smaller
    ones, to the smallest neighbour. Edges never multiply, a hub is one group whose minimum is combined
    before the shuffle, and each round is checkpointed. Links from a node to itself and NULLs are ignored.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = (
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u > v AND v IS NOT NULL").distinct().checkpoint()
    )

    def digest(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    before = digest(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")),
        )).alias("e")).select("e.*").where("u > v").distinct()
        edges = small.checkpoint()
        after = digest(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
