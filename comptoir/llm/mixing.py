"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from comptoir.llm.common import WORD, query, stored, table, unused

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 8
MAX_REPEATS = 3
SEED = "mix"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def apportion(rows: DataFrame, weight: str, seats: str, order: list[str], keys: list[str] = ()) -> DataFrame:
    """Add ``quota``: the ``seats`` of each group of ``keys`` dealt out by highest quotients weight / (2k - 1).

    The first seats come in closed form: with divisor W / (seats - m / 2), m rows and weights W in all, rounding
    gives no row more than it ends with. Only the last few quotients, about 5m for a group, are ranked. Equal
    quotients go by ``order``. A group whose weights are all zero gets no seats.
    """
    group = Window.partitionBy(*keys)
    m, total = F.count("*").over(group), F.sum(weight).over(group).cast("double")
    based = rows.withColumn("_m", m).withColumn("_w", total).withColumn(
        "_base",
        F.when(F.col("_w") > 0, F.greatest(F.lit(0).cast("long"), F.floor(
            F.col(weight).cast("double") * (F.col(seats) - F.col("_m") / 2) / F.col("_w") + 0.5) - 1)).otherwise(F.lit(0).cast("long")),
    ).withColumn("_left", F.when(F.col("_w") > 0, F.col(seats) - F.sum("_base").over(group)).otherwise(F.lit(0).cast("long")))
    more = F.when(F.col("_w") > 0, F.ceil(F.col(weight).cast("double") * F.col("_m") / F.col("_w"))).otherwise(F.lit(0)) + 3
    ranked = based.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), more.cast("long")))).withColumn(
        "_rank", F.row_number().over(group.orderBy(
            (F.col(weight).cast("double") / (2 * (F.col("_base") + F.col("_k")) - 1)).desc(),
            *[F.col(c).asc_nulls_last() for c in order], "_k")),
    )
    return ranked.groupBy(*rows.columns).agg(
        (F.first("_base") + F.sum((F.col("_rank") <= F.col("_left")).cast("long"))).alias("quota"))


def targets(sources: DataFrame, size: str, source: str, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target``: the sum of all sizes shared by weight, never above ``repeats`` times a source's own size.

    What a full source cannot take is shared again by weight: targets are min(cap, level * weight), and the level
    is found by passing over the sources in the order in which they fill up. One row per source.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col(source).isNull(), F.col(source))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    df = sources.withColumn("_weight", weight).withColumn("_cap", F.col(size) * repeats)
    filling = everything.orderBy(F.col("_cap") / F.col("_weight"), F.col(source).isNull(), F.col(source))
    before = F.coalesce(F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum(size).over(everything) - before).cast("double") / rest
    df = df.withColumn("_level", level)
    found = F.min(F.when(F.col("_level") <= F.col("_cap") / F.col("_weight"), F.struct(F.col("_cap") / F.col("_weight"), "_level"))).over(everything)
    return df.withColumn("target", F.least(F.col("_cap").cast("double"), found["_level"] * F.col("_weight"))).drop("_cap", "_level", "_weight")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
        block: int = BLOCK_WORDS, repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """How many words of each document a mix with the given source weights takes.

    Sources in code point order (NULL last) weigh ``weights``, repeating. The target of all words is cut into
    blocks of ``block`` words; Sainte-Laguë apportionment gives each source, then each of its shards, an integer
    number of them. A source of n documents with words has about sqrt(n) shards, so that neither shards nor their lists grow
    into one task. A shard is an endless stream of its documents in seeded order, and its first blocks are taken:
    full rounds, then a beginning of one more; the last block of a shard that is taken ``repeats`` times whole may be shorter. No document is taken more than ``repeats`` times. The choice depends on seed and
    ids only, so reruns agree.

    Returns one row per document: doc_id, source, size (words; NULL or blank text: 0), source_size, target (of its
    source), taken (words, repeats counted). An empty table gives no rows; documents of size 0 take nothing;
    repeated rows are separate documents that share a shard. Other columns are not read.
    """
    sizes = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size")))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("_docs"))
    sources = targets(sources, "source_size", "source", weights, repeats)
    seats = F.floor(F.sum("source_size").over(Window.partitionBy()) / block + 0.5)
    sources = apportion(sources.withColumn("_seats", seats), "target", "_seats", ["source"])
    sources = stored(sources.select(
        F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("_seats"), F.greatest(F.lit(1), F.ceil(F.sqrt("_docs"))).cast("long").alias("_shards")))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    placed = (
        sizes.join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_shard", F.pmod(number, F.col("_shards"))).drop("_source")
    )
    shards = placed.groupBy("source", "_shard").agg(
        F.sum("size").alias("_shard_size"), F.first("_seats").alias("_seats"))
    shards = apportion(shards, "_shard_size", "_seats", ["_shard"], ["source"]).select(
        F.col("source").alias("_source"), F.col("_shard").alias("_s"), "_shard_size",
        F.least(F.col("quota") * block, F.col("_shard_size") * repeats).alias("_words"))
    order = Window.partitionBy("source", "_shard").orderBy(F.md5(F.concat(F.lit("order "), key).cast("binary")), "doc_id", "size")
    ends = placed.withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rounds, rest = F.floor(F.col("_words") / F.col("_shard_size")), F.col("_words") % F.col("_shard_size")
    part = F.greatest(F.lit(0).cast("long"), F.least("_end", rest) - (F.col("_end") - F.col("size")))
    return ends.join(shards, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_s"))).select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("_shard_size") > 0, F.col("size") * rounds + part).otherwise(F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents of the mix, in their own columns, each as many times as it is taken.

    Documents stay whole: one whose last copy is cut by the end of its shard's blocks gets that copy when at least
    half of it is taken. Ids must be unique per source and size for a clear count; repeated rows average theirs.
    """
    taken = mix(docs, doc_id, source, text, **options)
    per_id = taken.groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("_taken"), F.count("*").alias("_n")).where("_taken > 0")
    copies = F.floor(F.col("_taken") / (F.col("size") * F.col("_n")) + 0.5)
    id_, of, size, times, words, copy = (unused(docs.columns, c) for c in ("_id", "_source", "_size", "_copies", "_words", "_copy"))
    per_id = per_id.select(F.col("doc_id").alias(id_), F.col("source").alias(of), F.col("size").alias(size), copies.alias(times)).where(F.col(times) > 0)
    sized = docs.withColumn(words, n_words(text))
    joined = sized.join(per_id, F.col(doc_id).eqNullSafe(F.col(id_)) & F.col(source).eqNullSafe(F.col(of)) & (F.col(words) == F.col(size)))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*(F.col(f"`{c}`") for c in docs.columns))


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) FILTER (size > 0) AS docs FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    {MAX_REPEATS} * source_size AS cap FROM per),
levelled AS (
  SELECT *, CAST((SELECT sum(source_size) FROM per) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
aimed AS (
  SELECT source, source_size, docs, least(CAST(cap AS DOUBLE),
    (SELECT level FROM levelled WHERE level <= cap / weight ORDER BY cap / weight, level LIMIT 1) * weight) AS target FROM levelled),
seated AS (SELECT *, CAST(floor((SELECT sum(source_size) FROM per) / {BLOCK_WORDS} + 0.5) AS BIGINT) AS seats,
  (SELECT count(*) FROM per) AS m, (SELECT sum(target) FROM aimed) AS w FROM aimed),
based AS (SELECT *, CASE WHEN w > 0 THEN greatest(0, CAST(floor(target * (seats - m / 2) / w + 0.5) AS BIGINT) - 1) ELSE 0 END AS base FROM seated),
quotients AS (
  SELECT *, row_number() OVER (ORDER BY target / (2 * (base + k) - 1) DESC, source NULLS LAST, k) AS rank,
    CASE WHEN w > 0 THEN seats - (SELECT sum(base) FROM based) ELSE 0 END AS remaining
  FROM (SELECT *, unnest(range(1, CAST(CASE WHEN w > 0 THEN ceil(target * m / w) ELSE 0 END AS BIGINT) + 4)) AS k FROM based)),
quotas AS (
  SELECT source, source_size, target, greatest(1, CAST(ceil(sqrt(docs)) AS BIGINT)) AS shards,
    any_value(base) + sum(CASE WHEN rank <= remaining THEN 1 ELSE 0 END) AS seats FROM quotients GROUP BY source, source_size, target, docs),
placed AS (
  SELECT s.*, q.source_size, q.target, q.seats, CAST('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) % q.shards AS shard
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
shard AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(seats) AS seats FROM placed GROUP BY source, shard),
shard_total AS (SELECT *, count(*) OVER (PARTITION BY source) AS m, CAST(sum(shard_size) OVER (PARTITION BY source) AS DOUBLE) AS w FROM shard),
shard_base AS (SELECT *, CASE WHEN w > 0 THEN greatest(0, CAST(floor(CAST(shard_size AS DOUBLE) * (seats - m / 2) / w + 0.5) AS BIGINT) - 1) ELSE 0 END AS base FROM shard_total),
shard_left AS (SELECT *, CASE WHEN w > 0 THEN seats - sum(base) OVER (PARTITION BY source) ELSE 0 END AS remaining FROM shard_base),
shard_quotients AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY CAST(shard_size AS DOUBLE) / (2 * (base + k) - 1) DESC, shard, k) AS rank
  FROM (SELECT *, unnest(range(1, CAST(CASE WHEN w > 0 THEN ceil(CAST(shard_size AS DOUBLE) * m / w) ELSE 0 END AS BIGINT) + 4)) AS k FROM shard_left)),
shard_quotas AS (
  SELECT source, shard, shard_size, least((any_value(base) + sum(CASE WHEN rank <= remaining THEN 1 ELSE 0 END)) * {BLOCK_WORDS}, shard_size * {MAX_REPEATS}) AS words
  FROM shard_quotients GROUP BY source, shard, shard_size),
ended AS (
  SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY md5('order {SEED}:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ending FROM placed)
SELECT e.doc_id, e.size, e.source_size, e.target, CAST(CASE WHEN q.shard_size > 0 THEN
    e.size * (q.words // q.shard_size) + greatest(0, least(e.ending, q.words % q.shard_size) - (e.ending - e.size)) ELSE 0 END AS BIGINT) AS taken
FROM ended e JOIN shard_quotas q ON e.source IS NOT DISTINCT FROM q.source AND e.shard = q.shard
"""


@query("op10_mixing", SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")
