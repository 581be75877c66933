"""Resampling of documents towards the words of a target (operator 13)."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import query, slices, stored, table

GRAMS = 1
BUCKETS = 10_000
SHARE = 10
SEED = 2024
LEAST_WORDS = 20
#: So many keys for each segment are taken from the sorted runs to choose the splitters.
REGULAR = 16
#: Rows of a segment that one task merges, about.
SEGMENT = 1_000_000
#: Bytes that are not part of a word, as spaces: ASCII but for digits and small letters.
_APART = bytes(b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and code points beyond ASCII, A-Z in lower case, as UTF-8."""
    return text.encode().lower().translate(_APART).split() if text else []


def bucketed(found: list[bytes], grams: int, buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to ``grams`` consecutive words, repeats included."""
    hashed = [np.fromiter(map(zlib.crc32, found), np.int64, len(found))]
    for size in range(2, grams + 1):
        runs = [b" ".join(found[i:i + size]) for i in range(len(found) - size + 1)]
        hashed.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)))
    return np.concatenate(hashed) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows. A task sends one row per bucket it has met; ``buckets`` rows reach the driver."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, text):
            found = [bucketed(words(t.as_py()), grams, buckets) for t in batch.column(0)]
            total += np.bincount(np.concatenate(found), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = np.zeros(buckets, np.int64)
    for row in texts.select(F.col(text)).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counted[row["bucket"]] = row["n"]
    return counted


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths by which the logarithm of a bucket's smoothed share is larger in the target, rounded down."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def scores(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", grams: int = GRAMS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each document.

    The gains of a batch's features are taken as one array and summed per document. The weight is their floored mean,
    0 without features; the score adds Gumbel noise that depends on seed and id alone, so a rerun gives the same. A NULL
    id counts as empty text there.
    """
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["doc_id"]]).add("n_words", "long").add("n_features", "long").add("weight", "long").add("score", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in slices(batches, "text"):
            n_words, found = [], []
            for t in batch.column("text"):
                w = words(t.as_py())
                n_words.append(len(w))
                found.append(bucketed(w, grams, len(gain)))
            n = np.array([len(x) for x in found], np.int64)
            before = np.concatenate([[0], np.cumsum(gain[np.concatenate(found)])])
            ends = np.cumsum(n)
            weight = (before[ends] - before[ends - n]) // np.maximum(n, 1)
            h = np.array([int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16) for name in batch.column("name").to_pylist()])
            noise = np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in (np.array(n_words, np.int64), n, weight, weight + noise))], names=schema.names)

    return source.mapInArrow(work, schema)


def _placed(keys: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The segment of each key (rows of numbers, compared from left to right)."""
    kind = np.dtype([(f"k{i}", np.int64) for i in range(keys.shape[1])])
    return np.searchsorted(np.ascontiguousarray(splitters).view(kind).ravel(), np.ascontiguousarray(keys).view(kind).ravel(), "right")


def _keyed(columns: Sequence[pa.Array]) -> np.ndarray:
    """The rows of whole-number columns as keys that numpy compares from left to right."""
    keys = np.empty(len(columns[0]), [(f"k{i}", np.int64) for i in range(len(columns))])
    for i, column in enumerate(columns):
        keys[f"k{i}"] = column.to_numpy(zero_copy_only=False)
    return keys


def ranked(rows: DataFrame, order: list[str], first: Callable[[DataFrame], int], segment: int = SEGMENT) -> DataFrame:
    """Give the first rows in ascending order of ``order`` their exact rank from 1, and NULL to the others.

    Parallel sorting by regular sampling: each task sorts its rows and stores them as a run; every k-th row of each run
    gives the splitters; rows go to the segments between splitters, and each segment merges what it gets. The rank is the
    number of rows in earlier segments, from one count per segment, plus the place in the own one. Segments behind the
    last rank are counted but neither sent nor merged. ``first`` gets the stored rows and says how many ranks to give.

    The order's columns are whole numbers without NULLs, and no two rows may agree in all of them. REGULAR keys for each
    segment, and at most one for each run, reach the driver; a segment holds about ``segment`` rows, as a splitter is off
    by at most one sampling step per run.
    """
    spark = rows.sparkSession
    runs = stored(rows.sortWithinPartitions(*order))
    n, most = runs.count(), first(runs)
    parts = max(-(-n // segment), 2 * spark.sparkContext.defaultParallelism)
    every = max(1, n // (REGULAR * parts))

    def regularly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield batch.take(pa.array(np.flatnonzero((np.arange(seen, seen + batch.num_rows) + 1) % every == every // 2)))
            seen += batch.num_rows

    keys = runs.select(*order)
    seen = _keyed([c.combine_chunks() for c in keys.mapInArrow(regularly, keys.schema).toArrow().columns])
    seen.sort()
    shared = spark.sparkContext.broadcast(seen[np.unique(np.arange(1, parts) * len(seen) // parts)] if len(seen) else seen)

    @F.arrow_udf("int")
    def segment_of(*columns: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(shared.value, _keyed(columns), "right").astype(np.int32))

    dealt = runs.withColumn("_segment", segment_of(*order))
    counts = sorted((r["_segment"], r["count"]) for r in dealt.groupBy("_segment").count().collect())
    starts, before = [], 0
    for k, size in counts:
        if before < most:
            starts.append((k, before))
        before += size
    last = starts[-1][0] if starts else -1
    # one row for each segment, so about one for each ``segment`` rows
    front = dealt.where(F.col("_segment") <= last).join(F.broadcast(spark.createDataFrame(starts, "_segment int, _before long")), "_segment")
    place = F.row_number().over(Window.partitionBy("_segment").orderBy(*order)) + F.col("_before")
    merged = front.withColumn("rank", F.when(place <= most, place)).drop("_before")
    return merged.unionByName(dealt.where(F.col("_segment") > last).withColumn("rank", F.lit(None).cast("long"))).drop("_segment")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", grams: int = GRAMS,
             buckets: int = BUCKETS, share: int = SHARE, seed: int = SEED, least: int = LEAST_WORDS) -> DataFrame:
    """Draw ``share`` percent of the documents of at least ``least`` words so that their words come near the target's.

    Features are all runs of 1 to ``grams`` words, hashed to ``buckets``; their counts over all documents and all target
    texts give a gain per bucket. Those with the highest scores (``scores``) are drawn, rounded down, ties to the smaller id.
    Returns every document's doc_id, n_features, weight, score and rank (NULL where not drawn).

    Ids are whole numbers; a NULL id comes after all others of its score, and repeated rows are ranked one after the other.
    NULL, empty and wordless texts have no features, weight 0 and no rank. Other columns are not read. An empty table gives
    an empty result, an empty target the gains of a uniform one.
    """
    if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        raise TypeError(f"{doc_id} must be a whole number")
    gain = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets))
    rows = scores(docs, gain, doc_id, text, grams, seed).select(
        "*", F.when(F.col("n_words") >= least, 0).otherwise(1).cast("long").alias("_short"), (-F.col("score")).alias("_least"),
        F.col("doc_id").isNull().cast("long").alias("_nameless"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.monotonically_increasing_id().alias("_row"))
    done = ranked(rows, ["_short", "_least", "_nameless", "_id", "_row"], lambda runs: runs.where("_short = 0").count() * share // 100)
    return done.select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, resampled: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The drawn documents with all their columns; an id that is repeated brings all of its rows."""
    picked = resampled.where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn"))
    return docs.join(picked, F.col(doc_id).eqNullSafe(F.col("_drawn")), "left_semi")


SQL = f"""
WITH crc AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i::UBIGINT, list_transform(range(0, 8), lambda k: k::UBIGINT)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
), texts AS (
  SELECT 0 AS target, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), found AS (
  SELECT target, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), counted AS (
  SELECT target, id, word, count(*) AS n FROM found GROUP BY ALL
), hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, length(hex(word)) // 2), lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM counted), crc
), buckets AS (
  SELECT bucket, sum(n) FILTER (target = 0) AS s, sum(n) FILTER (target = 1) AS t FROM counted JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM buckets)::DOUBLE + {BUCKETS})
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT sum(t) FROM buckets)::DOUBLE + {BUCKETS}))))::BIGINT AS gain FROM buckets
), weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE target = 0 GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON id = doc_id
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total FROM scored WHERE n_features >= {LEAST_WORDS}
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= {SHARE} * total // 100 THEN place END AS rank FROM scored s LEFT JOIN drawn d ON s.doc_id = d.doc_id
"""


@query("op13_importance", SQL)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
