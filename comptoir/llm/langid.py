"""Language identification by prediction by partial matching (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm.common import fold, query, stored, table

ORDER = 3
SAMPLE_BYTES = 2_000_000
UNKNOWN = "und"
#: Code lengths are whole multiples of 1 / SCALE bit, so that sums do not depend on the order of addition.
SCALE = 65536
_CHUNK = 1 << 20


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): how often each string of 1 to ORDER + 1 bytes stands in the texts of a batch."""
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1)
        for lang in langs.unique().to_pylist():
            own = texts.filter(pc.equal(langs, lang)).to_pylist()
            data = np.frombuffer(b"".join(b"\n" * ORDER + t.encode().lower() for t in own), np.uint8).astype(np.uint64)
            for width in range(1, ORDER + 2):
                # every gram ends at a byte of a text: the padding before each text only serves as context
                code = np.zeros(len(data) - ORDER, np.uint64)
                for i in range(width):
                    at = ORDER - width + 1 + i
                    code = code << np.uint64(8) | data[at:at + len(code)]
                grams, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array(np.full(len(grams), width, np.int32)), pa.array(grams.astype(np.int64)), pa.array(n)],
                    names=["lang", "width", "gram", "n"])


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", sample_bytes: int = SAMPLE_BYTES) -> list[tuple]:
    """Frozen statistics of each language: [(lang, {width: (grams, counts)})], sorted by language.

    Each language learns from about ``sample_bytes`` bytes of whole texts: a text is in the sample when the hash of
    its key falls below the rate that its language's size allows; where none does, the text with the smallest hash is taken. The counting runs on executors; the driver gets
    the distinct grams, whose number that sample bounds. NULL texts and languages teach nothing.
    """
    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("key")).where(
        "lang IS NOT NULL AND text <> ''")
    known = known.withColumn("key", F.pmod("key", F.lit(1_000_000)))
    sizes = known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n"), F.min("key").alias("least")).collect()
    if not sizes:
        return []
    rates = {r["lang"]: min(1.0, sample_bytes / r["n"]) for r in sizes}
    rate = F.element_at(F.create_map(*[F.lit(x) for pair in rates.items() for x in pair]), F.col("lang"))
    chosen = known.where((F.col("key") < rate * 1_000_000) | (rate >= 1)).select("lang", "text")
    missed = [r["lang"] for r in sizes if r["least"] >= rates[r["lang"]] * 1_000_000 and rates[r["lang"]] < 1]
    if missed:
        first = F.min_by("text", F.struct("key", F.xxhash64("text")))
        chosen = chosen.unionByName(known.where(F.col("lang").isin(missed)).groupBy("lang").agg(first.alias("text")))
    counts = (
        chosen.mapInArrow(_grams, "lang string, width int, gram long, n long")
        .groupBy("lang", "width", "gram").agg(F.sum("n").alias("n")).toArrow().sort_by([("lang", "ascending"), ("width", "ascending"), ("gram", "ascending")])
    )
    names, widths = counts.column("lang").to_numpy(), counts.column("width").to_numpy()
    grams, n = counts.column("gram").to_numpy(), counts.column("n").to_numpy()
    model = []
    for name in sorted(set(names.tolist())):
        per = {w: (names == name) & (widths == w) for w in range(1, ORDER + 2)}
        model.append((name, {w: (grams[m], n[m]) for w, m in per.items()}))
    return model


class Coder:
    """Code lengths under the frozen trees of all languages.

    A context of up to ORDER bytes gives a seen byte n / (t + q), with t bytes and q different ones seen after it,
    and passes the rest q / (t + q) to the context one byte shorter (escape method C, without exclusions); a context
    never seen passes on everything; below the empty context all 256 bytes are alike.
    """

    def __init__(self, model: list[tuple]):
        self.names = [name for name, _ in model]
        used = np.unique(np.concatenate([m[1][0] for _, m in model] + [[ord("\n")]])).astype(np.int64)
        self.size = a = len(used) + 1  # the last symbol stands for all bytes never seen
        self.symbol = np.full(256, a - 1, np.int32)
        self.symbol[used] = np.arange(len(used))
        coded = [{w: (self._recode(g, w), n) for w, (g, n) in m.items()} for _, m in model]
        contexts = np.unique(np.concatenate([c[ORDER + 1][0] // a for c in coded]))
        self.row = (len(contexts) + np.arange(a ** ORDER, dtype=np.int32) % a ** (ORDER - 1)).astype(np.int32)
        self.row[contexts] = np.arange(len(contexts), dtype=np.int32)
        self.cost = np.empty(((len(contexts) + a ** (ORDER - 1)) * a, len(model)), np.int32)
        for i, c in enumerate(coded):
            p = np.full((1, a), 1 / 256)
            for width in range(1, ORDER + 1):
                p = self._blend(p[np.arange(a ** (width - 1)) % len(p)], np.arange(a ** (width - 1)), *c[width])
            long = self._blend(p[contexts % len(p)], contexts, *c[ORDER + 1])
            self.cost[:, i] = np.rint(-np.log2(np.concatenate([long, p])) * SCALE).ravel()

    def _recode(self, grams: np.ndarray, width: int) -> np.ndarray:
        code = np.zeros(len(grams), np.int64)
        for i in reversed(range(width)):
            code = code * self.size + self.symbol[grams >> 8 * i & 255]
        return code

    def _blend(self, shorter: np.ndarray, contexts: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
        at, byte = np.searchsorted(contexts, code // self.size), code % self.size
        total, kinds = (np.bincount(at, w, len(contexts)) for w in (n, None))
        mass = np.maximum(total + kinds, 1)
        p = shorter * np.where(kinds > 0, kinds / mass, 1)[:, None]
        p[at, byte] = n / mass[at]
        return p

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths in 1 / SCALE bit: one row per text, one column per language."""
        out = np.zeros((len(texts), len(self.names)), np.int64)
        pad = b"\n" * ORDER
        joined = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
        ends = np.cumsum([len(t) + ORDER for t in texts])
        starts = np.concatenate([[0], ends[:-1]]) + ORDER
        for lo in range(0, len(joined) - ORDER, _CHUNK):  # temporary arrays stay small, however long a text is
            s = self.symbol[joined[lo:lo + _CHUNK + ORDER]]
            n = len(s) - ORDER
            context = s[:n]
            for i in range(1, ORDER):
                context = context * self.size + s[i:n + i]
            cost = self.cost[self.row[context] * self.size + s[ORDER:]]  # of the bytes from lo + ORDER on
            first, last = np.searchsorted(ends, lo + ORDER, "right"), np.searchsorted(starts, lo + ORDER + n, "left")
            b = np.clip(np.column_stack([starts[first:last], ends[first:last]]) - lo - ORDER, 0, n)
            some = b[:, 1] > b[:, 0]
            if some.any():
                b = b[some]
                cost = np.concatenate([cost, np.zeros((1, cost.shape[1]), cost.dtype)])
                out[first:last][some] += np.add.reduceat(cost, b.ravel(), axis=0, dtype=np.int64)[::2]
        return out


@lru_cache(maxsize=1)
def _coder(broadcast) -> Coder:
    return Coder(broadcast.value)


def identify(text: Column, model: list[tuple], spark: SparkSession) -> Column:
    """Struct (lang, score, bits_per_byte) of a text column under a fitted model.

    The language with the shortest code wins, ties the first by name; score is its share if each language had the
    prior 1 / L and the probability 2 ** -length; bits_per_byte is its length over the text's bytes. A text that is
    NULL or has no letter, or an empty model, gives 'und', score 0 and NULL bits.
    """
    kind = "lang string, score double, bits_per_byte double"
    if not model:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(kind)
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _coder(shared)
        for column in columns:
            found, value, bits = [], [], []
            for lo in range(0, len(column), 256):
                texts = [None if t is None else t.encode().lower() for t in column.slice(lo, 256).to_pylist()]
                length = coder.lengths([t or b"" for t in texts])
                best = length.argmin(1) if length.size else []
                share = 1 / np.exp2(np.maximum((length[np.arange(len(texts)), best][:, None] - length) / SCALE, -1000)).sum(1)
                found += [UNKNOWN if t is None else coder.names[b] for t, b in zip(texts, best)]
                value += [0.0 if t is None else x for t, x in zip(texts, share.tolist())]
                bits += [length[i, b] / SCALE / len(t) if t else None for i, (t, b) in enumerate(zip(texts, best))]
            yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(value, pa.float64()), pa.array(bits, pa.float64())], ["lang", "score", "bits_per_byte"])

    # so that a filter on the answer is not evaluated below it, by a second set of workers
    return score.asNondeterministic()(F.when(text.rlike(r"\p{L}"), text))


@query("op7_langid")
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from three folds of documents and predict all."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", 4) != 2))
    found = identify(F.col("text"), model, spark)
    return docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), found.alias("f")).select(
        "doc_id", "held_out", F.col("f.lang").alias("lang_pred"), F.col("f.score").alias("score"), F.col("f.bits_per_byte").alias("bits_per_byte"))
