"""Document fingerprints by locally consistent parsing (operator 5)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import query, table

SLOTS = 48
LEVEL = 3
GROUP_CHARS = 4_000_000
_EMPTY = "0" * 16

_U = np.uint64
_LOW = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)
#: label of a byte after its left neighbour, at 256 * left + byte: twice the lowest bit where they differ, plus that bit of the byte
_TOSS = (2 * _LOW[np.arange(256)[:, None] ^ np.arange(256)] + (np.arange(256)[None, :] >> _LOW[np.arange(256)[:, None] ^ np.arange(256)] & 1)).astype(np.uint8).ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2 ** 64, and their inverses."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def parse(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: names of the phrases into which sequences fall, and where each sequence starts among them.

    ``names`` (uint8 or uint64) holds all sequences, none empty; ``starts`` says where each begins. Runs of one name become
    a single symbol. Neighbours then differ, and deterministic coin tossing shrinks the symbols to six labels: each time a
    symbol is replaced by the lowest bit in which it differs from its left neighbour. Phrases start at local maxima of the
    labels, so they hold 2 to about 11 symbols, and where one starts depends on a few symbols around it only. A phrase's
    name is a hash of its symbols, their order and run lengths.
    """
    new = np.empty(len(names), bool)
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new[starts] = True
    at = np.flatnonzero(new)
    symbol, first = names[new], np.searchsorted(at, starts)
    if symbol.dtype == np.uint8:
        label, value = symbol, _BYTES[symbol]
    else:
        differ = symbol.copy()
        differ[1:] ^= symbol[:-1]
        differ[first] = _U(1)
        low = np.bitwise_count((differ & (~differ + _U(1))) - _U(1)).astype(np.uint64)
        label, value = (2 * low + (symbol >> low & _U(1))).astype(np.uint8), symbol.copy()
    for _ in range(3):
        pair = label.astype(np.uint16)
        pair[1:] |= pair[:-1] << 8
        pair[first] = label[first] | (label[first] ^ 1).astype(np.uint16) << 8
        label = _TOSS[pair]
    start = np.zeros(len(label), bool)
    rising = label[1:] > label[:-1]
    start[1:-1] = rising[:-1] & ~rising[1:]  # neighbours never share a label
    start[np.append(first[1:], len(label)) - 1] = False
    start[first] = True
    run = np.diff(at, append=len(names))
    several = np.flatnonzero(run > 1)
    value[several] += _mix(run[several].astype(np.uint64))
    power, inverse = _power(len(value))
    begin = np.flatnonzero(start)
    return _mix(np.add.reduceat(value * power, begin) * inverse[begin]), np.searchsorted(begin, first)


def fingerprints(texts: list[str], slots: int = SLOTS, level: int = LEVEL) -> list[str]:
    """Fingerprint of each text: 16 hex digits that name the whole text, then the ``slots`` least of its phrase names.

    Levels are parsed until one symbol is left, whose name stands for the whole text. The sketch takes the names of phrases at
    ``level`` and above (each some tens of letters or more), or of the topmost level that a short text reaches, in ascending
    order. Equal texts have equal fingerprints. An empty text has sixteen zeros and no sketch.
    """
    raw = [t.encode() for t in texts]
    alive = np.array([i for i, r in enumerate(raw) if r], np.int64)
    names = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(raw[i]) for i in alive], np.int64)
    root = np.zeros(len(raw), np.uint64)
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    depth = 0
    while len(names):
        names, starts = parse(names, np.cumsum(sizes) - sizes)
        depth += 1
        sizes = np.diff(starts, append=len(names))
        single = sizes == 1
        root[alive[single]] = _mix(names[starts[single]] + _U(depth))
        if depth >= level:
            kept.append((names, np.repeat(alive, sizes)))
        else:
            kept.append((names[starts[single]], alive[single]))
        names = names[np.repeat(~single, sizes)]
        alive, sizes = alive[~single], sizes[~single]
    sketch = [[] for _ in raw]
    if kept:
        name, owner = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((name, owner))
        name, owner = name[order], owner[order]
        fresh = np.ones(len(name), bool)
        fresh[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
        name, owner = name[fresh], owner[fresh]
        least = np.arange(len(name)) - np.searchsorted(owner, owner) < slots
        for d, x in zip(owner[least].tolist(), name[least].tolist()):
            sketch[d].append(f"{x:016x}")
    return [f"{r:016x}" + "".join(s) if t else _EMPTY for r, s, t in zip(root.tolist(), sketch, raw)]


def likeness(a: str, b: str, slots: int = SLOTS) -> float:
    """Estimated share of phrase names that two texts have in common: of the least names of both, those in each sketch."""
    if a[:16] == b[:16]:
        return 1.0
    x, y = ({f[i:i + 16] for i in range(16, len(f), 16)} for f in (a, b))
    least = sorted(x | y)[:slots]
    return len(x.intersection(y, least)) / len(least) if least else 0.0


def edited(text: str, after: str) -> str:
    """The last half of the code points replaced by the first as many, or all, of the next text."""
    n = len(text) // 2
    return text[:len(text) - n] + after[:n]


def _rows(pairs: list[tuple[str, str]]) -> list[tuple]:
    changed = [edited(t, after) for t, after in pairs]
    own = fingerprints([t for t, _ in pairs] + [pairs[-1][1]])
    other = fingerprints(changed)
    return [(len(t), hashlib.sha256(c.encode()).hexdigest(), f, e, likeness(f, e), likeness(f, own[i + 1]))
            for i, ((t, _), c, f, e) in enumerate(zip(pairs, changed, own, other))]


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_chars: int = GROUP_CHARS) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with likenesses to that and to the next document.

    The next document is the one with the next smaller id; after the smallest comes the largest. Ids are cut into ranges of
    about ``group_chars`` letters by approximate quantiles (ids that are no numbers: of a drawn sample), and each text travels once, to its range. The first text of a range
    (its largest id) also travels to the range before it, whose last document needs it: one more text per range, named by
    a table of one row per range. Rows that repeat an id follow each other by text; NULL ids come last; NULL texts are empty.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    numeric = isinstance(docs.schema[doc_id].dataType, T.NumericType)
    chars, rows = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("doc_id")).first()
    parts = max(1, chars // group_chars)
    if parts == 1:
        bounds = []
    elif numeric:
        bounds = sorted(set(source.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (8 * parts))))
    else:
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < 1_000_003 * min(1.0, 32 * parts / max(rows, 1))
        ids = source.select("doc_id").where(F.col("doc_id").isNotNull() & drawn).distinct().toArrow().column("doc_id").to_pylist()
        bounds = sorted(ids)[32::32] if len(ids) > 2 * parts else sorted(ids)
    shared = spark.sparkContext.broadcast(np.array(bounds, np.float64 if numeric else object))

    @F.arrow_udf(T.IntegerType())
    def in_range(ids: pa.Array) -> pa.Array:
        out = np.full(len(ids), len(shared.value) + 1, np.int32)
        known = ids.drop_null()
        x = known.cast(pa.float64(), safe=False).to_numpy() if numeric else np.array(known.to_pylist(), object)  # large ids may round, but keep their order
        out[ids.is_valid().to_numpy(zero_copy_only=False)] = len(shared.value) - np.searchsorted(shared.value, x, "left")  # 0: the largest ids
        return pa.array(out)

    placed = source.withColumn("part", in_range("doc_id"))
    heads = source.select("doc_id").withColumn("part", in_range("doc_id")).groupBy("part").agg(F.max("doc_id").alias("head")).collect()
    order = sorted((r["part"], r["head"]) for r in heads)
    # the head of each range closes the range before it, the head of the first closes the last
    before = spark.createDataFrame(
        [(order[(i + 1) % len(order)][1], order[i][0]) for i in range(len(order))],
        T.StructType([T.StructField("head", docs.schema[doc_id].dataType), T.StructField("to", T.IntegerType())]))
    copies = source.join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", F.col("to").alias("part"))
    moved = placed.withColumn("extra", F.lit(False)).unionByName(copies.withColumn("extra", F.lit(True)))
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type)]).add("n_chars", "long").add("edited_sha256", "string").add("fingerprint", "string").add(
        "edited_fingerprint", "string").add("near_edited", "double").add("near_next", "double")

    def work(group: pa.Table) -> pa.Table:
        rows = list(zip(group.column("doc_id").to_pylist(), group.column("text").to_pylist(), group.column("extra").to_pylist()))

        def ordered(some: list[tuple]) -> list[tuple]:
            by_text = sorted(some, key=lambda r: r[1])
            return sorted((r for r in by_text if r[0] is not None), key=lambda r: r[0], reverse=True) + [r for r in by_text if r[0] is None]

        own = ordered([r for r in rows if not r[2]])
        after = ordered([r for r in rows if r[2]])[0][1]
        texts = [r[1] for r in own] + [after]
        out, lo = [], 0
        while lo < len(own):  # a slice of the range at a time keeps temporary arrays small
            hi, size = lo, 0
            while hi < len(own) and (hi == lo or size < 500_000):
                size += len(texts[hi])
                hi += 1
            out += _rows(list(zip(texts[lo:hi], texts[lo + 1:hi + 1])))
            lo = hi
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.Table.from_arrays(
            [pa.array([r[0] for r in own], group.schema.field("doc_id").type), *(pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds))], names=schema.names)

    return moved.groupBy("part").applyInArrow(work, schema)


@query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))
