"""Best-fit packing of tokenised documents into sequences (operator 3)."""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import query, slices, stored, table

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
#: The tokenizer's only special token; a text that holds it goes to the tokenizers library itself.
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def _encoders(path: str):
    """(fast, exact): the vocabulary as ranks for tiktoken, which gives the same ids for plain text, and the file itself."""
    import tiktoken
    from tokenizers import Tokenizer

    lines = Path(path).with_suffix(".tiktoken").read_bytes().splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = lru_cache(maxsize=1)(lambda: Tokenizer.from_file(path))
    return fast.encode_ordinary, lambda text: exact().encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY,
           end: int = END, with_ids: bool = False) -> DataFrame:
    """Token ids of each document followed by ``end``, cut where they exceed ``capacity``.

    One row per piece: doc_id, piece (from 0), start (ids of the document before it), length, ids_crc32 (of the
    little-endian 32-bit ids) and, if asked for, ids. Only longer documents are cut; the remainder stands first, all
    other pieces are full. A NULL or empty text is the end id alone. Columns besides the two named are not read.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([source.schema["doc_id"]]).add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    schema = schema.add("ids", T.ArrayType(T.IntegerType())) if with_ids else schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast, exact = _encoders(path)
        for batch in slices(batches, "text"):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                all_ids = np.array((exact if SPECIAL in t else fast)(t) + [end], "<u4")
                at = 0
                for k, to in enumerate(range(len(all_ids) % capacity or capacity, len(all_ids) + 1, capacity)):
                    part = all_ids[at:to]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(part.tobytes()))
                    ids.append(part.astype(np.int32)) if with_ids else None
                    at = to
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names=schema.names)

    return source.mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where pieces go, worked out on how many there are of each length: rows (length, rank, n, sequence, offset).

    The pieces of a length with ranks rank .. rank + n - 1 go, one each, to the sequences from ``sequence`` on, at
    ``offset``. Pieces above a third of the capacity come first, longest first: at most two of them fit together, so
    each takes the longest partner that fits, a greedy matching that wastes no sequence. Smaller ones follow,
    longest first, each into the tightest gap, or else into new sequences. Equal pieces move in runs, so the work
    depends on the capacity, not on the number of pieces.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []  # of the gaps, ascending
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    rows, made = [], 0

    def put(length: int, n: int, sequence: int, gap: int) -> None:
        rows.append((length, used[length], n, sequence, capacity - gap))
        used[length] += n
        left[length] -= n
        rest = gap - length
        if rest:
            if rest not in gaps:
                bisect.insort(sizes, rest)
                gaps[rest] = []
            gaps[rest].append((sequence, n))

    def fill(length: int, gap: int, most: int) -> None:
        sequence, n = gaps[gap].pop()
        k = min(n, most)
        if n > k:
            gaps[gap].append((sequence + k, n - k))
        if not gaps[gap]:
            del gaps[gap]
            sizes.remove(gap)
        put(length, k, sequence, gap)

    large = sorted(x for x in left if 3 * x > capacity)
    while large:
        a = large[-1]
        fits = bisect.bisect_right(large, capacity - a)
        b = large[fits - 1] if fits else 0
        n = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
        if n == 0:  # one of an even class is left over: the next shorter partner
            n, b = 1, large[fits - 2] if fits > 1 else 0
        put(a, n, made, capacity)
        made += n
        while b and n:
            gap = capacity - a
            before = left[b]
            fill(b, gap, n)
            n -= before - left[b]
        large = [x for x in large if left[x]]
    for a in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[a]:
            at = bisect.bisect_left(sizes, a)
            if at < len(sizes):
                fill(a, sizes[at], left[a])
            else:
                n = -(-left[a] // (capacity // a))
                put(a, n, made, capacity)
                made += n
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with doc_id, piece and length from 1 to ``capacity``.

    Only the number of pieces of each length reaches the driver. There ``plan`` gives runs of places; a piece finds its
    own by its rank among pieces of its length, counted in about sqrt(n) salted groups per length, so that a length
    with most of the pieces is no single task. The runs are at most a few thousand numbers and go to all tasks.
    Repeated rows are separate pieces. An empty table stays empty.
    """
    spark = cut.sparkSession
    cut = stored(cut)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    runs = sorted(plan(counts, capacity)) or [(0, 0, 0, 0, 0)]
    shared = spark.sparkContext.broadcast(np.array(runs, np.int64))
    salts = max(1, int(max(counts.values(), default=1) ** 0.5))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    group = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    sizes = salted.groupBy("length", "_salt").count().withColumn(
        "_before", F.sum("count").over(Window.partitionBy("length").orderBy("_salt")) - F.col("count")).drop("count")
    ranked = salted.withColumn("_rank", F.row_number().over(group)).join(sizes, ["length", "_salt"])

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        table = shared.value
        length, rank = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        run = table[np.searchsorted((table[:, 0] << 48) + table[:, 1], (length << 48) + rank, "right") - 1]
        return pa.StructArray.from_arrays([pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])], ["sequence_id", "offset"])

    placed = ranked.withColumn("_place", place(F.col("length"), F.col("_before") + F.col("_rank") - 1))
    return placed.select(*cut.columns, "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (joined by offset) and docs (doc_id, piece, offset, length)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"),
        F.transform("p", lambda x: F.struct(x.doc_id.alias("doc_id"), x.piece.alias("piece"), x.offset.alias("offset"), x.length.alias("length"))).alias("docs"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
