"""Grouping of spelling variants by k-d trees over letter counts (operator 12)."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm.common import query, slices, stored, table

LEAST_LENGTH = 5
LEAST_COUNT = 3
FACTOR = 2
#: One word in so many, by checksum of document and word, loses a letter.
NOISE = 97
RUN = re.compile("[a-zÀ-ÿ]+")
#: Words that one cell of a length's outer tree holds, about.
CELL = 20_000
#: The outer trees' cuts come from at most so many words; every word is placed and searched.
SAMPLE = 200_000
#: Letter counts are kept in so many bins: a to z, and the other code points by remainder.
BINS = 32
_LEAF = 32
_CHUNK = 1 << 21


def noisy_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, noise: int | None = NOISE) -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case and how often they occur; a task sends a word once for each 200,000 it meets.

    With ``noise``, a run loses one letter in documents where ``noise`` divides the checksum of id and run, as the text
    ``<id>:<run>``; the checksum also picks the letter. NULL texts have no words; a NULL id counts as empty text.
    """
    source = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return done

        for batch in slices(batches, "text"):
            for name, t in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                runs = Counter(RUN.findall(t.encode().lower().decode())) if t else {}
                begun = zlib.crc32(f"{name}:".encode())
                for run, n in runs.items():
                    if len(run) >= least_length:
                        if noise:
                            h = zlib.crc32(run.encode(), begun)
                            if h % noise == 0:
                                run = run[:h % len(run)] + run[h % len(run) + 1:]
                                if len(run) < least_length:
                                    continue
                        total[run] += n
            if len(total) >= 200_000:
                yield flush()
        if total:
            yield flush()

    return source.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of one length as rows of code points, and their letter counts in bins.

    One edit changes the counts by at most two in all (L1), also in bins; counts beyond 127 are cut off, which brings no two apart.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    low = codes - np.uint32(97)
    bins = np.where(low < 26, low, 26 + codes % (BINS - 26)).astype(np.int64)
    counts = np.zeros((len(words), BINS), np.int16)
    for place in range(codes.shape[1]):
        counts[np.arange(len(words)), bins[:, place]] += 1
    return codes, np.minimum(counts, 127).astype(np.int8)


class LetterTree:
    """A k-d tree over letter counts. A node cuts one bin at one value; places below it are a stretch of ``order``."""

    def __init__(self, counts: np.ndarray, leaf: int = _LEAF):
        self.order = np.arange(len(counts))
        self.bin, self.cut, self.low, self.high, self.child, self.begin, self.end = [], [], [], [], [], [], []
        cell = np.array([[-1, 128]] * BINS)
        todo = [(0, len(counts), cell, -1, 0)]
        while todo:
            begin, end, cell, parent, side = todo.pop()
            node = len(self.bin)
            if parent >= 0:
                self.child[parent][side] = node
            own = counts[self.order[begin:end]]
            at, cut, goes = self._best(own) if end - begin > leaf else (-1, 0, None)
            self.bin.append(at)
            self.cut.append(cut)
            self.low.append(cell[at, 0] if at >= 0 else 0)
            self.high.append(cell[at, 1] if at >= 0 else 0)
            self.child.append([-1, -1])
            self.begin.append(begin)
            self.end.append(end)
            if at >= 0:
                self.order[begin:end] = self.order[begin:end][np.argsort(~goes, kind="stable")]
                middle = begin + int(goes.sum())
                left, right = cell.copy(), cell.copy()
                left[at, 1], right[at, 0] = cut, cut + 1
                todo += [(middle, end, right, node, 1), (begin, middle, left, node, 0)]
        for name in ("bin", "cut", "low", "high", "child", "begin", "end"):
            setattr(self, name, np.array(getattr(self, name), np.int64))

    @staticmethod
    def _best(own: np.ndarray) -> tuple[int, int, np.ndarray | None]:
        """The bin and value that cut most evenly; no cut (-1) if all counts are equal."""
        n, best = len(own), (0, -1, 0)
        middle = np.sort(own, axis=0)[[n // 4, n // 2, 3 * n // 4]]
        for cut in (*middle, middle[1] - 1):
            below = (own <= cut).sum(axis=0)
            even = np.minimum(below, n - below)
            at = int(even.argmax())
            best = max(best, (int(even[at]), at, int(cut[at])))
        if not best[0]:
            spread = np.flatnonzero(own.min(axis=0) < own.max(axis=0))
            if not len(spread):
                return -1, 0, None
            best = (1, int(spread[0]), int(own[:, spread[0]].min()))
        return best[1], best[2], own[:, best[1]] <= best[2]

    def leaves(self, counts: np.ndarray, radius: int, after: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, leaf) for all leaves whose box is within the L1 ``radius`` of a query; boxes farther off are pruned with all below.

        All queries go down together, one level at a time. With ``after``, leaves that end before that place are left out.
        """
        who, node, far = np.arange(len(counts)), np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        while len(who):
            if after is not None:
                keep = self.end[node] > after[who]
                who, node, far = who[keep], node[keep], far[keep]
            inner = self.bin[node] >= 0
            yield who[~inner], node[~inner]
            who, node, far = who[inner], node[inner], far[inner]
            x = counts[who, self.bin[node]].astype(np.int64)
            under, over = np.maximum(self.low[node] - x, 0), np.maximum(x - self.high[node], 0)
            left = far - over + np.maximum(x - self.cut[node], 0)
            right = far - under + np.maximum(self.cut[node] + 1 - x, 0)
            a, b = left <= radius, right <= radius
            who, node, far = np.concatenate([who[a], who[b]]), np.concatenate([self.child[node[a], 0], self.child[node[b], 1]]), np.concatenate([left[a], right[b]])


def _unary(counts: np.ndarray) -> np.ndarray:
    """Counts 0, 1 and 2 or more of each bin as two bits: unequal bits are never more than the L1 distance."""
    bits = np.arange(BINS, dtype=np.uint64)
    return (((counts > 0).astype(np.uint64) << bits) | ((counts > 1).astype(np.uint64) << (bits + np.uint64(BINS)))).sum(axis=1, dtype=np.uint64)


def _pairs(tree: LetterTree, counts: np.ndarray, queries: np.ndarray, radius: int, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word) with letter counts at most ``radius`` apart, a block at a time; each pair once if the queries are the tree's own words."""
    bits, asked = _unary(counts)[tree.order], _unary(queries)
    place = np.empty(len(counts), np.int64)
    place[tree.order] = np.arange(len(counts))
    step = max(1, _CHUNK // 1024)
    for first in range(0, len(queries), step):
        block = slice(first, min(first + step, len(queries)))
        after = place[block] if own else None
        for who, leaf in tree.leaves(queries[block], radius, after):
            sizes = tree.end[leaf] - tree.begin[leaf]
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()), _CHUNK), "left")
            for a, b in zip(cuts, [*cuts[1:], len(leaf)]):
                n = sizes[a:b]
                at = np.arange(n.sum()) + np.repeat(tree.begin[leaf[a:b]] - np.cumsum(n) + n, n)
                asks = np.repeat(who[a:b], n)
                near = np.bitwise_count(asked[first + asks] ^ bits[at]) <= radius
                near &= (at > after[asks]) if own else True
                asks, words = first + asks[near], tree.order[at[near]]
                near = np.abs(queries[asks].astype(np.int16) - counts[words]).sum(axis=1) <= radius
                yield asks[near], words[near]


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of code points differ by exactly one edit: in one place, or by one letter more in ``long``."""
    n = short.shape[1]
    same = short == long[:, :n]
    if long.shape[1] == n:
        return same.sum(axis=1) == n - 1
    front = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


def search(words: list[str], n: np.ndarray, queries: list[str], queries_n: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) places that are one edit apart. All words have one length; queries have it too, or are one letter shorter."""
    codes, counts = letters(words)
    asked, asked_counts = (codes, counts) if own else letters(queries)
    radius = 2 if asked.shape[1] == codes.shape[1] else 1
    found = [(np.empty(0, np.int64),) * 2]
    for who, at in _pairs(LetterTree(counts), counts, asked_counts, radius, own):
        for a in range(0, len(who), step := max(1, _CHUNK // codes.shape[1])):
            near = one_edit(asked[who[a:a + step]], codes[at[a:a + step]])
            found.append((who[a:a + step][near], at[a:a + step][near]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _bests(texts: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """For each word of the pairs (a, b), both ways: how many near words, and the one of largest n, ties to the first in code-point order."""
    by = sorted(range(len(texts)), key=lambda i: (-n[i], texts[i]))
    rank = np.empty(len(texts), np.int64)
    rank[by] = np.arange(len(texts))
    word, near = np.concatenate([a, b]), rank[np.concatenate([b, a])]
    order = np.argsort(word, kind="stable")
    word, near = word[order], near[order]
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.empty(0, np.int64)
    best = [by[i] for i in np.minimum.reduceat(near, starts)] if len(word) else []
    own = word[starts]
    return pd.DataFrame({
        "word": [texts[i] for i in own], "n_near": np.diff(np.append(starts, len(word))).astype(np.int64),
        "best": [texts[i] for i in best], "best_n": n[best].astype(np.int64) if len(best) else np.empty(0, np.int64)})


_FOUND = "word string, n_near long, best string, best_n long"


def _search_cell(part: pa.Table) -> pa.Table:
    """The near words of one cell: among its own words (role 0), and of words of other cells (1) and one letter shorter (2) with them."""
    role = part.column("role").to_numpy()
    words, n = part.column("word").to_pylist(), part.column("n").to_numpy()
    at = [np.flatnonzero(role == r) for r in range(3)]
    own = [words[i] for i in at[0]]
    a, b = [], []
    for r in range(3) if own else ():
        if len(at[r]):
            who, near = search(own, n[at[0]], [words[i] for i in at[r]], n[at[r]], r == 0)
            a.append(at[r][who])
            b.append(at[0][near])
    found = _bests(words, n, np.concatenate(a), np.concatenate(b)) if a else _bests([], n, *[np.empty(0, np.int64)] * 2)
    return pa.Table.from_pandas(found, pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())]), preserve_index=False)


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, best, best_n) of words (word, n) that have a word one inserted, deleted or replaced code point away.

    ``words`` holds each word once and is read several times, so it should be stored. Words of one length are dealt to the
    cells of an outer k-d tree over their letter counts; its cuts come from at most ``sample`` words. A word is sent to its own
    cell and, as a query, to the later cells of its length within L1 distance two and to the cells of the next length within
    one, so each pair meets once. Each cell builds its own tree and prunes by boxes; the letter order of what is left is
    verified. A cell far above ``cell`` words, as one of many anagrams, is cut into parts that all its queries visit.
    Ties between best words go to the first in code-point order.
    """
    spark = words.sparkSession
    total = words.count()
    share = min(1.0, sample / max(total, 1))
    sizes = {r["size"]: r["count"] for r in words.groupBy(F.length("word").alias("size")).count().collect()}
    drawn = words.select("word") if share == 1 else words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))).select("word")
    by_length: dict[int, list[str]] = {size: [] for size in sizes}
    for word in drawn.toArrow().column("word").to_pylist() if max(sizes.values(), default=0) > cell else ():
        by_length[len(word)].append(word)
    trees = {}
    for size, some in by_length.items():
        few = sizes[size] <= cell or not some
        trees[size] = LetterTree(np.zeros((1, BINS), np.int8) if few else letters(some)[1], max(1, round(cell * share)))
        trees[size].order = None
    shared = spark.sparkContext.broadcast(trees)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            texts = np.array(batch.column("word").to_pylist(), object)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            parts = []
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                counts = letters(texts[at].tolist())[1]
                home = np.empty(len(at), np.int64)
                for who, leaf in trees[size].leaves(counts, 0):
                    home[who] = leaf
                parts.append((at, np.full(len(at), size), home, np.zeros(len(at), np.int64)))
                for who, leaf in trees[size].leaves(counts, 2):
                    later = leaf > home[who]
                    parts.append((at[who[later]], np.full(later.sum(), size), leaf[later], np.ones(later.sum(), np.int64)))
                for who, leaf in trees[size + 1].leaves(counts, 1) if size + 1 in trees else ():
                    parts.append((at[who], np.full(len(who), size + 1), leaf, np.full(len(who), 2)))
            at, size, leaf, role = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(size.astype(np.int32)), pa.array(leaf.astype(np.int32)), pa.array(role.astype(np.int32)), *(batch.column(c).take(pa.array(at)) for c in ("word", "n"))],
                names=["size", "cell", "role", "word", "n"])

    placed = words.select("word", F.col("n").cast("long")).mapInArrow(place, "size int, cell int, role int, word string, n long")
    full = [(r["size"], r["cell"], -(-r["count"] // cell)) for r in placed.where("role = 0").groupBy("size", "cell").count().where(F.col("count") > 2 * cell).collect()]
    if full:
        parts = spark.createDataFrame(full, "size int, cell int, parts int")
        own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        placed = (
            placed.join(F.broadcast(parts), ["size", "cell"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("own", F.when(F.col("role") == 0, own).otherwise(0))
            .withColumn("part", F.explode(F.sequence("own", F.col("parts") - 1)))
            .withColumn("role", F.when((F.col("role") == 0) & (F.col("part") > F.col("own")), 1).otherwise(F.col("role")))
            .select("size", "cell", "part", "role", "word", "n"))
    else:
        placed = placed.withColumn("part", F.lit(0))
    cells = sum(len(tree.bin) // 2 + 1 for tree in trees.values()) + sum(x[2] for x in full)
    dealt = placed.repartition(max(cells, int(spark.conf.get("spark.sql.shuffle.partitions"))), "size", "cell", "part")
    found = dealt.groupBy("size", "cell", "part").applyInArrow(_search_cell, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) without loops: forms followed to the last, twice as far in each round."""
    reached = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while reached.where("moved").limit(1).count():
        onward = reached.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        reached = stored(reached.join(onward, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")))
    return reached.select("word", "root")


def variants(words: DataFrame, factor: int = FACTOR, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of (word, n).

    A word's form is its near word (one inserted, deleted or replaced code point away) of largest n, ties to the first in
    code-point order, if that is at least ``factor`` (2 or more) times its own n. The root is the last form of the chain from the
    word, itself if it has none. Words are taken as they are, repeated ones added up; NULL and empty ones are left out.
    """
    words = stored(words.where("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")))
    near = stored(near_words(words, cell, sample))
    formed = words.join(near, "word", "left").withColumn("is", F.col("best_n") >= factor * F.col("n"))
    formed = stored(formed.select(
        "word", F.when(F.col("is"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is"), F.col("best_n")).alias("form_n")))
    followed = roots(formed.where("form IS NOT NULL"))
    return formed.join(followed, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i::UBIGINT, list_transform(range(0, 8), lambda k: k::UBIGINT)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL
), hexed AS (
  SELECT run, n, hex(doc_id || ':' || run) AS x FROM runs
), checked AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS h FROM hexed, crc
), words AS (
  SELECT CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM checked GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near JOIN words ON other = words.word GROUP BY near.word
), formed AS (
  SELECT w.word, CASE WHEN other_n >= {FACTOR} * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {FACTOR} * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
  SELECT word, word AS reached FROM formed UNION ALL SELECT chain.word, form FROM chain JOIN formed ON reached = formed.word WHERE form IS NOT NULL
)
SELECT f.word, f.form, chain.reached AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain ON f.word = chain.word JOIN formed last ON chain.reached = last.word AND last.form IS NULL
"""


@query("op12_spelling", SQL)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(noisy_words(table(spark, sf_dir, "documents")).where(F.col("n") >= LEAST_COUNT))
