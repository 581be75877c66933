"""Language-model scores from subword lattices (operator 6)."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import fold, query, slices, stored, table

VOCABULARY = "piece_bpe_32k.model"
#: At most so many words, the most frequent, go to every task; all others are joined.
HEAD = 200_000
#: Rounds of estimating the probabilities of pieces.
ROUNDS = 2
_SPACE = "▁"
_LN10 = math.log(10)
#: ln probability of a byte for which the vocabulary has no piece.
_NO_BYTE = -6 * _LN10
#: Odd multipliers that spread keys; fixed values.
_SPREAD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]
#: Letters of words that take the steps of the recursion together.
_LETTERS = 30_000
_FLUSH = 300_000
_MEMO = 200_000


def words_of(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case: bytes.lower and bytes.split know exactly ASCII letters and white space."""
    return text.encode().lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(words_of(text.as_py() or ""))
            if len(counts) > _FLUSH:
                yield out()
                counts = Counter()
    yield out()


@lru_cache(maxsize=1)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@dataclass
class Model:
    """Word counts as a stored table, their totals, and log10 probabilities of subword pieces and frequent words."""

    counts: DataFrame
    tokens: int
    kinds: int
    ends: int
    unseen: float
    shared: Broadcast

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.kinds + 1)


def fit(docs: DataFrame, text: str = "text", path: str | None = None, head: int = HEAD, rounds: int = ROUNDS) -> Model:
    """Learn from all texts: counts of every word, and a unigram score for each piece of an existing vocabulary.

    Words are counted per task, then by one shuffle; the table is stored. Pieces begin with their number in the
    vocabulary's own segmentation of each different word. Then, ``rounds`` times, their probabilities are estimated anew from all
    segmentations of all words (forward and backward recursion), each word weighing as many of its uses as its lattice, not
    its whole-word arc, is expected to account for: a word seen once is all spelt, as without this use it would not be known. The share of
    uses that are spelt is estimated along. Only numbers for pieces, as many as the vocabulary has, and at most ``head`` frequent
    words reach the driver and go to all tasks. A NULL text is an empty one: a text of the end token alone.
    """
    spark, path = docs.sparkSession, path or public_tokenizers.path(VOCABULARY)
    counts = stored(docs.select(F.col(text).alias("text")).mapInArrow(_count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c")))
    ends = docs.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("once")).first()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, pieces = _processor(path), Counter()
        for batch in batches:
            pieces.update(chain.from_iterable(sp.encode(batch.column(0).to_pylist(), num_threads=1)))
        yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), pa.array(list(pieces.values()), pa.int64())], names=["piece", "n"])

    sp = _processor(path)
    size = sp.get_piece_size()
    names = {i: sp.id_to_piece(i) for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i))}

    def probabilities(found: DataFrame) -> dict[str, float]:
        used = {r["piece"]: r["n"] for r in found.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        spelt.append(used.pop(None, 0.0))
        whole = math.fsum(used.values()) + 0.5 * size
        return {name: math.log10((used.get(i, 0) + 0.5) / whole) for i, name in names.items()}

    spelt: list[float] = []
    scores = probabilities(counts.select("word").mapInArrow(cut, "piece int, n long"))
    tokens, kinds = total["n"] + ends, total["v"] + (ends > 0)
    unseen = max(1e-6, total["once"] / tokens) if tokens else 1.0
    for _ in range(rounds if total["v"] else 0):
        found = counts.mapInArrow(_expected(spark.sparkContext.broadcast((scores, unseen, tokens)), list(names)), "piece int, n double")
        scores = probabilities(found)
        unseen = max(1e-6, spelt[-1] / tokens)
    # a threshold that at most ``head`` words reach, from a histogram: a sorted limit would send that many words from each task
    step = F.floor(F.log2("c") * 8)
    least, reached = None, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        reached += r["count"]
        if reached > head:
            break
        least = r["step"]
    frequent = {} if least is None else {r["word"].encode(): r["c"] for r in counts.where(step >= least).collect()}
    mass = tokens + 0.5 * (kinds + 1)
    return Model(counts, tokens, kinds, ends, unseen, spark.sparkContext.broadcast((scores, frequent, mass, unseen)))


class _Trie:
    """Pieces by their letters. A step is keyed by (node, letter), exactly, and looked up for many places at once."""

    def __init__(self, pieces: dict[str, int]):
        steps: dict[int, int] = {}
        names = [-1]
        for piece, number in pieces.items():
            node = 0
            for c in piece:
                key = node << 21 | ord(c)
                node = steps.setdefault(key, len(names))
                if node == len(names):
                    names.append(-1)
            if piece:
                names[node] = number
        self.piece = np.array(names)
        self.keys = np.array([-1, *steps], np.int64)  # the key that leads to each node
        bits = max(8, len(names).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.tables = []
        left = np.arange(1, len(names))
        while len(left):  # nodes whose slot is taken go to the next table
            table = np.zeros(1 << bits, np.int64)
            slot = self._slot(self.keys[left], len(self.tables))
            table[slot] = left
            self.tables.append(table)
            left = left[table[slot] != left]

    def _slot(self, key: np.ndarray, table: int) -> np.ndarray:
        return ((key.view(np.uint64) * _SPREAD[table % len(_SPREAD)]) >> self.shift).view(np.int64)

    def find(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(place of its last letter, piece) of every place of every piece."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        ends, pieces = [], []
        while len(at):
            key = node << 21 | codes[at]
            node = np.zeros(len(at), np.int64)
            for k, table in enumerate(self.tables):
                other = table[self._slot(key, k)]
                node = np.where(self.keys[other] == key, other, node)
            at, node = at[node > 0], node[node > 0]
            piece = self.piece[node]
            ends.append(at[piece >= 0])
            pieces.append(piece[piece >= 0])
            more = at + 1 < len(codes)
            at, node = at[more] + 1, node[more]
        return (np.concatenate(ends), np.concatenate(pieces)) if ends else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class _Arcs:
    """Arcs of lattices side by side: nodes, letters before the end, letters, piece (-1: bytes), ln probability, word; per word the root and the letters."""

    start: np.ndarray
    end: np.ndarray
    depth: np.ndarray
    n: np.ndarray
    piece: np.ndarray
    value: np.ndarray
    word: np.ndarray
    root: np.ndarray
    sizes: np.ndarray
    odd: dict[int, str]


class Lattice:
    """Probability of a word over all of its segmentations into pieces, in log space.

    A trie finds every piece that ends at each letter. The forward recursion runs over the letters: what
    reaches a letter is the sum, over pieces that end there, of what reached the piece's start times the piece. A
    letter that is no piece itself is bridged by its bytes. The pieces' product over a word is a distribution over words,
    since a piece that begins with the word mark ends the word before. Many words take each step together, as arrays.
    """

    def __init__(self, scores: dict[str, float]):
        """``scores``: log10 probability of each piece."""
        self.names = list(scores)
        self.values = np.array([*scores.values(), 0.0]) * _LN10
        number = {p: i for i, p in enumerate(self.names)}
        self.bytes = [number.get(f"<0x{b:02X}>", -1) for b in range(256)]
        self.pieces = _Trie({p: i for p, i in number.items() if _SPACE not in p[1:]})
        self.single = {p for p in number if len(p) == 1}
        self.sizes = np.array([len(p) for p in self.names], np.int64)
        self.marked = np.array([p[:1] == _SPACE for p in self.names], bool)

    def _spelt(self, letter: str) -> float:
        return sum(self.values[self.bytes[b]] if self.bytes[b] >= 0 else _NO_BYTE for b in letter.encode())

    def _arcs(self, words: list[str]) -> _Arcs:
        """The lattices of some words side by side; each has a node before every letter, the mark included, and one at its end."""
        joined = _SPACE + _SPACE.join(words)
        sizes = np.array([len(w) + 1 for w in words])
        begin = np.cumsum(sizes) - sizes
        last, piece = self.pieces.find(joined)
        n = self.sizes[piece]
        word = np.repeat(np.arange(len(words)), sizes)
        own = ~self.marked[piece] | (last + 1 - n == begin[word[last]])  # a marked piece begins its word
        last, n, piece = last[own], n[own], piece[own]
        value = self.values[piece]
        odd = [(begin[i] + k, c) for i, w in enumerate(words) if _SPACE in w or not self.single.issuperset(w) for k, c in enumerate(w, 1)
               if c not in self.single or c == _SPACE]
        if _SPACE not in self.single:
            odd += [(k, _SPACE) for k in begin]
        last = np.concatenate([last, np.array([k for k, _ in odd], np.int64)])
        n = np.concatenate([n, np.ones(len(odd), np.int64)])
        piece = np.concatenate([piece, np.full(len(odd), -1)])
        value = np.concatenate([value, np.array([self._spelt(c) for _, c in odd])])
        word = word[last]
        end = last + 1 + word
        return _Arcs(end - n, end, last + 1 - begin[word], n, piece, value, word, begin + np.arange(len(words)), sizes, {len(piece) - len(odd) + i: c for i, (_, c) in enumerate(odd)})

    @staticmethod
    def _pass(at: np.ndarray, source: np.ndarray, target: np.ndarray, turn: np.ndarray, value: np.ndarray) -> None:
        """Fill in ``at`` the ln of the sum over arcs into each target, all targets of one turn together, earlier turns first."""
        order = np.argsort(target, kind="stable")
        turn = turn[order]
        order = order[np.argsort(turn.astype(np.uint16) if turn.max() < 1 << 16 else turn, kind="stable")]
        source, target, value, turn = source[order], target[order], value[order], np.sort(turn)
        new = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        counts = np.diff(np.append(new, len(target)))
        turns = np.flatnonzero(np.concatenate([[True], turn[1:] != turn[:-1], [True]]))
        groups = np.searchsorted(new, turns)
        for lo, hi, g, h in zip(turns[:-1], turns[1:], groups[:-1], groups[1:]):
            x, heads = at[source[lo:hi]] + value[lo:hi], new[g:h] - lo
            top = np.maximum.reduceat(x, heads)
            at[target[new[g:h]]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, counts[g:h])), heads))

    @classmethod
    def _forward(cls, arcs: _Arcs) -> np.ndarray:
        at = np.zeros(int((arcs.sizes + 1).sum()))
        cls._pass(at, arcs.start, arcs.end, arcs.depth, arcs.value)
        return at

    @staticmethod
    def _batches(words: list[str]) -> Iterator[list[int]]:
        """Numbers of words of similar length, about _LETTERS letters at a time."""
        batch, letters = [], 0
        for i in sorted(range(len(words)), key=lambda i: len(words[i])):
            if batch and letters + len(words[i]) > _LETTERS:
                yield batch
                batch, letters = [], 0
            batch.append(i)
            letters += len(words[i]) + 1
        if batch:
            yield batch

    def log10(self, words: list[str]) -> list[float]:
        """log10 probability of each word."""
        out = np.empty(len(words))
        for batch in self._batches(words):
            arcs = self._arcs([words[i] for i in batch])
            out[batch] = self._forward(arcs)[arcs.root + arcs.sizes] / _LN10
        return out.tolist()

    def expect(self, words: list[str], weigh) -> tuple[np.ndarray, float]:
        """How often each piece is expected where word i is spelt ``weigh(numbers, log10 probabilities)[i]`` times, and the sum of those.

        Forward and backward recursions give each arc's share among all segmentations of its word.
        """
        expected, total = np.zeros(len(self.names)), 0.0
        for batch in self._batches(words):
            arcs = self._arcs([words[i] for i in batch])
            reached = self._forward(arcs)
            ahead = np.zeros(len(reached))
            self._pass(ahead, arcs.end, arcs.start, arcs.sizes[arcs.word] - arcs.depth + arcs.n, arcs.value)
            whole = reached[arcs.root + arcs.sizes]
            weight = weigh(np.array(batch), whole / _LN10)
            total += float(weight.sum())
            share = weight[arcs.word] * np.exp(reached[arcs.start] + arcs.value + ahead[arcs.end] - whole[arcs.word])
            piece = arcs.piece >= 0
            expected += np.bincount(arcs.piece[piece], share[piece], len(expected))
            for arc, letter in arcs.odd.items():
                for b in letter.encode():
                    if self.bytes[b] >= 0:
                        expected[self.bytes[b]] += share[arc]
        return expected, total


@lru_cache(maxsize=1)
def _spelling(shared: Broadcast) -> Lattice:
    return Lattice(shared.value[0])


def _expected(shared: Broadcast, ids: list[int]):
    """Of rows (word, c): how often each piece is expected to be used, and in a row without a piece, how many uses of words are spelt."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, (_, unseen, tokens) = _spelling(shared), shared.value
        expected, spelt = np.zeros(len(ids)), 0.0
        for batch in batches:
            c = batch.column("c").to_numpy()
            pieces, uses = lattice.expect(batch.column("word").to_pylist(), lambda i, v: spelt_uses(c[i], v, tokens, unseen))
            expected += pieces
            spelt += uses
        yield pa.RecordBatch.from_arrays([pa.array([*ids, None], pa.int32()), pa.array([*expected, spelt], pa.float64())], names=["piece", "n"])

    return work


def spelt_uses(c: np.ndarray, spelling: np.ndarray, tokens: int, unseen: float) -> np.ndarray:
    """Of ``c`` uses of a word, how many the lattice accounts for, each use being held against the ``c - 1`` others."""
    other = (1 - unseen) * (c - 1) / max(1, tokens - 1)
    own = unseen * 10.0 ** spelling
    return np.divide(c * own, other + own, out=c.astype(float), where=c > 1)


@lru_cache(maxsize=1)
def _tables(shared: Broadcast):
    scores, frequent, mass, unseen = shared.value
    lattice = Lattice(scores)
    head = {}
    for (word, c), spelt in zip(frequent.items(), lattice.log10([w.decode() for w in frequent])):
        known = (c + 0.5) / mass
        head[word] = (math.log10(known), math.log10((1 - unseen) * known + unseen * 10 ** spelt))
    return lattice, head


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """log10 probability of each whole text under the model, next to a plain unigram score.

    A word is either an old one, with its smoothed frequency, or new, spelt by the lattice: P = (1 - unseen) * (c + 0.5) /
    (N + 0.5 (V + 1)) + unseen * lattice, where the first part is for words of the training texts and ``unseen`` is the
    share of uses that the lattice accounts for. This is the lattice with one more arc for the whole word, so the forward recursion over
    a text is the sum of its words' logarithms. The end of a text is a token.

    Frequent words are looked up in the task. Others leave it as (word, document, times) with the lattice value,
    already summed per document, and are joined with the counts by word; sums per document follow. Returns doc_id,
    n_tokens, n_known, base_score, score. Rows that repeat both id and text give equal rows; NULL text is empty text.
    """
    id_type = docs.schema[doc_id].dataType
    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shared = model.shared
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("h", T.LongType()), T.StructField("word", T.StringType()), T.StructField("times", T.LongType()),
        T.StructField("spelt", T.DoubleType()), T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("own", T.DoubleType())])
    end = math.log10((model.ends + 0.5) / model.mass)
    end_own = end + math.log10(1 - model.unseen) if model.unseen < 1 else end
    end_known = int(model.ends > 0)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, head = _tables(shared)
        memo: dict[bytes, float] = {}
        for batch in slices(batches, "text"):
            at, word, times, sums = [], [], [], []
            for i, (t, h) in enumerate(zip(batch.column("text").to_pylist(), batch.column("h").to_pylist())):
                tokens = words_of(t)
                known, base, own = end_known, end, end_own
                for w, k in Counter(tokens).items():
                    value = head.get(w)
                    if value:
                        known += k
                        base += k * value[0]
                        own += k * value[1]
                        continue
                    at.append(i)
                    word.append(w)
                    times.append(k)
                sums.append((b"\n%d" % h, len(tokens) + 1, known, base, own))
            n = len(at)
            if len(memo) > _MEMO:
                memo.clear()
            new = list({w for w in word if w not in memo})
            memo.update(zip(new, lattice.log10([w.decode() for w in new])))
            spelt = [memo[w] for w in word]
            ids = pa.array(at + list(range(len(sums))), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(ids), batch.column("h").take(ids), pa.array(word + [s[0] for s in sums], pa.binary()).cast(pa.string()),
                pa.array(times + [None] * len(sums), pa.int64()), pa.array(spelt + [None] * len(sums), pa.float64()),
                *(pa.array([None] * n + [s[k] for s in sums], kind) for k, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.float64()), (4, pa.float64())))],
                names=schema.names)

    # a document's own row carries a key that is no word, so that it passes the join and spreads evenly
    joined = source.mapInArrow(look_up, schema).join(model.counts, "word", "left")
    known = (F.col("c") + 0.5) / model.mass
    base = F.log10(F.coalesce(known, F.lit(0.5 / model.mass)))
    own = F.log10(F.coalesce(known * (1 - model.unseen), F.lit(0.0)) + model.unseen * F.pow(F.lit(10.0), "spelt"))
    own = F.when(F.col("c").isNull() | (F.col("spelt") < -300) & (F.lit(model.unseen) >= 1), F.col("spelt") + math.log10(model.unseen)).otherwise(own)
    sums = joined.groupBy("doc_id", "h").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count("n_tokens").alias("copies"),
        F.sum(F.coalesce("known", F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
        F.sum(F.coalesce("base", F.col("times") * base)).alias("base_score"), F.sum(F.coalesce("own", F.col("times") * own)).alias("score"))
    copies = F.col("copies")
    return sums.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(
        "doc_id", (F.col("n_tokens") / copies).cast("long").alias("n_tokens"), (F.col("n_known") / copies).cast("long").alias("n_known"),
        (F.col("base_score") / copies).alias("base_score"), (F.col("score") / copies).alias("score"))


@query("op6_lm")
def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from four folds of documents and score all."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", 5) != 1))
    return score(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
