"""Toxicity by a misspelling-tolerant lexicon with context windows (operator 4)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import fold, query, stored, table

SAMPLE_ROWS = 20_000
SUPPORT = 8
PRECISION = 0.95
STEMS = (4, 5, 6)
WINDOW = 4
QUOTED = 0.25
THRESHOLD = 0.3
#: Words that report what somebody else said.
REPORTING = frozenset("said says wrote writes called quoted quote quotes word words term sagte schrieb nannte zitat dit écrit appelé citation dijo escribió llamó cita".split())
QUOTES = "\"'“”„«»‘’`"
_EDGES = QUOTES + ".,;:!?()[]{}<>|*#&$%~_-+=/\\…¡¿"


class Lexicon:
    """A trie of terms, intersected with Levenshtein automata of up to 2 edits.

    Terms of 5 letters or more may have one edit, of 9 or more two; a stem, written with a final '*', stands at the
    start of a longer word without edits. States of the intersection are sets of (trie node, edits) and are made
    when first reached, so a word costs about one dictionary look-up per letter; most words die after a few.
    """

    MOST_STATES = 100_000
    MOST_WORDS = 500_000

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.reach = [0]  # most edits that any term below a node allows
        for term in sorted(terms):
            word, node, edits = term.rstrip("*"), 0, self.edits(term)
            self.reach[0] = max(self.reach[0], edits)
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], edits)
            (self.stem if term.endswith("*") else self.term)[node] = term
        self.reset()

    @staticmethod
    def edits(term: str) -> int:
        return 0 if term.endswith("*") or len(term) < 5 else 1 if len(term) < 9 else 2

    def reset(self) -> None:
        self.ids, self.sets, self.moves, self.memo = {}, [], [], {}
        self.start = self.state(self.closed({0: 0}))

    def closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes reached by leaving out letters of a term; fewest edits for each node."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and e + 1 < nodes.get(child, 9):
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        return nodes

    def state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(nodes)
            self.moves.append({})
        return self.ids[key]

    def move(self, state: int, c: str) -> int:
        after: dict[int, int] = {}
        for node, e in self.sets[state].items():
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.reach[child] and cost < after.get(child, 9):
                    after[child] = cost
            if e + 1 <= self.reach[node] and e + 1 < after.get(node, 9):
                after[node] = e + 1
        to = self.moves[state][c] = self.state(self.closed(after)) if after else -1
        return to

    def find(self, token: str) -> tuple[tuple[str, int], ...]:
        """(term, edits) of every term that a token, without its outer punctuation, matches."""
        found = self.memo.get(token)
        if found is None:
            if len(self.sets) > self.MOST_STATES or len(self.memo) > self.MOST_WORDS:
                self.reset()
            state, hits, word = self.start, [], token.strip(_EDGES)
            for i, c in enumerate(word):
                to = self.moves[state].get(c)
                state = self.move(state, c) if to is None else to
                if state < 0:
                    break
                hits += [(self.stem[n], 0) for n, e in self.sets[state].items() if e == 0 and self.stem[n] and i + 1 < len(word)]
            if state >= 0 and word:
                hits += [(self.term[n], e) for n, e in self.sets[state].items() if self.term[n] and e <= self.edits(self.term[n])]
            found = self.memo[token] = tuple(hits)
        return found


def in_context(tokens: list[str], i: int) -> float:
    """1 for a term used, QUOTED for one mentioned: quotation marks around it or a reporting word within WINDOW words before."""
    before, after = tokens[max(0, i - WINDOW):i + 1], tokens[i:i + WINDOW + 1]
    opened = any(t[0] in QUOTES for t in before)
    closed = any(t.rstrip(".,;:!?")[-1:] in QUOTES and t.rstrip(".,;:!?") for t in after)
    return QUOTED if opened and closed or any(t.strip(_EDGES) in REPORTING for t in before[:-1]) else 1.0


def evidence(lexicon: Lexicon, text: str) -> dict[tuple[str, int], float]:
    """Best context weight of each (term, edits) found in a text."""
    tokens, found = text.lower().split(), {}
    for i, token in enumerate(tokens):
        hits = lexicon.find(token)
        if hits:
            weight = in_context(tokens, i)
            for hit in hits:
                found[hit] = max(weight, found.get(hit, 0.0))
    return found


def rating(lexicon: Lexicon, worth: dict[tuple[str, int], float], rest: float, text: str) -> float:
    """One minus the product of (1 - worth * context weight) over the different words that match; a word counts by its best term."""
    tokens, best = text.lower().split(), {}
    for i, token in enumerate(tokens):
        value = max((worth.get(hit, 0.0) for hit in lexicon.find(token)), default=0.0)
        if value:
            word = token.strip(_EDGES)
            best[word] = max(best.get(word, 0.0), value * in_context(tokens, i))
    clean = 1 - rest
    for value in best.values():
        clean *= 1 - value
    return 1 - clean


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean): documents of a batch that hold each word or stem."""
    for batch in batches:
        counts = {1: Counter(), 0: Counter()}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = {w for t in set(text.lower().split()) if (w := t.strip(_EDGES))}
            counts[toxic].update(words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n})
        terms = list(counts[1] | counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([counts[y][t] for t in terms], pa.int64()) for y in (1, 0))], names=["term", "toxic", "clean"])


def _least(text: str) -> int:
    """Least hash of a text's 4-word shingles, which copies and near copies mostly share."""
    w = text.lower().split()
    return min(xxhash.xxh3_64_intdigest(" ".join(w[i:i + 4])) for i in range(max(1, len(w) - 3))) >> 1


@F.arrow_udf(T.LongType())
def _copy_key(column: pa.Array) -> pa.Array:
    return pa.array([_least(x.as_py()) for x in column], pa.int64())


def _counts(docs: DataFrame, y: DataFrame, terms: list[str], doc_id: str, text: str) -> dict[tuple[str, int], tuple[int, int]]:
    """How many toxic and clean texts of all rows of ``y`` each (term, edits) matches, copies counted once. Only matches are joined."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    own = docs.where(F.col(text) != "").select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(shared)
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if found := evidence(lexicon, t):
                    key = _least(t)
                    at += [i] * len(found)
                    rows += [(term, edits, key) for term, edits in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int32(), pa.int64())))],
                names=["_id", "term", "edits", "key"])

    found = own.mapInArrow(matches, T.StructType([own.schema["_id"]]).add("term", "string").add("edits", "integer").add("key", "long"))
    once = found.join(y, "_id").select("term", "edits", "_toxic", "key").distinct()
    return {(r["term"], r["edits"]): (r["a"], r["b"]) for r in once.groupBy("term", "edits").agg(
        F.count_if(F.col("_toxic") == 1).alias("a"), F.count_if(F.col("_toxic") == 0).alias("b")).collect()}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> dict:
    """Learn terms, what a match of each is worth, and the share of toxic texts without any.

    ``labels`` (doc_id, toxic 0/1) holds the rows to learn from; at most about ``sample_rows`` of them, half of each
    class where there are enough, are drawn by a hash of the id and joined by broadcast. Counts are weighted by how
    each class was drawn. Of copies and near copies one is kept, else their rare words would look like
    terms. The drawn rows name candidates, terms of SUPPORT toxic texts in them, and the share of toxic texts without any; so the driver holds no more terms
    than the words of ``sample_rows`` texts. Candidates and their edits are then counted through the automata over all rows to learn from,
    so that an edit that also hits harmless words is worth little. A term enters the lexicon with SUPPORT toxic texts and PRECISION. Without labels of both classes nothing is learned and every text scores the share of toxic labels.
    """
    spark = docs.sparkSession
    y = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_toxic")).where("_id IS NOT NULL")
    n = {r["_toxic"]: r["count"] for r in y.groupBy("_toxic").count().collect()}
    prior = n.get(1, 0) / max(1, sum(n.values()))
    if not n.get(0) or not n.get(1):
        return {"terms": [], "worth": {}, "rest": prior}
    few = min(n.values())
    share = min(few, sample_rows // 2)
    rate = {k: min(1.0, (share if v == few else sample_rows - share) / v) for k, v in n.items()}
    drawn = y.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < F.when(F.col("_toxic") == 1, rate[1]).otherwise(rate[0]) * 1_000_000)
    chosen = docs.where(F.col(text) != "").join(F.broadcast(drawn), F.col(doc_id) == F.col("_id")).select(F.col(text).alias("text"), "_toxic")
    chosen = stored(chosen.withColumn("_key", _copy_key("text")).dropDuplicates(["_toxic", "_key"]).drop("_key"))
    tally = chosen.mapInArrow(_terms, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # one clean text in the sample stands for many that need not exist: either estimate makes a candidate
    drawn_as = [F.col("toxic") * p / (F.col("toxic") * p + F.col("clean") * q) for p, q in ((1.0, 1.0), (1 / rate[1], 1 / rate[0]))]
    candidates = tally.where((F.col("toxic") >= SUPPORT) & (F.greatest(*drawn_as) >= PRECISION)).select("term").collect()
    counts = _counts(docs, y, sorted(r["term"] for r in candidates), doc_id, text)
    terms = sorted(term for (term, edits), (a, b) in counts.items() if edits == 0 and a >= SUPPORT and a / (a + b + 0.5) >= PRECISION)
    shared = spark.sparkContext.broadcast(terms)

    def unmatched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(shared)
        for batch in batches:
            rows = Counter(toxic for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if not evidence(lexicon, t))
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array(list(rows.values()), pa.int64())], names=["toxic", "n"])

    left = {r["toxic"]: r["n"] for r in chosen.mapInArrow(unmatched, "toxic int, n long").groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    a, b = left.get(1, 0) / rate[1], (left.get(0, 0) + 0.5) / rate[0]
    rest = a / (a + b) if left else prior
    kept = set(terms)
    worth = {k: a / (a + b + 0.5) for k, (a, b) in counts.items() if k[0] in kept}
    return {"terms": terms, "worth": {k: p for k, p in worth.items() if p >= 0.5}, "rest": min(rest, THRESHOLD / 2)}


@lru_cache(maxsize=2)
def _lexicon(broadcast) -> Lexicon:
    value = broadcast.value
    return Lexicon(value["terms"] if isinstance(value, dict) else value)


def toxicity(text: Column, model: dict, spark: SparkSession) -> Column:
    """Probability that a text is toxic, by ``rating``.

    NULL and empty texts, and texts without a match, score the learned share of toxic texts among those.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon, worth, rest = _lexicon(shared), shared.value["worth"], shared.value["rest"]
        for column in columns:
            yield pa.array([rating(lexicon, worth, rest, x.as_py() or "") for x in column], pa.float64())

    return score(text)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from three folds of the labelled documents and score all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(fold("doc_id", 4) != 2))
    score = toxicity(F.col("text"), model, spark)
    return docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
