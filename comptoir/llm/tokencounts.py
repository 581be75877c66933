"""Token counts by rank-synchronous merging of pair symbols in ragged arrays (operator 11)."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import query, slices, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: A task remembers the counts of so many different pre-tokens, none longer than LONG bytes; more are counted again.
REMEMBERED = 400_000
LONG = 64
_NEVER = np.int64(1) << 40


#: Code points met so far that have a category in Python's tables.
_assigned: set[str] = set()


@lru_cache(maxsize=3)
def _pattern(end: int) -> re.Pattern:
    """The byte-level pre-tokenizer's pattern for texts of code points below ``end``.

    Contractions, letters, numbers, other signs (each after one space at most) and white space. Letters and numbers are
    spelled as ranges of code points from their Unicode categories; the matcher is quicker with fewer of them.
    """
    ranges: dict[str, list[list[int]]] = {"L": [], "N": []}
    for code in range(end):
        own = ranges.get(unicodedata.category(chr(code))[0])
        if own is not None:
            if own and own[-1][1] == code - 1:
                own[-1][1] = code
            else:
                own.append([code, code])
    letters, numbers = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in own) for own in ranges.values())
    white = "".join(x for x in ("\\t-\\r \\x85\\xa0", "\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000") if end > 0x100 or "u" not in x)
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{white}{letters}{numbers}]+|[{white}]+(?![^{white}])|[{white}]+")


def pre_tokens(text: str) -> list[str]:
    """The pieces of a text that are merged each for itself.

    Python may know fewer Unicode letters than the tokenizer's library, so a text with a code point that has no category
    here is cut by the library.
    """
    signs = set(text)
    for sign in signs - _assigned:
        if unicodedata.category(sign) == "Cn":
            from tokenizers import pre_tokenizers

            return [text[a:b] for _, (a, b) in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        _assigned.add(sign)
    top = max(signs, default="")
    return _pattern(0x100 if top < "\u0100" else 0x10000 if top < "\U00010000" else 0x110000).findall(text)


class PairMerges:
    """A byte-level pair vocabulary as arrays: pair keys in order, with the rank and the merged symbol of each."""

    def __init__(self, path: str):
        model = json.loads(Path(path).read_text(encoding="utf-8"))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        vocabulary = model["model"]["vocab"]
        self.specials = [t["content"] for t in model["added_tokens"]]
        # bytes are written as printable characters: printable ones stand for themselves, the rest follow from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        self.byte = np.array([vocabulary[names[b]] for b in range(256)], np.int64)
        left, right, made = (np.array([vocabulary[x] for x in side], np.int64) for side in (*zip(*merges), [a + b for a, b in merges]))
        key = left << 32 | right
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], order, made[order]
        self.by_rank = made
        self.split = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)").split

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of neighbours; _NEVER where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], _NEVER)

    def survivors(self, words: list[bytes]) -> np.ndarray:
        """How many symbols are left of each pre-token when nothing more merges.

        All sequences lie in one array. In each round every sequence finds its lowest rank and merges that pair wherever
        it stands, from left to right; what it merges into has a higher rank only, so this is the order of single merges.
        Sequences without a pair leave the array.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        left = lengths.copy()
        while len(symbols) > 1:
            rank = np.full(len(symbols), _NEVER)
            inside = owner[1:] == owner[:-1]
            rank[:-1][inside] = self.ranks(symbols[:-1][inside], symbols[1:][inside])
            starts = np.flatnonzero(np.concatenate([[True], ~inside]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            at = _alternate(np.flatnonzero((rank == np.repeat(least, sizes)) & (rank != _NEVER)), np.arange(1, len(symbols) + 1))
            symbols[at] = self.by_rank[rank[at]]
            keep = np.repeat(least != _NEVER, sizes)
            keep[at + 1] = False
            np.subtract.at(left, owner[at], 1)
            symbols, owner = symbols[keep], owner[keep]
        return left

    def survivors_of_long(self, word: bytes) -> int:
        """The same for one long sequence: pairs wait in lists by rank, and a round visits those of the lowest rank only."""
        n = len(word)
        symbols = np.append(self.byte[np.frombuffer(word, np.uint8)], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[n] = n
        rank = np.append(self.ranks(symbols[:-2], symbols[1:-1]), [_NEVER, _NEVER])
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[rank[at] != _NEVER]
            at = at[np.argsort(rank[at], kind="stable")]
            for part in np.split(at, np.flatnonzero(np.diff(rank[at])) + 1):
                if len(part):
                    r = int(rank[part[0]])
                    if r not in waiting:
                        waiting[r] = []
                        heapq.heappush(heap, r)
                    waiting[r].append(part)

        wait(np.arange(n))
        gone = 0
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = _alternate(at[rank[at] == r], after)
            if not len(at):
                continue
            taken = after[at]
            symbols[at], rank[taken] = self.by_rank[r], _NEVER
            after[at] = after[taken]
            before[after[at]] = at
            gone += len(at)
            changed = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
            changed = changed[symbols[changed] >= 0]
            rank[changed] = np.where(after[changed] < n, self.ranks(symbols[changed], symbols[after[changed]]), _NEVER)
            wait(changed)
        return n - gone


def _alternate(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places in ascending order, those left when each one taken uses up the place after it: every other one of a run."""
    if len(at) < 2:
        return at
    new = np.ones(len(at), bool)
    new[1:] = after[at[:-1]] != at[1:]
    run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - run) % 2 == 0]


class Counter:
    """Counts tokens of texts; remembers the counts of short pre-tokens while a task lasts."""

    def __init__(self, path: str):
        self.merges = PairMerges(path)
        self.known: dict[str, int] = {}

    def counts(self, texts: Iterable[str]) -> list[int]:
        """Tokens of each text. A special token's string is one token, as the library has it."""
        known = self.known
        words, specials = [], []
        for text in texts:
            parts = self.merges.split(text)
            specials.append(len(parts) - 1)
            words.append(pre_tokens(text) if len(parts) == 1 else [w for part in parts for w in pre_tokens(part)])
        fresh = set().union(*words).difference(known)
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = set().union(*words)
        names = list(fresh)
        data = [w.encode() for w in names]
        short = [i for i, w in enumerate(data) if len(w) <= LONG]
        known.update(zip([names[i] for i in short], self.merges.survivors([data[i] for i in short]).tolist()))
        long = {names[i]: self.merges.survivors_of_long(w) for i, w in enumerate(data) if len(w) > LONG}
        known.update(long)
        counted = [n + sum(map(known.__getitem__, found)) for n, found in zip(specials, words)]
        for w in long:
            del known[w]
        return counted


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every text, by a byte-level pair vocabulary.

    ``path`` is a tokenizer file of that kind. Whole texts count, of any length, and no begin or end token is added. A NULL
    or empty text has 0 bytes and 0 tokens. Repeated rows are counted each; NULL ids stay NULL; an empty table stays empty;
    other columns are not read. Nothing is shuffled, and a task holds a few megabytes of text and its remembered counts.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([source.schema["doc_id"]]).add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            n = np.array(counter.counts(texts), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)], names=schema.names)

    return source.mapInArrow(work, schema)


@query("op11_tokencounts")
def op11_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
