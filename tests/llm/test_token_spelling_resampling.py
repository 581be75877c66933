"""Operators 11 to 13 on small tables: odd inputs, brute force, the tokenizers library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from comptoir.llm import importance, spelling, tokencounts
from tests.llm.test_operators import ODD, docs_of, prose


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [])


# 11: token counts

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tokencounts.TOKENIZER))


@pytest.fixture(scope="module")
def counter():
    return tokencounts.Counter(public_tokenizers.path(tokencounts.TOKENIZER))


def test_tokens_of_odd_strings_are_the_library_s(library, counter):
    rng = random.Random(1)
    parts = ["a", "b", "'s", "'ll", " ", "  ", "\n", "1", "é", "!", "<|endoftext|>", "<|endof", "zz", "the", "　", "\x85", "ab", "²", "Ⅷ", "٣"]
    texts = ["", "aaaa" * 300, "ab" * 5000, "é" * 3000 + " x", "日本語" * 500, "a" * 20001, "\U000105c0a\U00013460 1", "😀👩‍👩‍👧 " * 20]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(0x3000), rng.randrange(0xD800), rng.randrange(0x10000, 0x20000)])) for _ in range(30)) for _ in range(1000)]
    texts += ["".join(rng.choice("etaoinshr") for _ in range(30_000))]
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_assigned_code_point_is_cut_as_by_the_library(library, counter):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}" for c in points[i:i + 64]) for i in range(0, 0x3000, 64)]
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_rounds_over_all_and_lists_by_rank_agree_with_single_merges(counter):
    rng = random.Random(3)
    merges = counter.merges
    rank = {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(r) for k, r in zip(merges.key, merges.rank)}

    def plain(word):
        symbols = [int(merges.byte[b]) for b in word]
        while True:
            best = min(((rank.get(p, 1 << 40), i) for i, p in enumerate(zip(symbols, symbols[1:]))), default=(1 << 40, 0))
            if best[0] == 1 << 40:
                return len(symbols)
            symbols[best[1]:best[1] + 2] = [int(merges.by_rank[best[0]])]

    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 120))).encode() for letters in ("ab", "aabbcdet", "etaoin shr", "éàü") for _ in range(40)]
    expected = list(map(plain, words))
    assert merges.survivors(words).tolist() == expected
    assert [merges.survivors_of_long(w) for w in words] == expected


def test_counts_do_not_depend_on_what_is_remembered(counter, monkeypatch):
    texts = [prose(i) for i in range(30)]
    expected = counter.counts(texts)
    monkeypatch.setattr(tokencounts, "REMEMBERED", 10)
    monkeypatch.setattr(tokencounts, "LONG", 3)
    fresh = tokencounts.Counter(public_tokenizers.path(tokencounts.TOKENIZER))
    assert [n for t in texts for n in fresh.counts([t])] == expected


def test_token_counts_of_odd_rows(spark, odd, empty, library):
    got = sorted((tuple(r) for r in tokencounts.token_counts(odd).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in ODD]
    assert got == sorted(want, key=str)
    assert tokencounts.token_counts(empty).count() == 0
    assert {r["over_limit"] for r in tokencounts.token_counts(odd, limit=3).collect()} == {True, False}
    named = odd.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body"))
    assert tokencounts.token_counts(named, "key", "body").schema["doc_id"].dataType.simpleString() == "string"


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="test tables not present")
def test_token_counts_of_a_table_are_the_library_s(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = dict(zip(texts, (len(e.ids) for e in library.encode_batch(list(texts.values()), add_special_tokens=False))))
    assert {r["doc_id"]: r["n_tokens"] for r in tokencounts.op11_tokencounts(spark, "/root/testdata/sf0.01").collect()} == want


# 12: spelling variants

def brute_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, factor=2):
    rows = {}
    for w, n in counts.items():
        near = [v for v in counts if brute_near(v, w)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= factor * n else None
        rows[w] = [form, w, n, len(near), counts[form] if form is not None else None]
    for w in rows:
        while (form := rows[rows[w][1]][0]) is not None:
            rows[w][1] = form
    return sorted((w, *row) for w, row in rows.items())


def as_rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(7)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abcdeéèß") for _ in range(rng.randrange(4, 9)))
        n = 400
        for _ in range(12):
            counts[word] = counts.get(word, 0) + max(1, n)
            i, n = rng.randrange(len(word)), n // rng.choice([1, 2, 3])
            word = rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice("abé") + word[i + 1:], word[:i] + rng.choice("bdè") + word[i:]]) or "a"
    counts |= {"ab" * 40: 5, "ab" * 40 + "a": 11, "ab" * 39 + "bb": 12, "a": 3, "b": 6, "à": 6, "œuvre": 4, "œuvrez": 9, "日本語": 2, "日本誤": 5}
    counts |= {"".join(rng.sample("stone", 5)): rng.randrange(3, 90) for _ in range(60)}  # anagrams
    return counts


@pytest.mark.parametrize("settings", [{}, {"cell": 25}, {"cell": 8, "sample": 100}, {"cell": 1, "sample": 40}])
def test_variants_agree_with_brute_force(spark, vocabulary, settings):
    df = spark.createDataFrame([(w, n // 2) for w, n in vocabulary.items()] + [(w, n - n // 2) for w, n in vocabulary.items()], "word string, n long")
    assert as_rows(spelling.variants(df, **settings)) == brute_variants(vocabulary)


def test_tree_visits_every_leaf_within_reach():
    rng = np.random.default_rng(2)
    counts = np.minimum(rng.poisson(0.4, (600, spelling.BINS)), 5).astype(np.int8)
    counts[50:90] = counts[49]
    tree = spelling.LetterTree(counts, leaf=4)
    assert sorted(tree.order.tolist()) == list(range(600))
    for radius in (0, 1, 2):
        reached = {(q, w) for who, leaf in tree.leaves(counts, radius) for q, x in zip(who, leaf) for w in tree.order[tree.begin[x]:tree.end[x]]}
        distance = np.abs(counts[:, None].astype(int) - counts[None]).sum(axis=2)
        assert {tuple(x) for x in np.argwhere(distance <= radius)} <= reached
        assert len(reached) < 600 * 600 / 2  # the rest is pruned


def test_words_lose_letters_by_checksum(spark, odd, empty):
    rows = [(i, prose(i % 7)) for i in range(300)] + [(None, "Unter  ÉCOLE école uNTER"), (1, None), (2, ""), (3, "abcdef" * 2000)]
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    got = dict(spelling.noisy_words(docs_of(spark, rows)).collect())
    assert got == {w: n for w, n in counts.items() if len(w) >= 5}
    assert got["école"] == got["École"] == 1
    assert as_rows(spelling.variants(spelling.noisy_words(empty))) == []
    assert as_rows(spelling.variants(spelling.noisy_words(odd))) == brute_variants(dict(spelling.noisy_words(odd).collect()))


def test_variants_of_nulls_and_one_word(spark):
    df = spark.createDataFrame([(None, 5, 1), ("", 5, 1), ("alone", 5, 1), ("alone", None, 1)], "word string, n long, best int")
    assert as_rows(spelling.variants(df)) == [("alone", None, "alone", 5, 0, None)]


def test_a_hub_and_a_long_chain(spark):
    chain = {"q" * (5 + i): 3 * 2 ** i for i in range(30)}
    hub = {"wonderful": 1 << 40} | {f"wonderfu{c}": 3 for c in "abcdefghij"} | {f"w{c}onderful": 4 for c in "abcdefghij"}
    counts = chain | hub
    got = as_rows(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_variants(counts)
    assert {r[2] for r in got} == {"wonderful", "q" * 34}


# 13: importance resampling

def brute_resample(docs, target, grams=1, buckets=10_000, share=10, seed=2024, least=20):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return w, [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, grams + 1) for i in range(len(w) - k + 1)]

    s, t = (Counter(b for _, x in rows for b in features(x)[1]) for rows in (docs, target))
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        w, f = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in f]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w) >= least])
    long = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(long[:share * len(long) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("settings", [{}, {"grams": 3, "buckets": 50}, {"share": 60, "seed": 5, "least": 1}, {"share": 100}])
def test_resampling_agrees_with_brute_force(spark, settings):
    rng = random.Random(11)
    docs = [(i, prose(i % 50, rng.choice([0, 1, 19, 20, 21, 60]))) for i in range(400)] + ODD + [(i, None) for i in range(-5, 0)]
    docs = [x for i, x in enumerate(docs) if x[0] is None or all(x[0] != y[0] for y in docs[:i])] + [(5, prose(5, 60))] * 3
    target = [(i, prose(900 + i, 40, "stone green walked river".split())) for i in range(20)] + [(99, None)]
    got = importance.resample(docs_of(spark, docs).repartition(7), docs_of(spark, target), **settings)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_resample(docs, target, **settings)


def test_resampling_of_nothing_and_towards_nothing(spark, odd, empty):
    assert importance.resample(empty, odd).count() == 0
    assert sorted((tuple(r) for r in importance.resample(odd, empty).collect()), key=str) == brute_resample(ODD, [])
    with pytest.raises(TypeError):
        importance.resample(odd.withColumn("doc_id", F.lit("x")), odd)


def test_ranks_over_many_segments(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0, 0, 0, rng.randrange(-9, 9)]), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(11)
    for first in (0, 1, 700, 5000):
        got = {(r["a"], r["b"]): r["rank"] for r in importance.ranked(df, ["a", "b"], lambda runs: first, segment=40).collect()}
        assert [got[x] for x in sorted(rows)] == [i + 1 if i < first else None for i in range(len(rows))]


def test_drawn_documents_keep_their_columns(spark):
    docs = docs_of(spark, [(i, prose(i)) for i in range(50)])
    rows = importance.drawn(docs, importance.resample(docs, docs, share=20))
    assert rows.columns == docs.columns and rows.count() == 10
