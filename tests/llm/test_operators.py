"""Each operator on small tables: NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns, brute force."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from comptoir.llm import common, covertree, fingerprints, jaccard, langid, licenses, lines, lm, mixing, packing, toxicity
from comptoir.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, s long, removed int"


def docs_of(spark, rows):
    """Documents (doc_id, text[, lang[, source]]) with extra columns whose names operators use inside."""
    full = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), "x", 7, 1) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n=60, words="the of and river stone green walked under seven house lantern quiet morning paper engine".split()):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c"), (6, prose(1)), (7, prose(1)), (7, prose(1)), (None, prose(2)), (9, "é" * 3000 + " x"), (10, "<|endoftext|> İK")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [])


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(50, 50), (None, 3), (61, 60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys(range(7, 30), 7), 60: 60, 61: 60}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# 1: embeddings

def test_embeddings_agree_with_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 8))
    x = [base[i % 6] + rng.normal(size=8) * rng.choice([0.05, 0.2, 0.6]) for i in range(150)]
    x += [x[0], 2 * x[0], -x[0]]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(500, None), (501, [0.0] * 8), (502, [None] + [1.0] * 7), (503, [float("nan")] + [1.0] * 7), (504, [float("inf")] + [1.0] * 7), (505, [1.0, 0.0]), (506, [2.0, 0.0]), (507, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, weight int")
    for settings in ({}, {"pivots": 5, "block": 16}):
        got = {r["vec_id"]: r for r in covertree.near_embeddings(df, **settings).collect()}
        unit = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
        near = unit @ unit.T >= 0.95
        label = np.arange(len(x))
        for _ in range(len(x)):
            label = np.array([label[near[i]].min() for i in range(len(x))])
        for i in range(len(x)):
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum() - 1, label[i], label[i] == i)
        assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in (500, 501, 502, 503, 504, 507))
        assert got[506]["component_id"] == 505 and got[505]["n_links"] == 1
    assert covertree.near_embeddings(df.limit(0)).count() == 0


def test_cover_tree_covers():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[10] = x[11]
    tree = covertree.CoverTree(x)

    def members(node):
        kids = tree.children[node]
        return [tree.centre[node]] if kids is None else [m for c in kids for m in members(c)]

    assert sorted(members(0)) == list(range(300))
    for node, c in enumerate(tree.centre):
        assert max(np.linalg.norm(x[m] - x[c]) for m in members(node)) <= tree.reach[node] + covertree._SLACK


# 2: Jaccard

def brute_jaccard(rows, size, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = [r[0] for r in rows]
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and 100 * len(a & b) >= percent * len(a | b):
                    label[i] = min(label[i], label[j])
    return sorted((r[0], len(s), c) for r, s, c in zip(rows, sets, label))


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (1, 60)])
def test_jaccard_agrees_with_brute_force(spark, size, percent):
    rng = random.Random(size)
    shared = prose(99, 40)
    rows, k = [], 0
    for g in range(8):
        base = prose(g, 50).split()
        for _ in range(9):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(30)}"
            rows.append((k := k + 1, " ".join(words) + ("\n" + shared if rng.random() < 0.3 else "")))
    rows += [(200, "a b"), (201, "A\tb"), (202, "a b c"), (203, None), (204, ""), (205, shared), (206, shared + " end")]
    got = jaccard.join(docs_of(spark, rows), size=size, percent=percent).collect()
    assert sorted(map(tuple, got)) == brute_jaccard(rows, size, percent)


def test_jaccard_of_odd_rows(spark, odd, empty):
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in jaccard.join(odd).collect()), key=str)
    assert len(got) == len(ODD)
    assert {g for g in got if g[0] in (1, 2, 3)} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)} and [g for g in got if g[0] == 7] == [(7, 57, 6)] * 2
    assert jaccard.join(empty).count() == 0


# 3: packing

def test_packing_keeps_every_token_once(spark, odd, empty):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = packing.pack(packing.pieces(odd, with_ids=True)).collect()
    whole = Counter()
    for _, text in ODD:
        whole[tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])] += 1
    assert sum(r["length"] for r in rows) == sum(len(k) * n for k, n in whole.items())
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 1024
    long = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == 9)
    assert all(length == 1024 for _, _, length in long[1:]) and [s for _, s, _ in long] == [sum(x[2] for x in long[:i]) for i in range(len(long))]
    for _, group in _grouped(rows, "sequence_id"):
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.pack(packing.pieces(empty)).count() == 0
    joined = packing.sequences(packing.pack(packing.pieces(odd, with_ids=True))).collect()
    assert sum(len(r["ids"]) for r in joined) == sum(r["length"] for r in rows)


def _grouped(rows, key):
    groups = {}
    for r in rows:
        groups.setdefault(r[key], []).append(r)
    return groups.items()


def test_plan_is_a_packing_and_close_to_the_bound():
    rng = random.Random(3)
    for counts in ({1024: 3, 1: 5000}, {600: 4, 424: 3, 400: 5}, {342: 7}, {512: 9}, {n: rng.randrange(40) for n in range(1, 1025)}, {}):
        bins, used = {}, Counter()
        for length, rank, n, sequence, offset in packing.plan(counts):
            assert rank == used[length]
            used[length] += n
            for k in range(n):
                assert bins.get(sequence + k, 0) == offset
                bins[sequence + k] = offset + length
        assert used == Counter({k: v for k, v in counts.items() if v}) and max(bins.values(), default=0) <= 1024
    assert len(bins) == 0
    counts = {n: rng.randrange(40) for n in range(1, 1025)}
    made = len({s + k for _, _, n, s, _ in packing.plan(counts) for k in range(n)})
    need = max(math.ceil(sum(k * v for k, v in counts.items()) / 1024), sum(v for k, v in counts.items() if k > 512))
    assert made <= 1.02 * need + 1


# 4: toxicity

def test_lexicon_finds_what_edit_distance_allows():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i] + [0] * len(b) if False else _next(row, i, x, b)
        return row[-1]

    def _next(row, i, x, b):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        return new

    terms = ["idiot", "scum", "worthless", "trash", "lowei*"]
    lexicon, rng = toxicity.Lexicon(terms), random.Random(2)
    for _ in range(3000):
        word = list(rng.choice(["idiot", "scum", "worthless", "trash", "crash", "loweia"]))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(word) + 1)
            word[i:i + rng.randrange(2)] = rng.choice(["", "a", "t", "x"])
        word = "".join(word)
        want = {(t, distance(word, t)) for t in terms[:4] if word and distance(word, t) <= lexicon.edits(t)}
        want |= {("lowei*", 0)} if word.startswith("lowei") and len(word) > 5 else set()
        assert set(lexicon.find(word)) == want, word


def test_toxicity_learns_and_tells_quotation_from_abuse(spark, empty):
    rows = [(i, prose(i) + (" you idiot " if i % 2 else " ") + prose(i + 1000)) for i in range(400)]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    tests = [(1, prose(5000)), (2, prose(5001) + " such an idiiot he is"), (3, prose(5002) + ' he said "idiot" again'), (4, None), (5, "")]
    got = {r["doc_id"]: r["x"] for r in docs_of(spark, tests).select("doc_id", toxicity.toxicity(F.col("text"), model, spark).alias("x")).collect()}
    assert got[2] >= toxicity.THRESHOLD or ("idiot", 1) not in model["worth"]
    assert max(got[1], got[3], got[4], got[5]) < toxicity.THRESHOLD
    assert docs.where("doc_id = 7").select(toxicity.toxicity(F.col("text"), model, spark).alias("x")).first()["x"] > 0.9
    assert toxicity.fit(empty, labels.limit(0))["terms"] == []
    assert toxicity.fit(empty, labels)["terms"] == []


def test_worth_and_rating_agree_with_plain_counts(spark):
    rng = random.Random(8)
    texts = [(i, prose(i, 12) + rng.choice([" zorkelo ", " zorkela ", " blint ", ' said "blint" ', " ", " "]) * (i % 3 > 0) + prose(i + 9000, 12)) for i in range(150)]
    toxic = {i: int(i % 3 > 0 and ("zorkel" in t or "blint" in t)) if i % 17 else 1 - i % 2 for i, t in texts}
    rows = texts + [(1000 + i, t) for i, t in texts[:40]]  # copies count once
    labels = {**toxic, **{1000 + i: toxic[i] for i, _ in texts[:40]}}
    model = toxicity.fit(docs_of(spark, rows), spark.createDataFrame(sorted(labels.items()), "doc_id long, toxic int"))
    assert {"zorkelo", "blint"} <= set(model["terms"])
    lexicon, hits = toxicity.Lexicon(model["terms"]), Counter()
    for i, t in texts:
        words = [w.strip(toxicity._EDGES) for w in t.lower().split()]
        hits.update({(hit, toxic[i]) for w in words for hit in lexicon.find(w)})
    want = {hit: hits[hit, 1] / (hits[hit, 1] + hits[hit, 0] + 0.5) for hit, _ in hits}
    assert model["worth"] == pytest.approx({hit: p for hit, p in want.items() if p >= 0.5})
    free = [i for i, t in texts if not any(lexicon.find(w) for w in t.lower().split())]
    share = sum(toxic[i] for i in free) / (len(free) + 0.5)
    assert model["rest"] == pytest.approx(min(share, toxicity.THRESHOLD / 2))
    got = {r["doc_id"]: r["x"] for r in docs_of(spark, texts).select("doc_id", toxicity.toxicity(F.col("text"), model, spark).alias("x")).collect()}
    for i, t in texts:
        best = {}
        for w in t.lower().split():
            word = w.strip(toxicity._EDGES)
            value = max((want[hit] for hit in lexicon.find(w) if want[hit] >= 0.5), default=0) * (toxicity.QUOTED if '"' in w else 1)
            best[word] = max(best.get(word, 0), value)
        assert got[i] == pytest.approx(1 - (1 - model["rest"]) * math.prod(1 - v for v in best.values())), t


def test_terms_of_rare_toxicity_are_counted_over_all_rows(spark):
    rows = [(i, prose(i, 20) + (" you zorkelo " if i < 12 else " meanwhile " if i < 60 else " ") + prose(i + 5000, 20)) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(1200)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(spark, rows), labels, sample_rows=200)
    assert "zorkelo" in model["terms"] and "meanwhile" not in model["terms"] and model["worth"]["zorkelo", 0] == 12 / 12.5


# 5: fingerprints

def test_fingerprints_are_consistent(spark, odd, empty):
    text = prose(1, 400)
    f = fingerprints.fingerprints([text, text, "", "a", "aa", prose(2, 400), "qq " + text])
    assert f[0] == f[1] != f[5] and len(set(f[2:5])) == 3
    assert fingerprints.fingerprints([text]) == f[:1]
    assert fingerprints.likeness(f[0], f[6]) > 0.7 > 0.1 > fingerprints.likeness(f[0], f[5])
    rows = fingerprints.compared(odd, group_chars=500).collect()
    order = sorted(ODD, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        changed = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.fingerprints([t])[0], fingerprints.fingerprints([changed])[0]))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprints.compared(empty).count() == 0
    assert fingerprints.compared(odd.where("doc_id = 6")).first()["near_next"] == 1.0


# 6: language-model scores

def test_lattice_sums_all_segmentations():
    scores = {"▁a": -1.0, "▁": -2.0, "a": -1.5, "b": -2.0, "ab": -1.2, "ba": -1.7, "▁ab": -2.5, "<0xC3>": -4.0, "<0xA9>": -4.1}
    lattice, rng = lm.Lattice(scores), random.Random(4)

    def brute(s):
        total = 1.0 if not s else sum(10 ** scores[s[:k]] * brute(s[k:]) for k in range(1, len(s) + 1) if s[:k] in scores)
        return total + (10 ** -8.1 * brute(s[1:]) if s[:1] == "é" else 0)

    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(100)] + ["a", "b"]
    for word, value in zip(words, lattice.log10(words)):
        assert value == pytest.approx(math.log10(brute("▁" + word)), abs=1e-9)
    assert lattice.log10([]) == []


def plain_spelling(scores, word):
    """log10 of the sum over all segmentations, letter by letter."""
    s, reached = "▁" + word, [0.0]
    for end in range(1, len(s) + 1):
        c = s[end - 1]
        terms = [reached[k] + scores[s[k:end]] for k in range(max(0, end - 40), end) if s[k:end] in scores and "▁" not in s[max(k, 1):end]]
        if c not in scores or end > 1 and c == "▁":
            terms.append(reached[end - 1] + sum(scores.get(f"<0x{b:02X}>", -6.0) for b in c.encode()))
        top = max(terms)
        reached.append(top + math.log10(sum(10 ** (t - top) for t in terms)))
    return reached[-1]


def test_long_and_odd_words_agree_with_a_plain_recursion():
    scores = {"▁a": -1.0, "▁": -2.0, "a": -1.5, "b": -2.0, "ab": -1.2, "ba": -1.7, "▁ab": -2.5, "abab": -2.6, "<0xC3>": -4.0, "<0xA9>": -4.1}
    words = ["", "▁", "a▁ab", "▁▁b", "日本", "é", "\0", "😀a", "ab" * 40, "aé" * 5000, "b" * 30_000, "ab", "ab"]
    for known in (scores, {p: v for p, v in scores.items() if p != "▁"}):
        for word, value in zip(words, lm.Lattice(known).log10(words)):
            assert value == pytest.approx(plain_spelling(known, word), rel=1e-9), word[:20]


def test_expected_pieces_are_those_of_all_segmentations():
    scores = {"▁a": -1.0, "▁": -2.0, "a": -1.5, "b": -2.0, "ab": -1.2, "ba": -1.7, "▁ab": -2.5, "<0xC3>": -4.0, "<0xA9>": -4.1}
    lattice, rng = lm.Lattice(scores), random.Random(5)

    def cuts(s):
        if not s:
            yield (), 0.0
        if s[:1] == "é":
            for rest, v in cuts(s[1:]):
                yield ("<0xC3>", "<0xA9>", *rest), v - 8.1
        for k in range(1, len(s) + 1):
            if s[:k] in scores:
                for rest, v in cuts(s[k:]):
                    yield (s[:k], *rest), v + scores[s[:k]]

    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    weights, want = np.array([rng.random() for _ in words]), Counter()
    for word, w in zip(words, weights):
        ways = [(pieces, 10 ** v) for pieces, v in cuts("▁" + word)]
        for pieces, p in ways:
            for piece in pieces:
                want[piece] += w * p / sum(q for _, q in ways)
    got, total = lattice.expect(words, lambda i, v: weights[i])
    assert total == pytest.approx(weights.sum()) and dict(zip(lattice.names, got)) == pytest.approx({p: want[p] for p in scores})


def test_uses_that_are_spelt():
    got = lm.spelt_uses(np.array([1, 1, 3]), np.array([-2.0, -500.0, -2.0]), 101, 0.2)
    assert got.tolist() == pytest.approx([1.0, 1.0, 3 * 0.002 / (0.8 * 0.02 + 0.002)])


def test_lm_scores(spark, odd, empty):
    train = docs_of(spark, [(i, prose(i)) for i in range(30)] + [(99, None)])
    model = lm.fit(train, head=20)
    counts = Counter(w for i in range(30) for w in prose(i).split())
    n, v = sum(counts.values()) + 31, len(counts) + 1
    assert (model.tokens, model.kinds) == (n, v)
    rows = [*ODD, (50, prose(3)), (51, "zebra Q"), (51, "zebra Q")]
    got = lm.score(docs_of(spark, rows), model).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        w = (t or "").encode().lower().decode().split(" ") if (t or "").strip() else []
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").encode().lower().decode())
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + math.log10(31.5 / (n + 0.5 * (v + 1)))
        want.append((i, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, round(base, 6)))
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got), key=str) == sorted(want, key=str)
    scores, _, mass, unseen = model.shared.value
    scored = []
    for i, t in rows:
        own = math.log10((1 - unseen) * 31.5 / mass)
        for x in re.findall(r"[^\x20\x09-\x0D]+", (t or "").encode().lower().decode()):
            old = (1 - unseen) * (counts[x] + 0.5) / mass if x in counts else 0
            own += math.log10(old + unseen * 10 ** plain_spelling(scores, x)) if old else math.log10(unseen) + plain_spelling(scores, x)
        scored.append((i, own))
    for (i, a), (j, b) in zip(sorted(((r["doc_id"], r["score"]) for r in got), key=str), sorted(scored, key=str)):
        assert i == j and a == pytest.approx(b, rel=1e-9)
    untrained = lm.fit(empty)
    assert untrained.tokens == 0 and lm.score(odd, untrained).count() == len(ODD) and lm.score(empty, model).count() == 0


# 7: languages

def test_languages(spark, odd, empty):
    texts = {"en": "the thing that was with this other", "de": "der und schnell nicht auch über straße", "fr": "le être près où ça naïve très"}
    rng = random.Random(1)
    make = lambda l: " ".join(rng.choice(texts[l].split()) for _ in range(30))
    train = docs_of(spark, [(i, make(l), l) for i in range(40) for l in texts] + [(900, None, "en"), (901, "x", None), (902, "", "de")])
    model = langid.fit(train)
    tests = docs_of(spark, [(i, make(l), l) for i, l in enumerate(list(texts) * 5)])
    got = tests.select("lang", langid.identify(F.col("text"), model, spark).alias("f")).collect()
    assert all(r["lang"] == r["f"]["lang"] and 0.9 < r["f"]["score"] <= 1 for r in got)
    unknown = docs_of(spark, [(1, None), (2, ""), (3, "123 !? \n"), (4, "the 1")]).select("doc_id", langid.identify(F.col("text"), model, spark).alias("f")).collect()
    assert [r["f"]["lang"] for r in sorted(unknown)] == ["und", "und", "und", "en"]
    assert langid.fit(empty) == [] and odd.select(langid.identify(F.col("text"), [], spark)["lang"].alias("x")).distinct().count() == 1


def test_languages_of_few_long_texts_are_learned(spark):
    train = docs_of(spark, [(i, "der und schnell " * 2000, "de") for i in range(3)] + [(i, "the thing", "en") for i in range(3, 9)])
    model = langid.fit(train, sample_bytes=60)
    assert [name for name, _ in model] == ["de", "en"] and langid.fit(train, sample_bytes=1)[0][0] == "de"


def test_code_lengths_are_those_of_the_trees():
    """The table of code lengths against escapes worked out letter by letter, across chunk borders too."""
    data = {"aa": b"abracadabra " * 6, "bb": b"banana bandana " * 5}
    model = []
    for name, text in data.items():
        padded = b"\n" * langid.ORDER + text
        grams = {}
        for w in range(1, langid.ORDER + 2):
            c = Counter(int.from_bytes(padded[i - w + 1:i + 1], "big") for i in range(langid.ORDER, len(padded)))
            grams[w] = (np.array(sorted(c)), np.array([c[k] for k in sorted(c)]))
        model.append((name, grams))

    def probability(grams, context, byte):
        p = 1 / 256
        for k in range(len(context) + 1):
            before = context[len(context) - k:]
            after = {int(g) & 255: int(n) for g, n in zip(*grams[k + 1]) if int(g) >> 8 == int.from_bytes(before, "big")}
            if after:
                t, q = sum(after.values()), len(after)
                p = after[byte] / (t + q) if byte in after else q / (t + q) * p
        return p

    coder, langid._CHUNK = langid.Coder(model), 7
    try:
        texts = [b"abandon zz", b"", b"banana", "ünder".encode()]
        got = coder.lengths(texts)
    finally:
        langid._CHUNK = 1 << 20
    for i, t in enumerate(texts):
        padded = b"\n" * langid.ORDER + t
        for j, (_, grams) in enumerate(model):
            want = sum(round(-math.log2(probability(grams, padded[k - langid.ORDER:k], padded[k])) * langid.SCALE) for k in range(langid.ORDER, len(padded)))
            assert abs(got[i, j] - want) <= len(t)


# 8: lines

def brute_lines(rows, percent=80, least=1):
    seen, gone = [], set()
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for k, line in enumerate(t.split("\n")):
            s = set(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
            if len(s) >= least:
                if any(100 * len(s & x) >= percent * len(s | x) for x in seen):
                    gone.add((i, k))
                seen.append(s)
    return gone


def test_lines_agree_with_brute_force(spark, odd, empty):
    rng = random.Random(8)
    pool = [prose(i, rng.randrange(3, 30)) for i in range(25)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice(pool).split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
            own.append(" ".join(words) if rng.random() < 0.8 else "  " + "\t".join(reversed(words)).upper())
        rows.append((i, "\n".join(own)))
    rows += [(100, None), (101, ""), (102, "\n\n")]
    df = docs_of(spark, rows)
    want = brute_lines(rows)
    assert {tuple(r) for r in lines.removed_lines(df).collect()} == want and want
    texts = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()}
    for i, t in rows:
        assert texts[i] == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in want))
    assert lines.dedup_lines(odd).columns == odd.columns and lines.dedup_lines(odd).count() == len(ODD) and lines.dedup_lines(empty).count() == 0


def test_short_lines_take_part(spark, tmp_path):
    rng = random.Random(3)
    words = "a b c d e f".split()
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(8))) for _ in range(4))) for i in range(40)]
    rows += [(100, "k l m n"), (101, "k l m n o"), (102, "K\tL M"), (103, "m l k"), (104, "zz zz"), (105, "zz"), (106, "\n \n"), (107, " \n")]
    want = brute_lines(rows)
    assert {tuple(r) for r in lines.removed_lines(docs_of(spark, rows)).collect()} == want > brute_lines(rows, least=5)
    assert {tuple(r) for r in lines.removed_lines(docs_of(spark, rows), min_tokens=5).collect()} == brute_lines(rows, least=5)
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs_of(spark, rows), str(tmp_path)).collect()}
    kept = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in want) for i, t in rows}
    assert left == {i: t for i, t in kept.items() if t} and left.keys().isdisjoint({101, 103, 105}) and left[106] == "\n \n"


def test_long_lines_without_a_match_are_seldom_candidates(spark, monkeypatch):
    """Lines of 150 of 450 words share rare words; sixteen repeat most of another, fifteen enough to go."""
    rng, vocabulary = random.Random(5), [f"w{k}" for k in range(450)]
    texts = [rng.sample(vocabulary, 150) for _ in range(64)]
    texts += [t[: 150 - k] + [f"x{k}_{i}" for i in range(k)] for k, t in enumerate(texts[:16], 2)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sizes, later = [], lines._later
    monkeypatch.setattr(lines, "_later", lambda pairs, *a: sizes.append(pairs.count()) or later(pairs, *a))
    assert {tuple(r) for r in lines.removed_lines(docs_of(spark, rows)).collect()} == brute_lines(rows, least=1) == {(64 + k, 0) for k in range(15)}
    assert sizes[1] <= 40  # of 2,000 pairs or so that share a rare word


def test_lines_run_no_python_on_executors(spark, monkeypatch):
    """Neither the stored tables nor the result; the sketches of a match never differ by more than its tokens."""
    plans, stored = [], lines.stored
    monkeypatch.setattr(lines, "stored", lambda df: plans.append(df) or stored(df))
    base = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join(base[: 40 - i % 5] + [f"x{i}_{k}" for k in range(i % 5)])) for i in range(30)]
    docs = docs_of(spark, rows)
    plans.append(lines.dedup_lines(docs))
    assert {r["doc_id"] for r in plans[-1].where("text = ''").collect()} == {i for i, _ in brute_lines(rows)}
    assert len(plans) > 5 and not any(re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString()) for df in plans)


def test_lines_of_rows_that_share_an_id(spark):
    """A repeat found in one row leaves the other rows of its id alone, and copies at one number of different rows go but once."""
    a, b, c, d, e = (prose(700 + i, 12) for i in range(5))
    rows = [(1, a), (2, f"{b}\n{a}"), (2, f"{b}\n{c}"), (None, f"{d}\n{b}"), (None, f"{d}\n{e}"), (3, e), (3, e)]
    left = Counter(line for r in lines.dedup_lines(docs_of(spark, rows)).collect() for line in r["text"].split("\n") if line)
    assert left == {a: 1, b: 1, c: 1, d: 1, e: 1}


# 9: licences

def test_licence_places(spark, odd, empty):
    rows = [
        (1, "CC BY-NC; all Rights\nreserved. All rights reserved"), (2, "GNU General Public License, version 3"), (3, None), (4, ""),
        (5, "general public general public license"), (6, "Permission is hereby granted, free of charge, to any man obtaining a copy of this software"), (7, "ccby CC-BY"),
        (8, "İcc by Kall rights reserved")]
    got = {r["doc_id"]: r for r in licenses.summary(licenses.scan(docs_of(spark, rows))).collect()}
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["first_word"], got[1]["last_word"]) == (9, 3, 0, 6)
    assert got[1]["base_labels"] == "cc-by,reserved" and got[1]["labels"] == "cc-by,cc-by-nc,reserved"
    assert got[2]["labels"] == "gpl,gpl-3.0" and got[5]["first_word"] == 2 and got[5]["n_base"] == 1
    assert got[3]["n_words"] == got[4]["n_words"] == 0 and got[3]["labels"] == "" and got[3]["first_word"] is None
    assert got[6]["labels"] == "mit" and got[6]["n_base"] == 0 and 0.8 < got[6]["score"] < 1
    assert got[7]["n_base"] == 1 and got[7]["first_word"] == 1
    assert got[8]["n_words"] == 5 and got[8]["n_base"] == 0
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(empty).count() == 0


# 10: mixing

def test_apportionment_takes_highest_quotients(spark):
    rng = random.Random(5)
    for seats, weights in [(20, [53.0, 24.0, 23.0]), (7, [1.0, 1.0, 1.0]), (0, [3.0, 4.0]), (5, [0.0, 0.0]), (997, [rng.random() * 100 for _ in range(40)])]:
        df = spark.createDataFrame([(i, w, seats) for i, w in enumerate(weights)], "i long, w double, seats long")
        got = {r["i"]: r["quota"] for r in mixing.apportion(df, "w", "seats", ["i"]).collect()}
        best = sorted(((-w / (2 * k - 1), i) for i, w in enumerate(weights) for k in range(1, seats + 1)))[:seats] if sum(weights) else []
        assert got == {i: sum(b[1] == i for b in best) for i in range(len(weights))}


def test_mix_meets_targets(spark, odd, empty):
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randrange(1, 80)), None, rng.choice(["a", "b", "c", "d", None])) for i in range(400)] + [(900, None, None, "a"), (901, "", None, "zz"), (902, "x y", None, "é")]
    got = mixing.mix(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == sum(len((t or "").split()) for _, t, _, s in rows if s == r["source"])
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights, aims, left, open_ = dict(zip(names, [5, 2, 1] * 9)), {}, sum(sizes.values()), set(names)
    while True:  # the excess over three times a source's size is shared again until nothing is above
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > 3 * sizes[s]}
        if not full:
            break
        for s in full:
            aims[s] = 3 * sizes[s]
            left -= aims[s]
        open_ -= full
    aims.update({s: level * weights[s] for s in open_})
    for s in names:
        assert target[s] == pytest.approx(aims[s]) and abs(taken[s] - aims[s]) <= max(16, 0.05 * aims[s])
    again = mixing.mix(docs_of(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    mixed = mixing.mixed_documents(docs_of(spark, rows))
    assert mixed.columns == docs_of(spark, []).columns and abs(mixed.agg(F.sum(mixing.n_words("text"))).first()[0] - sum(sizes.values())) < 0.1 * sum(sizes.values())
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_texts_without_words_make_no_shards(spark):
    rows = [(i, "one two three four five", None, "a") for i in range(20)] + [(100 + i, None, None, "a") for i in range(2000)]
    rows += [(5000 + i, prose(i, 50), None, "b") for i in range(40)]
    got = mixing.mix(docs_of(spark, rows)).where("source = 'a'").agg(F.sum("taken"), F.max("target")).first()
    assert got[1] == 300 and 300 - 8 * 5 <= got[0] <= 300  # within one block for each of the five shards


# pipeline

def test_pipeline_stages(spark, tmp_path, odd, empty):
    rows = [(i, prose(i, 80) + ".\n" + prose(i + 500, 12), "en", f"s{i % 3}") for i in range(30)]
    rows += [(50, rows[0][1], "en", "s0"), (51, rows[1][1] + " more", "en", "s1"), (52, "123 456", "en", "s1"), (53, None, None, None), (54, "alone here", None, "s2")]
    docs = docs_of(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, str(tmp_path))
        if name != "pack":
            assert after.columns == docs.columns
        docs = spark.createDataFrame(after.toPandas(), after.schema) if after.count() else after
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert ids >= {i for i in range(30)} or name in ("mix", "pack")
        assert not ids & {52, 53} or name == "line_dedup"; assert (54 in ids or name in ("mix", "pack"))
        assert name == "language" or not ids & {50, 51}
    for start in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            start = stage(spark, start, str(tmp_path))
        assert start.count() >= 0


def test_stored_leaves_no_shuffle_files(spark):
    """The shuffle behind a stored table leaves the disk with the write, the session's own setting comes back, and the rows can be read again."""
    def shuffles():
        return set(Path(root).rglob("shuffle_*.data"))

    setting = common._SHUFFLES_GO
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    before, had = shuffles(), spark.conf.get(setting, "false")
    source = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = common.stored(source)
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(setting, "false") == had
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, source.collect()))
