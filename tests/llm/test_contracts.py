"""Rows that share ids, ids of other types, extreme numbers, clashing columns and repeated phrases, against plain versions."""

import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from comptoir.llm import covertree, fingerprints, licenses, lines, mixing, packing
from tests.llm.test_operators import brute_lines, docs_of, prose


# 1: embeddings

def test_embeddings_of_rows_that_share_an_id(spark):
    east, north, down = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, -1.0]
    rows = [(1, east), (1, north), (2, east), (None, north), (None, down), (None, [0.0, 0.1, -9.0]), (3, [0.01, 1.0, 0.0])]
    got = Counter(map(tuple, covertree.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == Counter([(1, 1, 1, True), (2, 1, 1, False), (1, 2, 1, True), (None, 2, 1, False), (3, 2, 1, False), (None, 1, None, True), (None, 1, None, True)])


def test_embeddings_of_extreme_length(spark):
    rows = [(1, [1e200, 0.0]), (2, [1e-200, 0.0]), (3, [5e-324, 0.0]), (4, [1.7e308, 1.7e308]), (5, [1e-310, 1e-310]), (6, [-1e200, 0.0])]
    got = {r[0]: tuple(r)[1:] for r in covertree.near_embeddings(spark.createDataFrame(rows, "vec_id string, embedding array<double>")).collect()}
    assert got == {"1": (2, "1", True), "2": (2, "1", False), "3": (2, "1", False), "4": (1, "4", True), "5": (1, "4", False), "6": (0, "6", True)}


def brute_links(x):
    unit = np.array(x, float) / np.linalg.norm(np.array(x, float), axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    label = np.arange(len(x))
    while (low := np.array([label[row].min() for row in near])).tolist() != label.tolist():
        label = low
    return {i: (int(near[i].sum()) - 1, int(label[i]), bool(label[i] == i)) for i in range(len(x))}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings_that_do_not_cluster_are_not_copied_more_as_they_grow(spark, monkeypatch, kind):
    blocks = []
    divide = covertree.Cells.divide

    def divided(self, *args):
        out = divide(self, *args)
        blocks.append(int((self.first + self.chunks).max()))
        return out

    monkeypatch.setattr(covertree.Cells, "divide", divided)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 40))
    x[1000:1200] = x[0] + rng.normal(size=(200, 40)) * 0.2  # one hot cell
    x[1200:1400] = x[rng.choice(1000, 200)] + rng.normal(size=(200, 40)) * rng.choice([0.1, 0.3, 0.5], size=(200, 1))
    x = x.astype("f4" if kind == "float" else "f8")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>")
    got = {r[0]: tuple(r)[1:] for r in covertree.near_embeddings(df, pivots=20, block=16).collect()}
    assert got == brute_links(x)
    assert len(blocks) == 1 and blocks[0] <= 2 * 4  # there were as many as the table has times 16 vectors


@pytest.mark.parametrize("pivots", [30, 1000])  # with 1000 each vector is a cell of its own, whose cosine may round to more than 1
def test_embeddings_of_many_blocks_meet_in_rounds(spark, monkeypatch, pivots):
    monkeypatch.setattr(covertree, "_SIDES", 9)
    monkeypatch.setattr(covertree, "_AT_ONCE", 4)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 6))
    x[200:] = x[:100] + rng.normal(size=(100, 6)) * 0.2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert {r[0]: tuple(r)[1:] for r in covertree.near_embeddings(df, pivots=pivots, block=16).collect()} == brute_links(x)


def test_embeddings_at_the_threshold(spark):
    x = []
    for k in range(40):  # pairs in planes of their own, closer to 0.95 than single precision can tell
        for c in (1.0, 0.95 + (k % 8 - 3.5) * 1e-9):
            x.append([0.0] * 80)
            x[-1][2 * k], x[-1][2 * k + 1] = c, (1 - c * c) ** 0.5
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = {r[0]: r[1] for r in covertree.near_embeddings(df, pivots=8, block=16).collect()}
    assert got == {2 * k + i: int(k % 8 >= 4) for k in range(40) for i in (0, 1)}


def test_blocks_of_cells_meet_as_all_pairs():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 48))
    x[300:500] = x[0] + rng.normal(size=(200, 48)) * 0.15
    x[500:600] = x[:100] * 3 + rng.normal(size=(100, 48)) * 0.3
    x[600:640] = x[rng.choice(40, 40)] * [[1.0]] + rng.normal(size=(40, 48)) * 0.02
    unit = covertree._unit(x)
    near = unit @ unit.T >= 0.95
    for pivots in (1, 3, 60):
        cells = covertree.Cells(unit[rng.choice(900, pivots, replace=False)])
        dots, cell = cells.nearest(covertree._single(x))
        cosine = dots[np.arange(900), cell]
        for halves in ([np.arange(900)], [np.arange(0, 900, 2), np.arange(1, 900, 2)], [np.arange(900), np.arange(0)]):
            links = covertree.Links(np.ones(900, np.int64))
            blocks = [covertree.Block(cells, x[at], cell[at], cosine[at], at) for at in halves]
            order = np.argsort(np.concatenate([b.near for b in blocks]), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            for b, r in zip(blocks, np.split(rank, np.cumsum([len(b.x) for b in blocks])[:-1])):
                b.rank = r
            for one in blocks:
                for two in blocks:
                    if one is not two:
                        covertree.traverse(cells, one, two, links, 0.95)
            if len(blocks) == 1:
                covertree.traverse(cells, blocks[0], blocks[0], links, 0.95)
                want = near.sum(1) - 1
            else:
                want = np.zeros(900, int)
                for at, other in (halves, halves[::-1]):
                    want[at] = near[np.ix_(at, other)].sum(1)
            links.settle()
            assert links.count.tolist() == want.tolist()


def test_embeddings_without_vectors_are_spread(spark):
    rows = [(i, None if i % 3 else [0.0, 0.0]) for i in range(30)] + [(30, [1.0, 2.0]), (31, [2.0, 4.0])]
    got = covertree.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(map(tuple, got)) == [(i, 0, i, True) for i in range(30)] + [(30, 1, 30, True), (31, 1, 30, False)]


# 3: packing

def test_packing_ids_of_whole_table(spark):
    from pathlib import Path

    import public_tokenizers
    from tokenizers import Tokenizer

    if not Path("/root/testdata/sf0.01/documents.parquet").exists():
        pytest.skip("test tables not present")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter(piece for d, t in docs.collect() for piece in plain_pieces(tokenizer, d, t))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packing.pack(packing.pieces(docs)).collect()) == want


def plain_pieces(tokenizer, doc_id, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    first = (len(ids) - 1) % 1024 + 1
    at = [0, *range(first, len(ids), 1024), len(ids)]
    return [(doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(at, at[1:]))]


# 5: fingerprints

def plain_fingerprint(text, slots=fingerprints.SLOTS, level=fingerprints.LEVEL):
    """Coin tossing letter by letter."""
    m = 1 << 64

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % m
        x = (x ^ x >> 27) * 0x94D049BB133111EB % m
        return x ^ x >> 31

    def toss(left, x):
        low = ((left ^ x) & -(left ^ x)).bit_length() - 1
        return 2 * low + (x >> low & 1)

    names, depth, kept = list(text.encode()), 0, set()
    if not names:
        return "0" * 16
    while True:
        runs = []
        for x in names:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        symbols = [x for x, _ in runs]
        values = [((mix((x + 1) * 0x9E3779B97F4A7C15 % m) if depth == 0 else x) + (mix(n) if n > 1 else 0)) % m for x, n in runs]
        labels = symbols if depth == 0 else [toss(b ^ 1 if a is None else a, b) for a, b in zip([None] + symbols, symbols)]
        for _ in range(3):
            labels = [toss(b ^ 1 if a is None else a, b) for a, b in zip([None] + labels, labels)]
        starts = [0] + [i for i in range(1, len(labels) - 1) if labels[i - 1] < labels[i] > labels[i + 1]]
        names = [mix(sum(v * pow(0xD1342543DE82EF95, j, m) for j, v in enumerate(values[a:b])) % m) for a, b in zip(starts, starts[1:] + [len(values)])]
        depth += 1
        if depth >= level or len(names) == 1:
            kept |= set(names)
        if len(names) == 1:
            return f"{mix((names[0] + depth) % m):016x}" + "".join(f"{x:016x}" for x in sorted(kept)[:slots])


def test_fingerprints_agree_with_tossing_letter_by_letter():
    rng = random.Random(3)
    texts = ["", "a", "ab", "aaaa", "abab", "é" * 50, prose(1, 300), prose(2, 900)]
    texts += ["".join(rng.choice("ab é\n") for _ in range(rng.randrange(60))) for _ in range(200)]
    assert fingerprints.fingerprints(texts) == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("kind, ids", [
    ("long", [2 ** 53 + i for i in range(12)] + [-5, None]), ("string", [f"document-{i:03d}" for i in range(12)] + ["a", None]),
    ("decimal(30,0)", [10 ** 25 + i for i in range(12)] + [3, None])])
def test_fingerprints_follow_ids_of_any_type(spark, kind, ids):
    rows = [(i, prose(k, 30)) for k, i in enumerate(ids)]
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0], reverse=True) + rows[-1:]
    want = {i: fingerprints.fingerprints([fingerprints.edited(t, after)])[0] for (i, t), (_, after) in zip(order, order[1:] + order[:1])}
    docs = spark.createDataFrame([(None if i is None else str(i), t) for i, t in rows], "doc_id string, text string")
    for chars in (500, 10 ** 6):
        got = fingerprints.compared(docs.withColumn("doc_id", F.col("doc_id").cast(kind)), group_chars=chars).collect()
        assert {None if r["doc_id"] is None else type(ids[0])(r["doc_id"]): r["edited_fingerprint"] for r in got} == want


# 8: lines

def test_lines_keep_columns_of_any_name(spark):
    rows = [(1, "a b c d e f\nx"), (2, "a b c d e f\ny")]
    docs = spark.createDataFrame([(*r, 1, 2, "k", True) for r in rows], "doc_id int, text string, _gone int, _ID int, _key string, _had boolean")
    got = sorted(lines.dedup_lines(docs).collect())
    assert [tuple(r) for r in got] == [(1, rows[0][1], 1, 2, "k", True), (2, "y", 1, 2, "k", True)] and got[0].asDict().keys() == dict.fromkeys(docs.columns).keys()
    with pytest.raises(TypeError, match="integers"):
        lines.dedup_lines(docs.withColumn("doc_id", F.lit("x")))


# 9: licences

def plain_places(text):
    words, found = [w for w in "".join(c.lower() if c.isascii() else c for c in text).replace("\n", " ").split(" ") if w], Counter()
    for t in licenses.TEMPLATES:
        for s in range(len(words)):
            if all(words[s + off:s + off + len(key)] == key for off, key in t.spans):
                found[t.label, s] = 1
    return found


def test_licence_places_of_repeated_phrases(spark):
    rng = random.Random(4)
    some = sorted({w for t in licenses.TEMPLATES for w in t.words} | {"stone", "é"})
    texts = ["cc by " * 10_000, "by " * 20_000, " ".join(rng.choice(["cc", "by", "nc", "sa", "apache", "license", "mit"]) for _ in range(20_000))]
    texts += [" ".join(rng.choice(some) for _ in range(60)) + " " + rng.choice(licenses.TEMPLATES).text for _ in range(60)]
    docs = docs_of(spark, list(enumerate(texts)))
    licenses.scan(docs.where("doc_id > 2")).collect()
    began = time.time()
    got = licenses.scan(docs).select("doc_id", F.transform("places", lambda p: F.struct(p.label, p.start)).alias("places")).collect()
    assert time.time() - began < 60  # comparing hits with hits would take many minutes
    for r in got:
        assert Counter(map(tuple, r["places"])) == plain_places(texts[r["doc_id"]])


# 10: mixing

def test_mix_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, prose(i, 20), "ab"[i % 2], i, 5, i, i) for i in range(40)], "doc_id long, text string, source string, _words long, _copy int, _id long, _size long")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.where("_words <> doc_id OR _copy <> 5 OR _id <> doc_id").count() == 0 < mixed.count()


def test_full_sources_are_taken_whole(spark):
    rows = [(i, "one two three four five", None, "a") for i in range(9)] + [(50 + i, prose(i, 50), None, "b") for i in range(40)]
    got = {r[0]: (r[1], r[2]) for r in mixing.mix(docs_of(spark, rows)).groupBy("source").agg(F.sum("taken"), F.max("target")).collect()}
    assert got["a"][1] == 135 and 135 - 4 * 3 <= got["a"][0] <= 135  # half a block for each of the three shards


# pipeline

def test_pipeline_agrees_with_plain_stages(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = [(i, prose(i, 80) + ".\n" + prose(i + 500, 12) + ("\n" + prose(900, 9) if i % 3 == 0 else ""), "en", f"s{i % 3}") for i in range(30)]
    rows += [(50, rows[0][1], "en", "s0"), (51, rows[1][1].replace("\n", " more\n"), "en", "s1"), (52, "123 456", "en", "s1"), (53, None, None, None)]
    rows += [(54, "alone here", None, "s2"), (55, prose(900, 9), "en", "s2"), (56, prose(77, 3000), "en", "s0"), (57, "", "en", "s0")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = [(i, t, s) for i, t, _, s in rows if t and any(c.isalpha() for c in t)]
    gone = brute_lines([(i, t) for i, t, _ in docs], least=1)
    docs = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone), s) for i, t, s in docs]
    docs = [d for d in docs if d[1]]
    grams = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, t, _ in docs for w in [t.lower().split()]}
    first = {i: i for i in grams}
    for _ in grams:
        first = {i: min(first[j] for j in grams if i == j or 100 * len(grams[i] & grams[j]) >= 80 * len(grams[i] | grams[j])) for i in grams}
    docs = [d for d in docs if first[d[0]] == d[0]]
    with duckdb.connect() as con:
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
        taken = {i: int(n / size + 0.5) for i, size, n in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for i, t, _ in docs:
        for piece in plain_pieces(tokenizer, i, t):
            want[piece] += taken[i]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == +want
    ends = Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 1024 and {50, 55} & {r["doc_id"] for r in got} == set()
