"""Line deduplication by an exact set-similarity join (operator 8)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import query, stored, table, unused

PERCENT = 80
MIN_TOKENS = 1
#: Words are counted by the first bits of their hash in so many counters; a word is as rare as its counter.
COUNTERS = 65536
_REST_BITS = 48
#: A line's words are counted in so many ranges of hashes, each count kept modulo 8 in four bits.
RANGES = 32
#: Codes of 0 to 7 that differ in as many bits as the numbers do in steps around the circle.
_CIRCLE = [0, 1, 3, 7, 15, 14, 12, 8]
#: Groups of at least so many classes are held against their first one ahead of the join.
BUSY = 8
#: Tables of at most so many numbers are broadcast to thin out rows before an exact join.
SIEVE = 1 << 20


def _plain(text: Column) -> Column:
    """Lower case, all white space but line feeds as spaces."""
    return F.lower(F.when(text.rlike(r"[\t\x0B\f\r]"), F.regexp_replace(text, r"[\t\x0B\f\r]", " ")).otherwise(text))


def _hashes(line: Column) -> Column:
    """The hashes of the different words of a plain line, sorted."""
    return F.sort_array(F.array_except(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)), F.array(F.xxhash64(F.lit("")))))


def rarity(docs: DataFrame) -> Column:
    """An array by counter that turns, by exclusive or, a hash's first bits into the rank of its counter, the least used first."""
    words = docs.select(F.explode(F.split(F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("word")).where("word != ''")
    counts = np.zeros(COUNTERS, np.int64)
    for r in words.groupBy(F.shiftrightunsigned(F.xxhash64("word"), _REST_BITS).alias("counter")).agg(F.count("*").alias("n")).collect():
        counts[r["counter"]] = r["n"]
    rank = np.empty(COUNTERS, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(COUNTERS) - COUNTERS // 2
    turned = (rank << _REST_BITS) ^ (np.arange(COUNTERS) << _REST_BITS)
    return F.from_json(F.lit("[" + ",".join(map(str, turned.tolist())) + "]"), "array<bigint>")


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, key, line and words (plain) of each line that is not blank."""
    return docs.select("doc_id", "key", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("line", "words")).where(F.trim("words") != "")


def _described(docs: DataFrame, rank: Column, percent: int) -> DataFrame:
    """doc_id, key, line, s (a hash of the tokens), n, their sketch, ends (two hashes that similar lines mostly share) and rarest tokens."""
    step = 1 << 64 - RANGES.bit_length() + 1
    bounds = [np.int64(k * step - (1 << 63)) for k in range(1, RANGES)]
    lines = _lines(docs).select("doc_id", "key", "line", _hashes(F.col("words")).alias("h")).select(
        "doc_id", "key", "line", "h", F.size("h").alias("n"),
        F.sort_array(F.transform("h", lambda x: x.bitwiseXOR(F.coalesce(F.get(rank, F.shiftrightunsigned(x, _REST_BITS)), F.lit(0).cast("long"))))).alias("t"),
        F.sort_array(F.concat("h", F.array(*map(F.lit, bounds)))).alias("cut"))
    lines = lines.select(
        "doc_id", "key", "line", "n", F.xxhash64("h").alias("s"), F.xxhash64(F.slice("h", 1, 2)).alias("low"), F.xxhash64(F.slice("h", -2, 2)).alias("high"),
        F.slice("t", F.lit(1), F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1).alias("first"),
        "cut", *[F.array_position("cut", F.lit(bounds[k - 1])).cast("int").alias(f"at{k}") for k in range(4, RANGES, 4)])
    ends = [F.lit(0), *(F.col(f"at{k}") for k in range(4, RANGES, 4)), F.col("n") + RANGES]
    parts = [F.slice("cut", a + 1, b - a - 1).alias(f"part{k}") for k, (a, b) in enumerate(zip(ends, ends[1:]))]
    lines = lines.select("doc_id", "key", "line", "n", "s", "low", "high", "first", *[e.alias(f"end{k}") for k, e in enumerate(ends)], *parts)
    # Where the bounds lie among the hashes: every fourth in the whole line, those between in their part.
    ends = [F.col(f"end{k // 4}") + (F.array_position(f"part{k // 4}", F.lit(bounds[k - 1])).cast("int") if k % 4 else 0) for k in range(RANGES)] + [F.col("n") + RANGES]
    # The order is that of whole tokens; a part of each is enough to find candidates.
    rarest = F.transform("first", lambda x: x.bitwiseAND((1 << 31) - 1).cast("int")).alias("rarest")
    lines = lines.select("doc_id", "key", "line", "n", "s", "low", "high", rarest, *[e.alias(f"at{k}") for k, e in enumerate(ends)])
    ends = [F.col(f"at{k}") for k in range(RANGES + 1)]
    circle = F.array(*(F.lit(c).cast("long") for c in _CIRCLE))
    codes = [F.shiftleft(F.get(circle, (b - a - 1).bitwiseAND(7)), 4 * (k % 16)) for k, (a, b) in enumerate(zip(ends, ends[1:]))]
    return lines.select("doc_id", "key", "line", "s", "n", *(reduce(Column.bitwiseOR, codes[k:k + 16]).alias(c) for c, k in (("sketch", 0), ("more", 16))), "low", "high", "rarest")


def _position() -> Column:
    """What sorts by id, then by a part of the text's hash, then by line; a NULL id comes first."""
    return F.struct(F.col("doc_id").cast("long").alias("id"), (F.col("key").bitwiseAND((1 << 31) - 1) * F.lit(1 << 31) + F.col("line")).alias("low"))


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, line): the lines, numbered from 0, that match an earlier one, in any row of that id.

    A line's tokens are its different words in lower case. Two lines match when the Jaccard similarity of their tokens is
    percent / 100 or more. Earlier means a smaller id, then, among rows of one id with different texts, a smaller hash of the text,
    then a smaller number; rows of the same id and text count as one place. Whether the earlier line is itself removed does not matter, so the result depends on no order of work. Lines of fewer than ``min_tokens`` tokens neither match nor go; with 1 all lines
    but blank ones take part.

    Tokens are ordered by rarity, words of rarely used counters first. Lines with equal tokens become one class, placed at its first
    line; classes so small that one token less or more is no match take no further part. Large groups first: each class is held against
    the earliest with the same two least, and the same two greatest, token hashes, where eight or more share them; one match is enough to
    go. Then every class lists as many of its rarest tokens as a match may lack, plus one. Classes that share one become candidates where
    their sizes allow a match, the places of that token leave room for enough overlap, and the numbers of their tokens in 32 ranges of
    hashes do not show too many differences; pairs of classes that both go already are left out. Candidates' lines are read again to count
    the overlap exactly. All of it is DataFrame functions and joins.

    Ids are integers; a NULL id comes first.
    """
    return _removed(docs, doc_id, text, percent, min_tokens).select("doc_id", "line").distinct()


def _removed(docs: DataFrame, doc_id: str, text: str, percent: int, min_tokens: int) -> DataFrame:
    """(doc_id, key, line): ``removed_lines`` of each row, known by its id and the hash of its text."""
    if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        raise TypeError(f"ids of lines must be integers, {doc_id} is {docs.schema[doc_id].dataType.simpleString()}")
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    placed = stored(_described(source, rarity(source), percent)).where(F.col("n") >= min_tokens).withColumn("pos", _position())
    sets = stored(placed.groupBy("s").agg(F.min("pos").alias("pos"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "sketch", "more", "low", "high", "rarest")]))
    wide = sets.where(F.col("n") * 100 >= (F.col("n") + 1) * percent)  # can match a class of other tokens

    ends = wide.select("s", "pos", "n", F.array("sketch", "more").alias("p"), F.explode(F.array("low", "high")).alias("end"))
    busy = ends.groupBy("end").agg(F.count("*").alias("classes")).where(F.col("classes") >= BUSY).select("end")
    first = Window.partitionBy("end").orderBy("pos")
    ahead = ends.join(stored(busy), "end").select(*[F.col(c).alias(f"{c}_u") for c in "snp"], *[F.first(c).over(first).alias(f"{c}_v") for c in "snp"]).where("s_u != s_v")
    ahead = ahead.where(_possible("n_u", "p_u", "n_v", "p_v", percent)).select(F.col("s_u").alias("u"), F.col("s_v").alias("v"), "n_u", "n_v").distinct()
    gone = stored(_later(ahead, sets, source, percent))

    once = wide.join(gone.withColumn("goes", F.lit(1)), "s", "left").select("s", "sketch", "more", "n", F.coalesce("goes", F.lit(0)).alias("goes"), "rarest")
    listed = once.select("s", "sketch", "more", "n", "goes", F.posexplode("rarest").alias("at", "t")).select(
        "t", "s", "sketch", "more", (F.col("n").cast("long") * (1 << 25) + F.col("at") * 2 + F.col("goes")).alias("packed"))
    a, b = listed.alias("a"), listed.alias("b")
    n_a, n_b = (F.shiftright(f"{x}.packed", 25) for x in "ab")
    at_a, at_b = (F.shiftright(f"{x}.packed", 1).bitwiseAND((1 << 24) - 1) for x in "ab")
    overlap = F.least(n_a - at_a, n_b - at_b)  # at most, if this is the first shared token
    rest = (
        a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.s") < F.col("b.s")) & (F.col("a.packed").bitwiseAND(F.col("b.packed")).bitwiseAND(1) == 0)
               & _near(overlap, n_a, n_b, percent) & _differ(*([F.col(f"{x}.sketch"), F.col(f"{x}.more")] for x in "ab"), n_a, n_b, percent))
        .select(F.col("a.s").alias("u"), F.col("b.s").alias("v"), n_a.alias("n_u"), n_b.alias("n_v")).distinct()
    )
    gone = gone.unionByName(_later(rest, sets, source, percent)).distinct().withColumn("later", F.lit(True))
    firsts = sets.select("s", "copies", F.col("pos").alias("first")).join(gone, "s", "left").where("later OR copies > 1")
    return placed.select("doc_id", "key", "line", "s", "pos").join(firsts, "s").where(
        F.col("later").isNotNull() | (F.col("pos") != F.col("first"))).select("doc_id", "key", "line")


def _differ(p: Sequence[Column] | Column, q: Sequence[Column] | Column, n: Column, m: Column, percent: int) -> Column:
    """False where the sketches show that the tokens differ in more than those of a match may."""
    return (F.bit_count(p[0].bitwiseXOR(q[0])) + F.bit_count(p[1].bitwiseXOR(q[1]))) * (100 + percent) <= (n + m) * (100 - percent)


def _possible(n: str, p: str, m: str, q: str, percent: int) -> Column:
    n, p, m, q = map(F.col, (n, p, m, q))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & _differ(p, q, n, m, percent)


def _near(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return overlap * (100 + percent) >= (a + b) * percent


def _sieved(df: DataFrame, key: Column, wanted: DataFrame, other: Column) -> DataFrame:
    """Rows whose key falls into the same of SIEVE numbers as some wanted key: fewer rows for an exact join to move."""
    numbers = wanted.select(F.pmod(other, F.lit(SIEVE)).alias("_number")).distinct()
    return df.join(F.broadcast(numbers), F.pmod(key, F.lit(SIEVE)) == F.col("_number"), "left_semi")


def _later(pairs: DataFrame, sets: DataFrame, source: DataFrame, percent: int) -> DataFrame:
    """(s): of each pair (u, v, n_u, n_v) that matches, the later class. Whole lines are read again for the overlap."""
    pairs = stored(pairs)
    if pairs.isEmpty():
        return sets.select("s").where("false")
    wanted = stored(sets.select("s", "pos").join(pairs.select(F.explode(F.array("u", "v")).alias("s")).distinct(), "s"))
    lines = source.select("doc_id", "key", F.posexplode(F.split("text", "\n")).alias("line", "text")).select(_position().alias("pos"), "text")
    found = _sieved(lines, F.xxhash64("pos"), wanted, F.xxhash64("pos")).join(wanted, "pos").select("s", "pos", "text").distinct()
    named = stored(found.select("s", "pos", _hashes(_plain(F.col("text"))).alias("h")).select("s", "pos", "h", F.xxhash64("h").alias("name")))
    full = named.where("s = name").drop("name")  # the others are lines of other rows
    left = full.select(F.col("s").alias("u"), F.col("h").alias("g"), F.col("pos").alias("p"))
    right = full.select(F.col("s").alias("v"), F.col("h").alias("k"), F.col("pos").alias("q"))
    matched = pairs.join(left, "u").join(right, "v").where(_near(F.size(F.array_intersect("g", "k")), F.col("n_u"), F.col("n_v"), percent))
    return matched.select(F.when(F.col("p") > F.col("q"), F.col("u")).otherwise(F.col("v")).alias("s")).distinct()


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, min_tokens: int = MIN_TOKENS,
                removed: str | None = None) -> DataFrame:
    """All documents with the lines of ``removed_lines`` taken out of their text, and their number in a column ``removed`` if named.

    Other columns stay. A NULL text stays NULL; a text that loses all its lines is empty. Rows that repeat an id and a text count as
    one place; rows of one id, or of none, with different texts lose their own lines only. Lines are separated by line feeds only.
    """
    id_, key, lost = (unused(docs.columns, c) for c in ("_id", "_key", "_gone"))
    gone = _removed(docs, doc_id, text, percent, min_tokens).groupBy(F.col("doc_id").alias(id_), F.col("key").alias(key)).agg(F.collect_set("line").alias(lost))
    gone = stored(gone)
    joined = docs.join(gone, F.col(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(key)), "left")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(lost, i)), "\n")
    return joined.select(
        *[F.when(F.col(lost).isNull(), F.col(text)).otherwise(kept).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns],
        *([F.coalesce(F.size(lost), F.lit(0)).alias(removed)] if removed else []))


SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, unnest(range(len(string_split(text, chr(10))))) AS line FROM documents),
t AS (SELECT doc_id, line, list_distinct(list_filter(string_split_regex(lower(content), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words FROM l),
s AS (SELECT row_number() OVER (ORDER BY min(doc_id), min(line)) AS id, min({{'d': doc_id, 'l': line}}) AS first, words, len(words) AS n
  FROM (SELECT doc_id, line, list_sort(words) AS words FROM t WHERE len(words) >= {MIN_TOKENS}) GROUP BY words),
w AS (SELECT id, n, unnest(words) AS word FROM s),
p AS (SELECT a.id AS u, b.id AS v FROM w a JOIN w b ON a.word = b.word AND a.id < b.id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {PERCENT}
  GROUP BY a.id, b.id, a.n, b.n HAVING count(*) * 100 >= (a.n + b.n - count(*)) * {PERCENT}),
later AS (SELECT DISTINCT CASE WHEN a.first > b.first THEN u ELSE v END AS id FROM p JOIN s a ON u = a.id JOIN s b ON v = b.id),
gone AS (SELECT DISTINCT t.doc_id, t.line FROM t JOIN s ON list_sort(t.words) = s.words
  WHERE s.id IN (SELECT id FROM later) OR s.first <> {{'d': t.doc_id, 'l': t.line}}),
kept AS (SELECT l.doc_id, string_agg(content, chr(10) ORDER BY l.line) AS text FROM l ANTI JOIN gone USING (doc_id, line) GROUP BY l.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(string_split(d.text, chr(10))) AS n_lines, CAST(coalesce(n, 0) AS INT) AS removed, coalesce(length(coalesce(k.text, '')), 0) AS n_chars, md5(coalesce(k.text, '')) AS text_md5
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


@query("op8_lines", SQL)
def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = dedup_lines(docs.select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines")), removed="removed")
    text = F.coalesce("text", F.lit(""))
    return done.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), "removed", F.length(text).cast("long").alias("n_chars"), F.md5(text.cast("binary")).alias("text_md5"))
