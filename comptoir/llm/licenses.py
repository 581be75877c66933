"""Licence scans by a positional index of rare template words (operator 9)."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm.common import query, table

#: What separates words once A-Z are lower case: every ASCII character but digits and letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A licence text; ``keys`` are its mandatory phrases, each found in ``text`` once; no keys: the whole text."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def spans(self) -> list[tuple[int, list[str]]]:
        """(offset, words) of the mandatory phrases."""
        found = []
        for key in self.keys or (self.text,):
            k = key.split()
            found.append((next(i for i in range(len(self.words)) if self.words[i:i + len(k)] == k), k))
        return found


#: The base phrases and labels, and the wording of common licence notices.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("agpl", "affero general public license"),
    Template("apache", "apache license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met", ("redistribution and use", "source and binary forms", "conditions are met")),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", ("cc0",)),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("lgpl", "lesser general public license"),
    Template("mit", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted", "free of charge", "obtaining a copy")),
    Template("mpl", "mozilla public license"),
    Template("public-domain", "released into the public domain", ("public domain",)),
)


def words_of(text: str) -> Column:
    """Words of a text with A-Z in lower case. lower() maps two other letters to ASCII; texts with them are translated."""
    t = F.coalesce(F.col(text), F.lit(""))
    low = F.when(t.rlike(r"[\u0130\u212A]"), F.translate(t, UPPER, LOWER)).otherwise(F.lower(t))
    return F.array_remove(F.split(low, GAPS), "")


def anchors(idf: dict[str, float], templates: tuple[Template, ...] = TEMPLATES, most: int = 2) -> list[list[tuple[int, str]]]:
    """For each template the (position, word) of its ``most`` rarest words inside mandatory phrases."""
    found = []
    for t in templates:
        places = sorted({(off + i, w) for off, key in t.spans for i, w in enumerate(key)}, key=lambda p: (-idf[p[1]], p[0]))
        found.append(sorted(places[:most]))
    return found


def rarity(words: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of every template word over all rows of ``words`` (words array<string>)."""
    vocabulary = sorted({w for t in templates for w in t.words})
    seen = words.select(F.explode(F.concat(F.array_intersect("words", F.array(*map(F.lit, vocabulary))), F.array(F.lit("")))).alias("w"))
    df = {r["w"]: r["count"] for r in seen.groupBy("w").count().collect()}
    return {w: math.log((df.get("", 0) + 1) / (df.get(w, 0) + 1)) for w in vocabulary}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Where licence templates stand in each whole text.

    One pass counts in how many texts each template word occurs. The two words of each template with the highest
    IDF, from its mandatory phrases, form a positional index, a literal of fixed size. A second pass looks up each text's
    words in it: every hit of an indexed word gives a place where its template would start; places that all of a template's
    indexed words give are candidates, and those with every mandatory phrase in place are matches. Nothing is shuffled but counts,
    and the time for a text grows with its length, however often it repeats a word of the index.

    Returns one row per document: doc_id, n_words, places: array of (label, base, start, coverage), where coverage is the share of
    template words found at their position. NULL and empty texts have no words and no places; repeated rows stay.
    """
    split = docs.select(F.col(doc_id).alias("doc_id"), words_of(text).alias("words"))
    index = anchors(rarity(split.select("words"), templates), templates)
    rare = F.array(*map(F.lit, sorted({word for places in index for _, word in places})))
    hits = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(rare, w), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    has = F.arrays_overlap("words", rare)
    voted = split.withColumn("hits", F.when(has, hits))

    def starts(at: int, word: str) -> Column:
        """Where a template would start by the postings of one of its words; each place once."""
        return F.transform(F.filter("hits", lambda h: (h.w == word) & (h.i >= at)), lambda h: h.i - at)

    # array_intersect hashes, so the time grows with the number of hits alone
    agreed = F.concat(*[
        F.transform(reduce(F.array_intersect, [starts(at, word) for at, word in places]), lambda s: F.struct(F.lit(t).alias("t"), s.alias("start")))
        for t, places in enumerate(index)])

    def stands(v: Column, t: Template) -> Column:
        return reduce(lambda a, b: a & b, [
            F.slice(F.col("words"), v.start + 1 + off, len(key)) == F.array(*map(F.lit, key)) for off, key in t.spans])

    def share(v: Column, t: Template) -> Column:
        same = [F.coalesce((F.get(F.col("words"), v.start + k) == w).cast("int"), F.lit(0)) for k, w in enumerate(t.words)]
        return reduce(lambda a, b: a + b, same) / len(same)

    def case(v: Column, value) -> Column:
        out = None
        for k, t in enumerate(templates):
            out = F.when(v.t == k, value(t)) if out is None else out.when(v.t == k, value(t))
        return out

    matched = voted.withColumn("found", F.filter(agreed, lambda v: case(v, lambda t: stands(v, t))))
    places = F.transform("found", lambda v: F.struct(
        case(v, lambda t: F.lit(t.label)).alias("label"), case(v, lambda t: F.lit(t.base)).alias("base"),
        v.start.cast("long").alias("start"), case(v, lambda t: share(v, t)).alias("coverage")))
    empty = F.array().cast("array<struct<label:string,base:boolean,start:bigint,coverage:double>>")
    return matched.select("doc_id", F.size("words").cast("long").alias("n_words"), F.coalesce(places, empty).alias("places"))


def summary(scanned: DataFrame) -> DataFrame:
    """Digest columns of a scan: base phrases counted and placed, labels joined, and the best coverage as score."""
    base = F.filter("places", lambda p: p.base)
    starts = F.transform(base, lambda p: p.start)
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda p: p.label))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p.coverage)), F.lit(0.0)).alias("score"))


def _sql() -> str:
    lists = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    parts = []
    for t in TEMPLATES:
        keys = " AND ".join(f"words[s + {off + 1}:s + {off + len(k)}] = {lists(k)}" for off, k in t.spans)
        share = " + ".join(f"coalesce((words[s + {k + 1}] = '{w}')::INT, 0)" for k, w in enumerate(t.words))
        parts.append(f"SELECT id, '{t.label}' AS label, {str(t.base).lower()} AS base, s, ({share}) / {len(t.words)} AS coverage FROM starts WHERE {keys}")
    return rf"""
WITH w AS (SELECT row_number() OVER () AS id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
starts AS (SELECT id, words, unnest(range(len(words))) AS s FROM w),
places AS ({" UNION ALL ".join(parts)}),
found AS (SELECT id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(coverage) AS score FROM places GROUP BY id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM w LEFT JOIN found USING (id)"""


@query("op9_licenses", _sql())
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(scan(table(spark, sf_dir, "documents")))
