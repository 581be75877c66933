"""N-gram Jaccard join by vertical partitioning (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import components, query, slices, stored, table
from comptoir.llm.ngrams import shingles

SIZE = 4
PERCENT = 85
#: The order of the n-grams, by hash, is cut into 2 ** FRAGMENT_BITS fragments.
FRAGMENT_BITS = 3


def _digests(flat: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """128-bit names of sets, and their first halves as numbers."""
    names = [xxhash.xxh3_128_digest(flat[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return names, np.frombuffer(b"".join(n[:8] for n in names), np.int64)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, name (of the set), s (its first half) and n (its size) of each document."""
    schema = T.StructType([docs.schema["doc_id"]]).add("name", "binary").add("s", "long").add("n", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, at = shingles(batch.column("text").to_pylist(), size)
            names, short = _digests(flat, at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(short), pa.array(np.diff(at))], names=schema.names)

    return docs.mapInArrow(work, schema)


def _early(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(h, s): the n-grams at the beginning of the order, with their sets; a task names a set once.

    The share read, a quarter for 85 percent, is 5/3 of what a set may miss: most sets without partners miss more in it.
    """
    end = min((1 << 63) - 1, -(1 << 63) + (1 << 64) * (100 - percent) // 60)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for batch in slices(batches, "text"):
            flat, at = shingles(batch.column("text").to_pylist(), size)
            names, short = _digests(flat, at)
            fresh = np.zeros(len(names), bool)
            for i, name in enumerate(names):
                if name not in done:
                    fresh[i] = True
                    done.add(name)
            if len(done) > 200_000:
                done.clear()
            keep = np.repeat(fresh, np.diff(at)) & (flat < end)
            yield pa.RecordBatch.from_arrays([pa.array(flat[keep]), pa.array(np.repeat(short, np.diff(at))[keep])], names=["h", "s"])

    return docs.mapInArrow(work, "h long, s long")


def _fragments(docs: DataFrame, size: int) -> DataFrame:
    """(s, fragment, grams) of documents with a column ``name``, where it is the name of their set."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, at = shingles(batch.column("text").to_pylist(), size)
            names, short = _digests(flat, at)
            right = np.repeat([a == b for a, b in zip(names, batch.column("name").to_pylist())], np.diff(at))
            flat, owner = flat[right], np.repeat(np.arange(len(names)), np.diff(at))[right]
            fragment = flat >> (64 - FRAGMENT_BITS)
            new = np.ones(len(flat), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (fragment[1:] != fragment[:-1])
            begin = np.flatnonzero(new)
            grams = pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(short[owner[begin]]), pa.array(fragment[begin].astype(np.int32)), grams], names=["s", "fragment", "grams"])

    return docs.select("text", "name").mapInArrow(work, "s long, fragment int, grams array<long>").dropDuplicates(["s", "fragment"])


def _misses(n: Column, percent: int) -> Column:
    """How many n-grams of a set of size n a partner may lack."""
    return n - F.floor((n * percent + 99) / 100)


def _near(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return overlap * 100 >= (a + b - overlap) * percent


def _verified(pairs: DataFrame, fragments: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v, n_u, n_v) that are near enough: overlaps are counted fragment by fragment and summed per pair."""
    left = fragments.select(F.col("s").alias("u"), "fragment", F.col("grams").alias("g"))
    right = fragments.select(F.col("s").alias("v"), "fragment", F.col("grams").alias("k"))
    partial = pairs.join(left, "u").join(right, ["v", "fragment"]).select("u", "v", "n_u", "n_v", F.size(F.array_intersect("g", "k")).alias("part"))
    total = partial.groupBy("u", "v", "n_u", "n_v").agg(F.sum("part").alias("overlap"))
    return total.where(_near(F.col("overlap"), F.col("n_u"), F.col("n_v"), percent)).select("u", "v")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Documents linked by the Jaccard similarity of their word n-grams, percent / 100 or more.

    1. Documents with equal sets form one class; only classes are compared.
    2. A class with more n-grams of its own, shared with no other class, than it may miss has no partner. The
       beginning of the n-gram order shows this for most classes; the whole of it is counted for the rest.
    3. Of what is left each class lists as many of its rarest n-grams as it may miss, plus one. Partners share one of
       them. Each class is first held against one leader, the class with the fewest n-grams of its own in its lists.
    4. Where a list still holds several components, all pairs across them are candidates unless the sizes, the n-grams
       that each has alone, or the places of their first shared n-gram rule them out. A class looks up only partners with few
       enough n-grams of their own, so a list of many that cannot match costs little.
    5. A candidate's overlap is counted in each fragment of the n-gram order separately and summed per pair.

    Pairs inside a component are not tested again, so large groups of copies cost one test per class; no cap is set on
    partners. Returns doc_id, n_shingles, component_id (smallest doc_id reachable by links; its own without words). NULL and
    blank texts have no n-grams; repeated rows are copies; other columns are not read.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sets = stored(_sets(source, size))
    classes = sets.where("n > 0").groupBy("name", "s", "n").agg(F.min("doc_id").alias("rep"))
    own = (
        _early(source, size, percent).groupBy("h").agg(F.min("s").alias("s"), F.max("s").alias("t")).where("s = t")
        .groupBy("s").agg(F.count("*").alias("own"))
    )
    left = classes.join(own, "s", "left").where(F.coalesce("own", F.lit(0)) <= _misses(F.col("n"), percent)).select("name", "rep")
    fragments = stored(_fragments(source.join(left, F.col("doc_id").eqNullSafe(F.col("rep"))), size))

    grams = fragments.select("s", F.explode("grams").alias("h"))
    counted = stored(grams.groupBy("h").agg(F.count("*").alias("c"), F.min("s").alias("s")))
    alone = counted.where("c = 1").groupBy("s").agg(F.count("*").alias("own"))
    sizes = fragments.groupBy("s").agg(F.sum(F.size("grams")).alias("n")).join(alone, "s", "left").select("s", "n", F.coalesce("own", F.lit(0)).alias("own"))
    sizes = stored(sizes.where(F.col("own") <= _misses(F.col("n"), percent)))
    shared = grams.join(sizes.select("s"), "s", "left_semi").join(counted.where("c > 1").select("h", "c"), "h")
    lists = (
        shared.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("g")).join(sizes, "s")
        .select("s", "n", "own", F.posexplode(F.slice("g", F.lit(1), (_misses(F.col("n"), percent) - F.col("own") + 1).cast("int"))).alias("at", "e"))
        .select("s", "n", "own", F.col("e.h").alias("h"), (F.col("own") + F.col("at")).alias("at"))
    )
    lists = stored(lists.withColumn("most", F.floor((F.col("n") - F.col("own")) * 100 / percent) - F.col("n")))

    lead = lists.groupBy("h").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("share"), F.col("s").alias("v"), F.col("n").alias("n_v"))).alias("lead"))
    leaders = (
        lists.join(lead, "h").where((F.col("s") != F.col("lead.v")) & _near(F.least("n", "lead.n_v"), F.col("n"), F.col("lead.n_v"), percent))
        .groupBy(F.col("s").alias("u"), F.col("n").alias("n_u")).agg(F.min("lead").alias("lead")).select("u", "n_u", "lead.v", "lead.n_v")
    )
    links = stored(_verified(leaders, fragments, percent))
    known = components(links)
    rows = lists.join(known, lists["s"] == known["node"], "left").select(*lists.columns, F.coalesce("component", "s").alias("component"))
    mixed = rows.groupBy("h").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("h")
    rows = stored(rows.join(mixed, "h"))
    level = lambda x: F.floor(F.log2(x + 1)).cast("int")
    looking = rows.withColumn("level", F.explode(F.sequence(F.lit(0), level(F.col("most")))))
    sought = rows.select("h", level(F.col("own")).alias("level"), *[F.col(c).alias(f"{c}_v") for c in ("s", "n", "own", "at", "most", "component")])
    most = F.least(F.col("n") - F.col("at"), F.col("n_v") - F.col("at_v"))  # overlap, if this is the first shared n-gram
    rest = looking.join(sought, ["h", "level"]).where(
        (F.col("s") < F.col("s_v")) & (F.col("component") != F.col("component_v")) & (F.col("own_v") <= F.col("most")) & (F.col("own") <= F.col("most_v"))
        & _near(most, F.col("n"), F.col("n_v"), percent)
    ).select(F.col("s").alias("u"), F.col("s_v").alias("v"), F.col("n").alias("n_u"), F.col("n_v")).distinct()
    links = stored(links.unionByName(_verified(rest, fragments, percent)))

    reached = classes.select("s", "rep").join(components(links), F.col("s") == F.col("node"), "left").select("s", "rep", F.coalesce("component", "s").alias("component"))
    smallest = reached.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = reached.join(smallest, "component").select("s", "component_id")
    return sets.join(labels, "s", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


@query("op2_jaccard")
def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
