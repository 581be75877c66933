"""From raw documents to packed sequences: five of the operators of comptoir.llm, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm import jaccard, langid, lines, mixing, packing
from comptoir.llm.common import stored, table, unused

#: A text that takes as many bits per byte as it has is like none of the languages learned.
RAW_BITS = 8.0
#: Shorter texts say too little to be rejected for that.
LEAST_BYTES = 64


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and longer ones that no learned language can code in under 8 bits a byte.

    The languages are learned from the labelled documents themselves; a missing label is filled in.
    """
    name = unused(docs.columns, "_found")
    named = docs.withColumn(name, langid.identify(F.col("text"), langid.fit(docs), spark)).where(
        (F.col(name)["lang"] != langid.UNKNOWN)
        & ((F.octet_length("text") < LEAST_BYTES) | (F.coalesce(F.col(name)["bits_per_byte"], F.lit(0.0)) < RAW_BITS)))
    return named.withColumn("lang", F.coalesce("lang", F.col(name)["lang"])).drop(name)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated lines out of the texts, short ones too; documents of which nothing is left go."""
    had = unused(docs.columns, "_had")
    done = lines.dedup_lines(docs.withColumn(had, F.col("text") != ""), min_tokens=1)
    left = done.where(~F.col(had) | (F.col("text") != "") | F.col(had).isNull())
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).drop(had)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group linked by five-word shingles at a Jaccard similarity of 0.8."""
    found = stored(jaccard.join(docs, size=5, percent=80))
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    one = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
    repeated = found.groupBy("doc_id").count().where("count > 1").limit(1).count()
    return one.dropDuplicates(["doc_id"]) if repeated else one


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents by the target weights of their sources, some several times."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise, and give each piece its place in a sequence."""
    return packing.pack(packing.pieces(docs))


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: The language models and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
