"""Label and one-hot encoding of text columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.functions.columns import as_list, categorical_columns, ref
from comptoir.operators import order
from comptoir.operators.order import distinct_estimates, fits_one_sort, value_ranks
from comptoir.session import ensure_checkpoint_dir
from comptoir.sources.errors import MissingPathError

_DICTIONARY = "`column` string, value string, code int"
MISSING_LABEL = "nan"  # a missing value is a category of its own, spelled like this


def _label(column: str) -> Column:
    return F.coalesce(ref(column).cast("string"), F.lit(MISSING_LABEL))


@dataclass(frozen=True)
class LabelEncoder:
    """A stored dictionary ``(column, value, code)``, reusable on other tables; unknown values get NULL.

    Columns whose part of the dictionary is small, by its counted bytes, are looked up in broadcast tables, all in one pass
    without a shuffle; a larger part is joined by shuffle, where Spark splits the partitions of hot values.
    """

    columns: tuple[str, ...]
    dictionary: DataFrame
    small: frozenset[str]

    def transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        for column in sorted(self.columns, key=lambda c: c not in self.small):
            codes = self.dictionary.filter(F.col("column") == column).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
            codes = F.broadcast(codes) if column in self.small else codes
            df = df.join(codes, _label(column) == F.col("_value"), "left")
            df = df.withColumn(column, F.col("_code")).drop("_value", "_code")
        return df.select(*[ref(c) for c in names])

    def save(self, path: str) -> int:
        """Write the dictionary as the next version below ``path``; versions count up from 1 and are never changed."""
        version = 1 + _newest(self.dictionary.sparkSession, path)
        self.dictionary.write.parquet(f"{path}/version={version}")
        return version


def _newest(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.parquet(path).agg(F.max("version")).first()[0] or 0
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return 0
        raise


def load_label_encoder(spark: SparkSession, path: str, version: int | None = None) -> LabelEncoder:
    """An encoder saved below ``path``, the newest one unless a version is named."""
    version = version or _newest(spark, path)
    if not version:
        raise MissingPathError(f"no encoder below {path}", path=path)
    return _encoder(spark.read.schema(_DICTIONARY).parquet(f"{path}/version={version}"))


def _encoder(dictionary: DataFrame, columns: Sequence[str] | None = None) -> LabelEncoder:
    size = F.sum(F.octet_length("value") + F.lit(64))
    sizes = {r["column"]: (r["n"], r["size"]) for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n"), size.alias("size")).collect()}
    small = frozenset(c for c, (n, bytes_) in sizes.items() if n <= order.SMALL_SORT and bytes_ <= order.BROADCAST_BYTES)
    return LabelEncoder(tuple(columns if columns is not None else sorted(sizes)), dictionary, small)


def fit_label_encoder(df: DataFrame, columns: str | Sequence[str] | None = None) -> LabelEncoder:
    """Codes count up from 0 in sorted (code point) order of the text.

    All columns are counted and ranked together; the dictionary is kept as a checkpoint, so that applying it does not read the
    table again. :meth:`LabelEncoder.save` keeps it for later sessions.
    """
    names = categorical_columns(df) if columns is None else as_list(columns)
    spark = df.sparkSession
    if not names:
        return LabelEncoder((), spark.createDataFrame([], _DICTIONARY), frozenset())
    ensure_checkpoint_dir(spark)
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), _label(c).alias("value")) for c in names])))
    ranks = value_ranks(long, "value", ["column"], small=fits_one_sort(max(distinct_estimates(df, names).values()) + 1))
    return _encoder(ranks.select("column", "value", F.col("code").cast("int").alias("code")).checkpoint(), names)


def one_hot(df: DataFrame, columns: str | Sequence[str], levels: dict[str, list] | None = None) -> DataFrame:
    """Replace each column by one boolean per level except the first; NULL is false everywhere.

    Levels become columns, so there may be at most ``spark.sql.pivotMaxValues`` of them, Spark's own
    limit for pivots; beyond it this fails. Pass known ``levels`` to save the pass that finds them.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    names = as_list(columns)
    kept = [ref(c) for c in df.columns if c not in names]
    flags = []
    for name in names:
        if levels and name in levels:
            found = list(levels[name])
        else:
            rows = df.select(ref(name)).filter(ref(name).isNotNull()).distinct().orderBy(ref(name)).limit(limit + 1)
            found = [row[0] for row in rows.collect()]
        if len(found) > limit:
            raise ValueError(f"'{name}' has more than {limit} levels (spark.sql.pivotMaxValues): too many columns")
        flags += [F.coalesce(ref(name) == F.lit(v), F.lit(False)).alias(f"{name}_{v}") for v in found[1:]]
    return df.select(*kept, *flags)


def encode_categorical_columns(
    df: DataFrame, columns: str | Sequence[str] | None = None, method: str = "label"
) -> DataFrame:
    names = categorical_columns(df) if columns is None else as_list(columns)
    if not names:
        return df
    if method == "label":
        return fit_label_encoder(df, names).transform(df)
    if method == "onehot":
        return one_hot(df, names)
    raise ValueError(f"unknown encoding: {method}")
