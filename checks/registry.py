"""Registered queries: each runs one operator over whole tables, next to the SQL that must agree with it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.functions.columns import ref
from comptoir.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The sales view of plans/sales.py in SQL.
SALES = """
sales AS (
  SELECT o_orderdate AS date, p_name AS produit, p_type AS categorie, p_retailprice AS prix,
         CAST(l_quantity AS INTEGER) AS quantite, n_name AS ville, o_orderpriority AS source,
         o_custkey AS customer_id, p_retailprice * CAST(l_quantity AS INTEGER) AS revenue
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` under a name, with its SQL where there is one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder next to the checkpoints, which all executors can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


def tidy(df: DataFrame, digits: int = 4, **other: int) -> DataFrame:
    """Round doubles (no negative zero) and spell dates as text, so that both engines print the same values."""
    columns = []
    for field in df.schema:
        column = ref(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, other.get(field.name, digits)) + F.lit(0.0)
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def cells(tables: dict[str, DataFrame], digits: int = 4, **other: int) -> DataFrame:
    """Whole tables in one long form ``part, item, measure, value``: text and dates name a row, each number of it is a value."""
    parts = []
    for part, df in tables.items():
        df = tidy(df, digits, **other)
        labels = [ref(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)]
        numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
        values = F.array(*[F.struct(F.lit(c).alias("measure"), ref(c).cast("double").alias("value")) for c in numbers])
        parts.append(df.select(F.lit(part).alias("part"), F.concat_ws("|", *labels).alias("item"), F.inline(values)))
    return reduce(DataFrame.unionByName, parts)


def cells_sql(part: str, source: str, labels: list[str], numbers: list[str]) -> str:
    """The same of a query in SQL."""
    item = "concat_ws('|', " + ", ".join(f'"{c}"' for c in labels) + ")" if labels else "''"
    names, values = ", ".join(f"'{c}'" for c in numbers), ", ".join(f'"{c}"::DOUBLE' for c in numbers)
    return f"SELECT '{part}' AS part, {item} AS item, unnest([{names}]) AS measure, unnest([{values}]) AS value FROM ({source})"
