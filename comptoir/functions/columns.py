"""Column helpers shared by the operators: schema inspection and NULL-safe arithmetic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_list(names: str | Iterable[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[ref(c) for c in numeric_columns(df)])


def select_categorical(df: DataFrame) -> DataFrame:
    return df.select(*[ref(c) for c in categorical_columns(df)])


def ref(name: str) -> Column:
    """Column by exact name, also where the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN in float columns becomes NULL."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    columns = [F.when(~F.isnan(ref(c)), ref(c)).alias(c) if c in floats else ref(c) for c in df.columns]
    return df.select(*columns) if floats else df


def with_revenue(df: DataFrame, overwrite: bool = False) -> DataFrame:
    """Add ``revenue = prix * quantite`` when both exist; keep a present one unless told otherwise."""
    if not {"prix", "quantite"} <= set(df.columns):
        return df
    if "revenue" in df.columns and not overwrite:
        return df
    return df.withColumn("revenue", F.col("prix") * F.col("quantite"))


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, rounded half to even; NULL when the whole is zero."""
    return F.bround(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def sort_by_desc(column: str, *ties: str) -> list[Column]:
    """Descending order with NULLs last and ascending tie-breaks, so that results do not depend on row order."""
    return [ref(column).desc_nulls_last(), *[ref(t).asc() for t in ties]]


def unique_names(names: list[str]) -> list[str]:
    """Name empty headers by position and number repeated ones."""
    seen: dict[str, int] = {}
    result = []
    for i, name in enumerate(names):
        name = name or f"Unnamed: {i}"
        result.append(f"{name}.{seen[name]}" if name in seen else name)
        seen[name] = seen.get(name, 0) + 1
    return result
