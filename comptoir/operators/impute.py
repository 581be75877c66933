"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.columns import as_list, categorical_columns, nan_to_null, numeric_columns, ref
from comptoir.operators.neighbours import knn_impute
from comptoir.operators.order import fill_along_order
from comptoir.operators.quantiles import quantile_columns


# The names of the strategies.
class Strategy(str, Enum):
    """How numeric columns are filled; text columns always get their most frequent value."""

    MEAN = "mean"
    MEDIAN = "median"
    MODE = "most_frequent"
    CONSTANT = "constant"
    KNN = "knn"
    FORWARD_FILL = "ffill"
    BACKWARD_FILL = "bfill"


@dataclass(frozen=True)
class Imputer:
    """One fill value per column, reusable on other tables with the same columns."""

    values: dict[str, object] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """Mean and median turn whole-number columns into doubles; other fills keep the type."""
        df = nan_to_null(df)
        filled = {}
        for name, value in self.values.items():
            kind = df.schema[name].dataType
            column: Column = ref(name)
            if isinstance(value, float) and kind.simpleString() not in ("double", "float"):
                column = column.cast("double")
                kind = None
            filled[name] = F.coalesce(column, F.lit(value) if kind is None else F.lit(value).cast(kind))
        return df.withColumns(filled) if filled else df


def columns_with_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    if not columns:
        return []
    row = df.agg(*[F.count_if(ref(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[i]]


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-NULL value per column, the smallest on ties.

    Columns are counted together as (column, value) pairs, which combine before the shuffle; a column
    with many values never sits in one task.
    """
    result: dict[str, object] = {}
    by_type: dict[str, list[str]] = {}
    for name in columns:
        by_type.setdefault(df.schema[name].dataType.simpleString(), []).append(name)
    for names in by_type.values():
        pairs = [F.struct(F.lit(c).alias("name"), ref(c).alias("value")) for c in names]
        counted = (
            df.select(F.inline(F.array(*pairs)))
            .filter(F.col("value").isNotNull())
            .groupBy("name", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        best = counted.groupBy("name").agg(F.min(F.struct(-F.col("n"), "value")).getField("value").alias("value"))
        result.update({row["name"]: row["value"] for row in best.collect()})  # one row per column
    return result


def fit_imputer(
    df: DataFrame, strategy: Strategy | str = Strategy.MEDIAN, columns: str | Sequence[str] | None = None,
    fill_value: float = 0,
) -> Imputer:
    """Fill values of the columns that have gaps; numeric ones by strategy, text by most frequent value."""
    df, strategy = nan_to_null(df), Strategy(strategy)
    names = df.columns if columns is None else as_list(columns)
    gaps = columns_with_missing(df, names)
    numbers = [c for c in numeric_columns(df) if c in gaps]
    texts = [c for c in categorical_columns(df) if c in gaps]
    values: dict[str, object] = {}
    if numbers and strategy in (Strategy.MEAN, Strategy.MEDIAN):
        if strategy is Strategy.MEAN:
            centers = {c: F.avg(ref(c)).cast("double") for c in numbers}
        else:
            centers = {c: q[0] for c, q in quantile_columns(df, {c: [0.5] for c in numbers}).items()}
        row = df.agg(*[center.alias(f"v{i}") for i, center in enumerate(centers.values())]).first()
        values.update({c: row[i] for i, c in enumerate(centers)})
    elif numbers and strategy is Strategy.CONSTANT:
        values.update({c: fill_value for c in numbers})
    elif numbers and strategy is Strategy.MODE:
        values.update(most_frequent(df, numbers))
    elif numbers:
        raise ValueError(f"{strategy.value} has no single fill value; use impute_missing_values")
    if texts:
        values.update(most_frequent(df, texts))
    return Imputer({c: v for c, v in values.items() if v is not None})


def impute_missing_values(
    df: DataFrame, strategy: Strategy | str = Strategy.MEDIAN, columns: str | Sequence[str] | None = None,
    order_by: str | Sequence[str] | None = None, partition_by: str | Sequence[str] = (),
    fill_value: float = 0, n_neighbors: int = 5,
) -> DataFrame:
    """Fill gaps. Forward and backward fill need ``order_by``, the row order they follow."""
    df, strategy = nan_to_null(df), Strategy(strategy)
    names = df.columns if columns is None else as_list(columns)
    if strategy not in (Strategy.KNN, Strategy.FORWARD_FILL, Strategy.BACKWARD_FILL):
        return fit_imputer(df, strategy, names, fill_value).transform(df)

    texts = fit_imputer(df, Strategy.MODE, [c for c in categorical_columns(df) if c in names])
    numbers = columns_with_missing(df, [c for c in numeric_columns(df) if c in names])
    if numbers and strategy is Strategy.KNN:
        df = knn_impute(df, numbers, n_neighbors)
    elif numbers:
        if not order_by:
            raise ValueError(f"{strategy.value} needs order_by: rows have no order of their own")
        df = fill_along_order(df, numbers, order_by, partition_by, backward=strategy is Strategy.BACKWARD_FILL)
    return texts.transform(df)
