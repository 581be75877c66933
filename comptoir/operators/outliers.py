"""Removing and flagging outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.columns import as_list, numeric_columns, ref
from comptoir.operators.order import distinct_estimates
from comptoir.operators.quantiles import exact_quantiles, quantile_columns

IQR_FACTOR = 1.5
ZSCORE_LIMIT = 3.0


def fences(q1: float, q3: float, factor: float = IQR_FACTOR) -> tuple[float, float]:
    return q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)


def remove_outliers(
    df: DataFrame, columns: str | Sequence[str] | None = None, method: str = "iqr",
    factor: float = IQR_FACTOR, limit: float = ZSCORE_LIMIT,
) -> DataFrame:
    """Keep rows inside the bounds of every column in turn; a NULL in the column drops the row.

    The bounds of each column come from the rows the earlier columns left, so there is one small
    aggregate per column. The bounds are literals in the result, and its filters reach the scan.
    """
    names = numeric_columns(df) if columns is None else [c for c in as_list(columns) if c in df.columns]
    # Filtering only lowers the number of distinct values, so one estimate serves all columns.
    distinct = distinct_estimates(df, names) if names and method == "iqr" else {}
    for name in names:
        if method == "iqr":
            q1, q3 = exact_quantiles(df, {name: [0.25, 0.75]}, distinct)[name]
            if q1 is None:
                return df.filter(F.lit(False))
            low, high = fences(q1, q3, factor)
            df = df.filter((ref(name) >= low) & (ref(name) <= high))
        elif method == "zscore":
            mean, spread = df.agg(F.avg(ref(name)), F.stddev_samp(ref(name))).first()
            if not spread:  # constant, one row or empty: no score is below the limit
                return df.filter(F.lit(False))
            df = df.filter(F.abs((ref(name) - mean) / spread) < limit)
        else:
            raise ValueError(f"unknown method: {method}")
    return df


def _beyond(name: str, method: str, stats: Column) -> Column:
    """Whether a value lies outside; ``stats`` is (Q1, Q3) or (mean, deviation). NULL is never an outlier."""
    if method == "iqr":
        low, high = fences(stats[0], stats[1])
        outside = (ref(name) < low) | (ref(name) > high)
    else:
        outside = F.abs(F.try_divide(ref(name) - stats[0], stats[1])) > ZSCORE_LIMIT
    return F.coalesce(outside, F.lit(False))


def _stats(df: DataFrame, names: Sequence[str], method: str) -> dict[str, Column]:
    if method == "iqr":
        return quantile_columns(df, {c: [0.25, 0.75] for c in names})
    if method == "zscore":
        return {c: F.array(F.avg(ref(c)), F.stddev_samp(ref(c))) for c in names}
    raise ValueError(f"unknown method: {method}")


def flag_outliers(df: DataFrame, column: str, method: str = "iqr", flag: str = "is_outlier") -> DataFrame:
    """Keep all rows and add a boolean column."""
    stats = _stats(df, [column], method)[column]
    if method == "zscore":
        stats = df.agg(stats).scalar()
    return df.withColumn(flag, _beyond(column, method, stats))


def outlier_counts(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr", known: dict[str, Column] | None = None
) -> DataFrame:
    """Number of outliers per column: one pass for all bounds, one for all counts. ``known`` gives first and third quartiles found before."""
    names = numeric_columns(df) if columns is None else as_list(columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, count bigint")
    per_column = known if known and method == "iqr" else _stats(df, names, method)
    if method == "zscore":
        bounds = df.agg(F.struct(*[per_column[c].alias(f"s{i}") for i, c in enumerate(names)])).scalar()
        per_column = {c: bounds.getField(f"s{i}") for i, c in enumerate(names)}
    counts = df.agg(*[F.count_if(_beyond(c, method, per_column[c])).alias(f"n{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count")) for i, c in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))
