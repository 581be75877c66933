"""Descriptive statistics, percentiles and the statistics report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.columns import as_list, categorical_columns, nan_to_null, numeric_columns, ref
from comptoir.operators.correlation import correlation_matrix
from comptoir.operators.outliers import outlier_counts
from comptoir.operators.quality import missing_report
from comptoir.operators.quantiles import quantile_columns

# The percentiles given when none are asked for.
DEFAULT_PERCENTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)

_SUMMARY = "array<struct<column:string,count:bigint,mean:double,std:double,min:double,q25:double,median:double," \
           "q75:double,max:double,skewness:double,kurtosis:double>>"


def sample_skewness(column: Column) -> Column:
    """Bias-corrected skewness; 0 for a constant column, NULL below three values."""
    n = F.count(column).cast("double")
    corrected = F.skewness(column) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n >= 3, F.when(F.min(column) == F.max(column), F.lit(0.0)).otherwise(corrected))


def sample_kurtosis(column: Column) -> Column:
    """Bias-corrected excess kurtosis; 0 for a constant column, NULL below four values."""
    n = F.count(column).cast("double")
    divisor = F.nullif((n - 2) * (n - 3), F.lit(0.0))
    corrected = (n - 1) / divisor * ((n + 1) * F.kurtosis(column) + 6)
    return F.when(n >= 4, F.when(F.min(column) == F.max(column), F.lit(0.0)).otherwise(corrected))


def describe(
    df: DataFrame, columns: str | Sequence[str] | None = None, rounded: bool = False, quartiles: dict[str, Column] | None = None
) -> DataFrame:
    """One summary row per numeric column, all from a single aggregate. ``rounded`` keeps two decimals; known ``quartiles`` save their passes."""
    names = numeric_columns(df) if columns is None else as_list(columns)
    df = nan_to_null(df)
    quartiles = quartiles or quantile_columns(df, {c: [0.25, 0.5, 0.75] for c in names})
    summaries = []
    for i, name in enumerate(names):
        column = ref(name).cast("double")
        summaries.append(F.struct(
            F.lit(name), F.count(column), F.avg(column), F.stddev_samp(column), F.min(column),
            quartiles[name][0], quartiles[name][1], quartiles[name][2], F.max(column),
            sample_skewness(column), sample_kurtosis(column),
        ).alias(f"s{i}"))
    one = df.agg(F.lit(0), *summaries)
    listed = F.array(*[F.col(f"s{i}") for i in range(len(names))]).cast(_SUMMARY)
    result = one.select(F.inline(listed))
    if rounded:
        # the noise of interpolation must not decide a tie
        result = result.withColumns({c: F.bround(F.round(c, 8), 2) for c in result.columns[2:]})
    return result


def percentiles(df: DataFrame, column: str, wanted: Sequence[float] = DEFAULT_PERCENTILES) -> DataFrame:
    """Exact percentiles with linear interpolation, one row each."""
    df = nan_to_null(df)
    values = quantile_columns(df, {column: list(wanted)})[column]
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in wanted]).alias("percentile"), F.col("v").alias("value"))
    return df.agg(values.alias("v")).select(F.inline(pairs)).toDF("percentile", "value")


def profile_counts(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric columns, text columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(len(numeric_columns(df))).alias("n_numeric"),
        F.lit(len(categorical_columns(df))).alias("n_categorical"),
    )


def statistics_report(df: DataFrame) -> dict[str, DataFrame]:
    """Overview, summaries, missing values, correlations (from two numeric columns on) and outlier counts."""
    df, names = nan_to_null(df), numeric_columns(df)
    report = {"overview": profile_counts(df), "missing_values": missing_report(df)}
    if names:
        quartiles = quantile_columns(df, {c: [0.25, 0.5, 0.75] for c in names})
        report["descriptive_stats"] = describe(df, names, rounded=True, quartiles=quartiles)
        bounds = {c: F.array(q[0], q[2]) for c, q in quartiles.items()}
        report["outliers"] = outlier_counts(df, names, known=bounds).filter(F.col("count") > 0)
    if len(names) > 1:
        report["correlations"] = correlation_matrix(df, columns=names)
    return report
