"""Calendar resampling, trend and cohorts.

The windows without a partition key below run over calendar periods, at most one row per day, never
over data rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from comptoir.functions.columns import as_list, ref, with_revenue
from comptoir.operators.aggregate import ZERO_WHEN_EMPTY, Aggregate, aggregate_by, plan_aggregates

# Accepted spellings of a frequency, and the months a period spans (0: day, -1: week).
FREQUENCIES = {"D": 0, "W": -1, "M": 1, "ME": 1, "Q": 3, "QE": 3, "Y": 12, "YE": 12, "A": 12}


def _span(freq: str) -> int:
    if freq not in FREQUENCIES:
        raise ValueError(f"unknown frequency '{freq}', expected one of {', '.join(FREQUENCIES)}")
    return FREQUENCIES[freq]


def as_timestamp(df: DataFrame, column: str) -> Column:
    """The column as a date or timestamp; text is parsed and bad text raises."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.to_timestamp(ref(column))
    return ref(column)


def period_end(moment: Column, freq: str) -> Column:
    """Label of the period that holds the moment: the day, the Sunday, or the last day of month, quarter or year."""
    day, months = F.to_date(moment), _span(freq)
    if months == 0:
        return day
    if months < 0:
        return F.next_day(F.date_sub(day, 1), "SUN")
    first = F.trunc(day, {1: "MM", 3: "quarter", 12: "year"}[months])
    return F.last_day(F.add_months(first, months - 1))


def _labels_until(label: Column, following: Column, freq: str) -> Column:
    """All period labels from ``label`` up to, but without, ``following`` (just ``label`` when that is NULL)."""
    months = _span(freq)
    if months <= 0:
        step = 1 if months == 0 else 7
        last = F.coalesce(F.date_sub(following, step), label)
        return F.sequence(label, last, F.expr(f"interval {step} day"))
    start = F.trunc(label, "MM")
    last = F.coalesce(F.add_months(F.trunc(following, "MM"), -months), start)
    return F.transform(F.sequence(start, last, F.expr(f"interval {months} month")), F.last_day)


def resample_timeseries(
    df: DataFrame, date_column: str, freq: str, agg_dict: dict[str, Aggregate],
    fill_method: str | None = None, order_by: str | Sequence[str] = (),
) -> DataFrame:
    """Aggregate per calendar period, with empty periods between the first and the last one present.

    Empty periods hold 0 for sums and counts and NULL otherwise; ``ffill`` or ``bfill`` then fills the NULLs.
    """
    if fill_method not in (None, "ffill", "bfill"):
        raise ValueError(f"unknown fill method: {fill_method}")
    planned = plan_aggregates(agg_dict)
    moment = as_timestamp(df, date_column)
    rows = df.filter(moment.isNotNull()).withColumn("_period", period_end(moment, freq))
    periods = aggregate_by(rows, ["_period"], planned, as_list(order_by))

    timeline = W.orderBy("_period")
    spread = periods.withColumn("_next", F.lead("_period").over(timeline)).select(
        "*", F.posexplode(_labels_until(F.col("_period"), F.col("_next"), freq)).alias("_gap", "_label")
    )
    columns = {}
    for _, how, name in planned:
        empty = F.lit(0).cast(periods.schema[name].dataType) if how in ZERO_WHEN_EMPTY else F.lit(None)
        columns[name] = F.when(F.col("_gap") == 0, ref(name)).otherwise(empty)
    result = spread.select(F.col("_label").alias(date_column), *[c.alias(n) for n, c in columns.items()])
    if fill_method:
        label = ref(date_column)
        line = W.orderBy(label.asc() if fill_method == "ffill" else label.desc()).rowsBetween(W.unboundedPreceding, 0)
        result = result.withColumns({n: F.last(ref(n), ignorenulls=True).over(line) for n in columns})
    return result.orderBy(ref(date_column))


def percent_change(column: str, order: str) -> Column:
    """Change against the previous row in percent; from zero it is infinite, and 0 to 0 is NULL."""
    current = ref(column).cast("double")
    previous = F.lag(current).over(W.orderBy(ref(order)))
    return (
        F.when(previous != 0, (current / previous - 1) * 100)
        .when((previous == 0) & (current > 0), F.lit(float("inf")))
        .when((previous == 0) & (current < 0), F.lit(float("-inf")))
    )


def moving_average(column: str, order: str, size: int = 3) -> Column:
    """Mean over the last ``size`` rows, NULL until that many values are present."""
    frame = W.orderBy(ref(order)).rowsBetween(1 - size, 0)
    return F.when(F.count(ref(column)).over(frame) == size, F.avg(ref(column)).over(frame))


def calculate_trend_analysis(df: DataFrame, date_column: str, period: str = "M") -> DataFrame:
    """Revenue, quantity and transactions per period, their changes in percent and a three-period mean."""
    trend = resample_timeseries(
        with_revenue(df), date_column, period, {"revenue": "sum", "quantite": "sum", "produit": "count"}
    ).toDF(date_column, "ca_total", "quantite_totale", "nb_transactions")
    return trend.withColumns({
        "ca_variation_pct": percent_change("ca_total", date_column),
        "quantite_variation_pct": percent_change("quantite_totale", date_column),
        "ca_ma3": moving_average("ca_total", date_column),
    }).orderBy(ref(date_column))


def first_purchase(df: DataFrame, date_column: str, customer_column: str) -> DataFrame:
    """Each customer's first date, one row per customer."""
    moment = as_timestamp(df, date_column)
    return df.filter(ref(customer_column).isNotNull()).groupBy(ref(customer_column)).agg(F.min(moment).alias("first_date"))


def calculate_cohort_analysis(df: DataFrame, date_column: str, customer_column: str) -> DataFrame:
    """Distinct customers and revenue per first-purchase month and age in months.

    Rows collapse to one per customer and month first. The window that finds a customer's first month
    then sees at most one row per month of the calendar, however many purchases the customer made, and
    counting those rows counts distinct customers.
    """
    month = F.trunc(as_timestamp(df, date_column), "MM")
    monthly = (
        df.select(ref(customer_column).alias("_customer"), month.alias("_month"), F.col("revenue"))
        .dropna(subset=["_customer", "_month"])
        .groupBy("_customer", "_month")
        .agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"))
    )
    dated = monthly.withColumn("cohort", F.min("_month").over(W.partitionBy("_customer")))
    age = (F.year("_month") - F.year("cohort")) * 12 + F.month("_month") - F.month("cohort")
    return (
        dated.groupBy("cohort", age.alias("cohort_age"))
        .agg(F.count(F.lit(1)).alias(customer_column), F.sum("revenue").alias("revenue"))
        .orderBy("cohort", "cohort_age")
    )
