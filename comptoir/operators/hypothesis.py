"""Tests and intervals. Each is one lazy row: distributed sums, then scalar maths on what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions import pvalues
from comptoir.functions.columns import ref
from comptoir.operators.aggregate import cross_tab_counts
from comptoir.operators.order import distinct_estimates, fits_one_sort, value_ranks

ALPHA = 0.05
_SCORES_PER_ROW = 50_000  # ranks that one row of the Shapiro sum is spread out to at once


def t_test_independent(df: DataFrame, column: str, group_column: str, group1, group2) -> DataFrame:
    """Student's t with pooled variance: ``statistic, dof, p_value, significant``."""
    value = ref(column).cast("double")
    first, second = F.when(ref(group_column) == group1, value), F.when(ref(group_column) == group2, value)
    sums = df.filter(ref(group_column).isin(group1, group2)).agg(*[
        f(c).alias(f"{name}{i}")
        for i, c in ((1, first), (2, second)) for name, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))
    ])
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    dof = n1 + n2 - 2
    pooled = F.try_divide((n1 - 1) * F.coalesce("v1", F.lit(0.0)) + (n2 - 1) * F.coalesce("v2", F.lit(0.0)), dof)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    scored = sums.select(F.try_divide(F.col("m1") - F.col("m2"), error).alias("statistic"), dof.alias("dof"))
    return scored.withColumn("p_value", pvalues.student_p("statistic", "dof")).withColumn(
        "significant", F.col("p_value") < ALPHA
    )


def chi2_test(df: DataFrame, col1: str, col2: str) -> DataFrame:
    """Chi-square test of independence, with Yates' correction for a 2 x 2 table: ``statistic, dof, p_value, significant``.

    The statistic needs only the non-empty cells: n (sum of O^2 / (R C) - 1). For two by two the
    correction is the same for all four cells, which differ from their expectation by the same amount.
    """
    cells = cross_tab_counts(df.select(ref(col1).alias("a"), ref(col2).alias("b")), "a", "b")
    across = cells.groupBy("a").agg(F.sum("n").alias("row_total"))
    down = cells.groupBy("b").agg(F.sum("n").alias("column_total"))
    full = cells.join(across, "a").join(down, "b").select(
        "n", *[F.col(c).cast("double").alias(c) for c in ("row_total", "column_total")]
    )
    total = cells.agg(F.sum("n").cast("double")).scalar()
    sizes = F.array(across.agg(F.count(F.lit(1))).scalar(), down.agg(F.count(F.lit(1))).scalar())
    expected = F.col("row_total") * F.col("column_total") / total
    sums = full.agg(
        (total * (F.sum(F.col("n") * F.col("n") / (F.col("row_total") * F.col("column_total"))) - 1)).alias("plain"),
        F.max(F.abs(F.col("n") - expected)).alias("gap"),
    ).select(
        "*", sizes.alias("sizes"), total.alias("total"),
    )
    dof = ((F.col("sizes")[0] - 1) * (F.col("sizes")[1] - 1)).cast("double")
    # chi2 is gap^2 times the sum of 1 / expected; correcting the gap scales it accordingly.
    corrected = F.greatest(F.lit(0.0), F.col("gap") - F.least(F.lit(0.5), F.col("gap")))
    yates = F.coalesce(F.col("plain") * F.try_divide(corrected * corrected, F.col("gap") * F.col("gap")), F.lit(0.0))
    statistic = F.when(dof == 0, F.lit(0.0)).when(dof == 1, yates).otherwise(F.greatest(F.lit(0.0), F.col("plain")))
    scored = sums.select(statistic.alias("statistic"), dof.alias("dof"))
    return scored.withColumn("p_value", pvalues.chi2_p("statistic", "dof")).withColumn(
        "significant", F.col("p_value") < ALPHA
    )


def confidence_interval(df: DataFrame, column: str, confidence: float = 0.95) -> DataFrame:
    """Mean with its two-sided Student interval: ``mean, lower, upper``."""
    value = ref(column).cast("double")
    sums = df.agg(F.count(value).cast("double").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("s"))
    quantile = pvalues.student_ppf(F.lit((1 + confidence) / 2), F.col("n") - 1)
    margin = quantile * F.col("s") / F.sqrt("n")
    return sums.select("mean", (F.col("mean") - margin).alias("lower"), (F.col("mean") + margin).alias("upper"))


def _ranks(df: DataFrame, column: str) -> DataFrame:
    values = df.select(ref(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    return value_ranks(values, "x", small=fits_one_sort(distinct_estimates(values, ["x"])["x"]))


def kolmogorov_smirnov(df: DataFrame, column: str) -> DataFrame:
    """Largest distance to the standard normal distribution; the values are not standardised first."""
    ranks = _ranks(df, column)
    total = df.agg(F.count(ref(column)).cast("double")).scalar()
    placed = ranks.withColumn("p", pvalues.normal_cdf("x"))
    gap = F.greatest((F.col("before") + F.col("n")) / total - F.col("p"), F.col("p") - F.col("before") / total)
    scored = placed.agg(F.max(gap).alias("statistic"), F.sum("n").cast("double").alias("n"))
    return scored.select("statistic", pvalues.kolmogorov_p("statistic", "n").alias("p_value")).withColumn(
        "is_normal", F.col("p_value") > ALPHA
    )


def shapiro_wilk(df: DataFrame, column: str) -> DataFrame:
    """W test: ``statistic, p_value, is_normal``; NULL below three values.

    Each distinct value covers a run of ranks. Long runs are split before they are spread out to ranks, whose normal scores
    are plain arithmetic inside the aggregate.
    """
    ranks = _ranks(df, column)
    value = ref(column).cast("double")
    totals = df.agg(F.struct(
        F.count(value).cast("double").alias("n"), F.var_pop(value).alias("variance"), F.avg(value).alias("mean"),
    )).scalar()
    first = F.sequence(F.col("before") + 1, F.col("before") + F.col("n"), F.lit(_SCORES_PER_ROW).cast("bigint"))
    last = F.least(F.col("first") + _SCORES_PER_ROW - 1, F.col("before") + F.col("n"))
    scored = (
        ranks.withColumn("first", F.explode(first)).select("x", F.explode(F.sequence("first", last)).alias("rank"))
        .select("x", "rank", totals.getField("n").alias("total"), totals.getField("mean").alias("mean"))
        .withColumn("score", pvalues.normal_quantile((F.col("rank") - 0.375) / (F.col("total") + 0.25)))
    )
    ends = {"lowest": F.min("x"), "low": F.min(F.when(F.col("rank") == 2, F.col("x"))),
            "high": F.max(F.when(F.col("rank") == F.col("total") - 1, F.col("x"))), "highest": F.max("x")}
    one = scored.agg(
        F.max("total").alias("n"),
        F.sum((F.col("x") - F.col("mean")) * F.col("score")).alias("score_sum"),
        F.sum(F.col("score") * F.col("score")).alias("squares"),
        *[e.alias(name) for name, e in ends.items()],
    ).withColumn("spread", totals.getField("variance") * F.col("n")).filter(F.col("n") >= 3)
    statistic = pvalues.shapiro_w("n", "score_sum", "squares", "spread", "lowest", "low", "high", "highest")
    scored = one.select(statistic.alias("statistic"), "n")
    return scored.select("statistic", pvalues.shapiro_p("statistic", "n").alias("p_value")).withColumn(
        "is_normal", F.col("p_value") > ALPHA
    )


def test_normality(df: DataFrame, column: str, method: str = "shapiro") -> DataFrame:
    if method == "shapiro":
        return shapiro_wilk(df, column)
    if method == "kstest":
        return kolmogorov_smirnov(df, column)
    raise ValueError(f"unknown method: {method}")


test_normality.__test__ = False  # not a test case
