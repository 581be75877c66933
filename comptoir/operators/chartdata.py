"""The series behind each chart. Drawing them is left to the caller's plotting tool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.columns import as_list, ref
from comptoir.operators.aggregate import bar_aggregate, top_rows, with_share
from comptoir.operators.correlation import correlation_matrix
from comptoir.operators.order import broadcastable
from comptoir.operators.outliers import fences
from comptoir.operators.quantiles import group_quantiles

KDE_POINTS = 100


def bar(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Bars as they are: ``x, y`` and the colour column. Use :func:`bar_totals` to sum raw rows first."""
    return df.select(*[ref(c) for c in dict.fromkeys([x, y, *as_list(color)])])


def bar_totals(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Sum of ``y`` per text ``x`` (and colour)."""
    if color is None or color == x:
        return bar_aggregate(df, x, y)
    keys = [ref(x), ref(color)]
    return df.dropna(subset=[x, color]).groupBy(*keys).agg(F.coalesce(F.sum(ref(y)), F.lit(0)).alias(y)).orderBy(*keys)


def line(df: DataFrame, x: str, y: str | Sequence[str]) -> DataFrame:
    """Points in ``x`` order; several ``y`` columns become ``x, series, value``."""
    names = as_list(y)
    if isinstance(y, str):
        return df.select(ref(x), ref(y)).orderBy(ref(x))
    values = df.select(ref(x), *[ref(c).cast("double").alias(c) for c in names])
    return values.unpivot([ref(x)], [ref(c) for c in names], "series", "value").orderBy(ref(x), "series")


def pie(df: DataFrame, names: str, values: str, top: int | None = None) -> DataFrame:
    """Slices with their share in percent. Rows of the same name are one slice; ``top`` keeps the largest."""
    slices = df.groupBy(ref(names)).agg(F.coalesce(F.sum(ref(values)), F.lit(0)).alias(values))
    if top is not None:
        slices = top_rows(slices, values, names, top)
    return with_share(slices, values, "share")


def scatter(df: DataFrame, x: str, y: str, color: str | None = None, size: str | None = None) -> DataFrame:
    """All points with their colour and size columns."""
    return df.select(*[ref(c) for c in dict.fromkeys([x, y, *as_list(color), *as_list(size)])])


def trend_line(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Least-squares ``slope, intercept`` (per colour); NULL where ``x`` does not vary."""
    complete = df.filter(ref(x).isNotNull() & ref(y).isNotNull())
    xs, ys = ref(x).cast("double"), ref(y).cast("double")
    slope = F.try_divide(F.covar_pop(ys, xs), F.var_pop(xs))
    return complete.groupBy(*[ref(c) for c in as_list(color)]).agg(
        slope.alias("slope"), (F.avg(ys) - slope * F.avg(xs)).alias("intercept")
    )


def heatmap(df: DataFrame, method: str = "pearson", columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation cells ``row, column, value``."""
    return correlation_matrix(df, method, columns).toDF("row", "column", "value")


def matrix_cells(table: DataFrame, index: str) -> DataFrame:
    """Any wide table with an index column as cells ``row, column, value``."""
    names = [c for c in table.columns if c != index]
    values = table.select(ref(index).cast("string").alias("row"), *[ref(c).cast("double").alias(c) for c in names])
    return values.unpivot(["row"], [ref(c) for c in names], "column", "value")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed: ``bin, low, high, count``, empty bins included.

    A constant column gets one unit of width around its value.
    """
    value = ref(column).cast("double")
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    flat = ends.getField("low") == ends.getField("high")
    low = F.when(flat, ends.getField("low") - 0.5).otherwise(ends.getField("low"))
    high = F.when(flat, ends.getField("high") + 0.5).otherwise(ends.getField("high"))
    placed = df.filter(value.isNotNull()).select(
        F.least(F.width_bucket(value, low, high, F.lit(bins)), F.lit(bins).cast("bigint")).cast("int").alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    width = (high - low) / bins
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin", (low + (F.col("bin") - 1) * width).alias("low"), (low + F.col("bin") * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    ).orderBy("bin")


def density(df: DataFrame, column: str, points: int = KDE_POINTS) -> DataFrame:
    """Gaussian kernel density at evenly spaced points between min and max: ``x, density``.

    The bandwidth is the sample deviation times n^(-1/5). Equal values are counted first; each distinct
    value then adds its kernel to the fixed grid, and the sums combine before the shuffle.
    """
    value = ref(column).cast("double")
    stats = df.agg(F.struct(
        F.count(value).cast("double").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.stddev_samp(value).alias("s"),
    )).scalar()
    counts = df.filter(value.isNotNull()).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("c"))

    def step(s: Column) -> Column:
        return (s.getField("high") - s.getField("low")) / (points - 1)

    def bandwidth(s: Column) -> Column:
        return s.getField("s") * F.pow(s.getField("n"), F.lit(-0.2))

    # In units of the bandwidth, from the value to the first grid point and from one point to the next.
    placed = counts.withColumn("s", stats).select(
        "c", F.try_divide(F.col("s.low") - F.col("v"), bandwidth(F.col("s"))).alias("first"),
        F.try_divide(step(F.col("s")), bandwidth(F.col("s"))).alias("step"),
    )
    kernels = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    z = F.col("first") + F.col("i") * F.col("step")
    sums = kernels.groupBy("i").agg(F.sum(F.col("c") * F.exp(-z * z / 2)).alias("sum"))
    scale = stats.getField("n") * bandwidth(stats) * F.sqrt(F.lit(2.0) * F.pi())
    return sums.select(
        (stats.getField("low") + F.col("i") * step(stats)).alias("x"),
        F.try_divide(F.col("sum"), scale).alias("density"),
    ).orderBy("x")


def box(df: DataFrame, y: str, x: str | None = None) -> DataFrame:
    """Per category (one row without): ``q1, median, q3``, whisker ends and the number of points beyond them.

    Whiskers reach the last value within 1.5 IQR of the box, and never into it.
    """
    key = x or "_all"
    rows = df if x else df.withColumn("_all", F.lit("all"))
    rows = rows.filter(ref(y).isNotNull() & ref(key).isNotNull()).select(ref(key).alias(key), ref(y).cast("double").alias(y))
    joined, low, high = _with_fences(rows, key, y)
    inside = ref(y).between(low, high)
    result = joined.groupBy(ref(key), "q").agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.when(inside, ref(y))).alias("low"), F.max(F.when(inside, ref(y))).alias("high"),
        F.count_if(~inside).alias("outliers"),
    ).select(
        ref(key), "count", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
        F.least("low", F.col("q")[0]).alias("whisker_low"), F.greatest("high", F.col("q")[2]).alias("whisker_high"),
        "outliers",
    ).orderBy(ref(key))
    return result if x else result.drop("_all")


def box_outliers(df: DataFrame, y: str, x: str | None = None) -> DataFrame:
    """The points beyond the fences of their category."""
    key = x or "_all"
    rows = df if x else df.withColumn("_all", F.lit("all"))
    joined, low, high = _with_fences(rows.filter(ref(y).isNotNull() & ref(key).isNotNull()), key, y)
    return joined.filter(~ref(y).between(low, high)).select(*([ref(x)] if x else []), ref(y))


def _with_fences(rows: DataFrame, key: str, y: str) -> tuple[DataFrame, Column, Column]:
    """Attach each row's quartiles. One row per category, broadcast after a check of their size."""
    quartiles = group_quantiles(rows, [key], y, [0.25, 0.5, 0.75])
    if broadcastable(rows, key):
        quartiles = F.broadcast(quartiles)
    low, high = fences(F.col("q")[0], F.col("q")[2])
    return rows.join(quartiles, key), low, high


def dashboard(charts: Sequence[dict]) -> dict[str, DataFrame]:
    """Series of several charts by title. Only bars are laid out; a chart of another type has no series."""
    series = {}
    for i, chart in enumerate(charts):
        if chart.get("type", "bar") == "bar":
            series[chart.get("title", f"Chart {i + 1}")] = bar(chart["data"], chart["x"], chart["y"])
    return series
