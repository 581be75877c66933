import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comptoir.operators import chartdata


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(31)
    return pd.DataFrame({"g": rng.choice(["a", "b", "c"], 900, p=[0.6, 0.3, 0.1]), "v": np.round(rng.lognormal(1, 1, 900), 2)})


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_equals_numpy(spark, data, bins):
    got = chartdata.histogram(spark.createDataFrame(data), "v", bins).toPandas()
    counts, edges = np.histogram(data["v"], bins)
    assert list(got["count"]) == list(counts)
    np.testing.assert_allclose(got["low"], edges[:-1])
    np.testing.assert_allclose(got["high"], edges[1:])


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    got = chartdata.histogram(df, "v", 4).toPandas()
    counts, edges = np.histogram([3.0, 3.0], 4)
    assert list(got["count"]) == list(counts) and list(got["low"]) == list(edges[:-1])


def test_density(spark, data):
    got = chartdata.density(spark.createDataFrame(data), "v", 20).toPandas()
    v = data["v"].to_numpy()
    grid = np.linspace(v.min(), v.max(), 20)
    h = v.std(ddof=1) * len(v) ** -0.2
    expected = [np.exp(-(((x - v) / h) ** 2) / 2).sum() / (len(v) * h * np.sqrt(2 * np.pi)) for x in grid]
    np.testing.assert_allclose(got["x"], grid)
    np.testing.assert_allclose(got["density"], expected, rtol=1e-9)


def test_box(spark, data, scale):
    got = chartdata.box(spark.createDataFrame(data), "v", "g").toPandas().set_index("g")
    points = chartdata.box_outliers(spark.createDataFrame(data), "v", "g").toPandas()
    for g, v in data.groupby("g")["v"]:
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        np.testing.assert_allclose(got.loc[g, ["q1", "median", "q3", "whisker_low", "whisker_high"]].to_numpy(float),
                                   [q1, q2, q3, inside.min(), inside.max()])
        assert got.loc[g, "outliers"] == len(v) - len(inside) == (points["g"] == g).sum()
    assert chartdata.box(spark.createDataFrame(data), "v").columns[0] == "count"


def test_series(spark):
    df = spark.createDataFrame([("x", 1.0, 2), ("y", 3.0, 4), ("x", 5.0, 6), (None, 2.0, 8)], "k string, v double, i int")
    assert [tuple(r) for r in chartdata.bar_totals(df, "k", "v").collect()] == [("x", 6.0), ("y", 3.0)]
    assert chartdata.bar(df, "k", "v", "i").columns == ["k", "v", "i"]
    assert [tuple(r) for r in chartdata.line(df, "i", "v").collect()][0] == (2, 1.0)
    assert chartdata.line(df, "k", ["v", "i"]).count() == 8
    pie = {r.k: r.share for r in chartdata.pie(df.dropna(), "k", "v").collect()}
    assert pie == {"x": 66.67, "y": 33.33}
    assert [r.k for r in chartdata.pie(df.dropna(), "k", "v", top=1).collect()] == ["x"]
    assert chartdata.scatter(df, "i", "v", color="k").count() == 4
    slope, intercept = np.polyfit([2, 4, 6, 8], [1, 3, 5, 2], 1)
    line = chartdata.trend_line(df, "i", "v").first()
    np.testing.assert_allclose([line.slope, line.intercept], [slope, intercept])
    assert chartdata.trend_line(df.withColumn("i", F.lit(1)), "i", "v").first().slope is None
    assert chartdata.matrix_cells(df.select("k", "v"), "k").columns == ["row", "column", "value"]
    board = chartdata.dashboard([{"data": df, "x": "k", "y": "v"}, {"type": "line", "data": df}])
    assert list(board) == ["Chart 1"]
