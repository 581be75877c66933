import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comptoir.operators import order, quantiles


def skewed(n=3000, seed=3):
    """A third of the rows share one key, and a third of the values are equal."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 1 / 3, "hot", rng.choice(list("abcdef"), n))
    value = np.where(rng.random(n) < 1 / 3, 50.0, np.round(rng.normal(50, 20, n), 1))
    return pd.DataFrame({"id": np.arange(n), "key": key, "value": value})


def test_ranks_equal_pandas(spark, scale):
    data = skewed()
    ranks = order.value_ranks(spark.createDataFrame(data), "value", small=scale == "small").toPandas()
    expected = data["value"].rank()
    got = data["value"].map(ranks.set_index("value").eval("before + (n + 1) / 2"))
    assert (got == expected).all()
    dense = data["value"].map(ranks.set_index("value")["code"])
    assert (dense == data["value"].rank(method="dense") - 1).all()


def test_ranks_within_keys(spark, scale):
    data = skewed()
    ranks = order.value_ranks(spark.createDataFrame(data), "value", ["key"], small=scale == "small").toPandas()
    merged = data.merge(ranks, on=["key", "value"])
    merged["expected"] = merged.groupby("key")["value"].rank()
    assert (merged["before"] + (merged["n"] + 1) / 2 == merged["expected"]).all()


@pytest.mark.parametrize("ranges", [1, 8])
@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_fill_equals_pandas(spark, backward, keys, ranges):
    data = skewed(800)
    rng = np.random.default_rng(4)
    data["value"] = data["value"].where(rng.random(len(data)) < 0.03)
    data["other"] = data["value"].where(rng.random(len(data)) < 0.5)
    rows = spark.createDataFrame(data).withColumns({c: F.nanvl(c, F.lit(None)) for c in ("value", "other")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        filled = order.fill_along_order(rows.orderBy(F.rand(1)), ["value", "other"], "id", keys, backward).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    filled = filled.sort_values("id").reset_index(drop=True)
    columns = data.groupby("key")[["value", "other"]] if keys else data[["value", "other"]]
    expected = columns.bfill() if backward else columns.ffill()
    pd.testing.assert_frame_equal(filled[["value", "other"]], expected)


def test_fill_leaves_an_empty_column(spark):
    rows = spark.createDataFrame([(1, None), (2, None)], "id int, value double")
    assert [r.value for r in order.fill_along_order(rows, "value", "id").collect()] == [None, None]


@pytest.mark.parametrize("shape", ["continuous", "hot", "two values", "one row", "integers", "infinite"])
def test_quantiles_equal_numpy(spark, scale, shape):
    rng = np.random.default_rng(5)
    values = {
        "continuous": rng.lognormal(0, 3, 4000),
        "hot": np.where(rng.random(4000) < 0.4, 7.0, rng.normal(7, 1e-3, 4000)),
        "two values": np.repeat([1.0, 2.0], [1500, 1501]),
        "one row": np.array([4.0]),
        "integers": rng.integers(-1000, 1000, 4000),
        "infinite": np.r_[-np.inf, rng.normal(0, 1, 3000), np.inf],
    }[shape]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0] if shape != "infinite" else [0.1, 0.5, 0.9]
    df = spark.createDataFrame(pd.DataFrame({"v": values})).unionByName(spark.range(50).select(F.lit(None).cast("double").alias("v")))
    got = quantiles.exact_quantiles(df, {"v": probabilities})["v"]
    np.testing.assert_allclose(got, np.quantile(values, probabilities), rtol=1e-12)


def test_quantiles_of_several_columns_at_once(spark, scale):
    rng = np.random.default_rng(6)
    data = pd.DataFrame({"a": rng.normal(0, 1, 2000), "b": rng.integers(0, 3, 2000), "c c.": rng.exponential(2, 2000)})
    got = quantiles.exact_quantiles(spark.createDataFrame(data), {c: [0.25, 0.75] for c in data})
    for column in data:
        np.testing.assert_allclose(got[column], np.quantile(data[column], [0.25, 0.75]), rtol=1e-12)


def test_quantiles_per_group(spark, scale):
    data = skewed()
    got = quantiles.group_quantiles(spark.createDataFrame(data), ["key"], "value", [0.25, 0.5, 0.9]).toPandas()
    for key, q in zip(got["key"], got["q"]):
        np.testing.assert_allclose(q, np.quantile(data.loc[data["key"] == key, "value"], [0.25, 0.5, 0.9]), rtol=1e-12)
    assert len(got) == data["key"].nunique()


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(df, {"v": [0.5]}) == {"v": [None]}


@pytest.mark.parametrize("backward", [False, True])
def test_fill_shuffles_rows_once_and_crosses_ranges(spark, backward):
    rng = np.random.default_rng(6)
    n = 900
    data = pd.DataFrame({
        "k": np.sort(rng.choice(["a", "b", "c", "d"], n, p=[0.7, 0.1, 0.1, 0.1])), "i": range(n), "v": np.where(rng.random(n) < 0.02, rng.normal(size=n), np.nan),
        "t": np.where(rng.random(n) < 0.5, "x", None), "d": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 99, n), unit="D")})
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "k string, i int, v double, t string, d timestamp").repartition(5)
    for keys in ([], ["k"]):
        filled = order.fill_along_order(df, ["v", "t"], "i", keys, backward)
        assert "Exchange" not in filled._jdf.queryExecution().executedPlan().toString()  # rows lie in their ranges already
        assert filled.columns == df.columns
        got = filled.orderBy("i").toPandas()
        groups = data.groupby("k") if keys else data
        want = groups[["v", "t"]].bfill() if backward else groups[["v", "t"]].ffill()
        np.testing.assert_array_equal(got["v"].to_numpy(float), want["v"].to_numpy(float))
        assert [x if isinstance(x, str) else None for x in got["t"]] == [x if isinstance(x, str) else None for x in want["t"]]
        assert (got["d"].to_numpy() == data["d"].to_numpy()).all()
    assert order.fill_along_order(df.limit(0), "v", "i", "k", backward).count() == 0
