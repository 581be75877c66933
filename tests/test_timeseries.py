import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comptoir.operators import timeseries as ts


@pytest.fixture
def events(spark):
    rng = np.random.default_rng(8)
    days = pd.to_datetime("2024-01-31") + pd.to_timedelta(np.sort(rng.integers(0, 900, 60)), unit="D")
    data = pd.DataFrame({"date": days, "v": np.round(rng.normal(10, 3, 60), 2), "w": rng.integers(0, 5, 60)})
    return spark.createDataFrame(data), data


@pytest.mark.parametrize("freq", ["D", "W", "M", "Q", "Y"])
@pytest.mark.parametrize("fill", [None, "ffill", "bfill"])
def test_resample_equals_pandas(events, freq, fill):
    df, data = events
    ours = ts.resample_timeseries(df, "date", freq, {"v": "mean", "w": "sum"}, fill).toPandas()
    modern = {"M": "ME", "Q": "QE", "Y": "YE"}.get(freq, freq)
    theirs = data.set_index("date").resample(modern).agg({"v": "mean", "w": "sum"})
    theirs = getattr(theirs, fill)() if fill else theirs
    assert [pd.Timestamp(d) for d in ours["date"]] == list(theirs.index)
    np.testing.assert_allclose(ours["v"].astype(float), theirs["v"])
    np.testing.assert_array_equal(ours["w"], theirs["w"])


def test_other_spellings_and_text_dates(spark):
    df = spark.createDataFrame([("2024-02-10", 1), ("2024-04-01", 2), (None, 4)], "d string, v int")
    got = [tuple(r) for r in ts.resample_timeseries(df, "d", "ME", {"v": "sum"}).selectExpr("cast(d AS string)", "v").collect()]
    assert got == [("2024-02-29", 1), ("2024-03-31", 0), ("2024-04-30", 2)]
    with pytest.raises(ValueError):
        ts.resample_timeseries(df, "d", "H", {"v": "sum"})


def test_resample_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "d date, v int")
    assert ts.resample_timeseries(df, "d", "M", {"v": "sum"}).count() == 0


def test_trend_changes(spark):
    data = [("2024-01-05", "p", 2.0, 5), ("2024-03-05", "p", 3.0, 5), ("2024-06-01", "p", 1.0, 1)]
    df = spark.createDataFrame(data, "date string, produit string, prix double, quantite int")
    got = ts.calculate_trend_analysis(df, "date").collect()
    assert [r.ca_total for r in got] == [10.0, 0.0, 15.0, 0.0, 0.0, 1.0]
    assert [r.ca_variation_pct for r in got] == [None, -100.0, float("inf"), -100.0, None, float("inf")]
    assert [r.ca_ma3 and round(r.ca_ma3, 4) for r in got] == [None, None, 8.3333, 5.0, 5.0, 0.3333]
    assert [r.nb_transactions for r in got] == [1, 0, 1, 0, 0, 1]


def test_cohorts(spark):
    data = [
        (1, "2024-12-30", 5.0), (1, "2025-01-02", 7.0), (1, "2025-01-20", 1.0), (2, "2025-01-01", 2.0),
        (2, "2025-03-01", 3.0), (None, "2025-01-01", 9.0), (3, None, 9.0),
    ]
    df = spark.createDataFrame(data, "client int, date string, revenue double")
    got = [(str(r.cohort), r.cohort_age, r.client, r.revenue) for r in ts.calculate_cohort_analysis(df, "date", "client").collect()]
    assert got == [("2024-12-01", 0, 1, 5.0), ("2024-12-01", 1, 1, 8.0), ("2025-01-01", 0, 1, 2.0), ("2025-01-01", 2, 1, 3.0)]
    with pytest.raises(Exception):
        ts.calculate_cohort_analysis(df.drop("revenue"), "date", "client").collect()


def test_first_purchase(spark):
    df = spark.createDataFrame([(1, "2024-12-30"), (1, "2024-02-01"), (None, "2020-01-01")], "client int, date string")
    assert [(r.client, str(r.first_date)[:10]) for r in ts.first_purchase(df, "date", "client").collect()] == [(1, "2024-02-01")]
