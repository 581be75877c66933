import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comptoir.operators import clean, encode, impute, neighbours, outliers, scale as scaling
from comptoir.operators.impute import Strategy
from comptoir.sources.errors import MissingPathError


def column(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]


def test_white_space(spark):
    texts = ["  a  b ", "\t x \n y\x1c", "", "   ", None, "é　è"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    expected = pd.Series(texts).str.strip().str.replace(r"\s+", " ", regex=True)
    assert column(clean.clean_string_columns(df), "t") == [None if pd.isna(e) else e for e in expected]
    assert clean.clean_string_columns(df, ["absent"]).columns == ["id", "t"]


def test_dates(spark):
    texts = ["2025-01-31", "31/01/2025", "2025-01-31 10:20:30", "31.01.2025", "20250131", "2025-02-30", "hier", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, d string")
    got = [d and str(d) for d in column(clean.convert_dates(df, ["d", "absent"]), "d")]
    assert got == ["2025-01-31 00:00:00"] * 2 + ["2025-01-31 10:20:30"] + ["2025-01-31 00:00:00"] * 2 + [None] * 3
    strict = [d and str(d)[:10] for d in column(clean.convert_dates(df, "d", "%d/%m/%Y"), "d")]
    assert strict == [None, "2025-01-31"] + [None] * 6
    assert clean.java_pattern("%Yy%m %H:%M") == "yyyy'y'M H:m"
    assert clean.java_pattern("%Y%m%d") == "yyyyMMdd"
    with pytest.raises(ValueError):
        clean.java_pattern("%Q")


@pytest.fixture
def gaps(spark):
    rows = [(1, 1.0, 10, "b"), (2, None, 20, "a"), (3, 2.0, None, None), (4, 4.0, 20, "b"), (5, 5.0, 10, "a"), (6, None, 40, None)]
    return spark.createDataFrame(rows, "id int, x double, n int, s string")


def test_impute_strategies(gaps, scale):
    mean = impute.impute_missing_values(gaps, "mean")
    assert column(mean, "x") == [1.0, 3.0, 2.0, 4.0, 5.0, 3.0] and column(mean, "n")[2] == 20.0
    assert column(mean, "s") == ["b", "a", "a", "b", "a", "a"]  # ties: the smaller text
    median = impute.impute_missing_values(gaps, Strategy.MEDIAN)
    assert column(median, "x")[1] == 3.0 and column(median, "n")[2] == 20.0
    mode = impute.impute_missing_values(gaps, "most_frequent")
    assert column(mode, "x")[1] == 1.0 and column(mode, "n")[2] == 10  # ties: the smaller number
    constant = impute.impute_missing_values(gaps, "constant")
    assert column(constant, "x")[1] == 0.0 and column(constant, "n")[2] == 0
    only = impute.impute_missing_values(gaps, "mean", ["x"])
    assert column(only, "n")[2] is None and column(only, "s")[2] is None
    assert dict(mode.dtypes)["n"] == "int" and dict(gaps.dtypes)["id"] == dict(mean.dtypes)["id"]


def test_impute_by_order(gaps):
    with pytest.raises(ValueError):
        impute.impute_missing_values(gaps, "ffill")
    forward = impute.impute_missing_values(gaps, "ffill", order_by="id")
    assert column(forward, "x") == [1.0, 1.0, 2.0, 4.0, 5.0, 5.0] and column(forward, "s")[2] == "a"
    backward = impute.impute_missing_values(gaps, "bfill", order_by="id")
    assert column(backward, "x") == [1.0, 2.0, 2.0, 4.0, 5.0, None]


def test_all_null_column_stays(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    for strategy in ("mean", "median", "most_frequent"):
        assert column(impute.impute_missing_values(df, strategy), "x") == [None, None]


def brute_knn(data, k=5):
    """Nan-Euclidean neighbours by comparing every pair."""
    values = data.to_numpy(float)
    filled = values.copy()
    width = values.shape[1]
    for i, row in enumerate(values):
        for j in np.flatnonzero(np.isnan(row)):
            candidates = []
            for other in values:
                both = ~np.isnan(row) & ~np.isnan(other)
                if not np.isnan(other[j]) and both.any():
                    candidates.append((width / both.sum() * sum((row[both] - other[both]) ** 2), other[j]))
            nearest = sorted(candidates)[:k]
            filled[i, j] = np.mean([v for _, v in nearest]) if nearest else np.nanmean(values[:, j])
    return filled


@pytest.mark.parametrize("tight", [False, True])
def test_knn_equals_brute_force(spark, monkeypatch, tight):
    if tight:
        monkeypatch.setattr(neighbours, "_MIN_SAMPLE", 40)
        monkeypatch.setattr(neighbours, "_MAX_SAMPLE", 60)
        monkeypatch.setattr(neighbours, "_SAMPLED_PER_BOX", 4)
        monkeypatch.setattr(neighbours, "_BLOCK", 7)
        monkeypatch.setattr(neighbours, "_DONORS", 9)
        monkeypatch.setattr(neighbours, "_PER_COLUMN", 6)
        monkeypatch.setattr(neighbours, "_MATRIX", 500)
    rng = np.random.default_rng(11)
    n = 240
    data = pd.DataFrame({
        "a": np.where(rng.random(n) < 1 / 3, 3.0, np.round(rng.normal(0, 5, n), 1)),
        "b": np.round(rng.normal(10, 2, n), 2), "c": rng.integers(0, 6, n).astype(float),
    })
    data = data.mask(rng.random(data.shape) < 0.25)
    data.loc[:5, :] = np.nan
    df = spark.createDataFrame(data.assign(id=range(n)))
    df = df.withColumns({c: F.nanvl(c, F.lit(None)) for c in "abc"})
    got = impute.impute_missing_values(df.repartition(8), "knn").orderBy("id").toPandas()
    np.testing.assert_allclose(got[["a", "b", "c"]].to_numpy(float), brute_knn(data), rtol=1e-9)


def test_knn_of_a_column_with_few_values_visits_few_boxes(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(neighbours, "_MIN_SAMPLE", 400)
    sizes, checkpoint = [], DataFrame.checkpoint

    def counted(self, *args, **kwargs):
        done = checkpoint(self, *args, **kwargs)
        sizes.append((done.columns, done.count(), done.select("box").distinct().count() if "box" in done.columns else 0))
        return done

    monkeypatch.setattr(DataFrame, "checkpoint", counted)
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"a": rng.normal(size=2000), "b": rng.normal(size=2000), "c": np.nan})
    data.loc[[3, 500, 900, 1200, 1999], "c"] = [1.0, 2.0, 3.0, 4.0, 50.0]
    df = spark.createDataFrame(data.assign(id=range(2000)))
    df = df.withColumns({c: F.nanvl(c, F.lit(None)) for c in "abc"})
    donors = data[data["c"].notna()]
    for k in (3, 8):
        got = neighbours.knn_impute(df.repartition(8), ["a", "b", "c"], k).orderBy("id").toPandas()
        distance = (data["a"].to_numpy()[:, None] - donors["a"].to_numpy()) ** 2 + (data["b"].to_numpy()[:, None] - donors["b"].to_numpy()) ** 2
        nearest = donors["c"].to_numpy()[np.argsort(distance, axis=1)[:, :k]].mean(axis=1)
        np.testing.assert_allclose(got["c"].to_numpy(float), data["c"].fillna(pd.Series(nearest)), rtol=1e-9)
        columns, rows, boxes = sizes[-1]
        assert "box" in columns and boxes <= 5 and rows <= 5 * 1995  # of the boxes, only those with the five values


def test_knn_on_one_column_is_the_mean(gaps):
    got = impute.impute_missing_values(gaps.drop("n"), "knn")
    assert column(got, "x") == [1.0, 3.0, 2.0, 4.0, 5.0, 3.0]


def test_outliers(spark, scale):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    assert column(outliers.remove_outliers(df, ["v", "absent"]), "v") == [1.0, 2.0, 3.0, 4.0]
    assert column(outliers.flag_outliers(df, "v"), "is_outlier") == [False] * 4 + [True, False]
    assert [tuple(r) for r in outliers.outlier_counts(df, ["v"]).collect()] == [("v", 1)]
    assert [tuple(r) for r in outliers.outlier_counts(df, ["v"], "zscore").collect()] == [("v", 0)]


def test_outlier_bounds_follow_each_other(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame({"a": rng.standard_cauchy(400), "b": rng.standard_cauchy(400)})
    kept = data
    for c in data:
        q1, q3 = kept[c].quantile(0.25), kept[c].quantile(0.75)
        kept = kept[(kept[c] >= q1 - 1.5 * (q3 - q1)) & (kept[c] <= q3 + 1.5 * (q3 - q1))]
    got = outliers.remove_outliers(spark.createDataFrame(data)).toPandas()
    assert sorted(got["a"]) == sorted(kept["a"])


def test_zscore_of_a_constant_drops_all_and_flags_none(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id int, v double")
    assert outliers.remove_outliers(df, "v", "zscore").count() == 0
    assert column(outliers.flag_outliers(df, "v", "zscore"), "is_outlier") == [False, False]
    with pytest.raises(ValueError):
        outliers.remove_outliers(df, "v", "mad")


def test_scaling(spark, scale):
    df = spark.createDataFrame([(1, 1.0, 5), (2, 2.0, 5), (3, 4.0, 5), (4, None, 5)], "id int, x double, k int")
    standard = scaling.normalize_numeric_columns(df, "standard", ["x", "k"])
    x = np.array([1.0, 2.0, 4.0])
    np.testing.assert_allclose(column(standard, "x")[:3], (x - x.mean()) / x.std())
    assert column(standard, "x")[3] is None and column(standard, "k") == [0.0] * 4
    minmax = scaling.fit_scaler(df, "minmax", ["x", "k"])
    assert column(minmax.transform(df), "k") == [0.0] * 4
    np.testing.assert_allclose(column(minmax.transform(df), "x")[:3], (x - 1) / 3)
    robust = scaling.normalize_numeric_columns(df, "robust", ["x"])
    np.testing.assert_allclose(column(robust, "x")[:3], (x - 2) / 1.5)
    with pytest.raises(ValueError):
        scaling.fit_scaler(df, "unit")


def test_labels(spark, scale):
    texts = ["b", "a", None, "é", "B", "nan", "b", "zz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    order = {t: i for i, t in enumerate(sorted({"nan" if t is None else t for t in texts}))}
    assert column(encode.encode_categorical_columns(df), "t") == [order["nan" if t is None else t] for t in texts]
    encoder = encode.fit_label_encoder(df, "t")
    other = spark.createDataFrame([(1, "b"), (2, "inconnu")], "id int, t string")
    assert column(encoder.transform(other), "t") == [order["b"], None]


def test_encoders_are_stored_and_versioned(spark, tmp_path, scale):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("c", "x")], "t string, `u.v` string")
    path = str(tmp_path / "encoder")
    with pytest.raises(MissingPathError):
        encode.load_label_encoder(spark, path)
    first = encode.fit_label_encoder(train)
    assert (first.save(path), encode.fit_label_encoder(train.filter("t <> 'a'")).save(path)) == (1, 2)
    other = spark.createDataFrame([("c", None), ("a", "x"), ("?", "y")], "t string, `u.v` string")
    by_version = {v: encode.load_label_encoder(spark, path, v).transform(other) for v in (1, 2, None)}
    assert [tuple(r) for r in by_version[1].collect()] == [(2, 0), (0, 1), (None, None)]
    assert [tuple(r) for r in by_version[2].collect()] == [tuple(r) for r in by_version[None].collect()] == [(1, None), (None, 0), (None, None)]
    train.createOrReplaceTempView("training")
    fitted = encode.fit_label_encoder(spark.table("training"), "t")
    plan = fitted.transform(other.select("t"))._jdf.queryExecution().executedPlan().toString()
    assert "training" not in plan and plan.count("Scan ExistingRDD") == 2  # the other table and the kept dictionary


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, t string")
    got = encode.encode_categorical_columns(df, "t", "onehot")
    assert got.columns == ["id", "t_b", "t_c"]
    assert column(got, "t_b") == [True, False, False, False] and column(got, "t_c") == [False, False, False, True]
    with pytest.raises(ValueError):
        encode.encode_categorical_columns(df, "t", "hash")


def test_clean_keeps_its_order(spark):
    rows = [(i, f" c {i % 2} ", float(v) if v is not None else None) for i, v in enumerate([1, 2, 3, 4, 500, None])]
    df = spark.createDataFrame(rows, "id int, s string, v double")
    got = clean.clean(df)
    assert got.count() == 4 and {r.s for r in got.collect()} == {"c 0", "c 1"}
    assert clean.clean(df, remove_outliers=False).filter("v = 3").count() == 2


def test_days_and_months_of_one_digit(spark):
    df = spark.createDataFrame([("1/2/2025",), ("01/02/2025",), ("31/12/2025",), ("32/1/2025",)], "d string")
    for given in ("%d/%m/%Y", None):
        got = [r.d and r.d.strftime("%Y-%m-%d") for r in clean.convert_dates(df, "d", given).collect()]
        assert got == ["2025-02-01", "2025-02-01", "2025-12-31", None]


def test_gaps_are_counted_before_text_is_cleaned(spark, monkeypatch):
    """Cleaning text makes no NULL, so that the pass that looks for gaps does not clean it."""
    seen, count = [], clean.columns_with_missing
    monkeypatch.setattr(clean, "columns_with_missing", lambda df, columns: seen.append(df) or count(df, columns))
    df = spark.createDataFrame([(1.0, " a  b "), (None, " c"), (4.0, None), (3.0, "a b"), (2.0, " a b")], "x double, t string")
    rows = sorted(tuple(r) for r in clean.clean(df, remove_outliers=False).collect())
    assert rows == [(1.0, "a b"), (2.0, "a b"), (2.5, "c"), (3.0, "a b"), (4.0, "a b")]
    assert [one.columns for one in seen] == [["x", "t"]]
    assert {r["t"] for r in seen[0].collect()} == {" a  b ", "\u00a0c", None, "a b", " a b"}
