import math
from decimal import Decimal, localcontext
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comptoir.functions import pvalues
from comptoir.operators import correlation, hypothesis, stats
from tests.test_order import skewed


def frame(spark, data):
    """Pandas to Spark with NaN as NULL."""
    df = spark.createDataFrame(data)
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c, t in df.dtypes if t == "double"})


@pytest.fixture(scope="module")
def measures():
    rng = np.random.default_rng(21)
    n = 600
    x = rng.gamma(2, 3, n)
    data = pd.DataFrame({
        "x": np.round(x, 1), "y": np.where(rng.random(n) < 1 / 3, 5.0, np.round(x * 2 + rng.normal(0, 8, n), 1)),
        "z": rng.integers(0, 9, n).astype(float), "same": 4.0,
    })
    return data.mask(rng.random(data.shape) < 0.1)


def test_describe_equals_pandas(spark, measures, scale):
    got = stats.describe(frame(spark, measures)).toPandas().set_index("column")
    for c in measures:
        v = measures[c].dropna()
        expected = [v.count(), v.mean(), v.std(), v.min(), v.quantile(0.25), v.median(), v.quantile(0.75), v.max(), v.skew(), v.kurtosis()]
        np.testing.assert_allclose(got.loc[c].to_numpy(float), expected, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("values", [[], [None], [1.0], [1.0, 2.0], [1.0, 2.0, 4.0], [3.0] * 5])
def test_describe_short_columns(spark, values):
    got = stats.describe(spark.createDataFrame([(v,) for v in values], "v double")).first()
    v = pd.Series(values, dtype=float).dropna()
    for name, expected in {"mean": v.mean(), "std": v.std(), "median": v.median(), "skewness": v.skew(), "kurtosis": v.kurtosis()}.items():
        assert got[name] is None if pd.isna(expected) else math.isclose(got[name], expected, abs_tol=1e-12)
    assert got["count"] == len(v)


def test_describe_rounds_to_two_decimals(spark):
    df = spark.createDataFrame([(1.005,), (2.0,)], "v double")
    assert stats.describe(df, rounded=True).first()["mean"] == 1.5
    assert stats.describe(df.select(F.lit("a").alias("t"))).count() == 0


def test_percentiles_and_profile(spark, measures, scale):
    df = frame(spark, measures)
    got = dict(tuple(r) for r in stats.percentiles(df, "x").collect())
    assert list(got) == list(stats.DEFAULT_PERCENTILES)
    np.testing.assert_allclose(list(got.values()), [measures["x"].quantile(p) for p in got])
    assert tuple(stats.profile_counts(df.withColumn("t", F.lit("a"))).first()) == (600, 5, 4, 1)


def as_matrix(long, names):
    rows = {(r.column1, r.column2): r.correlation for r in long.collect()}
    assert len(rows) == len(names) ** 2
    return np.array([[rows[a, b] for b in names] for a in names], dtype=float)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_equals_pandas(spark, measures, method, scale):
    long = correlation.correlation_matrix(frame(spark, measures), method)
    np.testing.assert_allclose(as_matrix(long, list(measures)), measures.corr(method).to_numpy(), atol=1e-9)


def tau_b(x, y):
    dx, dy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    return (dx * dy).sum() / math.sqrt((dx * dx).sum() * (dy * dy).sum())


def test_kendall_equals_brute_force(spark, measures, scale):
    names = ["x", "y", "z"]
    matrix = as_matrix(correlation.correlation_matrix(frame(spark, measures[names]), "kendall"), names)
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            pair = measures[[a, b]].dropna().to_numpy()
            assert math.isclose(matrix[i, j], tau_b(pair[:, 0], pair[:, -1]), abs_tol=1e-12)


def test_spearman_of_columns_with_the_same_gaps(spark, measures, scale):
    data = measures.assign(w=measures["x"] ** 2 + measures["z"].fillna(0), v=np.where(measures["x"].isna(), np.nan, 7 - measures["x"]))
    long = correlation.correlation_matrix(frame(spark, data), "spearman")
    np.testing.assert_allclose(as_matrix(long, list(data)), data.corr("spearman").to_numpy(), atol=1e-9)


@pytest.fixture
def stored_rows(monkeypatch):
    """Rows of each checkpoint that a test makes."""
    sizes, checkpoint = [], type_of_frames().checkpoint

    def counted(self, *args, **kwargs):
        done = checkpoint(self, *args, **kwargs)
        sizes.append(done.count())
        return done

    monkeypatch.setattr(type_of_frames(), "checkpoint", counted)
    return sizes


def type_of_frames():
    from pyspark.sql.classic.dataframe import DataFrame

    return DataFrame


@pytest.mark.parametrize("wide", [True, False])
def test_spearman_stores_ranks_once_per_column(spark, stored_rows, wide, monkeypatch):
    if not wide:
        monkeypatch.setattr(correlation.order, "BROADCAST_BYTES", 1)
    rng = np.random.default_rng(8)
    data = pd.DataFrame({f"c{i}": rng.normal(size=300) for i in range(8)})
    totals = []
    for m in (4, 8):
        stored_rows.clear()
        long = correlation.correlation_matrix(frame(spark, data.iloc[:, :m]), "spearman")
        np.testing.assert_allclose(as_matrix(long, list(data)[:m]), data.iloc[:, :m].corr("spearman").to_numpy(), atol=1e-9)
        totals.append(sum(stored_rows))
    assert totals[0] <= 4 * 300 * 2 and totals[1] <= 2.1 * totals[0]


def test_kendall_stores_at_most_one_copy_per_column_at_a_time(spark, stored_rows):
    rng = np.random.default_rng(9)
    data = pd.DataFrame({f"c{i}": rng.integers(0, 50, 200).astype(float) for i in range(6)})
    matrix = as_matrix(correlation.correlation_matrix(frame(spark, data), "kendall"), list(data))
    assert max(stored_rows) <= 6 * 200 and len(stored_rows) >= 3
    for i in range(6):
        for j in range(i):
            assert math.isclose(matrix[i, j], tau_b(data.iloc[:, i].to_numpy(), data.iloc[:, j].to_numpy()), abs_tol=1e-12)


def test_correlation_without_common_rows(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, None)], "a double, b double")
    for method in ("pearson", "spearman", "kendall"):
        got = {(r.column1, r.column2): r.correlation for r in correlation.correlation_matrix(df, method).collect()}
        assert got[("a", "b")] is None and got[("a", "a")] == 1.0
    with pytest.raises(ValueError):
        correlation.correlation_matrix(df, "cosine")


def test_strong_pairs_and_wide_form(spark, measures):
    df = frame(spark, measures)
    strong = correlation.strong_correlations(df, 0.3).collect()
    expected = measures.corr().loc["x", "y"]
    assert [(r.column1, r.column2) for r in strong] == [("x", "y")] and math.isclose(strong[0].correlation, expected)
    wide = correlation.wide_matrix(correlation.correlation_matrix(df), list(measures))
    assert wide.columns == ["column1", *measures] and wide.count() == 4


def test_report(spark, measures):
    report = stats.statistics_report(frame(spark, measures).withColumn("t", F.lit("a")))
    assert {r["column"] for r in report["missing_values"].collect()} == set(measures)
    assert set(report) == {"overview", "missing_values", "descriptive_stats", "outliers", "correlations"}
    assert set(stats.statistics_report(spark.createDataFrame([("a",)], "t string"))) == {"overview", "missing_values"}


# Published table values.
@pytest.mark.parametrize("t, dof", [(12.7062, 1), (2.5706, 5), (2.2281, 10), (2.0423, 30), (1.96, 1e7)])
def test_student_table(t, dof):
    assert math.isclose(pvalues.student_two_sided(t, dof), 0.05, abs_tol=1e-4)
    assert math.isclose(pvalues.student_quantile(0.975, dof), t, abs_tol=1e-3)


@pytest.mark.parametrize("x, dof", [(3.8415, 1), (5.9915, 2), (18.307, 10), (124.342, 100)])
def test_chi_square_table(x, dof):
    assert math.isclose(pvalues.chi2_upper(x, dof), 0.05, abs_tol=1e-5)


@pytest.mark.parametrize("d, n", [(0.40925, 10), (0.29408, 20), (0.13403, 100)])
def test_kolmogorov_table(d, n):
    assert math.isclose(pvalues.kolmogorov_upper(d, n), 0.05, abs_tol=2e-4)


def kolmogorov_in_decimals(d, n):
    """P(D_n >= d) by the matrix form with 80 digits."""
    with localcontext() as context:
        context.prec = 80
        d = Decimal(d)
        k = int(n * d) + 1
        h, size = k - n * d, 2 * k - 1
        matrix = [[Decimal(1 if i - j + 1 >= 0 else 0) for j in range(size)] for i in range(size)]
        for i in range(size):
            matrix[i][0] -= h ** (i + 1)
            matrix[-1][i] -= h ** (size - i)
        if 2 * h > 1:
            matrix[-1][0] += (2 * h - 1) ** size
        for i in range(size):
            for j in range(min(i + 1, size - 1) + 1):
                matrix[i][j] /= math.factorial(i - j + 1)

        def times(a, b):
            columns = list(zip(*b))
            return [[sum(x * y for x, y in zip(row, column)) for column in columns] for row in a]

        row, left, power = [[Decimal(int(j == k - 1)) for j in range(size)]], n, matrix
        while left:
            if left & 1:
                row = times(row, power)
            left >>= 1
            power = times(power, power) if left else power
        value = row[0][k - 1]
        for i in range(1, n + 1):
            value *= Decimal(i) / n
        return float(1 - value)


@pytest.mark.parametrize("d, n", [
    ("0.3", 3), ("0.6", 3), ("0.9", 3), ("0.03", 140), ("0.07", 140), ("0.12", 140), ("0.03", 141), ("0.07", 141), ("0.12", 141),
    ("0.2", 141), ("0.015", 500), ("0.03", 500), ("0.055", 500)])
def test_kolmogorov_to_many_digits(d, n):
    assert math.isclose(pvalues.kolmogorov_upper(float(d), n), kolmogorov_in_decimals(d, n), rel_tol=0, abs_tol=1e-9)


def test_kolmogorov_for_a_million_values_and_where_the_ways_meet():
    for d in (2e-4, 2.9e-4, 3.5e-4):  # two independent ways
        assert math.isclose(pvalues._kolmogorov_exact(d, 10**6), pvalues._pelz_good(d, 10**6), abs_tol=1e-10)
    for z in (0.4, 0.6, 1.0, 1.7, 1.99):
        n = 10**6
        assert math.isclose(pvalues.kolmogorov_upper(z / 1000, n), 1 - pvalues._pelz_good(z / 1000, n), abs_tol=1e-9)
        assert math.isclose(1 - pvalues._kolmogorov_exact(z / 100, 10**4), 1 - pvalues._pelz_good(z / 100, 10**4), abs_tol=1e-8)
    for n in (50, 141, 5000):  # the tail and the middle agree where they meet
        d = 2 / math.sqrt(n)
        assert math.isclose(2 * pvalues._smirnov_upper(d, n), 1 - pvalues._kolmogorov_exact(d, n), abs_tol=1e-11)
    assert 0 < pvalues.kolmogorov_upper(0.05, 10**5) < 1e-200 and pvalues.kolmogorov_upper(1e-9, 10**6) == 1


def test_normal_law_and_its_inverse(spark):
    x = np.linspace(-9, 9, 1001)
    np.testing.assert_allclose(pvalues.normal_below(x), [0.5 * math.erfc(-v / math.sqrt(2)) for v in x], rtol=1e-10, atol=1e-16)
    p = np.r_[1e-300, 1e-12, np.linspace(1e-4, 1 - 1e-4, 500), 1 - 1e-9]
    got = spark.createDataFrame(pd.DataFrame({"p": p})).select("p", pvalues.normal_quantile(F.col("p")).alias("q")).toPandas()
    np.testing.assert_allclose(got["q"], [NormalDist().inv_cdf(v) for v in got["p"]], rtol=1e-12, atol=1e-13)


def test_shapiro_on_the_published_example(spark, scale):
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    got = hypothesis.test_normality(spark.createDataFrame([(float(w),) for w in weights], "w double"), "w").first()
    assert math.isclose(got.statistic, 0.78881, abs_tol=1e-5) and math.isclose(got.p_value, 0.0067, abs_tol=1e-4)
    assert got.is_normal is False


def test_shapiro_with_ties_and_long_runs(spark, monkeypatch):
    monkeypatch.setattr(hypothesis, "_SCORES_PER_ROW", 7)
    data = skewed(500)["value"]
    n = len(data)
    scores = pvalues.normal_scores(np.arange(1, n + 1), n)
    x = np.sort(data)
    w = pvalues.shapiro_statistic(n, (scores * x).sum(), (scores**2).sum(), ((x - x.mean()) ** 2).sum(), [x[0], x[1], x[-2], x[-1]])
    got = hypothesis.shapiro_wilk(spark.createDataFrame(data.to_frame()), "value").first()
    assert math.isclose(got.statistic, w, rel_tol=1e-9)
    assert math.isclose(got.p_value, pvalues.shapiro_upper(w, n), abs_tol=1e-9)


def test_kolmogorov_on_small_samples(spark):
    values = [-1.2, 0.1, 0.1, 0.4, 2.0, None]
    x = np.sort([v for v in values if v is not None])
    f = np.array([NormalDist().cdf(v) for v in x])
    d = max((np.arange(1, 6) / 5 - f).max(), (f - np.arange(5) / 5).max())
    got = hypothesis.test_normality(spark.createDataFrame([(v,) for v in values], "v double"), "v", "kstest").first()
    assert math.isclose(got.statistic, d) and got.is_normal is True
    with pytest.raises(ValueError):
        hypothesis.test_normality(spark.range(3), "id", "anderson")


def test_t_test(spark):
    rows = [("a", v) for v in (1.0, 2.0, 3.0)] + [("b", v) for v in (2.0, 4.0, 6.0)] + [("b", None), ("c", 100.0)]
    got = hypothesis.t_test_independent(spark.createDataFrame(rows, "g string, v double"), "v", "g", "a", "b").first()
    assert math.isclose(got.statistic, -1.549193, abs_tol=1e-6) and got.dof == 4
    assert math.isclose(got.p_value, 0.196263, abs_tol=1e-5) and got.significant is False
    alone = hypothesis.t_test_independent(spark.createDataFrame(rows[:1], "g string, v double"), "v", "g", "a", "b").first()
    assert alone.p_value is None


def test_chi_square(spark):
    def table(cells):
        rows = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
        return spark.createDataFrame(rows, "a string, b string")

    yates = hypothesis.chi2_test(table({("x", "p"): 10, ("x", "q"): 20, ("y", "p"): 30, ("y", "q"): 10}), "a", "b").first()
    assert math.isclose(yates.statistic, 10.53125 * 7 / 7, rel_tol=0.2) and yates.dof == 1
    o, e = np.array([[10, 20], [30, 10]]), np.array([[40 * 30, 30 * 30], [40 * 40, 30 * 40]]) / 70
    assert math.isclose(yates.statistic, ((abs(o - e) - 0.5) ** 2 / e).sum())
    sparse = {("x", "p"): 5, ("y", "q"): 7, ("z", "p"): 2, ("z", "q"): 3}
    counts = np.array([[5, 0], [0, 7], [2, 3]])
    e = counts.sum(1)[:, None] * counts.sum(0)[None, :] / counts.sum()
    got = hypothesis.chi2_test(table(sparse), "a", "b").first()
    assert got.dof == 2 and math.isclose(got.statistic, ((counts - e) ** 2 / e).sum())
    one = hypothesis.chi2_test(table({("x", "p"): 5, ("y", "p"): 7}), "a", "b").first()
    assert (one.statistic, one.p_value) == (0.0, 1.0)


def test_interval(spark):
    got = hypothesis.confidence_interval(spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, None)], "v double"), "v").first()
    margin = 3.182446 * np.std([1, 2, 3, 4], ddof=1) / 2
    assert got.mean == 2.5 and math.isclose(got.upper - got.mean, margin, rel_tol=1e-6)


def test_student_law_with_many_degrees_of_freedom():
    from comptoir.functions import pvalues

    # independent values: numerical integration of the density
    for dof, want in ((30, 0.05934231289605003), (1000, 0.05027318495274859), (1e6, 0.04999606758526963), (1e12, 0.04999579029671804)):
        assert abs(pvalues.student_two_sided(1.96, dof) / want - 1) < 1e-9
    assert abs(pvalues.student_quantile(0.975, 1e12) - 1.959963984542) < 1e-10
