import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comptoir.functions.columns import with_revenue
from comptoir.operators import aggregate as agg
from comptoir.operators import merging, quantiles
from comptoir.operators.merging import MergeAggregate


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_kpis_of_the_sample(sales):
    assert rows(agg.calculate_kpis(sales)) == [(120.0, 3, 40.0, 13, 15.0, 3, 2, 2)]


def test_kpis_without_columns_or_rows(spark):
    assert rows(agg.calculate_kpis(spark.createDataFrame([(1,)], "autre int"))) == [(0.0, 1, 0.0, 0, 0.0, 0, 0, 0)]
    empty = spark.createDataFrame([], "prix double, quantite int, produit string")
    assert rows(agg.calculate_kpis(empty)) == [(0.0, 0, None, 0, None, 0, 0, 0)]


def test_breakdowns_of_the_sample(sales):
    assert rows(agg.calculate_sales_by_category(sales)) == [
        ("Maison", 60.0, 7, 17.5, 2, 50.0), ("Mode", 60.0, 6, 10.0, 1, 50.0)]
    assert rows(agg.calculate_sales_by_source(sales)) == [("web", 90.0, 12, 2, 75.0), ("magasin", 30.0, 1, 1, 25.0)]
    assert [r[0] for r in rows(agg.calculate_sales_by_city(sales))] == ["Lille", "Nantes"]


def test_shares_of_zero_revenue_are_null(spark):
    free = spark.createDataFrame([("a", "p", 0.0, 1)], "categorie string, produit string, prix double, quantite int")
    assert rows(agg.calculate_sales_by_category(free))[0][-1] is None


def test_top_products_break_ties_by_name(sales):
    assert [r.produit for r in agg.calculate_top_products(sales, 2).collect()] == ["Sac", "Lampe"]
    assert [r.produit for r in agg.calculate_top_products(sales, 2, "quantite").collect()] == ["Sac", "Tasse"]


def test_revenue_is_kept_unless_overwritten(sales):
    given = sales.withColumn("revenue", F.lit(1.0))
    assert {r.revenue for r in with_revenue(given).collect()} == {1.0}
    assert {r.revenue for r in with_revenue(given, overwrite=True).collect()} == {30.0, 60.0}


@pytest.fixture
def grouped(spark):
    data = [("a", 1.0, 1), ("a", 3.0, 2), ("a", None, 3), ("b", 5.0, 4), ("b", None, 5), (None, 9.0, 6), ("c", None, 7)]
    return spark.createDataFrame(data, "k string, v double, i int")


def test_group_by_matches_pandas(grouped, scale):
    functions = ["sum", "mean", "count", "nunique", "min", "max", "median", "std", "var"]
    ours = agg.group_by(grouped, "k", {"v": functions}).toPandas().sort_values("k").reset_index(drop=True)
    theirs = grouped.toPandas().groupby("k").agg({"v": functions})
    theirs.columns = ["_".join(c) for c in theirs.columns]
    pd.testing.assert_frame_equal(ours.astype(theirs.reset_index().dtypes), theirs.reset_index())


def test_group_by_first_and_last_need_an_order(grouped):
    with pytest.raises(ValueError):
        agg.group_by(grouped, "k", {"v": "first"})
    got = agg.group_by(grouped, "k", {"v": ["first", "last"]}, order_by="i", sort_by="k", ascending=True)
    assert rows(got) == [("a", 1.0, 3.0), ("b", 5.0, 5.0), ("c", None, None)]


def test_group_by_names_and_sorting(grouped):
    assert agg.group_by(grouped, "k", {"v": "sum", "i": "max"}).columns == ["k", "v", "i"]
    assert agg.group_by(grouped, ["k"], {"v": ["sum"], "i": "max"}).columns == ["k", "v_sum", "i_max"]
    ordered = agg.group_by(grouped, "k", {"v": "sum"}, sort_by="v")
    assert [r.k for r in ordered.collect()] == ["b", "a", "c"]
    assert agg.group_by(grouped, "k", {"v": "sum"}, sort_by="v_sum").count() == 3


def test_group_by_takes_a_pandas_udf(grouped):
    @F.pandas_udf("double")
    def spread(v: pd.Series) -> float:
        return float(v.max() - v.min())

    got = agg.group_by(grouped, "k", {"v": spread}).toPandas().set_index("k")["v"]
    assert got["a"] == 2.0 and got["b"] == 0.0


def test_unknown_aggregate(grouped):
    with pytest.raises(ValueError):
        agg.group_by(grouped, "k", {"v": "mad"})


def test_pivot_matches_pandas(spark):
    data = pd.DataFrame({
        "r": ["x", "x", "y", "y", None, "z"], "c": ["a", "b", "a", None, "a", "b"], "v": [1.0, 2.0, 3.0, 4.0, 5.0, None],
    })
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "r string, c string, v double")
    for how in ("sum", "mean", "max"):
        ours = agg.pivot_table(df, "r", "c", "v", how).toPandas().set_index("r")
        theirs = pd.pivot_table(data, index="r", columns="c", values="v", aggfunc=how)
        pd.testing.assert_frame_equal(ours, theirs, check_names=False)
    filled = agg.pivot_table(df, "r", "c", "v", "mean", fill_value=-1.0)
    assert rows(filled) == [("x", 1.0, 2.0), ("y", 3.0, -1.0)]


def test_pivot_with_known_values_and_median(spark, scale):
    df = spark.createDataFrame([("x", "a", float(i)) for i in range(9)], "r string, c string, v double")
    assert rows(agg.pivot_table(df, "r", "c", "v", "median", column_values=["a", "q"])) == [("x", 4.0, None)]


def test_too_many_pivot_columns_are_refused(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        df = spark.range(5).selectExpr("1 AS r", "id AS c", "id AS v")
        with pytest.raises(ValueError, match="too many"):
            agg.pivot_table(df, "r", "c", "v")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_cross_tab_drops_nulls_and_adds_up(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "b"), (None, "a"), ("y", None)], "r string, c string")
    assert rows(agg.cross_tab(df, "r", "c")) == [("x", 2, 0), ("y", 0, 1)]
    shares = agg.cross_tab(df, "r", "c", normalize=True).collect()
    assert math.isclose(sum(v for r in shares for v in r[1:]), 100.0)


def test_period_and_overview(sales, spark):
    dated = sales.withColumn("date", F.to_timestamp("date"))
    assert rows(agg.period_info(dated)) == [("05/03/2024 - 01/04/2024",)]
    assert rows(agg.period_info(sales.drop("date"))) == [("N/A",)]
    assert rows(agg.overview(sales.drop("ville"))) == [(3, 3, 2, None)]


def test_results_do_not_depend_on_partitioning(sales):
    one = rows(agg.calculate_sales_by_category(sales.repartition(1)))
    assert rows(agg.calculate_sales_by_category(sales.repartition(8))) == one


def test_bar_keeps_numeric_x(sales):
    assert agg.bar_aggregate(sales, "quantite", "prix").count() == 3
    assert rows(agg.bar_aggregate(sales, "source", "prix")) == [("magasin", 30.0), ("web", 15.0)]


def test_pivot_over_several_columns_keeps_equal_names_apart(spark):
    df = spark.createDataFrame([("r", "a_b", "c", 1), ("r", "a", "b_c", 10), ("r", "x", "y", 5)], "k string, p string, q string, v int")
    from comptoir.operators.aggregate import pivot_table

    got = pivot_table(df, "k", ["p", "q"], "v").first().asDict()
    assert got["x_y"] == 5 and sorted((got["a_b_c"], got["a_b_c.1"])) == [1, 10]


def test_pivot_cells_have_no_limit(spark):
    from comptoir.operators.aggregate import pivot_cells

    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        df = spark.range(6).selectExpr("id % 2 AS k", "id AS c", "id AS v")
        assert sorted(map(tuple, pivot_cells(df, "k", "c", "v").collect())) == [(i % 2, i, i) for i in (0, 2, 4)] + [(i % 2, i, i) for i in (1, 3, 5)]
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


MEAN = MergeAggregate(
    init=lambda: (0.0, 0), update=lambda s, v: (s[0] + float(v.sum()), s[1] + int(v.count())), merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
    finish=lambda s: s[0] / s[1] if s[1] else None, state="total double, n bigint", result="double", name="own_mean")
LONGEST = MergeAggregate(
    init=lambda: ("",), update=lambda s, v: (max([s[0], *v.dropna()], key=lambda x: (len(x), x)),), merge=lambda a, b: (max(a[0], b[0], key=lambda x: (len(x), x)),),
    finish=lambda s: s[0], state="text string", result="string")


def test_own_aggregate_with_merge(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, "yy"), ("b", None, None), ("c", 5.0, "é"), (None, 9.0, "z"), ("a", None, "zz")] * 3, "k string, v double, t string").repartition(5)
    got = agg.group_by(df, "k", {"v": [MEAN, "sum"], "t": LONGEST}, sort_by="k", ascending=True)
    assert got.columns == ["k", "v_own_mean", "v_sum", "t_merged"]
    assert [tuple(r) for r in got.collect()] == [("a", 2.0, 12.0, "zz"), ("b", None, 0.0, ""), ("c", 5.0, 15.0, "é")]
    assert [tuple(r) for r in agg.group_by(df, "k", {"v": MEAN}, sort_by="k", ascending=True).collect()] == [("a", 2.0), ("b", None), ("c", 5.0)]
    assert agg.group_by(df.limit(0), "k", {"v": MEAN}).count() == 0
    assert [tuple(r) for r in agg.pivot_table(df, "k", "t", "v", MEAN).select("k", "x", "yy").collect()] == [("a", 1.0, 3.0), ("c", None, None)]


def test_own_aggregate_sends_states_not_rows(spark, monkeypatch):
    df = spark.range(0, 20_000, numPartitions=8).selectExpr("IF(id % 10 = 0, id % 700, -1) AS k", "CAST(id AS double) AS v")
    want = {r.k: r.m for r in df.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    for held in (merging._STATES, 7):
        monkeypatch.setattr(merging, "_STATES", held)
        seen = spark.sparkContext.accumulator(0)

        def merge(a, b):
            seen.add(1)
            return a[0] + b[0], a[1] + b[1]

        own = MergeAggregate(MEAN.init, MEAN.update, merge, MEAN.finish, MEAN.state, MEAN.result)
        assert {r.k: r.v for r in agg.group_by(df, "k", {"v": own}).collect()} == want
        if held > 7:  # the key with nine rows in ten is one state of each task, like any other
            assert seen.value < 8 * len(want)


def test_medians_are_part_of_one_aggregate(spark, grouped):
    plan = agg.group_by(grouped, "k", {"v": ["median", "sum"], "i": "median"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("percentile(") >= 2


def test_medians_of_large_groups(spark, scale):
    rng = np.random.default_rng(4)
    data = pd.DataFrame({"k": rng.choice(["a", "a", "a", "b", "c"], 3000), "x": rng.normal(size=3000).round(1), "y": rng.integers(0, 10**6, 3000).astype(float), "z": 1.0})
    data.loc[rng.random(3000) < 0.2, "y"] = np.nan
    data.loc[data.k == "c", "x"] = np.nan
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "k string, x double, y double, z double").repartition(4)
    got = agg.group_by(df, "k", {"x": "median", "y": "median", "z": "median"}, sort_by="k", ascending=True).toPandas()
    pd.testing.assert_frame_equal(got, data.groupby("k").median().reset_index())
    found = {r["k"]: r["q"] for r in quantiles.grouped_selection(df, ["k"], ["x", "y"], [0.0, 0.25, 0.9, 1.0]).collect()}
    for k, group in data.groupby("k"):
        for i, c in enumerate("xy"):
            values = group[c].dropna()
            assert (found[k][i] is None) if values.empty else found[k][i] == pytest.approx(list(np.quantile(values, [0.0, 0.25, 0.9, 1.0])))
