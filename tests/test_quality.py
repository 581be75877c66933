from pyspark.sql import functions as F

from comptoir.operators import impute, quality, stats


def test_clean_sample_is_valid(sales):
    result = quality.validate_sales_data(sales)
    assert result.is_valid and not result.warnings
    metrics = result.metrics.first()
    assert (metrics.n_rows, metrics.n_columns, metrics.total_cells, metrics.missing_cells, metrics.duplicate_rows) == (3, 7, 21, 0, 0)
    assert metrics.column_types["prix"] == "double"


def test_two_unrelated_columns_fail_every_requirement(spark):
    result = quality.validate_sales_data(spark.createDataFrame([(1, 2)], "col1 bigint, col2 bigint"))
    assert not result.is_valid
    assert len(result.errors) == 7 and "'date'" in result.errors[0]


def test_findings(spark):
    data = [("a", 1.0), ("a", 1.0), ("a", 1.0), (None, -1.0), (None, None), (None, 99.0), (None, None)]
    df = spark.createDataFrame(data, "`100% nom` string, v double")
    result = quality.validate(df, value_ranges={"v": (0, 50), "absent": (0, 1)}, min_rows=8)
    found = {(r.severity, r.check, r.column): r.observed for r in result.findings.collect()}
    assert found == {
        ("warning", "missing", "100% nom"): 4.0, ("warning", "duplicates", None): 3.0,
        ("error", "range", "v"): 2.0, ("error", "rows", None): 7.0,
    }
    assert any("'100% nom': 57.1% of 7 values missing" in w for w in result.warnings)
    strict = quality.validate(df, strict=True)
    assert len(strict.errors) == 2 and not strict.warnings


def test_missing_share_must_exceed_the_limit(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert not quality.validate(df).warnings


def test_types(spark):
    df = spark.createDataFrame([], "i int, l bigint, d double, s string, t timestamp, b boolean, m decimal(5,2)")
    assert not quality.wrong_types(df, {"i": "int", "l": "float", "d": "float", "s": "str", "t": "datetime", "b": "bool", "m": "float"})
    assert quality.wrong_types(df, {"d": "int", "s": "float", "x": "int", "b": "int", "t": "object"}) == {
        "d": "double", "s": "string", "b": "boolean", "t": "timestamp"}


def test_text_under_a_range_rule_is_an_error_of_its_own(spark):
    df = spark.createDataFrame([("x",), ("-3",), (None,)], "v string")
    found = {(r.severity, r.check, r.column): r.observed for r in quality.validate(df, value_ranges={"v": (0, None)}, check_missing=False).findings.collect()}
    assert found == {("error", "range", "v"): 1.0, ("error", "type", "v"): 1.0}
    assert [tuple(r) for r in quality.range_violations(df, {"v": (0, None)}).collect()] == [("v", 1)]
    assert quality.range_violations(df, {}).count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    metrics = quality.table_metrics(df).first()
    assert metrics.n_rows == 0 and metrics.missing_percentage == 0.0 and metrics.duplicate_rows == 0
    assert [f.check for f in quality.validate(df, min_rows=1).findings.collect()] == ["rows"]
    assert quality.missing_report(df).count() == 0


def test_duplicates_match_pandas(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, 1).alias("b"))
    assert quality.duplicate_count(df).first()[0] == df.toPandas().duplicated().sum()


def test_validation_moves_fingerprints_once(spark):
    df = spark.createDataFrame([("x" * 50, 1.0)] * 3 + [(None, -1.0)], "name string, v double")
    result = quality.validate(df, value_ranges={"v": (0, None)})
    plan = result._counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    moved = plan.split("Exchange hashpartitioning")[1].split("\n")[1]
    assert "name" not in moved and "_m0" in moved
    assert {(r.check, r.column): r.observed for r in result.findings.collect()} == {("duplicates", None): 2.0, ("range", "v"): 1.0}
    assert result.metrics.first().duplicate_rows == 2


def test_rows_that_differ_in_the_place_of_a_null_are_no_duplicates(spark):
    rows = [(None, "a", 0.0), ("a", None, 0.0), (None, "a", -0.0), ("a", None, None), ("", "a", 0.0), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c double")
    assert quality.duplicate_count(df).first()[0] == len(rows) - df.distinct().count() == 2


def test_nan_is_missing_in_any_table(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 4.0), (3, None), (4, float("nan"))], "id int, v double")
    assert [r.column for r in quality.validate(df).findings.collect()] == ["v"]
    assert quality.table_metrics(df).first().missing_cells == 3
    assert [tuple(r)[:2] for r in quality.missing_report(df).collect()] == [("v", 3)]
    described = {r["column"]: r for r in stats.describe(df).collect()}
    assert (described["v"]["count"], described["v"]["mean"], described["v"]["max"]) == (1, 4.0, 4.0)
    for how in ("mean", "median", "most_frequent", "constant", "knn"):
        filled = impute.impute_missing_values(df, how, fill_value=4).orderBy("id").collect()
        assert [r.v for r in filled] == [4.0] * 4
    assert [r.v for r in impute.impute_missing_values(df, "ffill", order_by="id").orderBy("id").collect()] == [None, 4.0, 4.0, 4.0]


def test_more_conditions_than_one_mask_holds(spark):
    df = spark.range(3).select(*[F.when(F.col("id") > i % 3, F.lit(1)).alias(f"c{i}") for i in range(70)])
    counts = quality.missing_counts(df).collect()
    row = quality._counted(df, [F.col(c).isNull() for c in df.columns]).first()
    assert [row[f"c{i}"] for i in range(70)] == [r["count"] for r in counts] and row["different"] == 3
