"""Files written by Spark from the given tables and read back, report sections and whole jobs."""

from pyspark.sql import functions as F

from checks import aggregates  # noqa: F401  (its SQL is used again below)
from checks.cleaning import SALES_GAPS, sales_with_gaps
from checks.registry import SALES, SQL, cells, cells_sql, new_folder, query, table, tidy
from comptoir.operators import timeseries
from comptoir.plans import jobs, sections
from comptoir.plans.sales import sales_from_star
from comptoir.sources import files, sinks


def _written(spark, df, **options):
    folder = new_folder(spark)
    df.write.options(header=True, **options).csv(folder)
    return folder


@query("load_csv_inferred", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority, o_totalprice > 1000 AS large
FROM orders
""")
def load_csv_inferred(spark, folder):
    orders = table(spark, folder, "orders").withColumns({
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "o_orderpriority": F.when(F.col("o_orderpriority") == "5-LOW", "N/A").otherwise(F.col("o_orderpriority")),
        "large": F.col("o_totalprice") > 1000,
    })
    return files.load_csv(spark, _written(spark, orders, sep=";"))


@query("load_csv_with_schema", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, folder):
    path = _written(spark, table(spark, folder, "customer"), sep="|")
    return files.load_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double", "utf-8", "|")


@query("load_csv_mixed_files", """
SELECT n_nationkey, n_name || ' é' AS n_name FROM nation
UNION ALL SELECT s_suppkey, s_name || ' é€' FROM supplier
UNION ALL SELECT r_regionkey, r_name || ' é€' FROM region
""")
def _(spark, folder):
    parts = {
        "nation": (table(spark, folder, "nation").select("n_nationkey", F.concat("n_name", F.lit(" é")).alias("n_name")), ",", "ISO-8859-1"),
        "supplier": (table(spark, folder, "supplier").select("s_suppkey", F.concat("s_name", F.lit(" é€"))), "\t", "UTF-8"),
        # Written as ISO-8859-1, the byte 80 is what cp1252 calls the euro sign.
        "region": (table(spark, folder, "region").select("r_regionkey", F.concat("r_name", F.lit(" é\x80"))), "|", "ISO-8859-1"),
    }
    root = new_folder(spark)
    for name, (df, sep, encoding) in parts.items():
        df.toDF("n_nationkey", "n_name").write.options(header=True, sep=sep, encoding=encoding).csv(f"{root}/{name}")
    return files.load_csv(spark, [f"{root}/{name}" for name in parts])


@query("profile_files", """
SELECT 'latin' AS file, 'ISO-8859-1' AS encoding, ';' AS delimiter, count(*) AS lines FROM nation
UNION ALL SELECT 'utf', 'UTF-8', '|', count(*) FROM part
""")
def _(spark, folder):
    root = new_folder(spark)
    nation = table(spark, folder, "nation").withColumn("n_name", F.concat("n_name", F.lit(" é")))
    nation.repartition(3, "n_nationkey").write.options(header=True, sep=";", encoding="ISO-8859-1").csv(f"{root}/latin")
    table(spark, folder, "part").repartition(4, "p_partkey").write.options(header=True, sep="|").csv(f"{root}/utf")
    found = files.profile_files(spark, [f"{root}/latin", f"{root}/utf"])
    # one row for each kind of file; the header of each file is no row of the table
    return found.groupBy(F.regexp_extract("path", "/(latin|utf)/", 1).alias("file"), "encoding", "delimiter").agg(F.sum(F.col("lines") - 1).alias("lines"))


@query("rejected_rows", """
SELECT p_partkey::VARCHAR AS p_partkey, p_name, 'surplus' AS extra FROM part WHERE p_size > 40
""")
def _(spark, folder):
    wide = F.concat_ws(",", "p_partkey", "p_name", F.when(F.col("p_size") > 40, F.lit("surplus")))
    root = new_folder(spark)
    numbered = table(spark, folder, "part").repartition(4, "p_partkey").select(F.spark_partition_id().alias("file"), wide.alias("value"))
    # each file begins with its header
    header = numbered.select("file").distinct().withColumn("value", F.lit("p_partkey,p_name"))
    lines = header.withColumn("row", F.lit(0)).unionByName(numbered.withColumn("row", F.lit(1)))
    lines.repartition("file").sortWithinPartitions("file", "row").select("file", "value").write.partitionBy("file").text(root)
    return files.rejected_rows(spark, f"{root}/file=*", "utf-8", ",").withColumnRenamed("_extra", "extra")


@query("load_csv_multiline", """
SELECT o_orderkey, 'line "1" of ' || o_orderpriority || chr(10) || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || ', é' ELSE o_orderstatus END AS note, o_custkey
FROM orders
""")
def load_csv_multiline(spark, folder):
    last = F.when(F.col("o_orderkey") % 3 == 0, F.lit("\n, é")).otherwise(F.col("o_orderstatus"))
    note = F.concat(F.lit('line "1" of '), "o_orderpriority", F.lit("\n"), last)
    orders = table(spark, folder, "orders").select("o_orderkey", note.alias("note"), "o_custkey")
    return files.load_csv(spark, _written(spark, orders, escape='"'))


@query("load_csv_wide_numbers", """
SELECT (o_orderkey::HUGEINT * 10000000000000000000 + o_custkey)::VARCHAR AS wide, 9007199254740993 + o_orderkey AS exact FROM orders
""")
def _(spark, folder):
    wide = (F.col("o_orderkey").cast("decimal(18,0)") * F.expr("10000000000000000000BD") + F.col("o_custkey")).cast("decimal(38,0)")
    orders = table(spark, folder, "orders").select(wide.alias("wide"), (F.col("o_orderkey") + 9007199254740993).alias("exact"))
    df = files.load_csv(spark, _written(spark, orders))
    if df.schema["wide"].dataType.simpleString() != "decimal(38,0)" or df.schema["exact"].dataType.simpleString() != "bigint":
        raise AssertionError(df.schema)
    return df.withColumn("wide", F.col("wide").cast("string"))


@query("load_csv_reordered_headers", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
""")
def _(spark, folder):
    root = new_folder(spark)
    table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).write.options(header=True).csv(f"{root}/c")
    table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).write.options(header=True).csv(f"{root}/s")
    return files.load_csv(spark, [f"{root}/c", f"{root}/s"]).select("key", "name", "balance")


@query("load_parquet", "SELECT * FROM region")
def _(spark, folder):
    return files.load_data(spark, f"{folder}/region.parquet")


@query("load_json", "SELECT s_acctbal, s_name, s_nationkey, s_suppkey FROM supplier")
def _(spark, folder):
    root = new_folder(spark)
    table(spark, folder, "supplier").write.json(root)
    return files.load_data(spark, root, "json")


@query("union_all_tables", """
SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier
""")
def _(spark, folder):
    customer = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    supplier = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return files.union_all([customer, supplier])


@query("write_tables", """
SELECT 'nation' AS name, n_nationkey AS key, n_name AS label FROM nation UNION ALL SELECT 'region', r_regionkey, r_name FROM region
""")
def _(spark, folder):
    bundle = {
        "nation": table(spark, folder, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("label")),
        "region": table(spark, folder, "region").toDF("key", "label"),
    }
    paths = sinks.write_tables(bundle, new_folder(spark))
    back = [spark.read.parquet(p).select(F.lit(n).alias("name"), "key", "label") for n, p in zip(bundle, paths)]
    return back[0].unionByName(back[1])


def _section(name, columns=None):
    def run(spark, folder):
        sales = sales_from_star(spark, folder, columns) if columns else sales_from_star(spark, folder)
        return sections.report_sections(sales)[name]
    return run


@query("section_kpi_cards", f"""
WITH {SALES}, k AS (SELECT sum(revenue) AS r, count(*) AS n, avg(revenue) AS a, sum(quantite)::BIGINT AS q FROM sales)
SELECT 'Chiffre d''Affaires Total' AS label, format('{{:,.2f}} €', r) AS value FROM k
UNION ALL SELECT 'Nombre de Transactions', format('{{:,}}', n) FROM k
UNION ALL SELECT 'Panier Moyen', format('{{:.2f}} €', a) FROM k
UNION ALL SELECT 'Quantité Totale', format('{{:,}}', q) FROM k
""")
def _(spark, folder):
    return _section("kpi", ["produit", "categorie", "prix", "quantite", "ville"])(spark, folder)


query("section_overview", SQL["overview_counts"])(_section("overview", ["produit", "categorie", "ville", "prix", "quantite"]))
query("section_period", SQL["data_period"])(lambda spark, folder: _section("period", ["date", "prix", "quantite", "produit"])(spark, folder))
query("section_category", SQL["sales_by_category"])(
    lambda spark, folder: tidy(_section("category", ["produit", "categorie", "prix", "quantite"])(spark, folder), ca_total=2))
query("section_geography", SQL["sales_by_city"])(
    lambda spark, folder: tidy(_section("geography", ["produit", "ville", "prix", "quantite"])(spark, folder), 2))
query("section_time", SQL["trend_monthly"])(
    lambda spark, folder: tidy(_section("time", ["date", "produit", "prix", "quantite"])(spark, folder), ca_total=2))
query("section_top_products", SQL["top_products_by_revenue"])(
    lambda spark, folder: tidy(_section("top_products", ["produit", "prix", "quantite"])(spark, folder), ca_total=2))


_SUMMARY = ["count", "mean", "std", "min", "q25", "median", "q75", "max", "skewness", "kurtosis"]


def _described(columns, source):
    """Whole summaries with two decimals, as a report prints them."""
    return " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count("{c}") AS count, round_even(avg("{c}"), 2) AS mean, round_even(stddev_samp("{c}"), 2) AS std, round_even(min("{c}")::DOUBLE, 2) AS min,
       round_even(quantile_cont("{c}", 0.25)::DOUBLE, 2) AS q25, round_even(quantile_cont("{c}", 0.5)::DOUBLE, 2) AS median,
       round_even(quantile_cont("{c}", 0.75)::DOUBLE, 2) AS q75, round_even(max("{c}")::DOUBLE, 2) AS max,
       round_even(skewness("{c}"), 2) + 0.0 AS skewness, round_even(kurtosis("{c}"), 2) + 0.0 AS kurtosis FROM {source}""" for c in columns)


def _correlated(columns, source, digits=4):
    """All cells of a correlation matrix."""
    value = {True: "1.0::DOUBLE", False: 'round(corr("{a}", "{b}"), {digits}) + 0.0'}
    return " UNION ALL ".join(
        f" SELECT '{a}' AS column1, '{b}' AS column2, any_value(v) AS correlation FROM (SELECT {value[a == b].format(a=a, b=b, digits=digits)} AS v FROM {source})"
        if a != b else f" SELECT '{a}' AS column1, '{b}' AS column2, {value[True]} AS correlation" for a in columns for b in columns)


@query("section_statistics", f"WITH {SALES}" + _described(["prix", "quantite"], "sales"))
def _(spark, folder):
    return tidy(_section("statistics", ["prix", "quantite"])(spark, folder))


# The breakdowns of a job, each with the columns that name a row and those that hold numbers.
_BREAKDOWNS = {
    "by_category": ("sales_by_category", ["categorie"], ["ca_total", "quantite_totale", "prix_moyen", "nb_transactions", "ca_percentage"]),
    "by_city": ("sales_by_city", ["ville"], ["ca_total", "quantite_totale", "nb_produits_uniques", "ca_percentage"]),
    "top_products": ("top_products_by_revenue", ["produit"], ["ca_total", "quantite_totale", "prix_moyen"]),
    "by_source": ("sales_by_source", ["source"], ["ca_total", "quantite_totale", "nb_transactions", "ca_percentage"]),
    "trend": ("trend_monthly", ["date"], ["ca_total", "quantite_totale", "nb_transactions", "ca_variation_pct", "quantite_variation_pct", "ca_ma3"]),
}


@query("job_aggregations", " UNION ALL ".join(cells_sql(part, SQL[name], labels, numbers) for part, (name, labels, numbers) in _BREAKDOWNS.items()))
def _(spark, folder):
    return cells(jobs.aggregations(sales_from_star(spark, folder)), ca_total=2)


# The sales table of the SQL above, after the gaps of SALES_GAPS are filled with medians.
_FILLED = SALES_GAPS.replace("sales AS (", "whole AS (", 1).replace("FROM sales)", "FROM whole)") + """,
middles AS (SELECT median(prix) AS p, median(quantite) AS q FROM dirty),
sales AS (SELECT strptime(date, '%Y-%m-%d') AS date, produit, categorie, ville, source, coalesce(prix, p) AS prix,
                 coalesce(quantite, q) AS quantite, coalesce(prix, p) * coalesce(quantite, q) AS revenue FROM dirty, middles)"""
_NUMBERS = ["prix", "quantite", "revenue"]
_KPIS = ["revenue_total", "transaction_count", "average_basket", "total_quantity", "average_price", "unique_products", "unique_categories", "unique_cities"]


def _on_filled(name):
    return SQL[name].replace(SALES, _FILLED)


def _fences(column):
    low, high = f"quantile_cont({column}, 0.25)", f"quantile_cont({column}, 0.75)"
    return (f"SELECT '{column}' AS \"column\", count(*) FILTER ({column} < low OR {column} > high) AS count FROM sales, "
            f"(SELECT {low} - 1.5 * ({high} - {low}) AS low, {high} + 1.5 * ({high} - {low}) AS high FROM sales)")


def _report(prefix):
    """The statistics report on the filled sales; nothing is missing there."""
    outliers = f"WITH {_FILLED} SELECT * FROM (" + " UNION ALL ".join(map(_fences, _NUMBERS)) + ") WHERE count > 0"
    return [
        cells_sql(f"{prefix}overview", f"WITH {_FILLED} SELECT count(*) AS n_rows, 8 AS n_columns, 3 AS n_numeric, 4 AS n_categorical FROM sales", [], ["n_rows", "n_columns", "n_numeric", "n_categorical"]),
        cells_sql(f"{prefix}descriptive_stats", f"WITH {_FILLED}" + _described(_NUMBERS, "sales"), ["column"], _SUMMARY),
        cells_sql(f"{prefix}outliers", outliers, ["column"], ["count"]),
        cells_sql(f"{prefix}correlations", f"WITH {_FILLED}" + _correlated(_NUMBERS, "sales"), ["column1", "column2"], ["correlation"]),
    ]


@query("job_analyze", " UNION ALL ".join([
    cells_sql("data_info", f"WITH {_FILLED} SELECT count(*) AS n_rows, 8 AS n_columns FROM sales", [], ["n_rows", "n_columns"]),
    cells_sql("kpis", _on_filled("sales_kpis"), [], _KPIS),
    *[cells_sql(part, _on_filled(_BREAKDOWNS[name][0]), *_BREAKDOWNS[name][1:])
      for part, name in (("sales_by_category", "by_category"), ("sales_by_city", "by_city"), ("top_products", "top_products"))],
    *_report("statistics_")]))
def job_analyze(spark, folder):
    return cells(jobs.analyze(sales_with_gaps(spark, folder)), ca_total=2, revenue_total=2)


@query("job_profile", cells_sql("metrics", SQL["table_metrics"], [], ["n_rows", "n_columns", "total_cells", "missing_cells", "missing_percentage", "duplicate_rows"])
       + " UNION ALL " + cells_sql("findings", SQL["validate_sales"], ["severity", "check", "column"], ["observed", "total"]))
def _(spark, folder):
    found = jobs.profile(sales_with_gaps(spark, folder))
    return cells({"metrics": found.metrics.drop("column_types"), "findings": found.findings.drop("message")})


@query("job_describe_file", _described(["p_partkey", "p_size", "p_retailprice"], "part"))
def _(spark, folder):
    return tidy(jobs.describe_file(spark, f"{folder}/part.parquet"))


@query("job_correlate_file", _correlated(["c_custkey", "c_nationkey", "c_acctbal"], "customer", 6))
def _(spark, folder):
    return tidy(jobs.correlate_file(spark, f"{folder}/customer.parquet"), 6)


def _job_output(spark, folder, parts):
    """Run the whole job on a written file and read tables of its output back."""
    source = _written(spark, sales_with_gaps(spark, folder))
    output = new_folder(spark)
    jobs.run(spark, source, output, file_format="csv")
    return {name: spark.read.parquet(f"{output}/{path}") for name, path in parts.items()}


@query("job_full_run", " UNION ALL ".join([
    cells_sql("kpis", _on_filled("sales_kpis"), [], _KPIS),
    *[cells_sql(part, _on_filled(name), labels, numbers) for part, (name, labels, numbers) in _BREAKDOWNS.items()],
    *_report(""),
    cells_sql("findings", SQL["validate_sales"], ["severity", "check", "column"], ["observed", "total"])]))
def job_full_run(spark, folder):
    names = ["overview", "descriptive_stats", "outliers", "correlations"]
    parts = {n: f"aggregations/{n}" for n in ("kpis", *_BREAKDOWNS)} | {n: f"statistics/{n}" for n in names} | {"findings": "quality/validation"}
    tables = _job_output(spark, folder, parts)
    return cells(tables | {"findings": tables["findings"].drop("message")}, ca_total=2, revenue_total=2)


@query("job_charts", " UNION ALL ".join([
    cells_sql("ventes_categorie", _on_filled("sales_by_category"), ["categorie"], ["ca_total"]),
    cells_sql("repartition_villes", f"SELECT ville, ca_total, round_even(ca_total / sum(ca_total) OVER () * 100, 2) AS share FROM (SELECT * FROM ({_on_filled('sales_by_city')}) ORDER BY ca_total DESC, ville LIMIT 10)", ["ville"], ["ca_total", "share"]),
    cells_sql("evolution_ca", _on_filled("trend_monthly"), ["date"], ["ca_total"]),
    cells_sql("top_produits", _on_filled("top_products_by_revenue"), ["produit"], ["ca_total"]),
    cells_sql("correlation_matrix", f"""SELECT column1 AS "row", column2 AS "column", correlation AS value FROM (WITH {_FILLED}{_correlated(_NUMBERS, "sales")})""", ["row", "column"], ["value"])]))
def _(spark, folder):
    charts = ["ventes_categorie", "repartition_villes", "evolution_ca", "top_produits", "correlation_matrix"]
    return cells(_job_output(spark, folder, {n: f"charts/{n}" for n in charts}), ca_total=2)


@query("resample_text_dates", """
SELECT strftime(last_day(o_orderdate::DATE), '%Y-%m-%d') AS day, round(sum(o_totalprice), 2) AS o_totalprice FROM orders GROUP BY 1
""")
def _(spark, folder):
    orders = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"), "o_totalprice")
    return tidy(timeseries.resample_timeseries(orders, "day", "M", {"o_totalprice": "sum"}), 2)
