"""Quality checks, cleaning, imputation, scaling and encoding."""

from pyspark.sql import functions as F

from checks.registry import SALES, new_folder, query, table, tidy
from comptoir.operators import clean, encode, impute, outliers, quality, scale
from comptoir.plans.sales import sales_from_star

# Line items with gaps: quantities and flags are missing where other columns hold certain values.
GAPPY_SQL = """
gappy AS (
  SELECT l_orderkey, CASE WHEN l_discount = 0.03 THEN NULL ELSE l_quantity END AS qty,
         CASE WHEN l_tax = 0.02 THEN NULL ELSE l_extendedprice END AS price,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS flag, l_linestatus AS status
  FROM lineitem)"""


def gappy(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_discount") != 0.03, F.col("l_quantity")).alias("qty"),
        F.when(F.col("l_tax") != 0.02, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


def sales_with_gaps(spark, folder):
    sales = sales_from_star(spark, folder)
    return sales.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "produit", "categorie",
        F.when(F.col("quantite") < 30, F.col("prix")).alias("prix"),
        F.when(F.col("prix") < 990, F.col("quantite") - 1).alias("quantite"), "ville", "source",
    )


SALES_GAPS = f"""{SALES}, dirty AS (
  SELECT strftime(date, '%Y-%m-%d') AS date, produit, categorie, CASE WHEN quantite < 30 THEN prix END AS prix,
         CASE WHEN prix < 990 THEN quantite - 1 END AS quantite, ville, source FROM sales)"""


@query("range_violations", """
SELECT * FROM (
  SELECT 'l_quantity' AS "column", count(*) FILTER (l_quantity < 5 OR l_quantity > 45) AS invalid FROM lineitem
  UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax > 0.05) FROM lineitem
  UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount < 0.01) FROM lineitem)
""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    return quality.range_violations(lines, {"l_quantity": (5, 45), "l_tax": (None, 0.05), "l_discount": (0.01, None)})


@query("missing_report", f"""
WITH {GAPPY_SQL}
SELECT 'qty' AS "column", count(*) - count(qty) AS count, round((count(*) - count(qty)) * 100.0 / count(*), 4) AS percentage FROM gappy
UNION ALL SELECT 'price', count(*) - count(price), round((count(*) - count(price)) * 100.0 / count(*), 4) FROM gappy
UNION ALL SELECT 'flag', count(*) - count(flag), round((count(*) - count(flag)) * 100.0 / count(*), 4) FROM gappy
""")
def _(spark, folder):
    return tidy(quality.missing_report(gappy(spark, folder)))


@query("duplicate_rows", """
SELECT (SELECT count(*) FROM lineitem) - count(*) AS duplicate_rows
FROM (SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem)
""")
def _(spark, folder):
    columns = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return quality.duplicate_count(table(spark, folder, "lineitem").select(*columns))


@query("table_metrics", f"""
WITH {SALES_GAPS}
SELECT count(*) AS n_rows, 7 AS n_columns, count(*) * 7 AS total_cells, 2 * count(*) - count(prix) - count(quantite) AS missing_cells,
       round((2 * count(*) - count(prix) - count(quantite)) * 100.0 / (count(*) * 7), 4) AS missing_percentage,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicate_rows
FROM dirty
""")
def _(spark, folder):
    return tidy(quality.table_metrics(sales_with_gaps(spark, folder)).drop("column_types"))


@query("validate_sales", f"""
WITH {SALES_GAPS}, s AS (
  SELECT count(*) AS total, count(*) - count(prix) AS no_price, count(*) FILTER (prix < 0) AS cheap, count(*) FILTER (quantite < 1) AS none,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS copies, count(*) - count(quantite) AS no_quantity
  FROM dirty)
SELECT * FROM (
  SELECT 'warning' AS severity, 'missing' AS "check", 'prix' AS "column", no_price AS observed, total FROM s WHERE no_price > total / 2
  UNION ALL SELECT 'warning', 'missing', 'quantite', no_quantity, total FROM s WHERE no_quantity > total / 2
  UNION ALL SELECT 'warning', 'duplicates', NULL, copies, total FROM s WHERE copies > 0
  UNION ALL SELECT 'error', 'range', 'prix', cheap, total FROM s WHERE cheap > 0
  UNION ALL SELECT 'error', 'range', 'quantite', none, total FROM s WHERE none > 0)
""")
def _(spark, folder):
    return quality.validate_sales_data(sales_with_gaps(spark, folder)).findings.drop("message")


@query("validate_rules", """
SELECT * FROM (
  SELECT 'error' AS severity, 'required' AS "check", 'email' AS "column", NULL::DOUBLE AS observed, count(*) AS total FROM customer
  UNION ALL SELECT 'error', 'type', 'c_name', NULL, count(*) FROM customer
  UNION ALL SELECT 'error', 'range', 'c_acctbal', count(*) FILTER (c_acctbal < 0), count(*) FROM customer
  UNION ALL SELECT 'error', 'rows', NULL, count(*), count(*) FROM customer)
""")
def _(spark, folder):
    return quality.validate(
        table(spark, folder, "customer"), required_columns=["c_name", "email"],
        column_types={"c_name": "int", "c_acctbal": "float", "c_custkey": "int"},
        value_ranges={"c_acctbal": (0, None), "absent": (0, 1)}, min_rows=1_000_000_000, strict=True,
    ).findings.drop("message")


@query("validate_missing", """
WITH g AS (SELECT c_custkey, CASE WHEN c_acctbal > 6000 THEN c_acctbal END AS rare, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS half FROM customer)
SELECT 'error' AS severity, 'missing' AS "check", 'rare' AS "column", (count(*) - count(rare))::DOUBLE AS observed, count(*)::DOUBLE AS total,
       printf('column ''rare'': %.1f%% of %d values missing', (count(*) - count(rare)) * 100.0 / count(*), count(*)) AS message
FROM g HAVING count(rare) * 2 < count(*)
""")
def _(spark, folder):
    gaps = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 6000, F.col("c_acctbal")).alias("rare"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("half"))
    return quality.validate(gaps, strict=True).findings


@query("validate_customers", """
SELECT 'error' AS severity, 'required' AS "check", 'email' AS "column", NULL::DOUBLE AS observed, 2 * count(*)::DOUBLE AS total,
       'required column ''email'' is missing' AS message FROM customer
UNION ALL SELECT 'warning', 'duplicates', NULL, count(*), 2 * count(*), printf('%d duplicate rows among %d', count(*), 2 * count(*)) FROM customer
""")
def _(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
    return quality.validate(customers.unionAll(customers), **quality.CUSTOMER_SCHEMA).findings


@query("encode_labels_fitted", """
WITH d AS (SELECT n_name, dense_rank() OVER (ORDER BY n_name) - 1 AS code FROM nation)
SELECT c_custkey, code::INTEGER AS nation, CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE 0 END::INTEGER AS parity
FROM customer LEFT JOIN d ON n_name = 'NATION_' || (c_nationkey + 5)
""")
def _(spark, folder):
    nations = table(spark, folder, "nation").select(
        F.col("n_name").alias("nation"), F.when(F.col("n_nationkey") % 2 == 0, "odd or even").otherwise("even or odd").alias("parity"))
    root = f"{new_folder(spark)}/encoder"
    encode.fit_label_encoder(nations).save(root)
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 5).cast("string")).alias("nation"),
        F.when(F.col("c_nationkey") % 2 == 0, "odd or even").otherwise("even or odd").alias("parity"))
    return encode.load_label_encoder(spark, root).transform(customers)


@query("scale_and_impute_fitted", """
WITH f AS (SELECT avg(c_acctbal) AS mean, stddev_pop(c_acctbal) AS sd, median(c_acctbal) AS middle FROM customer WHERE c_custkey % 5 > 0)
SELECT s_suppkey, round((coalesce(CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END, middle) - mean) / sd, 6) AS balance FROM supplier, f
""")
def _(spark, folder):
    train = table(spark, folder, "customer").select(F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("balance"))
    other = table(spark, folder, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 > 0, F.col("s_acctbal")).alias("balance"))
    filled = impute.fit_imputer(train, "median", ["balance"]).transform(other)
    return tidy(scale.fit_scaler(train, "standard", "balance").transform(filled), 6)


_PADDED = r"chr(160) || '  ' || replace(text, ' ', chr(9) || ' ' || chr(8195)) || chr(10)"


@query("clean_strings", rf"""
SELECT doc_id, md5(trim(regexp_replace({_PADDED}, '[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))) AS digest
FROM documents
""")
def _(spark, folder):
    wide = F.replace(F.col("text"), F.lit(" "), F.lit("\t  "))
    padded = F.concat(F.lit("   "), wide, F.lit("\n"))
    documents = table(spark, folder, "documents").select("doc_id", padded.alias("text"))
    return clean.clean_string_columns(documents).select("doc_id", F.md5("text").alias("digest"))


@query("convert_dates", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS day
FROM orders
""")
def _(spark, folder):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(status == "O", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise("not a date")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", text.alias("day"))
    return tidy(clean.convert_dates(orders, ["day", "absent"]))


def _impute_sql(qty, price, flag):
    return f"""
WITH {GAPPY_SQL}, f AS (SELECT {qty} AS q, {price} AS p FROM gappy),
m AS (SELECT flag FROM gappy WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
SELECT l_orderkey, round(coalesce(qty, q), 4) AS qty, round(coalesce(price, p), 4) AS price,
       coalesce(g.flag, m.flag) AS flag, status
FROM gappy g, f, m"""


def _most_frequent_sql(column):
    return f"(SELECT {column} FROM gappy WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


for _strategy, _fills in {
    "mean": ("avg(qty)", "avg(price)"),
    "median": ("median(qty)", "median(price)"),
    "most_frequent": (f"any_value({_most_frequent_sql('qty')})", f"any_value({_most_frequent_sql('price')})"),
    "constant": ("0", "0"),
}.items():
    def _run(spark, folder, strategy=_strategy):
        return tidy(impute.impute_missing_values(gappy(spark, folder), strategy))

    query(f"impute_{_strategy}", _impute_sql(*(f if f != "0" else "any_value(0)" for f in _fills), "flag"))(_run)


def _fill_sql(window, pick, partition=""):
    return f"""
WITH e AS (SELECT event_id, ts, user_id, CASE WHEN value > 60 THEN value END AS value FROM events)
SELECT event_id, {pick}(value IGNORE NULLS) OVER ({partition} ORDER BY ts, event_id ROWS BETWEEN {window}) AS value FROM e"""


_PAST = "UNBOUNDED PRECEDING AND CURRENT ROW"
_FUTURE = "CURRENT ROW AND UNBOUNDED FOLLOWING"


def _sparse_events(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", "ts", "user_id", F.when(F.col("value") > 60, F.col("value")).alias("value"))


@query("impute_forward_fill", _fill_sql(_PAST, "last_value"))
def _(spark, folder):
    filled = impute.impute_missing_values(_sparse_events(spark, folder), "ffill", order_by=["ts", "event_id"])
    return filled.select("event_id", "value")


@query("impute_backward_fill", _fill_sql(_FUTURE, "first_value"))
def _(spark, folder):
    filled = impute.impute_missing_values(_sparse_events(spark, folder), "bfill", order_by=["ts", "event_id"])
    return filled.select("event_id", "value")


@query("impute_forward_fill_per_user", _fill_sql(_PAST, "last_value", "PARTITION BY user_id"))
def _(spark, folder):
    events = _sparse_events(spark, folder)
    filled = impute.impute_missing_values(events, "ffill", order_by=["ts", "event_id"], partition_by="user_id")
    return filled.select("event_id", "value")


@query("impute_knn", """
WITH t AS (SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_size END AS a,
                  CASE WHEN p_brand = 'Brand#7' THEN NULL ELSE p_retailprice END AS b FROM part),
d AS (SELECT a, b FROM t WHERE a IS NOT NULL AND b IS NOT NULL),
fa AS (SELECT p_partkey, avg(v) AS v FROM (
  SELECT t.p_partkey, d.a AS v, row_number() OVER (PARTITION BY t.p_partkey ORDER BY (t.b - d.b) * (t.b - d.b), d.a) AS r
  FROM t, d WHERE t.a IS NULL AND t.b IS NOT NULL) WHERE r <= 5 GROUP BY 1),
fb AS (SELECT p_partkey, avg(v) AS v FROM (
  SELECT t.p_partkey, d.b AS v, row_number() OVER (PARTITION BY t.p_partkey ORDER BY (t.a - d.a) * (t.a - d.a), d.b) AS r
  FROM t, d WHERE t.b IS NULL AND t.a IS NOT NULL) WHERE r <= 5 GROUP BY 1)
SELECT t.p_partkey, round(coalesce(t.a, fa.v, (SELECT avg(a) FROM t)), 4) AS size,
       round(coalesce(t.b, fb.v, (SELECT avg(b) FROM t)), 4) AS price
FROM t LEFT JOIN fa USING (p_partkey) LEFT JOIN fb USING (p_partkey)
""")
def _(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_type") != "SMALL", F.col("p_size")).alias("size"),
        F.when(F.col("p_brand") != "Brand#7", F.col("p_retailprice")).alias("price"),
    )
    return tidy(impute.impute_missing_values(part, "knn"))


def _removed_sql(columns):
    steps, source = [], "lineitem"
    for i, c in enumerate(columns):
        steps.append(f"""
b{i} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source}),
s{i} AS (SELECT {source}.* FROM {source}, b{i} WHERE {c} BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1))""")
        source = f"s{i}"
    return f"WITH {','.join(steps)} SELECT l_orderkey, l_linenumber, {', '.join(columns)} FROM {source}"


@query("remove_outliers_iqr", _removed_sql(["l_extendedprice", "l_discount", "l_tax"]))
def _(spark, folder):
    columns = ["l_extendedprice", "l_discount", "l_tax"]
    kept = outliers.remove_outliers(table(spark, folder, "lineitem"), columns, factor=0.5)
    return kept.select("l_orderkey", "l_linenumber", *columns)


@query("remove_outliers_zscore", """
WITH z AS (SELECT *, abs((value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events)) AS z FROM events)
SELECT event_id, value FROM z WHERE z < 3
""")
def _(spark, folder):
    return outliers.remove_outliers(table(spark, folder, "events"), "value", "zscore").select("event_id", "value")


@query("flag_outliers_iqr", """
WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS is_outlier FROM events, b
""")
def _(spark, folder):
    return outliers.flag_outliers(table(spark, folder, "events"), "value").select("event_id", "is_outlier")


@query("flag_outliers_zscore", """
SELECT event_id, abs((value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events)) > 3 AS is_outlier
FROM events
""")
def _(spark, folder):
    return outliers.flag_outliers(table(spark, folder, "events"), "value", "zscore").select("event_id", "is_outlier")


def _scale_sql(center, scale_by):
    def one(c):
        return f"round(({c} - (SELECT {center.format(c=c)} FROM lineitem)) / (SELECT {scale_by.format(c=c)} FROM lineitem), 6) + 0.0 AS {c}"
    return f"SELECT l_orderkey, {one('l_quantity')}, {one('l_extendedprice')} FROM lineitem"


for _method, _parts in {
    "standard": ("avg({c})", "stddev_pop({c})"),
    "minmax": ("min({c})", "max({c}) - min({c})"),
    "robust": ("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
}.items():
    def _run(spark, folder, method=_method):
        lines = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
        return tidy(scale.normalize_numeric_columns(lines, method, ["l_quantity", "l_extendedprice"]), 6)

    query(f"scale_{_method}", _scale_sql(*_parts))(_run)


@query("encode_labels", """
WITH t AS (SELECT p_partkey, CASE WHEN p_size = 7 THEN NULL ELSE p_name END AS p_name, p_type FROM part)
SELECT p_partkey, dense_rank() OVER (ORDER BY coalesce(p_name, 'nan')) - 1 AS p_name, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type
FROM t
""")
def _(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", F.when(F.col("p_size") != 7, F.col("p_name")).alias("p_name"), "p_type")
    return encode.encode_categorical_columns(part)


@query("encode_one_hot", """
SELECT o_orderkey, coalesce(CASE WHEN o_custkey > 700 THEN o_orderstatus END = 'O', false) AS "o_orderstatus_O",
       coalesce(CASE WHEN o_custkey > 700 THEN o_orderstatus END = 'P', false) AS "o_orderstatus_P"
FROM orders
""")
def _(spark, folder):
    status = F.when(F.col("o_custkey") > 700, F.col("o_orderstatus"))
    orders = table(spark, folder, "orders").select("o_orderkey", status.alias("o_orderstatus"))
    return encode.encode_categorical_columns(orders, "o_orderstatus", "onehot")


@query("clean_sequence", """
WITH t AS (
  SELECT p_partkey, upper(p_name) AS name, CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice END AS price FROM part),
k AS (SELECT * FROM t, (SELECT quantile_cont(p_partkey, 0.25) AS a1, quantile_cont(p_partkey, 0.75) AS a3 FROM t)
      WHERE p_partkey BETWEEN a1 - 1.5 * (a3 - a1) AND a3 + 1.5 * (a3 - a1)),
o AS (SELECT k.* FROM k, (SELECT quantile_cont(price, 0.25) AS b1, quantile_cont(price, 0.75) AS b3 FROM k)
      WHERE price BETWEEN b1 - 1.5 * (b3 - b1) AND b3 + 1.5 * (b3 - b1))
SELECT round((p_partkey - avg(p_partkey) OVER ()) / stddev_pop(p_partkey) OVER (), 6) + 0.0 AS p_partkey,
       dense_rank() OVER (ORDER BY name) - 1 AS name,
       round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) + 0.0 AS price
FROM o
""")
def _(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit("\t "), F.upper("p_name"), F.lit("  ")).alias("name"),
        F.when(F.col("p_size") <= 45, F.col("p_retailprice")).alias("price"),
    )
    return tidy(clean.clean(part, normalize=True, encode_categorical=True), 6)
