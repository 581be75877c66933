"""Aggregations, time series and sales breakdowns."""

from pyspark.sql import functions as F

from checks.registry import SALES, query, table, tidy
from comptoir.functions.columns import select_categorical, select_numeric, with_revenue
from comptoir.operators import aggregate as agg
from comptoir.operators import timeseries as ts
from comptoir.operators.merging import MergeAggregate
from comptoir.plans.sales import sales_from_star

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("revenue_projection", f"""
WITH {SALES} SELECT date_part('year', date)::INT AS annee, produit, prix, quantite, round(revenue, 2) AS revenue FROM sales
""")
def _(spark, folder):
    sales = sales_from_star(spark, folder, ["date", "produit", "prix", "quantite"])
    return tidy(with_revenue(sales).select(F.year("date").alias("annee"), "produit", "prix", "quantite", "revenue"), 2)


@query("select_numeric", "SELECT p_partkey, p_size, round(p_retailprice, 4) AS p_retailprice FROM part")
def _(spark, folder):
    return tidy(select_numeric(table(spark, folder, "part")))


@query("select_categorical", "SELECT p_name, p_brand, p_type FROM part")
def _(spark, folder):
    return select_categorical(table(spark, folder, "part"))


@query("sales_kpis", f"""
WITH {SALES}
SELECT round(sum(revenue), 2) AS revenue_total, count(*) AS transaction_count, round(avg(revenue), 4) AS average_basket,
       CAST(sum(quantite) AS BIGINT) AS total_quantity, round(avg(prix), 4) AS average_price,
       count(DISTINCT produit) AS unique_products, count(DISTINCT categorie) AS unique_categories,
       count(DISTINCT ville) AS unique_cities
FROM sales
""")
def _(spark, folder):
    sales = sales_from_star(spark, folder, ["produit", "categorie", "prix", "quantite", "ville"])
    return tidy(agg.calculate_kpis(sales), revenue_total=2)


def _breakdown(key, extra):
    return f"""
WITH {SALES}, g AS (
  SELECT {key}, sum(revenue) AS ca_total, CAST(sum(quantite) AS BIGINT) AS quantite_totale, {extra}
  FROM sales GROUP BY {key})
SELECT * REPLACE (round(ca_total, 2) AS ca_total), round_even(ca_total / sum(ca_total) OVER () * 100, 2) AS ca_percentage
FROM g
"""


@query("sales_by_category", _breakdown("categorie", "round(avg(prix), 4) AS prix_moyen, count(produit) AS nb_transactions"))
def sales_by_category(spark, folder):
    sales = sales_from_star(spark, folder, ["produit", "categorie", "prix", "quantite"])
    return tidy(agg.calculate_sales_by_category(sales), ca_total=2)


@query("sales_by_city", _breakdown("ville", "count(DISTINCT produit) AS nb_produits_uniques"))
def _(spark, folder):
    return tidy(agg.calculate_sales_by_city(sales_from_star(spark, folder, ["produit", "prix", "quantite", "ville"])), 2)


@query("sales_by_source", _breakdown("source", "count(produit) AS nb_transactions"))
def _(spark, folder):
    return tidy(agg.calculate_sales_by_source(sales_from_star(spark, folder, ["produit", "prix", "quantite", "source"])), 2)


def _top(order):
    return f"""
WITH {SALES}
SELECT produit, round(sum(revenue), 2) AS ca_total, CAST(sum(quantite) AS BIGINT) AS quantite_totale,
       round(avg(prix), 4) AS prix_moyen
FROM sales GROUP BY produit ORDER BY {order} DESC, produit LIMIT 10
"""


@query("top_products_by_revenue", _top("sum(revenue)"))
def _(spark, folder):
    return tidy(agg.calculate_top_products(sales_from_star(spark, folder, ["produit", "prix", "quantite"])), ca_total=2)


@query("top_products_by_quantity", _top("sum(quantite)"))
def _(spark, folder):
    sales = sales_from_star(spark, folder, ["produit", "prix", "quantite"])
    return tidy(agg.calculate_top_products(sales, metric="quantite"), ca_total=2)


@query("top_cities", f"""
WITH {SALES} SELECT ville, round(sum(revenue), 2) AS ca_total FROM sales GROUP BY ville
ORDER BY sum(revenue) DESC, ville LIMIT 10
""")
def _(spark, folder):
    cities = agg.calculate_sales_by_city(sales_from_star(spark, folder, ["produit", "prix", "quantite", "ville"]))
    return tidy(agg.top_rows(cities, "ca_total", "ville").select("ville", "ca_total"), 2)


@query("first_rows_in_order", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_orderpriority
FROM orders ORDER BY orders.o_orderdate, o_orderkey LIMIT 1000
""")
def _(spark, folder):
    return tidy(agg.head(table(spark, folder, "orders"), ["o_orderdate", "o_orderkey"], 1000))


@query("group_by_multi", """
WITH t AS (SELECT CASE WHEN l_discount = 0.03 THEN NULL ELSE l_returnflag END AS flag, l_linestatus AS status,
                  CASE WHEN l_tax = 0.02 THEN NULL ELSE l_quantity END AS qty, l_extendedprice AS price FROM lineitem)
SELECT flag, status, sum(coalesce(qty, 0)) AS qty_sum, round(avg(qty), 4) AS qty_mean, count(qty) AS qty_count,
       count(DISTINCT qty) AS qty_nunique, min(price) AS price_min, max(price) AS price_max,
       round(median(price), 4) AS price_median, round(stddev_samp(price), 4) AS price_std,
       round(var_samp(qty), 4) AS qty_var
FROM t WHERE flag IS NOT NULL GROUP BY flag, status
""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_discount") != 0.03, F.col("l_returnflag")).alias("flag"), F.col("l_linestatus").alias("status"),
        F.when(F.col("l_tax") != 0.02, F.col("l_quantity")).alias("qty"), F.col("l_extendedprice").alias("price"),
    )
    return tidy(agg.group_by(lines, ["flag", "status"], {
        "qty": ["sum", "mean", "count", "nunique", "var"], "price": ["min", "max", "median", "std"],
    }))


@query("group_by_sorted", """
SELECT c_mktsegment, round(sum(c_acctbal), 2) AS c_acctbal, count(*) AS c_custkey FROM customer GROUP BY c_mktsegment
""")
def _(spark, folder):
    customer = table(spark, folder, "customer")
    return tidy(agg.group_by(customer, "c_mktsegment", {"c_acctbal": "sum", "c_custkey": "count"}, "c_acctbal"), 2)


@query("group_by_first_last", """
SELECT o_orderpriority, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice_first,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice_last
FROM orders GROUP BY o_orderpriority
""")
def _(spark, folder):
    orders = table(spark, folder, "orders")
    return agg.group_by(orders, "o_orderpriority", {"o_totalprice": ["first", "last"]}, order_by=["o_orderdate", "o_orderkey"])


def spread(column):
    return F.max(column) - F.min(column)


@query("group_by_merge", f"""
WITH {SALES}
SELECT categorie, round(sum(prix * quantite) / sum(quantite), 4) AS prix, sum(least(quantite, 40))::BIGINT AS quantite, count(*) AS produit
FROM sales GROUP BY categorie
""")
def group_by_merge(spark, folder):
    weighted = MergeAggregate(
        init=lambda: (0.0, 0.0), update=lambda s, v, w: (s[0] + float((v * w).sum()), s[1] + float(w[v.notna()].sum())),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]), finish=lambda s: s[0] / s[1] if s[1] else None,
        state="total double, weight double", result="double", columns=("quantite",), name="weighted_mean")
    capped = MergeAggregate(
        init=lambda: (0,), update=lambda s, v: (s[0] + int(v.clip(upper=40).sum()),), merge=lambda a, b: (a[0] + b[0],),
        finish=lambda s: s[0], state="total bigint", result="bigint", name="capped_sum")
    sales = sales_from_star(spark, folder, ["categorie", "prix", "quantite", "produit"])
    return tidy(agg.group_by(sales, "categorie", {"prix": weighted, "quantite": capped, "produit": "count"}))


@query("pivot_merge", f"""
WITH {SALES}
SELECT categorie, max(quantite) FILTER (ville = 'NATION_1') - min(quantite) FILTER (ville = 'NATION_1') AS "NATION_1",
       max(quantite) FILTER (ville = 'NATION_2') - min(quantite) FILTER (ville = 'NATION_2') AS "NATION_2"
FROM sales WHERE ville IN ('NATION_1', 'NATION_2') GROUP BY categorie
""")
def _(spark, folder):
    span = MergeAggregate(
        init=lambda: (1 << 62, -(1 << 62)), update=lambda s, v: (min(s[0], int(v.min())), max(s[1], int(v.max()))),
        merge=lambda a, b: (min(a[0], b[0]), max(a[1], b[1])), finish=lambda s: s[1] - s[0],
        state="low bigint, high bigint", result="int", name="span")
    sales = sales_from_star(spark, folder, ["categorie", "ville", "quantite"]).filter("ville IN ('NATION_1', 'NATION_2')")
    return agg.pivot_table(sales, "categorie", "ville", "quantite", span)


@query("resample_merge", f"""
WITH {SALES}
SELECT strftime(last_day(date::DATE), '%Y-%m-%d') AS date, sum(least(quantite, 40))::BIGINT AS quantite FROM sales GROUP BY 1
""")
def _(spark, folder):
    capped = MergeAggregate(
        init=lambda: (0,), update=lambda s, v: (s[0] + int(v.clip(upper=40).sum()),), merge=lambda a, b: (a[0] + b[0],),
        finish=lambda s: s[0], state="total bigint", result="bigint", name="capped_sum")
    return tidy(ts.resample_timeseries(sales_from_star(spark, folder, ["date", "quantite"]), "date", "M", {"quantite": capped}))


@query("group_by_callable", """
SELECT p_type, round(max(p_retailprice) - min(p_retailprice), 4) AS p_retailprice_spread,
       round(avg(p_retailprice), 4) AS p_retailprice_mean
FROM part GROUP BY p_type
""")
def _(spark, folder):
    return tidy(agg.group_by(table(spark, folder, "part"), "p_type", {"p_retailprice": [spread, "mean"]}))


def _cells(expression, table_sql="sales", column="source", values=PRIORITIES):
    cells = ", ".join(f"""{expression.format(c=f"{column} = '{v}'")} AS "{v}" """ for v in values)
    return f"WITH {SALES} SELECT categorie, {cells} FROM {table_sql} GROUP BY categorie"


@query("pivot_sum", _cells("CAST(sum(quantite) FILTER ({c}) AS BIGINT)"))
def pivot_sum(spark, folder):
    return agg.pivot_table(sales_from_star(spark, folder, ["categorie", "source", "quantite"]), "categorie", "source", "quantite")


@query("pivot_mean_filled", """
SELECT l_returnflag, coalesce(round(avg(l_extendedprice) FILTER (l_linestatus = 'F' AND l_quantity > 25), 4), 0) AS "F",
       coalesce(round(avg(l_extendedprice) FILTER (l_linestatus = 'O' AND l_quantity > 25), 4), 0) AS "O"
FROM lineitem GROUP BY l_returnflag
""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("price", F.when(F.col("l_quantity") > 25, F.col("l_extendedprice")))
    return tidy(agg.pivot_table(lines, "l_returnflag", "l_linestatus", "price", "mean", fill_value=0))


@query("pivot_two_columns", """
SELECT l_linenumber, round(sum(l_tax) FILTER (l_returnflag = 'A' AND l_linestatus = 'F'), 2) AS "A_F",
       round(sum(l_tax) FILTER (l_returnflag = 'A' AND l_linestatus = 'O'), 2) AS "A_O",
       round(sum(l_tax) FILTER (l_returnflag = 'N' AND l_linestatus = 'F'), 2) AS "N_F",
       round(sum(l_tax) FILTER (l_returnflag = 'N' AND l_linestatus = 'O'), 2) AS "N_O",
       round(sum(l_tax) FILTER (l_returnflag = 'R' AND l_linestatus = 'F'), 2) AS "R_F",
       round(sum(l_tax) FILTER (l_returnflag = 'R' AND l_linestatus = 'O'), 2) AS "R_O"
FROM lineitem GROUP BY l_linenumber
""")
def _(spark, folder):
    return tidy(agg.pivot_table(table(spark, folder, "lineitem"), "l_linenumber", ["l_returnflag", "l_linestatus"], "l_tax"), 2)


@query("pivot_callable", _cells("max(prix) FILTER ({c}) - min(prix) FILTER ({c})").replace("max(", "round(max(").replace(") AS \"", "), 4) AS \""))
def _(spark, folder):
    return tidy(agg.pivot_table(sales_from_star(spark, folder, ["categorie", "source", "prix"]), "categorie", "source", "prix", spread))


@query("cross_tab", _cells("count(*) FILTER ({c})"))
def _(spark, folder):
    return agg.cross_tab(sales_from_star(spark, folder, ["categorie", "source"]), "categorie", "source")


@query("cross_tab_percent", _cells("round(count(*) FILTER ({c}) * 100.0 / (SELECT count(*) FROM sales), 4)"))
def _(spark, folder):
    return tidy(agg.cross_tab(sales_from_star(spark, folder, ["categorie", "source"]), "categorie", "source", normalize=True))


@query("overview_counts", f"""
WITH {SALES} SELECT count(*) AS transactions, count(DISTINCT produit) AS produits, count(DISTINCT categorie) AS categories,
count(DISTINCT ville) AS villes FROM sales
""")
def _(spark, folder):
    return agg.overview(sales_from_star(spark, folder, ["produit", "categorie", "ville"]))


@query("data_period", """
SELECT strftime(min(o_orderdate), '%d/%m/%Y') || ' - ' || strftime(max(o_orderdate), '%d/%m/%Y') AS period FROM orders
""")
def _(spark, folder):
    return agg.period_info(table(spark, folder, "orders"), "o_orderdate")


@query("bar_aggregate", "SELECT c_mktsegment, round(sum(c_acctbal), 2) AS c_acctbal FROM customer GROUP BY c_mktsegment")
def _(spark, folder):
    return tidy(agg.bar_aggregate(table(spark, folder, "customer"), "c_mktsegment", "c_acctbal"), 2)


# Period label and the calendar between the first and last label, per frequency.
_LABEL = {
    "D": "CAST(d AS DATE)",
    "W": "CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE)",
    "M": "last_day(CAST(d AS DATE))",
    "Q": "last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE))",
    "Y": "make_date(CAST(year(d) AS INT), 12, 31)",
}
_STEP = {"D": "1 DAY", "W": "7 DAY", "M": "1 MONTH", "Q": "3 MONTH", "Y": "12 MONTH"}


def _calendar(freq, source, date, columns):
    """CTEs ``g`` (aggregates per label) and ``spine`` (all labels)."""
    start = "CAST(lo AS TIMESTAMP)" if freq in "DW" else "date_trunc('month', CAST(lo AS TIMESTAMP))"
    label = "CAST(x AS DATE)" if freq in "DW" else "last_day(CAST(x AS DATE))"
    return f"""
g AS (SELECT {_LABEL[freq]} AS p, {columns} FROM (SELECT {date} AS d, * FROM {source}) WHERE d IS NOT NULL GROUP BY 1),
spine AS (SELECT {label} AS p FROM (SELECT min(p) AS lo, max(p) AS hi FROM g),
          LATERAL unnest(generate_series({start}, CAST(hi AS TIMESTAMP), INTERVAL {_STEP[freq]})) AS s(x))"""


def _resample_sql(freq):
    dated = "CASE WHEN o_totalprice > 450000 THEN o_orderdate END"
    columns = "sum(o_totalprice) AS s, count(o_custkey) AS c, max(o_orderkey) AS m"
    return f"""
WITH {_calendar(freq, "orders", dated, columns)}
SELECT strftime(p, '%Y-%m-%d') AS date, round(coalesce(s, 0), 2) AS o_totalprice, coalesce(c, 0) AS o_custkey, m AS o_orderkey
FROM spine LEFT JOIN g USING (p)
"""


def _resample(freq):
    def run(spark, folder):
        big = F.when(F.col("o_totalprice") > 450000, F.col("o_orderdate"))
        orders = table(spark, folder, "orders").withColumn("date", big)
        return tidy(ts.resample_timeseries(orders, "date", freq, {"o_totalprice": "sum", "o_custkey": "count", "o_orderkey": "max"}), 2)
    return run


for _freq, _name in {"D": "daily", "W": "weekly", "M": "monthly", "Q": "quarterly", "Y": "yearly"}.items():
    query(f"resample_{_name}", _resample_sql(_freq))(_resample(_freq))


def _fill_sql(direction):
    dated = "CASE WHEN o_totalprice > 450000 THEN o_orderdate END"
    columns = "avg(o_totalprice) AS a, count(*) AS c, max(o_custkey) - min(o_custkey) AS s"
    order, pick = ("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "last_value") if direction == "ffill" else (
        "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING", "first_value")
    return f"""
WITH {_calendar("D", "orders", dated, columns)}
SELECT strftime(p, '%Y-%m-%d') AS date, round({pick}(a IGNORE NULLS) OVER (ORDER BY p {order}), 6) AS o_totalprice,
       coalesce(c, 0) AS o_orderkey, {pick}(s IGNORE NULLS) OVER (ORDER BY p {order}) AS o_custkey
FROM spine LEFT JOIN g USING (p)
"""


def _fill(direction):
    def run(spark, folder):
        big = F.when(F.col("o_totalprice") > 450000, F.col("o_orderdate"))
        orders = table(spark, folder, "orders").withColumn("date", big)
        wanted = {"o_totalprice": "mean", "o_orderkey": "count", "o_custkey": spread}
        return tidy(ts.resample_timeseries(orders, "date", "D", wanted, fill_method=direction), 6)
    return run


for _direction in ("ffill", "bfill"):
    query(f"resample_{_direction}", _fill_sql(_direction))(_fill(_direction))


def _trend_sql(freq):
    columns = "sum(revenue) AS ca, CAST(sum(quantite) AS BIGINT) AS q, count(produit) AS n"
    change = "round(CASE WHEN lag({c}) OVER w <> 0 THEN ({c} / lag({c}) OVER w - 1) * 100 END, 4)"
    return f"""
WITH {SALES}, {_calendar(freq, "sales", "sales.date", columns)},
t AS (SELECT p, coalesce(ca, 0) AS ca, coalesce(q, 0) AS q, coalesce(n, 0) AS n FROM spine LEFT JOIN g USING (p))
SELECT strftime(p, '%Y-%m-%d') AS date, round(ca, 2) AS ca_total, q AS quantite_totale, n AS nb_transactions,
       {change.format(c="ca")} AS ca_variation_pct, {change.format(c="q")} AS quantite_variation_pct,
       CASE WHEN count(*) OVER (ORDER BY p ROWS 2 PRECEDING) = 3
            THEN round(avg(ca) OVER (ORDER BY p ROWS 2 PRECEDING), 4) END AS ca_ma3
FROM t WINDOW w AS (ORDER BY p)
"""


@query("trend_monthly", _trend_sql("M"))
def trend_monthly(spark, folder):
    sales = sales_from_star(spark, folder, ["date", "produit", "prix", "quantite"])
    return tidy(ts.calculate_trend_analysis(sales, "date"), ca_total=2)


@query("trend_weekly", _trend_sql("W"))
def _(spark, folder):
    sales = sales_from_star(spark, folder, ["date", "produit", "prix", "quantite"])
    return tidy(ts.calculate_trend_analysis(sales, "date", "W"), ca_total=2)


@query("first_purchase", """
SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS first_date FROM orders GROUP BY o_custkey
""")
def _(spark, folder):
    return tidy(ts.first_purchase(table(spark, folder, "orders"), "o_orderdate", "o_custkey"))


@query("cohort_analysis", f"""
WITH {SALES}, f AS (
  SELECT *, date_trunc('month', date) AS m, date_trunc('month', min(date) OVER (PARTITION BY customer_id)) AS cohort FROM sales)
SELECT strftime(cohort, '%Y-%m-%d') AS cohort,
       CAST((year(m) - year(cohort)) * 12 + month(m) - month(cohort) AS INT) AS cohort_age,
       count(DISTINCT customer_id) AS customer_id, round(sum(revenue), 2) AS revenue
FROM f GROUP BY 1, 2
""")
def _(spark, folder):
    sales = with_revenue(sales_from_star(spark, folder, ["date", "prix", "quantite", "customer_id"]))
    return tidy(ts.calculate_cohort_analysis(sales, "date", "customer_id"), 2)
