"""Chart series."""

from pyspark.sql import functions as F

from checks.registry import SALES, query, table, tidy
from comptoir.operators import aggregate as agg
from comptoir.operators import chartdata
from comptoir.plans.sales import sales_from_star


@query("chart_bar_by_color", f"""
WITH {SALES} SELECT categorie, source, sum(quantite)::BIGINT AS quantite FROM sales GROUP BY ALL
""")
def _(spark, folder):
    return chartdata.bar_totals(sales_from_star(spark, folder, ["categorie", "source", "quantite"]), "categorie", "quantite", "source")


@query("chart_line_series", """
SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, unnest(['o_custkey', 'o_totalprice']) AS series,
       unnest([o_custkey::DOUBLE, o_totalprice]) AS value
FROM orders
""")
def _(spark, folder):
    return tidy(chartdata.line(table(spark, folder, "orders"), "o_orderdate", ["o_totalprice", "o_custkey"]))


@query("chart_pie_share", """
SELECT c_mktsegment, round(sum(c_acctbal), 2) AS c_acctbal, round_even(sum(c_acctbal) / sum(sum(c_acctbal)) OVER () * 100, 2) AS share
FROM customer GROUP BY c_mktsegment
""")
def _(spark, folder):
    return tidy(chartdata.pie(table(spark, folder, "customer"), "c_mktsegment", "c_acctbal"), 2)


@query("chart_pie_top_cities", f"""
WITH {SALES}, t AS (SELECT ville, sum(revenue) AS r FROM sales GROUP BY ville ORDER BY r DESC, ville LIMIT 10)
SELECT ville, round(r, 2) AS ca_total, round_even(r / sum(r) OVER () * 100, 2) AS share FROM t
""")
def _(spark, folder):
    cities = agg.calculate_sales_by_city(sales_from_star(spark, folder, ["produit", "prix", "quantite", "ville"]))
    return tidy(chartdata.pie(cities, "ville", "ca_total", top=10), 2)


@query("chart_scatter", "SELECT p_size, p_retailprice, p_brand FROM part")
def _(spark, folder):
    return chartdata.scatter(table(spark, folder, "part"), "p_size", "p_retailprice", color="p_brand")


@query("chart_trend_line", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem GROUP BY l_returnflag
""")
def _(spark, folder):
    return tidy(chartdata.trend_line(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag"))


@query("chart_heatmap", """
SELECT 'p_size' AS "row", 'p_size' AS "column", 1.0 AS value UNION ALL SELECT 'p_retailprice', 'p_retailprice', 1.0
UNION ALL SELECT 'p_size', 'p_retailprice', round(corr(p_size, p_retailprice), 6) FROM part
UNION ALL SELECT 'p_retailprice', 'p_size', round(corr(p_size, p_retailprice), 6) FROM part
""")
def _(spark, folder):
    return tidy(chartdata.heatmap(table(spark, folder, "part").select("p_size", "p_retailprice")), 6)


@query("chart_matrix_cells", f"""
WITH {SALES} SELECT categorie AS "row", source AS "column", sum(quantite)::DOUBLE AS value FROM sales GROUP BY ALL
""")
def _(spark, folder):
    sales = sales_from_star(spark, folder, ["categorie", "source", "quantite"])
    return chartdata.matrix_cells(agg.pivot_table(sales, "categorie", "source", "quantite"), "categorie")


@query("chart_histogram", """
WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 30)) + 1, 30) AS INT) AS bin, count(*) AS n FROM events, e GROUP BY 1)
SELECT s.bin::INT AS bin, round(lo + (s.bin - 1) * (hi - lo) / 30, 4) AS low, round(lo + s.bin * (hi - lo) / 30, 4) AS high,
       coalesce(n, 0) AS count
FROM e, generate_series(1, 30) AS s(bin) LEFT JOIN c ON c.bin = s.bin
""")
def histogram(spark, folder):
    return tidy(chartdata.histogram(table(spark, folder, "events"), "value"))


@query("chart_density", """
WITH e AS (SELECT count(*) AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) * power(count(*), -0.2) AS h FROM events),
v AS (SELECT value, count(*) AS c FROM events GROUP BY value),
g AS (SELECT lo + i * (hi - lo) / 99 AS x, n, h FROM e, generate_series(0, 99) AS s(i))
SELECT round(x, 4) AS x, round(sum(c * exp(-power((x - value) / h, 2) / 2)) / any_value(n * h * sqrt(2 * pi())), 8) AS density
FROM g, v GROUP BY x
""")
def density(spark, folder):
    return tidy(chartdata.density(table(spark, folder, "events"), "value"), density=8)


_BOX = """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS q2, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
r AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM events JOIN q USING (event_type))"""


@query("chart_box", f"""{_BOX}
SELECT event_type, count(*) AS count, round(q1, 4) AS q1, round(q2, 4) AS median, round(q3, 4) AS q3,
       round(least(min(value) FILTER (inside), q1), 4) AS whisker_low, round(greatest(max(value) FILTER (inside), q3), 4) AS whisker_high,
       count(*) FILTER (NOT inside) AS outliers
FROM r GROUP BY event_type, q1, q2, q3
""")
def box(spark, folder):
    return tidy(chartdata.box(table(spark, folder, "events"), "value", "event_type"))


@query("chart_box_outliers", f"{_BOX} SELECT event_type, value FROM r WHERE NOT inside")
def _(spark, folder):
    return chartdata.box_outliers(table(spark, folder, "events"), "value", "event_type")


@query("chart_dashboard", f"""
WITH {SALES} SELECT 'Catégories' AS chart, categorie AS x, round(sum(revenue), 2) AS y FROM sales GROUP BY categorie
UNION ALL SELECT 'Chart 2', source, round(sum(revenue), 2) FROM sales GROUP BY source
""")
def _(spark, folder):
    sales = sales_from_star(spark, folder, ["produit", "categorie", "prix", "quantite", "source"])
    series = chartdata.dashboard([
        {"type": "bar", "title": "Catégories", "data": agg.calculate_sales_by_category(sales), "x": "categorie", "y": "ca_total"},
        {"data": agg.calculate_sales_by_source(sales), "x": "source", "y": "ca_total"},
        {"type": "line", "data": sales, "x": "categorie", "y": "prix"},
    ])
    parts = [s.toDF("x", "y").select(F.lit(name).alias("chart"), "x", F.round("y", 2).alias("y")) for name, s in series.items()]
    return parts[0].unionByName(parts[1])
