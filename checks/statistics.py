"""Descriptive statistics, correlation and tests."""

from functools import reduce

from pyspark.sql import functions as F

from checks.cleaning import GAPPY_SQL, gappy
from checks.registry import SQL, cells, cells_sql, query, table, tidy
from comptoir.functions import pvalues
from comptoir.operators import correlation, hypothesis, outliers, stats


def _summary_sql(column, source, expression=None):
    c = expression or column
    return f"""
SELECT '{column}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS median,
       round(quantile_cont({c}, 0.75), 4) AS q75, max({c})::DOUBLE AS max, round(skewness({c}), 4) + 0.0 AS skewness,
       round(kurtosis({c}), 4) + 0.0 AS kurtosis
FROM {source}"""


@query("describe_column", _summary_sql("value", "events"))
def _(spark, folder):
    return tidy(stats.describe(table(spark, folder, "events"), "value"))


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_all", " UNION ALL ".join(_summary_sql(c, "lineitem") for c in _NUMERIC))
def describe_all(spark, folder):
    return tidy(stats.describe(table(spark, folder, "lineitem").select(*_NUMERIC)))


_TENTHS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query("percentiles", "SELECT unnest([" + ", ".join(map(str, _TENTHS)) + "])::DOUBLE AS percentile, round(unnest(quantile_cont("
       "l_extendedprice, [" + ", ".join(map(str, _TENTHS)) + "])), 4) AS value FROM lineitem")
def percentiles(spark, folder):
    return tidy(stats.percentiles(table(spark, folder, "lineitem"), "l_extendedprice"))


@query("profile_counts", "SELECT count(*) AS n_rows, 6 AS n_columns, 3 AS n_numeric, 2 AS n_categorical FROM orders")
def _(spark, folder):
    return stats.profile_counts(table(spark, folder, "orders"))


def _outliers_sql(column):
    return f"""
SELECT '{column}' AS "column", (SELECT count(*) FROM lineitem WHERE {column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1)) AS count
FROM (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM lineitem)"""


@query("outlier_counts", " UNION ALL ".join(_outliers_sql(c) for c in _NUMERIC))
def _(spark, folder):
    return outliers.outlier_counts(table(spark, folder, "lineitem"), _NUMERIC)


def _pairs(names):
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]


def _matrix_sql(names, pair_sql, with_sql=""):
    upper = [f"SELECT '{a}' AS a, '{b}' AS b, ({pair_sql(a, b)}) AS r" for a, b in _pairs(names)]
    same = [f"SELECT '{a}' AS a, '{a}' AS b, 1.0 AS r" for a in names]
    return f"""
{with_sql or "WITH"} u AS ({" UNION ALL ".join(upper + same)})
SELECT a AS column1, b AS column2, round(r, 6) + 0.0 AS correlation FROM u
UNION ALL SELECT b, a, round(r, 6) + 0.0 FROM u WHERE a <> b"""


@query("correlation_pearson", _matrix_sql(_NUMERIC, lambda a, b: f"SELECT corr({a}, {b}) FROM lineitem"))
def _(spark, folder):
    return tidy(correlation.correlation_matrix(table(spark, folder, "lineitem").select(*_NUMERIC)), 6)


@query("correlation_pearson_with_gaps", _matrix_sql(
    ["l_orderkey", "qty", "price"], lambda a, b: f"SELECT corr({a}, {b}) FROM gappy", f"WITH {GAPPY_SQL},"))
def _(spark, folder):
    return tidy(correlation.correlation_matrix(gappy(spark, folder)), 6)


def _spearman_pair(a, b):
    return f"""
SELECT corr(ra, rb) FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
  FROM gappy WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query("correlation_spearman", _matrix_sql(["l_orderkey", "qty", "price"], _spearman_pair, f"WITH {GAPPY_SQL},"))
def spearman(spark, folder):
    return tidy(correlation.correlation_matrix(gappy(spark, folder), "spearman"), 6)


def _kendall_pair(a, b):
    return f"""
WITH c AS (SELECT {a} AS x, {b} AS y, count(*) AS n FROM lineitem GROUP BY 1, 2),
p AS (SELECT sum(s.n * t.n * sign(t.x - s.x) * sign(t.y - s.y)) / 2 AS s FROM c AS s, c AS t),
tx AS (SELECT sum(n * (n - 1) / 2) AS t FROM (SELECT sum(n) AS n FROM c GROUP BY x)),
ty AS (SELECT sum(n * (n - 1) / 2) AS t FROM (SELECT sum(n) AS n FROM c GROUP BY y)),
m AS (SELECT sum(n) * (sum(n) - 1) / 2 AS t FROM c)
SELECT p.s / (sqrt(m.t - tx.t) * sqrt(m.t - ty.t)) FROM p, tx, ty, m"""


_DISCRETE = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("correlation_kendall", _matrix_sql(_DISCRETE, _kendall_pair))
def kendall(spark, folder):
    return tidy(correlation.correlation_matrix(table(spark, folder, "lineitem").select(*_DISCRETE), "kendall"), 6)


@query("strong_correlations", """
SELECT 'l_quantity' AS column1, 'l_extendedprice' AS column2, round(corr(l_quantity, l_extendedprice), 6) AS correlation
FROM lineitem HAVING abs(corr(l_quantity, l_extendedprice)) >= 0.002
UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6) FROM lineitem HAVING abs(corr(l_quantity, l_tax)) >= 0.002
UNION ALL SELECT 'l_quantity', 'twice', 1.0 FROM lineitem HAVING count(*) > 0
UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem HAVING abs(corr(l_extendedprice, l_tax)) >= 0.002
UNION ALL SELECT 'l_extendedprice', 'twice', round(corr(l_quantity, l_extendedprice), 6) FROM lineitem HAVING abs(corr(l_quantity, l_extendedprice)) >= 0.002
UNION ALL SELECT 'l_tax', 'twice', round(corr(l_quantity, l_tax), 6) FROM lineitem HAVING abs(corr(l_quantity, l_tax)) >= 0.002
""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_tax", (F.col("l_quantity") * 2).alias("twice"))
    return tidy(correlation.strong_correlations(lines, 0.002), 6)


# Tail of a density by Simpson's rule in 20,000 steps: independent of the continued fractions under test.
def _simpson(density, upper):
    return f"""(SELECT sum(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {density}) * ({upper}) / 20000 / 3
       FROM (SELECT i, ({upper}) * i / 20000 AS u FROM generate_series(0, 20000) AS g(i)))"""


_T_DENSITY = "exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi()) - (dof + 1) / 2 * ln(1 + u * u / dof))"
_CHI2_DENSITY = "CASE WHEN u > 0 THEN exp((dof / 2 - 1) * ln(u) - u / 2 - dof / 2 * ln(2) - lgamma(dof / 2)) ELSE 0 END"


@query("t_test", f"""
WITH s AS (
  SELECT count(*) FILTER (g = 'A') AS n1, count(*) FILTER (g = 'R') AS n2, avg(v) FILTER (g = 'A') AS m1, avg(v) FILTER (g = 'R') AS m2,
         var_samp(v) FILTER (g = 'A') AS v1, var_samp(v) FILTER (g = 'R') AS v2
  FROM (SELECT l_returnflag AS g, l_extendedprice AS v FROM lineitem)),
t AS (SELECT n1 + n2 - 2.0 AS dof, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS statistic FROM s),
p AS (SELECT *, 1 - 2 * {_simpson(_T_DENSITY, "abs(statistic)")} AS p FROM t)
SELECT round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, p < 0.05 AS significant FROM p
""")
def _(spark, folder):
    return tidy(hypothesis.t_test_independent(table(spark, folder, "lineitem"), "l_extendedprice", "l_returnflag", "A", "R"), 6)


def _chi2_sql(a, b, source):
    return f"""
WITH c AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {source} GROUP BY 1, 2),
grid AS (SELECT x.a, y.b, coalesce(c.n, 0) AS o, r.n * k.n * 1.0 / (SELECT sum(n) FROM c) AS e
         FROM (SELECT DISTINCT a FROM c) x, (SELECT DISTINCT b FROM c) y LEFT JOIN c ON c.a = x.a AND c.b = y.b
         JOIN (SELECT a, sum(n) AS n FROM c GROUP BY a) r ON r.a = x.a JOIN (SELECT b, sum(n) AS n FROM c GROUP BY b) k ON k.b = y.b),
d AS (SELECT ((SELECT count(DISTINCT a) FROM c) - 1) * ((SELECT count(DISTINCT b) FROM c) - 1) * 1.0 AS dof),
t AS (SELECT dof, (SELECT sum(power(CASE WHEN dof = 1 THEN greatest(abs(o - e) - 0.5, 0) ELSE abs(o - e) END, 2) / e) FROM grid) AS statistic FROM d)"""


@query("chi2_test", _chi2_sql("l_returnflag", "l_linenumber", "lineitem") + f""",
p AS (SELECT *, 1 - {_simpson(_CHI2_DENSITY, "statistic")} AS p FROM t)
SELECT round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, p < 0.05 AS significant FROM p
""")
def _(spark, folder):
    return tidy(hypothesis.chi2_test(table(spark, folder, "lineitem"), "l_returnflag", "l_linenumber"), 6)


@query("chi2_test_two_by_two", _chi2_sql("l_linestatus", "l_returnflag = 'A'", "lineitem") + f""",
p AS (SELECT *, 1 - 2 * {_simpson("exp(-u * u / 2) / sqrt(2 * pi())", "sqrt(statistic)")} AS p FROM t)
SELECT round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, p < 0.05 AS significant FROM p
""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("returned", F.col("l_returnflag") == "A")
    return tidy(hypothesis.chi2_test(lines, "l_linestatus", "returned"), 6)


@query("confidence_interval", """
WITH s AS (SELECT count(*) - 1 AS v, avg(value) AS m, stddev_samp(value) / sqrt(count(*)) AS e, 1.959963984540054 AS z FROM events),
q AS (SELECT *, z + (z ** 3 + z) / (4 * v) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * v ** 2) AS t FROM s)
SELECT round(m, 4) AS mean, round(m - t * e, 4) AS lower, round(m + t * e, 4) AS upper FROM q
""")
def _(spark, folder):
    return tidy(hypothesis.confidence_interval(table(spark, folder, "events"), "value"))


def _pelz_good(z, n):
    """P(D < d) for z = sqrt(n) d by the expansion in 1 / sqrt(n), in SQL; at sizes of the test tables it agrees with the exact law to 7 digits."""
    def total(term):
        return f"list_sum(list_transform(range(-30, 31), lambda k: {term}))"

    odd, even = "((pi() * (k + 0.5)) ** 2)", "((pi() * k) ** 2)"
    at_odd, at_even = f"exp(-{odd} / (2 * {z} * {z}))", f"exp(-{even} / (2 * {z} * {z}))"
    return f"""sqrt(pi() / 2) * ({total(at_odd)} / {z} + {total(f"({odd} - {z} ** 2) * {at_odd}")} / (6 * {z} ** 4 * sqrt({n}))
  + ({total(f"(6 * {z} ** 6 + 2 * {z} ** 4 + (2 * {z} ** 4 - 5 * {z} ** 2) * {odd} + (1 - 2 * {z} ** 2) * {odd} ** 2) * {at_odd}")} / (72 * {z} ** 7)
     - {total(f"{even} * {at_even}")} / (36 * {z} ** 3)) / {n}
  + ({total(f"((5 - 30 * {z} ** 2) * {odd} ** 3 + (212 * {z} ** 4 - 60 * {z} ** 2) * {odd} ** 2 + (135 * {z} ** 4 - 96 * {z} ** 6) * {odd} - 30 * {z} ** 6 - 90 * {z} ** 8) * {at_odd}")} / (6480 * {z} ** 10)
     + {total(f"(3 * {z} ** 2 * {even} - {even} ** 2) * {at_even}")} / (216 * {z} ** 6)) / {n} ** 1.5)"""


_BELOW = f"""CASE WHEN abs(x) > 9 THEN (sign(x) + 1) / 2 ELSE 0.5 + sign(x) * {_simpson("exp(-u * u / 2) / sqrt(2 * pi())", "abs(x)").replace("20000", "400")} END"""
# The mean prices of each customer's and each supplier's lines are near a normal law, so that p-values are neither 0 nor 1.
_MEANS = "SELECT {key} AS key, avg(l_extendedprice) AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY {key}"


@query("normality_kolmogorov", f"""
WITH m AS ({_MEANS.format(key="o_custkey")}), v AS (SELECT (x - avg(x) OVER ()) / stddev_pop(x) OVER () * 1.02 + 0.01 AS x FROM m),
r AS (SELECT DISTINCT x, rank() OVER (ORDER BY x) - 1 AS before, count(*) OVER (PARTITION BY x) AS n, count(*) OVER () AS total FROM v),
p AS (SELECT *, {_BELOW} AS f FROM r),
d AS (SELECT max(greatest((before + n) / total - f, f - before / total)) AS d, any_value(total)::DOUBLE AS n FROM p),
z AS (SELECT d, n, sqrt(n) * d AS z FROM d), q AS (SELECT d, 1 - {_pelz_good("z", "n")} AS p FROM z)
SELECT round(d, 6) AS statistic, round(p, 4) AS p_value, p > 0.05 AS is_normal FROM q
""")
def ks(spark, folder):
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    means = lines.groupBy("o_custkey").agg(F.avg("l_extendedprice").alias("x"))
    facts = means.agg(F.struct(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))).scalar()
    standard = means.select(((F.col("x") - facts.getField("mean")) / facts.getField("sd") * 1.02 + 0.01).alias("x"))
    return tidy(hypothesis.test_normality(standard, "x", "kstest"), 6, p_value=4)


def _quantile(p):
    """The normal quantile of an expression in SQL."""
    def ratio(part, r):
        above, under = (reduce(lambda total, c: f"({total} * {r} + {c!r}::DOUBLE)", co[1:], f"{co[0]!r}::DOUBLE") for co in pvalues._QUANTILE[part])
        return f"({above} / {under})"

    q, r = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    return f"""CASE WHEN abs{q} <= 0.425 THEN {q} * {ratio(0, f"(0.180625 - {q} * {q})")}
WHEN {r} <= 5 THEN sign{q} * {ratio(1, f"({r} - 1.6)")} ELSE sign{q} * {ratio(2, f"({r} - 5)")} END"""


def _poly(coefficients, x):
    return "(" + " + ".join(f"{c!r}::DOUBLE * {x} ** {i}" for i, c in enumerate(coefficients)) + ")"


@query("normality_shapiro", f"""
WITH m AS (SELECT l_suppkey AS key, avg(l_extendedprice) AS y FROM lineitem GROUP BY l_suppkey),
r AS (SELECT y, row_number() OVER (ORDER BY y) AS k, (count(*) OVER ())::DOUBLE AS n, avg(y) OVER () AS mean FROM m),
p AS (SELECT *, (k - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM r), s AS (SELECT *, {_quantile("p")} AS score FROM p),
t AS (SELECT any_value(n) AS n, sum((y - mean) * score) AS total, sum(score * score) AS squares, sum((y - mean) ** 2) AS spread,
  max(y) - min(y) AS outer_gap, max(y) FILTER (k = n - 1) - max(y) FILTER (k = 2) AS inner_gap,
  -max(score) FILTER (k = 1) AS m1, -max(score) FILTER (k = 2) AS m2 FROM s),
a AS (SELECT *, m1 / sqrt(squares) + {_poly(pvalues._WEIGHT_LAST, "(1 / sqrt(n))")} AS a1, m2 / sqrt(squares) + {_poly(pvalues._WEIGHT_NEXT, "(1 / sqrt(n))")} AS a2 FROM t),
w AS (SELECT n, (a1 * outer_gap + a2 * inner_gap + (total - m1 * outer_gap - m2 * inner_gap)
  / sqrt((squares - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))) ** 2 / spread AS w FROM a),
z AS (SELECT w, (ln(1 - w) - {_poly(pvalues._LARGE_MEAN, "ln(n)")}) / exp({_poly(pvalues._LARGE_LOG_SD, "ln(n)")}) AS x FROM w),
q AS (SELECT w, 1 - {_BELOW} AS p FROM z)
SELECT round(w, 6) AS statistic, round(p, 6) AS p_value, p > 0.05 AS is_normal FROM q
""")
def shapiro(spark, folder):
    means = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.avg("l_extendedprice").alias("mean_price"))
    return tidy(hypothesis.test_normality(means, "mean_price"), 6)


_REPORTED = ["l_orderkey", "qty", "price"]


def _fenced(column):
    low, high = f"quantile_cont({column}, 0.25)", f"quantile_cont({column}, 0.75)"
    return (f"SELECT '{column}' AS \"column\", count(*) FILTER ({column} < low OR {column} > high) AS count FROM gappy, "
            f"(SELECT {low} - 1.5 * ({high} - {low}) AS low, {high} + 1.5 * ({high} - {low}) AS high FROM gappy)")


@query("statistics_report", " UNION ALL ".join([
    cells_sql("overview", f"WITH {GAPPY_SQL} SELECT count(*) AS n_rows, 5 AS n_columns, 3 AS n_numeric, 2 AS n_categorical FROM gappy", [], ["n_rows", "n_columns", "n_numeric", "n_categorical"]),
    cells_sql("missing_values", SQL["missing_report"], ["column"], ["count", "percentage"]),
    cells_sql("descriptive_stats", f"WITH {GAPPY_SQL}" + " UNION ALL ".join(
        _summary_sql(c, "gappy").replace("round(", "round_even(").replace(", 4)", ", 2)") for c in _REPORTED), ["column"],
        ["count", "mean", "std", "min", "q25", "median", "q75", "max", "skewness", "kurtosis"]),
    cells_sql("outliers", f"WITH {GAPPY_SQL} SELECT * FROM (" + " UNION ALL ".join(map(_fenced, _REPORTED)) + ") WHERE count > 0", ["column"], ["count"]),
    cells_sql("correlations", f"WITH {GAPPY_SQL} " + " UNION ALL ".join(
        f"SELECT '{a}' AS column1, '{b}' AS column2, " + ("1.0" if a == b else f"round(corr({a}, {b}), 4) + 0.0") + " AS correlation" + ("" if a == b else " FROM gappy")
        for a in _REPORTED for b in _REPORTED), ["column1", "column2"], ["correlation"])]))
def _(spark, folder):
    return cells(stats.statistics_report(gappy(spark, folder)))
