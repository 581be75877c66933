"""Group-by, pivot, cross-tab, KPIs, sales breakdowns and top-N."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.functions.columns import as_list, percent_of, ref, sort_by_desc, unique_names, with_revenue
from comptoir.operators.merging import MergeAggregate, merged_aggregates
from comptoir.operators.order import groups_fit_tasks
from comptoir.operators.quantiles import grouped_selection
from comptoir.session import ensure_checkpoint_dir

Aggregate = str | Callable[[Column], Column] | MergeAggregate

_PLAIN: dict[str, Callable[[Column], Column]] = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "mean": F.avg,
    "count": F.count,
    "nunique": F.count_distinct,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "size": lambda c: F.count(F.lit(1)),
}
_ORDERED = {"first": F.min_by, "last": F.max_by}
# What an empty calendar period holds: these aggregates of nothing are 0, all others NULL.
ZERO_WHEN_EMPTY = {"sum", "count", "nunique", "size"}


def aggregate_column(column: str, how: Aggregate, order_by: Sequence[str] = ()) -> Column:
    """Aggregate expression for a function name or for a callable that builds one from a Column.

    A callable may also be a grouped-aggregate pandas UDF; Spark then holds one whole group per task,
    so prefer built-in expressions or a MergeAggregate, which combine before the shuffle.
    """
    if callable(how):
        return how(ref(column))
    if how in _PLAIN:
        return _PLAIN[how](ref(column))
    if how in _ORDERED:
        if not order_by:
            raise ValueError(f"'{how}' needs order_by: rows have no order of their own")
        position = F.struct(*[ref(c) for c in order_by])
        return _ORDERED[how](ref(column), F.when(ref(column).isNotNull(), position))
    raise ValueError(f"unknown aggregate: {how}")


def output_name(column: str, how: Aggregate, suffixed: bool) -> str:
    if not suffixed:
        return column
    return f"{column}_{how if isinstance(how, str) else getattr(how, '__name__', 'agg')}"


def plan_aggregates(agg_dict: dict[str, Aggregate | list[Aggregate]]) -> list[tuple[str, Aggregate, str]]:
    """Flatten to (column, function, output name). One list anywhere puts the function into every name."""
    suffixed = any(isinstance(how, (list, tuple)) for how in agg_dict.values())
    return [
        (column, one, output_name(column, one, suffixed))
        for column, how in agg_dict.items()
        for one in (how if isinstance(how, (list, tuple)) else [how])
    ]


def aggregate_by(
    df: DataFrame, keys: list[str], planned: list[tuple[str, Aggregate, str]], order_by: Sequence[str] = ()
) -> DataFrame:
    """Group and aggregate.

    Exact medians are part of the one aggregate while no group has too many distinct values (one sketch over all
    median columns tells); beyond that all of them come from one grouped selection, joined on the grouped rows.
    A user's own :class:`~comptoir.operators.merging.MergeAggregate` runs as partial states.
    """
    by = [ref(k) for k in keys]
    medians = {name: c for c, how, name in planned if how == "median"}
    merged = [(c, how, name) for c, how, name in planned if isinstance(how, MergeAggregate)]
    others = [aggregate_column(c, how, order_by).alias(name) for c, how, name in planned
              if name not in medians and not isinstance(how, MergeAggregate)]
    if medians and groups_fit_tasks(df, list(medians.values()), keys):
        others += [F.percentile(ref(c).cast("double"), F.lit(0.5)).alias(name) for name, c in medians.items()]
        medians = {}
    result = df.groupBy(*by).agg(*others) if others else None
    if merged:
        owned = merged_aggregates(df, keys, merged)
        result = owned if result is None else result.join(owned, keys)
    if result is None:
        result = df.select(*by).distinct()
    if medians:
        middle = grouped_selection(df, keys, list(medians.values()), [0.5])
        picked = [F.col("q")[i][0].alias(name) for i, name in enumerate(medians)]
        result = result.join(middle.select(*by, *picked), keys, "left")
    return result.select(*by, *[ref(name) for _, _, name in planned])


def group_by(
    df: DataFrame, group_columns: str | Sequence[str], agg_dict: dict[str, Aggregate | list[Aggregate]],
    sort_by: str | None = None, ascending: bool = False, order_by: str | Sequence[str] = (),
) -> DataFrame:
    """Aggregate per key combination; rows with a NULL key are left out.

    ``order_by`` gives the row order that ``first`` and ``last`` mean. A ``sort_by`` that names no
    result column is ignored.
    """
    keys = as_list(group_columns)
    result = aggregate_by(df.dropna(subset=keys), keys, plan_aggregates(agg_dict), as_list(order_by))
    if sort_by in result.columns:
        first = ref(sort_by).asc_nulls_last() if ascending else ref(sort_by).desc_nulls_last()
        result = result.orderBy(first, *[ref(k) for k in keys if k != sort_by])
    return result


def _pivot_values(cells: DataFrame, column: str) -> list:
    """Distinct values that become columns; the limit is Spark's own for pivots, and beyond it this fails."""
    limit = int(cells.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = cells.select(ref(column)).distinct().orderBy(ref(column)).limit(limit + 1)
    values = [row[0] for row in rows.collect()]
    if len(values) > limit:
        raise ValueError(f"'{column}' has more than {limit} values (spark.sql.pivotMaxValues): too many columns; pivot_cells has no limit")
    return values


def _stored(grouped: DataFrame) -> DataFrame:
    """Keep a grouped result that is used twice, so that its input is read once."""
    ensure_checkpoint_dir(grouped.sparkSession)
    return grouped.checkpoint()


def pivot_cells(
    df: DataFrame, index: str | Sequence[str], columns: str | Sequence[str], values: str,
    aggfunc: Aggregate = "sum", order_by: str | Sequence[str] = (),
) -> DataFrame:
    """A pivot in long form: one row ``(index.., columns.., value)`` per cell that has rows, without any limit."""
    keys = [*as_list(index), *as_list(columns)]
    kept = df.dropna(subset=keys)
    if aggfunc not in ZERO_WHEN_EMPTY:
        kept = kept.filter(ref(values).isNotNull())
    return aggregate_by(kept, keys, [(values, aggfunc, "value")], as_list(order_by))


def pivot_table(
    df: DataFrame, index: str | Sequence[str], columns: str | Sequence[str], values: str,
    aggfunc: Aggregate = "sum", fill_value: float | None = None,
    order_by: str | Sequence[str] = (), column_values: list | None = None,
) -> DataFrame:
    """One row per index, one column per distinct value of ``columns`` (joined by ``_`` when several;
    equal names are numbered).

    The columns are found from the aggregated cells, which are stored for that; with ``column_values``
    given, the result is fully lazy.
    """
    rows, across = as_list(index), as_list(columns)
    kept = df.dropna(subset=[*rows, *across])
    if aggfunc not in ZERO_WHEN_EMPTY:
        kept = kept.filter(ref(values).isNotNull())
    joined = len(across) > 1
    if joined:
        parts = [ref(c).cast("string") for c in across]
        # found values are told apart part by part; given ones are joined names
        kept = kept.withColumn("_across", F.to_json(F.array(*parts)) if column_values is None else F.concat_ws("_", *parts))
        across = ["_across"]
    cells = aggregate_by(kept, [*rows, *across], [(values, aggfunc, "_cell")], as_list(order_by))
    if column_values is None:
        cells = _stored(cells)
        column_values = _pivot_values(cells, across[0])
        if joined:
            names = unique_names(["_".join(json.loads(v)) for v in column_values])
            column_values = dict(sorted(zip(names, column_values)))
    if isinstance(column_values, dict):
        cells = cells.withColumn("_across", F.element_at(F.create_map(*[F.lit(x) for n, v in column_values.items() for x in (v, n)]), F.col("_across")))
        column_values = list(column_values)
    table = cells.groupBy(*[ref(r) for r in rows]).pivot(across[0], column_values).agg(F.first("_cell"))
    if fill_value is not None:
        filled = [c for c in table.columns if c not in rows]
        table = table.withColumns({c: F.coalesce(ref(c), F.lit(fill_value)) for c in filled})
    return table.orderBy(*[ref(r) for r in rows])


def cross_tab_counts(df: DataFrame, row_column: str, col_column: str) -> DataFrame:
    """Contingency counts in long form: one row per non-empty cell."""
    pair = df.dropna(subset=[row_column, col_column])
    return pair.groupBy(ref(row_column), ref(col_column)).agg(F.count(F.lit(1)).alias("n"))


def cross_tab(
    df: DataFrame, row_column: str, col_column: str, normalize: bool = False, column_values: list | None = None
) -> DataFrame:
    """Contingency table; with ``normalize`` each cell is a percentage of all rows."""
    cells = _stored(cross_tab_counts(df, row_column, col_column))
    if column_values is None:
        column_values = _pivot_values(cells, col_column)
    table = cells.groupBy(ref(row_column)).pivot(col_column, column_values).agg(F.sum("n"))
    names = [c for c in table.columns if c != row_column]
    if normalize:
        total = cells.agg(F.sum("n")).scalar()
        table = table.withColumns({c: F.coalesce(F.try_divide(ref(c), total) * 100, F.lit(0.0)) for c in names})
    else:
        table = table.fillna(0, subset=names) if names else table
    return table.orderBy(ref(row_column))


def _collapsed(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One row per combination of the present key columns, with row counts, sums and value counts.

    Counting the distinct values of several columns multiplies the rows by the number of columns; here that
    happens to the combinations, not to the data.
    """
    totals = [x for i, c in enumerate(sums) if c in df.columns for x in (F.sum(ref(c)).alias(f"_s{i}"), F.count(ref(c)).alias(f"_c{i}"))]
    return df.groupBy(*[ref(k) for k in keys if k in df.columns]).agg(F.count(F.lit(1)).alias("_rows"), *totals)


def calculate_kpis(df: DataFrame) -> DataFrame:
    """One row with the eight indicators; those whose column is missing are 0."""
    df = with_revenue(df, overwrite=True)
    grouped = _collapsed(df, ("produit", "categorie", "ville"), ("revenue", "quantite", "prix"))

    def of(column: str, expression: Column, empty: float = 0) -> Column:
        return expression if column in df.columns else F.lit(empty)

    def mean(i: int) -> Column:
        return F.try_divide(F.sum(f"_s{i}").cast("double"), F.sum(f"_c{i}"))

    return grouped.agg(
        of("revenue", F.coalesce(F.sum("_s0").cast("double"), F.lit(0.0)), 0.0).alias("revenue_total"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("transaction_count"),
        of("revenue", mean(0), 0.0).alias("average_basket"),
        of("quantite", F.coalesce(F.sum("_s1").cast("bigint"), F.lit(0))).cast("bigint").alias("total_quantity"),
        of("prix", mean(2), 0.0).alias("average_price"),
        of("produit", F.count_distinct("produit")).cast("bigint").alias("unique_products"),
        of("categorie", F.count_distinct("categorie")).cast("bigint").alias("unique_categories"),
        of("ville", F.count_distinct("ville")).cast("bigint").alias("unique_cities"),
    )


def with_share(grouped: DataFrame, value: str, share: str = "ca_percentage") -> DataFrame:
    """Add each row's percentage of the column total; the grouped rows are stored, as both need them."""
    grouped = _stored(grouped)
    return grouped.withColumn(share, percent_of(ref(value), grouped.agg(F.sum(ref(value))).scalar()))


def _sales_by(df: DataFrame, key: str, products: Column, *, name: str, price: bool = False) -> DataFrame:
    totals = [F.coalesce(F.sum("revenue"), F.lit(0)).alias("ca_total"),
              F.coalesce(F.sum("quantite"), F.lit(0)).alias("quantite_totale")]
    if price:
        totals.append(F.avg("prix").alias("prix_moyen"))
    grouped = with_revenue(df).dropna(subset=[key]).groupBy(key).agg(*totals, products.alias(name))
    return with_share(grouped, "ca_total").orderBy(*sort_by_desc("ca_total", key))


def calculate_sales_by_category(df: DataFrame) -> DataFrame:
    return _sales_by(df, "categorie", F.count("produit"), name="nb_transactions", price=True)


def calculate_sales_by_city(df: DataFrame) -> DataFrame:
    return _sales_by(df, "ville", F.count_distinct("produit"), name="nb_produits_uniques")


def calculate_sales_by_source(df: DataFrame) -> DataFrame:
    return _sales_by(df, "source", F.count("produit"), name="nb_transactions")


def calculate_top_products(df: DataFrame, top_n: int = 10, metric: str = "revenue") -> DataFrame:
    """The ``top_n`` products by revenue, or by quantity for any other metric."""
    grouped = with_revenue(df).dropna(subset=["produit"]).groupBy("produit").agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("ca_total"),
        F.coalesce(F.sum("quantite"), F.lit(0)).alias("quantite_totale"),
        F.avg("prix").alias("prix_moyen"),
    )
    column = "ca_total" if metric == "revenue" else "quantite_totale"
    return grouped.orderBy(*sort_by_desc(column, "produit")).limit(top_n)


def top_rows(df: DataFrame, column: str, ties: str | Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows by descending column, ties in key order."""
    return df.orderBy(*sort_by_desc(column, *as_list(ties))).limit(n)


def head(df: DataFrame, order_by: str | Sequence[str], n: int = 1000) -> DataFrame:
    """First ``n`` rows of a table in a stated order (the export sheet of cleaned rows)."""
    return df.orderBy(*[ref(c) for c in as_list(order_by)]).limit(n)


def overview(df: DataFrame) -> DataFrame:
    """Row count and distinct products, categories and cities; NULL where the column is missing."""
    def distinct(column: str) -> Column:
        return F.count_distinct(column) if column in df.columns else F.lit(None).cast("bigint")

    return _collapsed(df, ("produit", "categorie", "ville"), ()).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("transactions"),
        distinct("produit").alias("produits"),
        distinct("categorie").alias("categories"),
        distinct("ville").alias("villes"),
    )


def period_info(df: DataFrame, date_column: str = "date") -> DataFrame:
    """First and last day of the data as ``dd/MM/yyyy - dd/MM/yyyy``; ``N/A`` without dates."""
    if date_column not in df.columns:
        return df.sparkSession.range(1).select(F.lit("N/A").alias("period"))
    day = ref(date_column).cast("timestamp")
    first, last = F.date_format(F.min(day), "dd/MM/yyyy"), F.date_format(F.max(day), "dd/MM/yyyy")
    return df.agg(F.coalesce(F.concat(first, F.lit(" - "), last), F.lit("N/A")).alias("period"))


def bar_aggregate(df: DataFrame, x: str, y: str) -> DataFrame:
    """Sum ``y`` per ``x`` when ``x`` is text; any other ``x`` is charted as it is."""
    if not isinstance(df.schema[x].dataType, T.StringType):
        return df.select(ref(x), ref(y))
    return group_by(df, x, {y: "sum"}).orderBy(ref(x))
