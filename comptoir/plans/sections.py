"""Report sections as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.columns import numeric_columns
from comptoir.operators import aggregate as agg
from comptoir.operators import chartdata, stats
from comptoir.operators.clean import convert_dates
from comptoir.operators.timeseries import calculate_trend_analysis


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The four headline indicators, formatted: ``label, value``."""
    def euros(column: str, grouping: bool = True) -> Column:
        number = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
        text = F.format_number(number, 2) if grouping else F.format_string("%.2f", number)
        return F.concat(text, F.lit(" €"))

    # The labels of the report.
    cards = {
        "Chiffre d'Affaires Total": euros("revenue_total"),
        "Nombre de Transactions": F.format_number("transaction_count", 0),
        "Panier Moyen": euros("average_basket", grouping=False),
        "Quantité Totale": F.format_number("total_quantity", 0),
    }
    pairs = [F.struct(F.lit(label).alias("label"), value.alias("value")) for label, value in cards.items()]
    return kpis.select(F.inline(F.array(*pairs)))


def report_sections(df: DataFrame, ready: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """One table per section of the sales report; sections whose columns are missing are left out.

    ``ready`` gives sections that are already computed, by name, and ``kpis`` for the cards.
    """
    ready, have = ready or {}, set(df.columns)
    builders = {
        "kpi": (set(), lambda: kpi_cards(ready["kpis"] if "kpis" in ready else agg.calculate_kpis(df))),
        "overview": (set(), lambda: agg.overview(df)),
        "period": (set(), lambda: agg.period_info(convert_dates(df, "date"))),
        "category": ({"categorie"}, lambda: agg.calculate_sales_by_category(df)),
        "geography": ({"ville"}, lambda: agg.calculate_sales_by_city(df)),
        "time": ({"date"}, lambda: calculate_trend_analysis(convert_dates(df, "date"), "date")),
        "top_products": ({"produit"}, lambda: agg.calculate_top_products(df)),
    }
    if numeric_columns(df):
        builders["statistics"] = (set(), lambda: stats.describe(df, rounded=True))
    return {name: ready.get(name) or build() for name, (needed, build) in builders.items() if needed <= have}


def chart_series(sections: dict[str, DataFrame], correlations: DataFrame | None = None) -> dict[str, DataFrame]:
    """The charts of the report, from section tables that are already computed."""
    charts = {}
    if "category" in sections:
        charts["ventes_categorie"] = chartdata.bar(sections["category"], "categorie", "ca_total")
    if "geography" in sections:
        charts["repartition_villes"] = chartdata.pie(sections["geography"], "ville", "ca_total", top=10)
    if "time" in sections:
        charts["evolution_ca"] = chartdata.line(sections["time"], "date", "ca_total")
    if "top_products" in sections:
        charts["top_produits"] = chartdata.bar(sections["top_products"], "produit", "ca_total")
    if correlations is not None:
        charts["correlation_matrix"] = correlations.toDF("row", "column", "value")
    return charts
