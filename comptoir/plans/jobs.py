"""Whole jobs: from files to tables of results.

``python -m comptoir.plans.jobs INPUT OUTPUT`` runs the full sequence.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from comptoir.functions.columns import with_revenue
from comptoir.operators import aggregate as agg
from comptoir.operators import quality, stats
from comptoir.operators.clean import clean, convert_dates
from comptoir.operators.correlation import correlation_matrix
from comptoir.operators.timeseries import calculate_trend_analysis
from comptoir.plans.sections import chart_series, report_sections
from comptoir.session import ensure_checkpoint_dir, get_session
from comptoir.sources.files import load_data
from comptoir.sources.sinks import write_tables

EXPORT_ROWS = 1000


def aggregations(df: DataFrame) -> dict[str, DataFrame]:
    """Breakdowns by category, city and source, the top ten products and the monthly trend."""
    tables = {
        "by_category": agg.calculate_sales_by_category(df),
        "by_city": agg.calculate_sales_by_city(df),
        "top_products": agg.calculate_top_products(df),
    }
    if "source" in df.columns:
        tables["by_source"] = agg.calculate_sales_by_source(df)
    if "date" in df.columns:
        tables["trend"] = calculate_trend_analysis(df, "date")
    return tables


def analyze(df: DataFrame, clean_first: bool = True, remove_outliers: bool = False) -> dict[str, DataFrame]:
    """Indicators, breakdowns and statistics of one data set, which is cleaned and stored once for all of them."""
    df = convert_dates(df, "date")
    if clean_first:
        df = clean(df, remove_outliers=remove_outliers)
    ensure_checkpoint_dir(df.sparkSession)
    df = with_revenue(df, overwrite=True).checkpoint()
    tables = {
        "data_info": stats.profile_counts(df).select("n_rows", "n_columns"),
        "kpis": agg.calculate_kpis(df),
        "sales_by_category": agg.calculate_sales_by_category(df),
        "sales_by_city": agg.calculate_sales_by_city(df),
        "top_products": agg.calculate_top_products(df),
    }
    return tables | {f"statistics_{name}": table for name, table in stats.statistics_report(df).items()}


def profile(df: DataFrame) -> quality.Validation:
    """What a load reports: size, columns and the findings of the sales rules."""
    return quality.validate_sales_data(df)


def describe_file(spark: SparkSession, path: str, **options) -> DataFrame:
    """Summary statistics of a file, two decimals."""
    return stats.describe(load_data(spark, path, **options), rounded=True)


def correlate_file(spark: SparkSession, path: str, method: str = "pearson", **options) -> DataFrame:
    return correlation_matrix(load_data(spark, path, **options), method)


@dataclass(frozen=True)
class Outcome:
    """Where the tables of a run were written, and whether the input passed validation."""

    paths: list[str]
    is_valid: bool | None


def run(
    spark: SparkSession, path: str, output: str, skip_cleaning: bool = False, skip_validation: bool = False,
    generate_report: bool = True, export: bool = True, export_format: str = "csv",
    order_by: tuple[str, ...] = ("date", "produit", "ville", "source"), **load_options,
) -> Outcome:
    """Load, validate, clean, aggregate, describe and write everything below ``output``.

    Findings do not stop the run. The loaded and the cleaned table are each written once and read back:
    what follows reads only the columns it needs, text is not parsed again, and lost executors do not
    bring the work back. Small result tables are read back too, so that charts and exports do not
    compute them again.
    """
    paths, is_valid = [], None

    def stored(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
        paths.extend(write_tables(tables, f"{output}/{folder}"))
        return {name: spark.read.parquet(f"{output}/{folder}/{name}") for name in tables}

    raw = stored({"loaded": load_data(spark, path, **load_options)}, "tables")["loaded"]
    if not skip_validation:
        checked = quality.validate_sales_data(raw)
        found = stored({"validation": checked.findings, "metrics": checked.metrics}, "quality")
        is_valid = found["validation"].filter("severity = 'error'").isEmpty()

    table = convert_dates(raw, "date") if "date" in raw.columns else raw
    if not skip_cleaning:
        table = clean(table, remove_outliers=False)
    table = with_revenue(table, overwrite=True)
    cleaned = stored({"cleaned": table}, "tables")["cleaned"]

    results = stored({"kpis": agg.calculate_kpis(cleaned), **aggregations(cleaned)}, "aggregations")
    statistics = stored(stats.statistics_report(cleaned), "statistics")
    sections = {"category": results["by_category"], "geography": results["by_city"], "top_products": results["top_products"]}
    if "trend" in results:
        sections["time"] = results["trend"]
    paths += write_tables(chart_series(sections, statistics.get("correlations")), f"{output}/charts")
    if generate_report:
        ready = {**sections, "kpis": results["kpis"], "statistics": statistics.get("descriptive_stats")}
        paths += write_tables(report_sections(cleaned, ready), f"{output}/report")
    if export:
        # The sheets of the export.
        sheets = {
            "Données Nettoyées": agg.head(cleaned, [c for c in order_by if c in cleaned.columns], EXPORT_ROWS),
            "Ventes par Catégorie": results["by_category"],
            "Ventes par Ville": results["by_city"],
            "Top Produits": results["top_products"],
        }
        if "trend" in results:
            sheets["Évolution Temporelle"] = results["trend"]
        paths += write_tables(sheets, f"{output}/export", export_format)
    return Outcome(paths, is_valid)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Analyse a sales file and write tables of results.")
    parser.add_argument("input")
    parser.add_argument("output", nargs="?", default="outputs")
    parser.add_argument("--skip-cleaning", action="store_true")
    parser.add_argument("--skip-validation", action="store_true")
    parser.add_argument("--no-report", action="store_true")
    parser.add_argument("--no-export", action="store_true")
    options = parser.parse_args(arguments)
    outcome = run(
        get_session(), options.input, options.output, options.skip_cleaning, options.skip_validation,
        not options.no_report, not options.no_export,
    )
    print(f"{len(outcome.paths)} tables written below {options.output}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
