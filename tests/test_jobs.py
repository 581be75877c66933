from pyspark.sql import functions as F

from comptoir.plans import jobs, sections
from tests.test_sources import SAMPLE


def test_full_run(spark, tmp_path):
    source = tmp_path / "ventes.csv"
    source.write_text(SAMPLE.replace(",5.0,", ",,").replace("Nantes", "  Nantes "), encoding="utf-8")
    out = str(tmp_path / "out")
    outcome = jobs.run(spark, str(source), out)
    assert outcome.is_valid is True

    def read(name):
        return spark.read.parquet(f"{out}/{name}")

    cleaned = read("tables/cleaned")
    assert {r.ville for r in cleaned.collect()} == {"Lille", "Nantes"}
    assert cleaned.filter("produit = 'Tasse'").first().prix == 20.0  # the median of the others
    assert read("aggregations/kpis").first().revenue_total == 210.0
    assert read("aggregations/trend").count() == 2
    assert {r["column"] for r in read("statistics/descriptive_stats").collect()} == {"prix", "quantite", "revenue"}
    assert read("charts/correlation_matrix").count() == 9
    assert read("report/kpi").filter("label = 'Quantité Totale'").first().value == "13"
    export = spark.read.option("header", True).csv(f"{out}/export/Ventes par Ville")
    assert export.count() == 2
    assert all((tmp_path / "out").joinpath(p.removeprefix(out + "/")).exists() for p in outcome.paths)


def test_steps_can_be_skipped(spark, tmp_path):
    source = tmp_path / "ventes.csv"
    source.write_text(SAMPLE)
    outcome = jobs.run(spark, str(source), str(tmp_path / "o"), True, True, False, False)
    assert outcome.is_valid is None
    assert not (tmp_path / "o" / "report").exists() and not (tmp_path / "o" / "export").exists()


def test_command_line(spark, tmp_path):
    source = tmp_path / "ventes.csv"
    source.write_text(SAMPLE)
    assert jobs.main([str(source), str(tmp_path / "o"), "--skip-cleaning", "--no-report", "--no-export"]) == 0


def test_analyze_and_profile(spark, sales):
    got = jobs.analyze(sales)
    assert got["kpis"].first().revenue_total == 120.0
    assert tuple(got["data_info"].first()) == (3, 8)
    assert {r["column"] for r in got["statistics_descriptive_stats"].collect()} == {"prix", "quantite", "revenue"}
    assert jobs.profile(sales).is_valid


def test_sections(sales):
    got = sections.report_sections(sales)
    assert set(got) == {"kpi", "overview", "period", "category", "geography", "time", "top_products", "statistics"}
    assert [tuple(r) for r in got["kpi"].collect()] == [
        ("Chiffre d'Affaires Total", "120.00 €"), ("Nombre de Transactions", "3"), ("Panier Moyen", "40.00 €"), ("Quantité Totale", "13")]
    assert got["period"].first()[0] == "05/03/2024 - 01/04/2024"
    small = sections.report_sections(sales.select("prix", "quantite"))
    assert set(small) == {"kpi", "overview", "period", "statistics"} and small["period"].first()[0] == "N/A"


def test_invalid_input_does_not_stop_the_run(spark, tmp_path):
    source = tmp_path / "ventes.csv"
    source.write_text(SAMPLE.replace("10.0,6", "-10.0,0"))
    outcome = jobs.run(spark, str(source), str(tmp_path / "o"), generate_report=False, export=False)
    assert outcome.is_valid is False
    found = spark.read.parquet(str(tmp_path / "o" / "quality" / "validation"))
    assert found.filter(F.col("check") == "range").count() == 2
