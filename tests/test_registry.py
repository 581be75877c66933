import importlib.util
from pathlib import Path

import pytest

spec = importlib.util.spec_from_file_location("entry", Path(__file__).resolve().parent.parent / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)


def test_every_query_has_sql():
    assert set(entry.registry.QUERIES) == set(entry.registry.SQL)
    assert set(entry.registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables not present")
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["categorie", "ca_total", "quantite_totale", "prix_moyen", "nb_transactions", "ca_percentage"]
    assert df.count() == 6
