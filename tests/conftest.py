import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["small", "distributed"])
def scale(request, monkeypatch):
    """Run a test on both ways: everything fits one task, or nothing does."""
    if request.param == "distributed":
        from comptoir.operators import correlation, order, quantiles

        for limit in ("SMALL_DISTINCT", "SMALL_GROUP", "SMALL_SORT", "BROADCAST_BYTES"):
            monkeypatch.setattr(order, limit, 3)
        monkeypatch.setattr(quantiles, "_GATHER", 20)
        monkeypatch.setattr(quantiles, "_ACCURACY", 50)
        monkeypatch.setattr(correlation, "_PAIRS_PER_TASK", 60)
        monkeypatch.setattr(correlation, "_CELLS", 40)
        monkeypatch.setattr(correlation, "_STRIPES", 3)
    return request.param


@pytest.fixture
def sales(spark):
    rows = [
        ("2024-03-05", "Tasse", "Maison", 5.0, 6, "Lille", "web"),
        ("2024-03-09", "Lampe", "Maison", 30.0, 1, "Nantes", "magasin"),
        ("2024-04-01", "Sac", "Mode", 10.0, 6, "Lille", "web"),
    ]
    return spark.createDataFrame(
        rows, "date string, produit string, categorie string, prix double, quantite int, ville string, source string"
    )
