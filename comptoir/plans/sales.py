"""The sales table as a view over a star schema of order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names of the sales model.
SALES_COLUMNS = ["date", "produit", "categorie", "prix", "quantite", "ville", "source"]

_FROM_ORDERS = {"date", "ville", "source", "customer_id"}
_FROM_PART = {"produit", "categorie", "prix"}


def sales_from_star(spark: SparkSession, folder: str, columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Assemble the wanted sales columns; dimensions that supply none of them are not read.

    Every join is many-to-one and keeps lines whose key finds nothing, so the rows do not depend on the columns. Join
    strategies are left to Spark, which knows the sizes at run time.
    """
    wanted = set(columns)

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    rows = table("lineitem").withColumn("quantite", F.col("l_quantity").cast("int"))
    if wanted & _FROM_PART:
        part = table("part").select(
            "p_partkey", F.col("p_name").alias("produit"), F.col("p_type").alias("categorie"),
            F.col("p_retailprice").alias("prix"),
        )
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if wanted & _FROM_ORDERS:
        orders = table("orders").select(
            "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("date"),
            F.col("o_orderpriority").alias("source"),
        )
        if "ville" in wanted:
            customer, nation = table("customer"), table("nation")
            cities = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
                "c_custkey", F.col("n_name").alias("ville")
            )
            orders = orders.join(cities, F.col("customer_id") == F.col("c_custkey"), "left")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.select(*columns)
