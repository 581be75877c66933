"""Writing a bundle of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_tables(tables: dict[str, DataFrame], folder: str, file_format: str = "parquet", mode: str = "overwrite") -> list[str]:
    """One directory per table, and their paths. Text formats get a header where they have one."""
    paths = []
    for name, table in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        writer = table.write.mode(mode).format(file_format)
        if file_format == "csv":
            writer = writer.option("header", True)
        writer.save(path)
        paths.append(path)
    return paths
