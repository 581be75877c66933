"""Run registered queries on Spark and their SQL on DuckDB and compare whole results.

python tools/check_oracle.py [folder] [name ...]
"""

import importlib.util
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def entry_module():
    spec = importlib.util.spec_from_file_location("entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float, Decimal)):
        return float(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), sorted(columns)


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    module = entry_module()
    queries, sql = module.queries(), module.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    bad = []
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            ours, our_columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if name not in sql:
                print(f"rows  {name}: {len(ours)} rows, {took:.2f}s")
                continue
            result = con.execute(sql[name])
            columns = [d[0] for d in result.description]
            theirs, their_columns = rows_of(columns, result.fetchall())
            same = ours == theirs and our_columns == their_columns
            print(f"{'ok   ' if same else 'DIFF '} {name}: {len(ours)} rows, {took:.2f}s")
            if not same:
                bad.append(name)
                print("   ", our_columns, their_columns, len(ours), len(theirs))
                for a, b in [(a, b) for a, b in zip(ours, theirs) if a != b][:3]:
                    print("    spark ", a, "\n    duckdb", b)
        except Exception as error:
            bad.append(name)
            print(f"FAIL  {name}: {str(error)[:1500]}")
    print(f"{len(names) - len(bad)} of {len(names)} agree", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
