"""Run registered queries in Spark and their SQL in DuckDB and compare the rows as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

import __spark_entry__ as registry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def differences(spark, con, sf_dir: str, name: str) -> str | None:
    """None if both sides have the same columns and rows, else what differs."""
    df = registry.queries()[name](spark, sf_dir)
    result = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got = Counter(map(tuple, df.select(*columns).collect()))
    want = Counter(result.fetchall())
    if got == want:
        return None
    return f"{got.total()} rows != {want.total()}; extra {list((got - want))[:2]}; lacking {list((want - got))[:2]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in sys.argv[2:] or registry.queries():
        start = time.time()
        try:
            diff = differences(spark, con, sf, name)
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {diff or 'ok'}", flush=True)
