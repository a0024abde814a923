"""Runs registered queries and their SQL side by side: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.queries import registry

TABLES = Path("/root/testdata/sf0.01")


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tallygrid-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_session(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides have the same columns and the same rows as multisets, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = Counter(tuple(row[names.index(c)] for c in df.columns) for row in result.fetchall())
    actual = Counter(tuple(row) for row in df.collect())
    if actual == expected:
        return None
    only_spark, only_sql = actual - expected, expected - actual
    return f"{actual.total()} rows vs {expected.total()}; only Spark {list(only_spark)[:3]}; only SQL {list(only_sql)[:3]}"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else str(TABLES)
    spark, con = session(), oracle_session(sf_dir)
    failed = 0
    for name, (query, sql) in registry().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.perf_counter()
        try:
            found = difference(query(spark, sf_dir), con, sql)
        except Exception as error:  # noqa: BLE001 - report every query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.perf_counter() - start:.2f}s {found or ''}", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
