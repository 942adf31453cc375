"""Run queries against their oracles: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = os.environ.get("TESTDATA", "/root/testdata")


def local_session(cpus: int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("checks")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        # A date folder costs the same however little it holds: keep small writes parallel.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, con, name: str, sf_dir: str) -> tuple[int, str]:
    """Rows of the query, and a text that is empty when both sides agree."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return got.total(), ""
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return got.total(), f"columns differ: {set(columns) ^ set(df.columns)}"
    if got == want:
        return got.total(), ""
    extra, missing = got - want, want - got
    example = f"{sorted(df.columns)}\n  {next(iter(extra), None)}\n  {next(iter(missing), None)}"
    return got.total(), f"{extra.total()} only in Spark, {missing.total()} only in SQL: {example}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"{DATA}/{sf}"
    spark, con = local_session(int(os.environ.get("CPUS", "8"))), duck(sf_dir)
    failed = 0
    for name in names:
        begun = time.time()
        n_rows, text = differences(spark, con, name, sf_dir)
        failed += bool(text)
        verdict = "DIFFERS " + text if text else ("ok" if name in ORACLES else "rows only")
        print(f"{name:30s} {n_rows:8d} rows {time.time() - begun:7.2f}s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
