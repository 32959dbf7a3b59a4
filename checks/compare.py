"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def session(cores: str = "8", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per expression
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or not hasattr(value, "__float__"):
        return str(value)
    return round(float(value), 6)


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not theirs:
        return "no rows to compare"
    if ours != theirs:
        return f"{sum(ours.values())} rows != {sum(theirs.values())}; only Spark {list((ours - theirs).items())[:3]}; only SQL {list((theirs - ours).items())[:3]}"
    return None


def main() -> None:
    from .registry import ORACLES, QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    sf_dir = f"/root/testdata/sf{options.sf}"
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in options.names or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
