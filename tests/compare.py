"""Side-by-side comparison of a Spark result with DuckDB SQL on the same tables."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(result, connection, sql: str) -> str | None:
    """None when both give the same bag of rows under the same column names."""
    relation = connection.execute(sql)
    columns = [column[0] for column in relation.description]
    expected = relation.fetchall()
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} instead of {sorted(columns)}"
    got = _bag(result.columns, result.collect())
    want = _bag(columns, expected)
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows instead of {sum(want.values())}; "
        f"extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    from pulselog.plans import ORACLES, QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "10g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            problem = differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name}: {problem or 'equal'} ({time.time() - start:.1f}s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
