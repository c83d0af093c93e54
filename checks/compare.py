"""Run registered queries next to their SQL and compare the results by value."""

from __future__ import annotations

import sys
import time
from collections import Counter
from collections.abc import Iterable
from typing import Any

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _bag(columns: list[str], rows: Iterable[tuple[Any, ...]]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty when they are equal."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = _bag(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    actual = _bag(df.columns, (tuple(r) for r in df.collect()))
    found = []
    if actual.total() != expected.total():
        found.append(f"rows {actual.total()} != {expected.total()}")
    found += [f"only in Spark: {r}" for r in list((actual - expected).elements())[:3]]
    found += [f"only in SQL: {r}" for r in list((expected - actual).elements())[:3]]
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from checks.oracles import ORACLES
    from checks.registered import QUERIES
    from threadline.session import local_session

    spark: SparkSession = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wrong = 0
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = differences(query(spark, sf_dir), con, ORACLES[name])
        except Exception as e:  # one failing query must not hide the others
            found = [f"{type(e).__name__}: {str(e)[:500]}"]
        wrong += bool(found)
        print(f"{'DIFF' if found else 'ok':5s}{name:28s}{time.time() - start:7.1f}s", *found, sep="\n     " if found else "")
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
