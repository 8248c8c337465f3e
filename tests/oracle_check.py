"""Runs registered queries and their DuckDB SQL side by side.

    python tests/oracle_check.py [data folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL's; empty when equal to the last bit."""
    found = connection.execute(sql)
    want_columns, want = _rows([d[0] for d in found.description], found.fetchall())
    got_columns, got = _rows(spark_df.columns, spark_df.collect())
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    kinds = {d[0]: str(d[1]).lower() for d in connection.execute(sql).description}
    names = {"bigint": "bigint", "int": "integer", "smallint": "smallint", "double": "double", "string": "varchar",
             "boolean": "boolean"}
    differences = [
        f"type of {c}: {kind} != {kinds[c]}" for c, kind in spark_df.dtypes if names.get(kind, kind) != kinds[c]
    ]
    if len(got) != len(want):
        differences.append(f"{len(got)} rows != {len(want)}")
    unequal = [(g, w) for g, w in zip(got, want, strict=False) if g != w]
    if unequal:
        differences.append(f"{len(unequal)} rows differ; first: {unequal[0][0]} != {unequal[0][1]}")
    return differences


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, queries, oracle = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problems = compare(df, connection, oracle[name]) if name in oracle else []
            note = "ok" if name in oracle else f"rows only ({df.count()})"
        except Exception as error:  # one broken query must not hide the others
            problems = [str(error)[:600]]
        bad += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s  {'; '.join(problems) if problems else note}", flush=True)
    print(f"{bad} with differences")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
