"""Carrier and airport lookups from a database or a file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

def read_lookup(
    spark: SparkSession,
    path: str | None = None,
    *,
    jdbc: Mapping[str, str] | None = None,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """A lookup table from JDBC options, or from a Parquet / CSV path when no database is given.

    ``columns`` maps result names to source names, for example {"code": "Code", "name": "Description"}.
    """
    if jdbc:
        df = spark.read.format("jdbc").options(**jdbc).load()
    elif path is None:
        raise ValueError("give a path or JDBC options")
    elif path.rstrip("/").endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
    else:
        df = spark.read.parquet(path)
    if columns:
        df = df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])
    return df
