"""The SQL surface: tables as views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def total_rows(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(f"SELECT COUNT(*) AS total_rows FROM `{view}`")


def preview(spark: SparkSession, view: str, n: int = 10) -> DataFrame:
    return spark.sql(f"SELECT * FROM `{view}` LIMIT {int(n)}")


def category_count(spark: SparkSession, view: str, column: str) -> DataFrame:
    """Rows per category, most frequent first, ties by name."""
    return spark.sql(
        f"SELECT `{column}` AS category, COUNT(*) AS `count` FROM `{view}` GROUP BY 1 ORDER BY 2 DESC, 1"
    )


def schema_text(df: DataFrame) -> str:
    """What printSchema shows."""
    return df._jdf.schema().treeString()
