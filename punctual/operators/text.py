"""Word and category counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def words(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per whitespace-separated token; leading whitespace gives an empty token."""
    return df.select(F.explode(F.split(F.col(column), r"\s+")).alias("word"))


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """Tokens by frequency. A frequent word is summed inside each task before the shuffle."""
    counts = words(df, column).groupBy("word").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "word")
