"""Row filters over the flight fact. All of them reach the Parquet scan as pushed filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctual.functions.flight import CANCELLED_SQL, DELAYED_SQL, OPERATED_SQL


#: The filters below by name, for counting several populations in one scan.
RULES = {"operated": OPERATED_SQL, "delayed": DELAYED_SQL, "cancelled": CANCELLED_SQL}


def with_operated(df: DataFrame) -> DataFrame:
    return df.withColumn("is_operated", F.expr(OPERATED_SQL))


def operated(df: DataFrame) -> DataFrame:
    return df.where(OPERATED_SQL)


def delayed(df: DataFrame) -> DataFrame:
    return df.where(DELAYED_SQL)


def cancelled(df: DataFrame) -> DataFrame:
    return df.where(CANCELLED_SQL)


def in_years(df: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Keep a span of years; on the year-partitioned fact this prunes directories."""
    if first is not None:
        df = df.where(F.col("Year") >= first)
    if last is not None:
        df = df.where(F.col("Year") <= last)
    return df


def slice_by(df: DataFrame, **choices) -> DataFrame:
    """Keep rows whose column is the given value, or one of the given values; None selects all."""
    for column, wanted in choices.items():
        if wanted is None:
            continue
        values = list(wanted) if isinstance(wanted, (list, tuple, set, frozenset)) else [wanted]
        df = df.where(F.col(column).isin(values))
    return df


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("ArrDel15").cast("int"))
