"""Aggregate tables that grow month by month: a store of additive sums, of which a load replaces single months.

Every measure of the seven tables is a sum over flights, so sums per month and grain add up to those of any span. The
store holds them in folders ``Year=.../Month=...``: some thousand rows a month, whatever the size of the fact. A load
reads the months it names and writes their folders; the tables follow from the store alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from punctual.operators.tables import GRAINS, grain_sums, tables_of
from punctual.runtime import cut, hadoop_fs, scratch
from punctual.schema import FLIGHT_COLUMNS

MONTH = ("Year", "Month")


def months_of(fact: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    """The flights of some months. The year is a plain filter, so only folders of these years are read."""
    months = sorted(set(months))
    if not months:
        return fact.where(F.lit(False))
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    chosen = reduce(lambda a, b: a | b, [(F.col("Year") == y) & F.col("Month").isin(m) for y, m in by_year.items()])
    return fact.where(F.col("Year").isin(list(by_year)) & chosen)


def refresh(fact: DataFrame, store: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Recompute ``months`` ((year, month) pairs) of the store from ``fact`` and return the store.

    What the store held of these months is replaced, so loading a month twice, or again with other flights, gives what
    one load gives; a month without flights disappears. Other months are neither read nor written. A run that stops half
    way is put right by running it again. Flights without a year or month belong to no load.
    """
    spark, months = fact.sparkSession, sorted(set(months))
    with scratch(spark, "sums") as work:
        sums = cut(grain_sums(months_of(fact, months), by=MONTH), path=work)
        fresh = _present(sums)
        # one task per month, so one file per folder
        (
            sums.repartition(max(1, len(months)), *MONTH)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MONTH)
            .parquet(store)
        )
    held = read_store(spark, store, sums.schema)
    for year, month in _present(months_of(held, months)) - fresh:
        fs, path = hadoop_fs(spark, f"{store.rstrip('/')}/Year={year}/Month={month}")
        fs.delete(path, True)
    return read_store(spark, store, sums.schema)


def _present(sums: DataFrame) -> set[tuple[int, int]]:
    return {(r["Year"], r["Month"]) for r in sums.select(*MONTH).distinct().collect()}


def read_store(spark: SparkSession, store: str, schema: StructType | None = None) -> DataFrame:
    """The sums, with Year and Month from the folders. ``schema`` (that of the sums) serves a store that is still empty."""
    sums = (spark.read.schema(schema) if schema else spark.read).parquet(store)
    return sums.withColumns({c: F.col(c).cast(FLIGHT_COLUMNS[c]) for c in MONTH})


def tables_from_store(sums: DataFrame, dim: DataFrame | None = None, how: str = "left") -> dict[str, DataFrame]:
    """The seven tables over all months of the store."""
    return tables_of({g: sums.where(F.col("grain") == g) for g in GRAINS}, dim, how)
