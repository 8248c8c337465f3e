"""Is the raw landing area complete?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctual.runtime import cut

# Fixed value: a monthly file below this size is taken for a broken download.
MIN_BYTES = 50 * 1024 * 1024
# Fixed value: monthly files end in _<year>_<month>.csv
BY_NAME = r"_(\d{4})_(\d{1,2})\.csv$"
BY_FOLDER = r"/Year=(\d+)/Month=(\d+)/[^/]*$"


def _year_month(path: str, pattern: str) -> list[Column]:
    parts = [F.regexp_extract(path, pattern, i).try_cast("int") for i in (1, 2)]
    return [parts[0].alias("Year"), parts[1].alias("Month")]


def landed_files(spark: SparkSession, path: str, pattern: str = BY_NAME) -> DataFrame:
    """Path, size, year and month of every file, from the listing alone: no file is opened."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.select("path", F.col("length").alias("bytes"), *_year_month("path", pattern))


def month_grid(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Every month of every year of the span."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("Year"))
    return years.select("Year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("Month"))


def _beside(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by month; files without one stay together under nulls."""
    keys = ("Year", "Month")
    other = right.select(*[F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in right.columns])
    same = left["Year"].eqNullSafe(other["_Year"]) & left["Month"].eqNullSafe(other["_Month"])
    joined = left.join(other, same, how)
    return joined.withColumns({k: F.coalesce(F.col(k), F.col(f"_{k}")) for k in keys}).drop("_Year", "_Month")


def raw_manifest(
    spark: SparkSession,
    path: str,
    first_year: int,
    last_year: int,
    min_bytes: int = MIN_BYTES,
    count_rows: bool = False,
    pattern: str = BY_NAME,
) -> DataFrame:
    """(Year, Month, files, bytes, rows, ok) for every expected month; a missing month has 0 files.

    Files of other months, and files whose path names none (Year and Month null), are rows with ok = false.

    ``pattern`` finds year and month in a file's path. ``ok`` means at least one file and none below ``min_bytes``. ``rows`` is null unless
    ``count_rows``, which scans the files' row boundaries.
    """
    files = landed_files(spark, path, pattern).groupBy("Year", "Month")
    found = files.agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.min("bytes").alias("smallest")
    )
    grid = month_grid(spark, first_year, last_year).withColumn("expected", F.lit(True))
    out = _beside(grid, found, "full")
    rows: Column = F.lit(None).cast("bigint")
    if count_rows:
        lines = spark.read.option("header", True).csv(path).select(F.col("_metadata.file_path").alias("p"))
        counted = lines.groupBy("p").agg(F.count("*").alias("rows"))
        named = counted.select(*_year_month("p", pattern), "rows")
        out = _beside(out, named.groupBy("Year", "Month").agg(F.sum("rows").alias("rows")), "left")
        rows = F.coalesce("rows", F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    return out.select(
        "Year",
        "Month",
        F.coalesce("files", zero).alias("files"),
        F.coalesce("bytes", zero).alias("bytes"),
        rows.alias("rows"),
        (F.coalesce("expected", F.lit(False)) & (F.coalesce("smallest", F.lit(-1)) >= min_bytes)).alias("ok"),
    ).orderBy("Year", "Month")


def missing_months(df: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Months of the span (default: first to last year present) without a single row."""
    present = df.select("Year", "Month").distinct()
    if first_year is None or last_year is None:
        present = cut(present)  # read for the span and for the gaps
        span = present.agg(F.min("Year").alias("lo"), F.max("Year").alias("hi")).where("lo IS NOT NULL")
        lo = F.col("lo") if first_year is None else F.lit(first_year)
        hi = F.col("hi") if last_year is None else F.lit(last_year)
        years = span.select(F.explode(F.sequence(lo, hi)).alias("Year"))
        grid = years.select("Year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("Month"))
    else:
        grid = month_grid(df.sparkSession, first_year, last_year)
    return grid.join(present, ["Year", "Month"], "left_anti")


def month_coverage(df: DataFrame) -> DataFrame:
    """Rows per month over the full grid of the years present: (Year, Month, rows, ok)."""
    counts = cut(df.groupBy("Year", "Month").agg(F.count("*").alias("rows")))
    gaps = missing_months(counts).select("Year", "Month", F.lit(0).cast("bigint").alias("rows"))
    return counts.unionByName(gaps).withColumn("ok", F.col("rows") > 0)
