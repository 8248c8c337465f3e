"""Leak-free features and the splits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from punctual.operators.ranking import hash_position

# What is known before departure, and what is not.
CATEGORICAL = ["Reporting_Airline", "Origin", "Dest"]
NUMERIC = ["Month", "DayOfWeek", "Dep_Hour", "Distance", "CRSElapsedTime"]
FORBIDDEN = [
    "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15",
    "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "ActualElapsedTime", "AirTime",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    "Cancelled", "Diverted", "CancellationCode",
    "TaxiOut", "TaxiIn", "WheelsOff", "WheelsOn",
]


class LeakageError(ValueError):
    """A feature that is only known after departure."""


def check_features(columns: Iterable[str]) -> list[str]:
    """The columns, if every one is an allowed feature."""
    columns = list(columns)
    leaking = [c for c in columns if c.lower() in {f.lower() for f in FORBIDDEN}]
    if leaking:
        raise LeakageError(f"known only after departure: {leaking}")
    unknown = [c for c in columns if c not in CATEGORICAL + NUMERIC]
    if unknown:
        raise ValueError(f"not an allowed feature: {unknown}")
    return columns


def feature_stages(
    categorical: Iterable[str] = CATEGORICAL, numeric: Iterable[str] = NUMERIC, one_hot: bool = True
) -> list:
    """Index, optionally one-hot encode, assemble. An unseen category gets an index of its own;
    a row with a null feature is skipped. Trees take the indices directly."""
    categorical, numeric = list(categorical), list(numeric)
    check_features(categorical + numeric)
    indexed = [f"{c}_idx" for c in categorical]
    stages = [StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep")]
    ready = indexed
    if one_hot:
        ready = [f"{c}_ohe" for c in categorical]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=ready, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=ready + numeric, outputCol="features", handleInvalid="skip"))
    return stages


def training_rows(df: DataFrame) -> DataFrame:
    """Operated flights with their label, reduced to features, label and report columns."""
    from punctual.operators.population import operated, with_label

    kept = ["Year", "FlightDate", *CATEGORICAL, *NUMERIC, "label"]
    rows = with_label(operated(df))
    return rows.select(*dict.fromkeys(c for c in kept if c in rows.columns))


def split_random(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's random split; repeats only for the same partitions."""
    first, second = df.randomSplit([train, 1 - train], seed=seed)
    return first, second


def hash_part(df: DataFrame, train: float = 0.8, keys: list[str] | None = None, seed: int = 42) -> Column:
    """``train`` or ``test`` by a hash of the keys (default: all columns)."""
    return F.when(hash_position(df, keys, seed) < train, "train").otherwise("test")


def split_hash(
    df: DataFrame, train: float = 0.8, keys: list[str] | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """A split that repeats whatever the partitions; copies of a row stay on one side."""
    part = hash_part(df, train, keys, seed)
    return df.where(part == "train"), df.where(part == "test")


def year_part(
    df: DataFrame,
    last_train_year: int,
    test_year: int | None = None,
    train_fraction: float = 0.15,
    check_year: int | None = None,
    keys: list[str] | None = None,
    seed: int = 42,
) -> Column:
    """``train`` (a sample of the years up to ``last_train_year``; all from a fraction of 1 on), ``test``, ``check``, or
    ``rest`` for other rows."""
    test_year = last_train_year + 1 if test_year is None else test_year
    if any(y is not None and y <= last_train_year for y in (test_year, check_year)):
        raise ValueError("test years must come after the training years")
    drawn = F.col("Year") <= last_train_year
    if train_fraction < 1:
        drawn &= hash_position(df, keys, seed) < train_fraction
    part = F.when(drawn, "train").when(F.col("Year") == test_year, "test")
    if check_year is not None:
        part = part.when(F.col("Year") == check_year, "check")
    return part.otherwise("rest")


def split_by_year(
    df: DataFrame,
    last_train_year: int,
    test_year: int | None = None,
    train_fraction: float = 0.15,
    check_year: int | None = None,
    keys: list[str] | None = None,
    seed: int = 42,
) -> tuple[DataFrame, ...]:
    """Train on a sample of the years up to ``last_train_year``, test on the next; prunes by Year.

    With ``check_year`` a third part for a final check is returned. Rows of other years, and those not drawn, are in
    no part; ``year_part`` names them all.
    """
    test_year = last_train_year + 1 if test_year is None else test_year
    part = year_part(df, last_train_year, test_year, train_fraction, check_year, keys, seed)
    out = [df.where((F.col("Year") <= last_train_year) & (part == "train"))]
    return (*out, *[df.where(F.col("Year") == y) for y in (test_year, check_year) if y is not None])


#: What the default split hashes: texts, dates and whole numbers.
SPLIT_KEYS = ["FlightDate", *CATEGORICAL, "Dep_Hour", "label"]


def default_split(df: DataFrame, seed: int = 42, train_fraction: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """By year when the data has at least two: all rows of all but the last year train; else the 80/20 hash split.

    With a ``train_fraction`` below 1 a sample of the earlier years' rows trains. Rows are hashed by SPLIT_KEYS, or by all
    columns if one of these is absent.
    """
    keys = SPLIT_KEYS if set(SPLIT_KEYS) <= set(df.columns) else None
    span = df.agg(F.min("Year").alias("lo"), F.max("Year").alias("hi")).first()
    if span["lo"] is not None and span["lo"] < span["hi"]:
        train, test = split_by_year(df, span["hi"] - 1, span["hi"], train_fraction=train_fraction, keys=keys, seed=seed)
        return train, test
    return split_hash(df, keys=keys, seed=seed)
