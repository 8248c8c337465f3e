"""The flight fact derived from the order tables described in FIXTURES.md (part B1).

One flight per ``lineitem`` row. Every attribute lookup is a left join on the lookup's primary key,
which never changes the number of rows; a lookup none of whose columns is wanted is therefore left
out. ``lineitem`` is shuffled only for the lookups a query really needs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from punctual.runtime import hadoop_fs

# Each term may use table columns and the terms above it.
TERMS: dict[str, str] = {
    "hh": "CAST(l_partkey % 25 AS INT)",
    "mi": "CAST(l_suppkey % 4 AS INT) * 15",
    "ad": "CAST(floor(l_extendedprice) AS BIGINT) % 60 - 30",
    "cx": "CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 1 ELSE 0 END",
    "dv0": "CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END",
    "dist": "100 * abs(s_nationkey - c_nationkey) + 50",
    "dv": "CASE WHEN cx = 1 THEN 0 ELSE dv0 END",
    "dd": "ad - (l_linenumber - 4)",
    "crs": "CAST(floor(dist / 8.0D) AS BIGINT) + 30",
    "arr": "CASE WHEN cx = 0 AND dv = 0 THEN ad END",
    "dep": "CASE WHEN cx = 0 THEN dd END",
    "arrm": "CASE WHEN arr IS NOT NULL THEN greatest(arr, 0L) END",
    "depm": "CASE WHEN dep IS NOT NULL THEN greatest(dep, 0L) END",
    "a15": "CASE WHEN arr >= 15 THEN 1 WHEN arr IS NOT NULL THEN 0 END",
    "d15": "CASE WHEN dep >= 15 THEN 1 WHEN dep IS NOT NULL THEN 0 END",
    "cause": "CAST(l_partkey % 5 AS INT)",
    "Year": "CAST(year(l_shipdate) AS INT)",
    "Month": "CAST(month(l_shipdate) AS INT)",
    "DayofMonth": "CAST(day(l_shipdate) AS INT)",
    "DayOfWeek": "CAST(weekday(l_shipdate) + 1 AS INT)",
    "FlightDate": "CAST(l_shipdate AS DATE)",
    "Reporting_Airline": "p_brand",
    "Tail_Number": "CAST(l_suppkey AS STRING)",
    "Flight_Number_Reporting_Airline": "CAST(l_partkey AS STRING)",
    "Origin": "s_nation",
    "OriginCityName": "concat(s_nation, ', ', s_region)",
    "OriginState": "s_region",
    "Dest": "c_nation",
    "DestCityName": "concat(c_nation, ', ', c_region)",
    "DestState": "c_region",
    "CRSDepTime": "CASE WHEN hh = 24 THEN 2400 ELSE hh * 100 + mi END",
    "DepDelay": "dep",
    "DepDelayMinutes": "depm",
    "DepDel15": "d15",
    "ArrDelay": "arr",
    "ArrDelayMinutes": "arrm",
    "ArrDel15": "a15",
    "Cancelled": "cx",
    "CancellationCode": "CASE WHEN cx = 1 AND l_orderkey % 5 < 4 "
    "THEN substring('ABCD', CAST(l_orderkey % 5 AS INT) + 1, 1) END",
    "Diverted": "dv",
    "CRSElapsedTime": "crs",
    "ActualElapsedTime": "crs + arr - dep",
    "AirTime": "CASE WHEN arr IS NOT NULL THEN crs - 20 + l_linenumber END",
    "Distance": "dist",
    "CarrierDelay": "CASE WHEN a15 = 1 THEN CASE WHEN cause = 0 THEN arrm - 5 WHEN cause = 4 THEN 5 ELSE 0 END END",
    "WeatherDelay": "CASE WHEN a15 = 1 THEN CASE WHEN cause = 1 THEN arrm - 5 WHEN cause = 0 THEN 5 ELSE 0 END END",
    "NASDelay": "CASE WHEN a15 = 1 THEN CASE WHEN cause = 2 THEN arrm - 5 WHEN cause = 1 THEN 5 ELSE 0 END END",
    "SecurityDelay": "CASE WHEN a15 = 1 THEN CASE WHEN cause = 3 THEN arrm - 5 WHEN cause = 2 THEN 5 ELSE 0 END END",
    "LateAircraftDelay": "CASE WHEN a15 = 1 THEN CASE WHEN cause = 4 THEN arrm - 5 WHEN cause = 3 THEN 5 "
    "ELSE 0 END END",
    "Dep_Hour": "hh % 24",
    "Route": "concat_ws('-', s_nation, c_nation)",
}
_HELPERS = set(list(TERMS)[: list(TERMS).index("Year")])
COLUMNS = [t for t in TERMS if t not in _HELPERS]
_WORD = re.compile(r"[A-Za-z_0-9]+")


def _requires(wanted: list[str]) -> tuple[list[str], set[str]]:
    """The terms behind the wanted columns, in order, and the table columns they read."""
    terms, tables, todo = set(), set(), list(wanted)
    while todo:
        term = todo.pop()
        if term in terms:
            continue
        terms.add(term)
        for word in _words(term):
            if word in TERMS and word != term:
                todo.append(word)
            elif word[:2] in ("l_", "p_", "s_", "c_"):
                tables.add(word)
    return [t for t in TERMS if t in terms], tables


_schemas: dict[tuple[str, int], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Its schema is read from a file footer once, and again when the table has been rewritten."""
    path = f"{sf_dir}/{name}.parquet"
    fs, jpath = hadoop_fs(spark, path)
    known = (path, fs.getFileStatus(jpath).getModificationTime())
    if known not in _schemas:
        _schemas[known] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[known]).parquet(path)


def places(spark: SparkSession, sf_dir: str, side: str, names: bool, regions: bool) -> DataFrame:
    """nation (and region) under the names of one end of the flight."""
    nation = table(spark, sf_dir, "nation")
    columns = [F.col("n_nationkey").alias(f"{side}_nk")]
    if regions:
        nation = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        columns.append(F.col("r_name").alias(f"{side}_region"))
    if names:
        columns.append(F.col("n_name").alias(f"{side}_nation"))
    return nation.select(*columns)


def flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The flight fact, with the given columns (default: all of them)."""
    wanted = list(columns) or COLUMNS
    terms, reads = _requires(wanted)
    keys = {"l_" + k for k, need in (("partkey", "p_"), ("suppkey", "s_"), ("orderkey", "c_")) if _any(reads, need)}
    lines = table(spark, sf_dir, "lineitem")
    early = _early(terms, keys)
    gone = {c for t in early for c in _columns(t) - keys if _users(c, terms) == [t]}
    df = lines.selectExpr(*[c for c in lines.columns if c in reads | keys and c not in gone], *[f"{TERMS[t]} AS `{t}`" for t in early])
    if _any(reads, "p_"):
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        df = df.join(part, df["l_partkey"] == part["p_partkey"], "left")
    if _any(reads, "s_"):
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        df = df.join(supplier, df["l_suppkey"] == supplier["s_suppkey"], "left")
    if _any(reads, "c_"):
        # orders x customer first: lineitem is then shuffled once, with a small integer to carry.
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        buyer = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
            "o_orderkey", "c_nationkey"
        )
        df = df.join(buyer, df["l_orderkey"] == buyer["o_orderkey"], "left")
    # Names come last, so that the shuffles above carry nation numbers only.
    for side in ("s", "c"):
        df = _with_place(spark, sf_dir, df, side, reads)
    # Later terms refer to earlier ones of the same select (lateral column aliases).
    return df.selectExpr(*[f"`{t}`" if t in early else f"{TERMS[t]} AS `{t}`" for t in terms]).select(*wanted)


def _words(term: str) -> list[str]:
    return _WORD.findall(re.sub(r"'[^']*'", "", TERMS[term]))


def _columns(term: str) -> set[str]:
    """Table columns that a term reads itself."""
    return {w for w in _words(term) if w[:2] in ("l_", "p_", "s_", "c_")}


def _users(column: str, terms: list[str]) -> list[str]:
    return [t for t in terms if column in _words(t)]


def _early(terms: list[str], keys: set[str]) -> list[str]:
    """Terms over lineitem alone that take the place of a column, which then is in no shuffle: only they read it."""
    alone = [t for t in terms if not any(w in TERMS for w in _words(t)) and all(c[:2] == "l_" for c in _columns(t))]
    return [t for t in alone if any(_users(c, terms) == [t] and c not in keys for c in _columns(t))]


def _any(reads: set[str], prefix: str) -> bool:
    return any(c.startswith(prefix) for c in reads)


def _with_place(spark: SparkSession, sf_dir: str, df: DataFrame, side: str, reads: set[str]) -> DataFrame:
    names, regions = f"{side}_nation" in reads, f"{side}_region" in reads
    if not (names or regions):
        return df
    place = places(spark, sf_dir, side, names, regions)
    return df.join(place, df[f"{side}_nationkey"] == place[f"{side}_nk"], "left")


def scored(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Operated flights with a fixed score in place of a model: (flight number mod 100) / 100.

    The score is predicted late from 0.5 on; the label is ArrDel15.
    """
    need = [c for c in dict.fromkeys(["Flight_Number_Reporting_Airline", "Cancelled", "Diverted", "ArrDel15", *columns])]
    rows = flights(spark, sf_dir, *need).where("Cancelled = 0 AND Diverted = 0 AND ArrDel15 IS NOT NULL")
    return rows.selectExpr(
        *columns,
        "CAST(ArrDel15 AS INT) AS label",
        "(CAST(Flight_Number_Reporting_Airline AS BIGINT) % 100) / 100.0D AS score",
    ).withColumn("prediction", F.expr("CASE WHEN score >= 0.5D THEN 1 ELSE 0 END"))
