"""The registered queries: every operator applied to the tables of a data folder."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from punctual import functions as fn
from punctual.ml import features, metrics, models
from punctual.operators import checks, incremental, population, ranking, serving, tables, text
from punctual.operators.lookup import with_names
from punctual.operators.rollup import rate_rollup
from punctual.plans import batch, sql
from punctual.plans.demo import COLUMNS, flights, scored, table
from punctual.runtime import cut, hadoop_fs, kept_dir, scratch
from punctual.schema import CLICK_EVENT_SCHEMA, CONTRACTS, FLIGHT_COLUMNS, struct
from punctual.sources import files, manifest, publish as publishing, release as releases
from punctual.sources.publish import publish_dir
from punctual.streaming import accounted, events, live, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def fact(spark: SparkSession, sf_dir: str, name: str, *more: str) -> DataFrame:
    """The flight fact with the columns one of the tables reads."""
    return flights(spark, sf_dir, *dict.fromkeys([*tables.READS[name], *more]))


def _airline(spark, sf_dir, **options):
    return tables.airline_performance(fact(spark, sf_dir, "airline_performance"), **options)


def _airport(spark, sf_dir, **options):
    return tables.airport_performance(fact(spark, sf_dir, "airport_performance"), **options)


def _causes(spark, sf_dir):
    return tables.delay_causes_monthly(fact(spark, sf_dir, "delay_causes_monthly"))


def _hourly(spark, sf_dir):
    return tables.hourly_delays(fact(spark, sf_dir, "hourly_delays"))


def _routes(spark, sf_dir):
    return tables.route_traffic(fact(spark, sf_dir, "route_traffic"))


def _calendar(spark, sf_dir, **options):
    return tables.calendar_delays(fact(spark, sf_dir, "calendar_delays"), **options)


def _reasons(spark, sf_dir):
    return tables.cancellation_reasons(fact(spark, sf_dir, "cancellation_reasons"))


# --- the aggregate tables ---------------------------------------------------------------------


@query
def airline_performance(spark, sf_dir):
    return _airline(spark, sf_dir)


@query
def airport_performance(spark, sf_dir):
    return _airport(spark, sf_dir)


@query
def airport_performance_full(spark, sf_dir):
    return _airport(spark, sf_dir, how="full")


@query
def delay_causes_monthly(spark, sf_dir):
    return _causes(spark, sf_dir)


@query
def hourly_delays(spark, sf_dir):
    return _hourly(spark, sf_dir)


@query
def route_traffic(spark, sf_dir):
    return _routes(spark, sf_dir)


@query
def calendar_delays(spark, sf_dir):
    return _calendar(spark, sf_dir)


@query
def cancellation_reasons(spark, sf_dir):
    return _reasons(spark, sf_dir)


def _brands(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("code"), F.concat(F.lit("Carrier "), F.col("p_brand")).alias("name")
    )


@query
def airline_named(spark, sf_dir):
    return _airline(spark, sf_dir, dim=_brands(spark, sf_dir))


@query
def airport_named(spark, sf_dir):
    """Airport names from a lookup, joined to the aggregated table."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    dim = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("code"), F.col("r_name").alias("state")
    )
    counts = rate_rollup(flights(spark, sf_dir, "Origin"), {"Airport_Code": "Origin"}, ["Total_Departures"])
    return with_names(counts, dim, "Airport_Code", names={"State": "state"})


@query
def airport_unknown_codes(spark, sf_dir):
    """Names, cities and states from a lookup that lacks some codes: only the name falls back to the code."""
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 3 <> 0")
    dim = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("code"),
        F.concat(F.lit("Airport "), "n_name").alias("name"),
        F.concat("n_name", F.lit(" City")).alias("city"),
        F.col("r_name").alias("state"),
    )
    counts = rate_rollup(flights(spark, sf_dir, "Origin"), {"Airport_Code": "Origin"}, ["Total_Departures"])
    names = {"Airport_Name": "name", "City": "city", "State": "state"}
    return with_names(counts, dim, "Airport_Code", names=names)


@query
def carrier_season_rollup(spark, sf_dir):
    """The generic rollup with measures and outputs of its own."""
    df = flights(spark, sf_dir, "Reporting_Airline", "Month", "Cancelled", "Diverted", "ArrDel15", "ArrDelayMinutes")
    df = df.withColumn("Season", fn.season("Month"))
    return rate_rollup(
        df,
        ["Reporting_Airline", "Season"],
        {
            "Flights": "n",
            "Long_Delays": "long_delays",
            "Long_Delay_Pct": "CASE WHEN n > 0 THEN long_delays / n * 100.0D ELSE 0.0D END",
            "Diverted_Flights": "diverted",
        },
        measures={
            "n": "1",
            "long_delays": "CASE WHEN ArrDelayMinutes > 20 THEN 1 ELSE 0 END",
            "diverted": "CASE WHEN Diverted = 1 THEN 1 ELSE 0 END",
        },
    )


@query
def one_pass_grains(spark, sf_dir):
    return tables.grain_sums(fact(spark, sf_dir, "all_tables"))


# --- published forms --------------------------------------------------------------------------


def _widened(df: DataFrame) -> DataFrame:
    """Float columns as doubles, so that both engines print them alike."""
    return df.select(*[F.col(c).cast("double").alias(c) if kind == "float" else F.col(c) for c, kind in df.dtypes])


@query
def published_airline(spark, sf_dir):
    return _widened(checks.apply_contract(_airline(spark, sf_dir), "agg_airline_performance"))


@query
def published_airport(spark, sf_dir):
    return _widened(checks.apply_contract(_airport(spark, sf_dir), "agg_airport_performance"))


@query
def published_causes(spark, sf_dir):
    return _widened(checks.apply_contract(_causes(spark, sf_dir), "agg_delay_causes_monthly"))


@query
def published_hourly(spark, sf_dir):
    return _widened(checks.apply_contract(_hourly(spark, sf_dir), "agg_hourly_delays"))


@query
def published_routes(spark, sf_dir):
    return _widened(checks.apply_contract(_routes(spark, sf_dir), "agg_route_traffic"))


@query
def published_calendar(spark, sf_dir):
    return _widened(checks.apply_contract(_calendar(spark, sf_dir), "agg_calendar_delays"))


@query
def published_reasons(spark, sf_dir):
    return checks.apply_contract(_reasons(spark, sf_dir), "agg_cancellation_reasons")


@query
def publish_all(spark, sf_dir):
    """One-scan tables, published and read back: rows per table."""
    with scratch(spark, "serving") as target:
        counts = publishing.publish_all(tables.all_tables(fact(spark, sf_dir, "all_tables")), target)
    return spark.createDataFrame(list(counts.items()), "table_name string, table_rows bigint")


@query
def release_versions(spark, sf_dir):
    """Flights of the first years released, then of all years, then a release that breaks off: what readers find."""
    df = fact(spark, sf_dir, "all_tables")
    with scratch(spark, "releases") as target:
        first = releases.release(spark, tables.all_tables(df.where("Year <= 1996")), target)
        made = tables.all_tables(df)
        second = releases.release(spark, {n: made[n] for n in ("agg_hourly_delays", "agg_calendar_delays")}, target)
        broken = made["agg_route_traffic"].withColumn("Origin", F.raise_error(F.lit("stopped")).cast("string"))
        with contextlib.suppress(SparkRuntimeException):
            releases.release(spark, {"agg_calendar_delays": made["agg_calendar_delays"].limit(0), "agg_route_traffic": broken}, target)
        seen = {"first": first, "second": second, "newest": None}
        totals = [
            checks.reconcile_totals(releases.read_release(spark, target, v)).select(F.lit(n).alias("Release"), "Metric", "Source", "Total")
            for n, v in seen.items()
        ]
        return cut(reduce(DataFrame.unionByName, totals))


def _in_steps(spark, sf_dir) -> dict[str, DataFrame]:
    """The seven tables from a store that was loaded in steps: some years with half of their flights, the others, some
    again with all flights, and one of these months twice."""
    df = fact(spark, sf_dir, "all_tables", "Year", "Month")
    with scratch(spark, "fact") as path:
        files.write_flights(df, path)
        whole = files.read_flights(spark, path)
        months = sorted((r["Year"], r["Month"]) for r in whole.select("Year", "Month").distinct().collect())
        early = [m for m in months if m[0] <= 1996]
        store = kept_dir(spark, "store")
        incremental.refresh(whole.where("Dep_Hour < 12"), store, early)
        incremental.refresh(whole, store, [m for m in months if m[0] > 1996])
        incremental.refresh(whole, store, early)
        return incremental.tables_from_store(incremental.refresh(whole, store, early[:1]))


@query
def incremental_totals(spark, sf_dir):
    return checks.reconcile_totals(_in_steps(spark, sf_dir))


@query
def incremental_calendar(spark, sf_dir):
    return _in_steps(spark, sf_dir)["agg_calendar_delays"]


@query
def export_and_load(spark, sf_dir):
    """The calendar and hourly tables as named CSV files, loaded from the directory, totals read back."""
    made = {"agg_calendar_delays": _calendar(spark, sf_dir), "agg_hourly_delays": _hourly(spark, sf_dir)}
    with scratch(spark, "export") as path:
        for name, df in made.items():
            files.export_csv(checks.apply_contract(df, name), f"{path}/csv", name, CONTRACTS[name].keys)
        publish_dir(spark, f"{path}/csv", f"{path}/serving")
        return cut(checks.reconcile_totals({n: spark.read.parquet(f"{path}/serving/{n}") for n in made}))


@query
def reconcile_totals(spark, sf_dir):
    return checks.reconcile_totals(tables.all_tables(fact(spark, sf_dir, "all_tables")))


@query
def contract_violations(spark, sf_dir):
    """The flight rows checked as if they were the hourly table: every repeated hour is a violation."""
    rows = flights(spark, sf_dir, "Dep_Hour", "ArrDelay").select(
        "Dep_Hour",
        F.lit(1).alias("Total_Flights"),
        F.col("ArrDelay").alias("Delayed_Flights"),
        (F.col("ArrDelay") * 5).alias("Delay_Probability_Pct"),
        F.lit(0.0).alias("Avg_Delay_Minutes"),
    )
    return checks.contract_violations(rows, "agg_hourly_delays")


# --- serving questions ------------------------------------------------------------------------


@query
def airline_ranking(spark, sf_dir):
    return serving.airline_ranking(_airline(spark, sf_dir))


@query
def airline_ranking_all_years(spark, sf_dir):
    return serving.airline_ranking_all_years(fact(spark, sf_dir, "airline_performance"))


@query
def top_airports(spark, sf_dir):
    return serving.top_airports(_airport(spark, sf_dir), 10, min_departures=10)


@query
def peak_hours(spark, sf_dir):
    return serving.peak_hours(_hourly(spark, sf_dir))


@query
def hourly_curve(spark, sf_dir):
    return serving.hourly_curve(_hourly(spark, sf_dir))


@query
def cause_share(spark, sf_dir):
    return serving.cause_share(_causes(spark, sf_dir))


@query
def dow_rates(spark, sf_dir):
    return serving.dow_rates(_calendar(spark, sf_dir, extra=["Operated_Flights"]))


@query
def month_rates(spark, sf_dir):
    return serving.month_rates(_calendar(spark, sf_dir, extra=["Operated_Flights"]))


@query
def season_rates(spark, sf_dir):
    return serving.season_rates(_calendar(spark, sf_dir, extra=["Operated_Flights"]))


@query
def cancel_share(spark, sf_dir):
    return serving.cancel_share(_reasons(spark, sf_dir))


@query
def airline_cancel_rate(spark, sf_dir):
    return serving.airline_cancel_rate(_airline(spark, sf_dir))


@query
def airport_cancel_rate(spark, sf_dir):
    return serving.airport_cancel_rate(_airport(spark, sf_dir))


@query
def top_routes(spark, sf_dir):
    return serving.top_routes(_routes(spark, sf_dir))


@query
def delayed_routes(spark, sf_dir):
    return serving.delayed_routes(_routes(spark, sf_dir), 10, min_flights=100)


@query
def distance_vs_delay(spark, sf_dir):
    return serving.distance_vs_delay(_routes(spark, sf_dir))


@query
def distance_delay_correlation(spark, sf_dir):
    return serving.distance_delay_correlation(_routes(spark, sf_dir))


@query
def yoy_growth(spark, sf_dir):
    return serving.traffic_growth(_airline(spark, sf_dir))


@query
def kpi_cards(spark, sf_dir):
    return serving.kpi_cards(_airline(spark, sf_dir))


@query
def minutes_per_late_flight(spark, sf_dir):
    return serving.minutes_per_late_flight(
        flights(spark, sf_dir, "Cancelled", "Diverted", "ArrDel15", "ArrDelayMinutes")
    )


@query
def sliced_airlines(spark, sf_dir):
    """The overview page's slicers on the airline table."""
    return population.slice_by(_airline(spark, sf_dir), Year=[1996, 1998], Reporting_Airline=["Brand#1", "Brand#12"])


@query
def population_counts(spark, sf_dir):
    """Operated, late and cancelled flights per year, each through its own row filter, in one scan."""
    df = flights(spark, sf_dir, "Year", "Cancelled", "Diverted", "ArrDel15")
    counted = df.groupBy("Year").agg(
        *[F.count_if(F.expr(rule)).alias(name) for name, rule in population.RULES.items()]
    )
    cases = ", ".join(f"'{name}', `{name}`" for name in population.RULES)
    return counted.selectExpr("Year", f"stack({len(population.RULES)}, {cases}) AS (Population, Flights)").where(
        "Flights > 0"
    )


# --- ingest -----------------------------------------------------------------------------------


def _raw_text(df: DataFrame) -> DataFrame:
    """The fact as raw files carry it: all text, numbers as "3.00", an empty last column, and bad
    cells: on day 1 of a month the carrier delay is "x", on day 2 blank, on day 3 padded."""
    numbers = [c for c in df.columns if FLIGHT_COLUMNS.get(c) == "double"]
    columns = []
    for c in (c for c in df.columns if c not in ("Dep_Hour", "Route")):
        value = F.col(c).cast("string")
        if c in numbers:
            value = F.concat(value, F.lit(".00"))
        columns.append(value.alias(c))
    bad = (
        F.when(F.col("DayofMonth") == "1", "x")
        .when(F.col("DayofMonth") == "2", "")
        .when(F.col("DayofMonth") == "3", F.concat(F.lit(" "), "CarrierDelay", F.lit(" ")))
        .otherwise(F.col("CarrierDelay"))
    )
    return df.select(*columns).withColumn("CarrierDelay", bad).withColumn("_c109", F.lit(None).cast("string"))


@query
def conform_flights(spark, sf_dir):
    """Raw text typed. It lies in files before, as raw data does."""
    raw = cut(_raw_text(flights(spark, sf_dir)))
    out = files.conform(raw)
    return out.withColumn("FlightDate", F.col("FlightDate").cast("string"))


@query
def dep_hour_route(spark, sf_dir):
    df = flights(spark, sf_dir, "CRSDepTime", "Origin", "Dest")
    return (
        df.select(fn.dep_hour("CRSDepTime").alias("Dep_Hour"), fn.route("Origin", "Dest").alias("Route"))
        .groupBy("Dep_Hour", "Route")
        .agg(F.count("*").alias("Flights"))
    )


@query
def csv_etl(spark, sf_dir):
    """Raw CSV written, read back by name and typed: months with sums over the typed columns."""
    columns = [c for c in COLUMNS if c not in ("Dep_Hour", "Route")]
    with scratch(spark, "raw") as path:
        files.write_csv(_raw_text(flights(spark, sf_dir, *columns)), path)
        df = files.conform(files.read_raw_csv(spark, path))
        return cut(
            df.groupBy("Year", "Month").agg(
                F.count("*").alias("Flights"),
                F.count("CarrierDelay").alias("Carrier_Values"),
                F.sum("CarrierDelay").alias("Carrier_Minutes"),
                F.sum("ArrDelay").alias("Arr_Delay"),
                F.count("DepTime").alias("Dep_Times"),
                F.sum("Dep_Hour").alias("Hour_Sum"),
                F.min("Route").alias("First_Route"),
            )
        )


@query
def csv_mixed_headers(spark, sf_dir):
    """Two folders of raw files as one, the second with other column order and without one column: matched by name."""
    df = flights(spark, sf_dir, "Year", "Month", "Origin", "Dest", "ArrDelay", "Distance")
    raw = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    with scratch(spark, "mixed") as path:
        files.write_csv(raw.where("Year % 2 = 0"), f"{path}/a")
        files.write_csv(raw.where("Year % 2 = 1").select("Dest", "ArrDelay", "Month", "Origin", "Year"), f"{path}/b")
        back = files.conform(files.read_raw_csv(spark, [f"{path}/a", f"{path}/b"]), derive=False)
        return cut(
            back.groupBy("Year", "Origin", "Dest").agg(
                F.count("*").alias("Flights"), F.sum("ArrDelay").alias("Minutes"), F.count("Distance").alias("Distances")
            )
        )


def _folder(file: str = "file"):
    return F.regexp_extract(file, "/([ab])/[^/]*$", 1).alias("folder")


@query
def csv_losses(spark, sf_dir):
    """Raw files of two kinds, the second with short and overlong lines, loaded with an account of all that is lost."""
    columns = [c for c in COLUMNS if c not in ("Dep_Hour", "Route")]
    raw = _raw_text(flights(spark, sf_dir, *columns))
    names = ["Year", "Month", "Dest", "Origin", "ArrDelay"]
    day = F.col("DayofMonth").cast("int") % 3
    fields = [F.coalesce(F.col(c), F.lit("")) for c in names]
    line = F.when(day == 0, F.concat_ws(",", *fields[:-1])).when(day == 1, F.concat_ws(",", *fields, F.lit("more"))).otherwise(F.concat_ws(",", *fields))
    with scratch(spark, "lossy") as path:
        files.write_csv(raw.where("Year % 2 = 0"), f"{path}/raw/a")
        lines = raw.where("Year % 2 = 1").select(line.alias(",".join(names)))
        lines.write.option("header", True).option("sep", "\t").option("quote", "").csv(f"{path}/raw/b")
        account = files.load_raw(spark, [f"{path}/raw/a", f"{path}/raw/b"], f"{path}/cleaned", f"{path}/rejects")
        if not account.where("rows_in <> rows_out + rejected").isEmpty():
            raise AssertionError("rows are neither in nor among the rejects")
        sums = account.groupBy(_folder()).agg(F.sum("rows_in").alias("Rows_In"), F.sum("rejected").alias("Rejected"))
        lost = account.select("file", F.explode_outer("lost")).groupBy(_folder()).agg(
            F.coalesce(F.sum("value"), F.lit(0)).alias("Lost_Values"), F.count_distinct("key").alias("Lossy_Columns")
        )
        lines = spark.read.parquet(f"{path}/rejects").groupBy(_folder()).agg(F.count("*").alias("Lines"))
        loaded = files.read_flights(spark, f"{path}/cleaned").groupBy(F.when(F.col("Year") % 2 == 0, "a").otherwise("b").alias("folder"))
        loaded = loaded.agg(F.count("*").alias("Loaded"), F.sum("ArrDelay").alias("Minutes"))
        return cut(sums.join(lost, "folder").join(lines, "folder", "left").join(loaded, "folder").na.fill(0, ["Lines"]))


@query
def csv_inferred(spark, sf_dir):
    """Types guessed over two folders with other column orders: whole and broken numbers, dates, texts, an empty column."""
    df = flights(spark, sf_dir, "Year", "FlightDate", "Origin", "ArrDelay", "Distance", "CancellationCode")
    raw = df.withColumns({"Distance": F.col("Distance") / 4, "Nothing": F.lit(None).cast("string")})
    with scratch(spark, "inferred") as path:
        files.write_csv(raw.where("Year % 2 = 0"), f"{path}/a")
        files.write_csv(raw.where("Year % 2 = 1").select("Origin", "Nothing", "Distance", "ArrDelay", "FlightDate", "CancellationCode", "Year"), f"{path}/b")
        back = files.read_csv_inferred(spark, [f"{path}/a", f"{path}/b"])
        kinds = F.lit(",".join(f"{c}:{kind}" for c, kind in sorted(back.dtypes)))
        return back.groupBy("Year", "Origin").agg(
            kinds.alias("Kinds"), F.sum("ArrDelay").alias("Minutes"), F.sum("Distance").alias("Miles"),
            F.count("CancellationCode").alias("Codes"), F.count("Nothing").alias("Nothings"), F.max("FlightDate").cast("string").alias("Last"),
        )


@query
def parquet_by_year(spark, sf_dir):
    """Year-partitioned Parquet written and read back under a year filter, which prunes directories."""
    with scratch(spark, "flights") as path:
        files.write_flights(fact(spark, sf_dir, "calendar_delays"), path)
        return cut(tables.calendar_delays(population.in_years(files.read_flights(spark, path), 1997, 1999)))


@query
def written_counts(spark, sf_dir):
    """Rows that the write of the fact reports, beside those that lie there per year."""
    with scratch(spark, "flights") as path:
        written = files.write_flights(fact(spark, sf_dir, "calendar_delays"), path)
        there = files.read_flights(spark, path).groupBy("Year").agg(F.count("*").alias("Flights"))
        return cut(there.withColumn("Written", F.lit(written).cast("bigint")))


@query
def batch_run(spark, sf_dir):
    """The whole batch from packed raw CSV files: rows of the fact and of every published table, predictions included."""
    with scratch(spark, "batch") as path:
        columns = [c for c in COLUMNS if c not in ("Dep_Hour", "Route")]
        files.write_csv(_raw_text(flights(spark, sf_dir, *columns)), f"{path}/raw", compression="gzip")
        done = batch.run_batch(spark, f"{path}/raw", f"{path}/cleaned", f"{path}/serving")
    counts = [("flights", done.fact_rows), *done.published.items()]
    return spark.createDataFrame(counts, "table_name string, table_rows bigint")


@query
def raw_manifest_months(spark, sf_dir):
    return manifest.month_coverage(flights(spark, sf_dir, "Year", "Month"))


@query
def raw_manifest_files(spark, sf_dir):
    """Raw months written to folders, then listed and counted: months with files, rows and state."""
    months = flights(spark, sf_dir, "Year", "Month", "FlightDate", "ArrDelay")
    span = months.agg(F.min("Year").alias("lo"), F.max("Year").alias("hi")).first()
    with scratch(spark, "landing") as path:
        # one task per month and part of it, not one file per month and input task
        months = months.repartition("Year", "Month", F.pmod(F.xxhash64("FlightDate"), F.lit(4)))
        months.write.partitionBy("Year", "Month").option("header", True).csv(path)
        found = manifest.raw_manifest(
            spark, path, span["lo"], span["hi"], min_bytes=1, count_rows=True, pattern=manifest.BY_FOLDER
        )
        return cut(found.select("Year", "Month", (F.col("files") > 0).alias("landed"), "rows", "ok"))


# --- models: metrics on a fixed score, then trained models ------------------------------------

_REPORT = ("FlightDate", "Reporting_Airline", "Origin", "Dest", "Dep_Hour")


def _predictions(spark, sf_dir, *columns):
    """Predictions with the fixed score, with only the report columns a query needs."""
    return scored(spark, sf_dir, *columns).select(
        *columns,
        F.col("label").alias("Actual_Delayed"),
        F.col("prediction").alias("Predicted_Delayed"),
        F.round("score", 4).cast("float").alias("Delay_Probability"),
    ).withColumn("Risk_Category", fn.risk_category("Delay_Probability"))


@query
def risk_buckets(spark, sf_dir):
    """Rows per published probability and its bucket."""
    out = _predictions(spark, sf_dir).groupBy("Delay_Probability", "Risk_Category").agg(F.count("*").alias("Flights"))
    return out.select(F.round(F.col("Delay_Probability").cast("double"), 4).alias("P"), "Risk_Category", "Flights")


@query
def high_risk_flights(spark, sf_dir):
    return serving.high_risk_flights(_predictions(spark, sf_dir))


@query
def risk_distribution(spark, sf_dir):
    return serving.risk_distribution(_predictions(spark, sf_dir))


@query
def flight_inspection(spark, sf_dir):
    rows = serving.flight_inspection(_predictions(spark, sf_dir, *_REPORT), risk="High", hour=[17, 18])
    return rows.withColumn("FlightDate", F.col("FlightDate").cast("string"))


@query
def prediction_table(spark, sf_dir):
    rows = models.predictions(scored(spark, sf_dir, *_REPORT), limit=None)
    out = _widened(checks.apply_contract(rows, "ml_delay_predictions"))
    return out.withColumn("FlightDate", F.col("FlightDate").cast("string"))


@query
def prediction_table_vector(spark, sf_dir):
    """The prediction table where the score comes as a vector of both classes' probabilities."""
    rows = scored(spark, sf_dir, *_REPORT)
    rows = rows.withColumn("probability", array_to_vector(F.array(1 - F.col("score"), "score"))).drop("score")
    out = _widened(checks.apply_contract(models.predictions(rows), "ml_delay_predictions"))
    return out.withColumn("FlightDate", F.col("FlightDate").cast("string"))


@query
def prediction_sample(spark, sf_dir):
    """A published sample: 50,000 rows in hash order."""
    rows = models.predictions(scored(spark, sf_dir, *_REPORT), limit=50_000)
    out = _widened(checks.apply_contract(rows, "ml_delay_predictions"))
    return out.withColumn("FlightDate", F.col("FlightDate").cast("string"))


@query
def hash_sample(spark, sf_dir):
    """A tenth of the flights, drawn by a hash of what names a flight, per year."""
    keys = ["FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest"]
    drawn = ranking.hash_sample(flights(spark, sf_dir, "Year", *keys), 0.1, keys)
    return drawn.groupBy("Year").agg(F.count("*").alias("Flights"))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir))


@query
def precision_recall(spark, sf_dir):
    return metrics.precision_recall(scored(spark, sf_dir))


@query
def roc_points(spark, sf_dir):
    return metrics.roc_points(scored(spark, sf_dir), bins=20)


@query
def majority_baseline(spark, sf_dir):
    return metrics.majority_baseline(scored(spark, sf_dir))


@query
def roc_auc_by_rank(spark, sf_dir):
    return metrics.roc_auc_by_rank(scored(spark, sf_dir))


@query
def pr_area(spark, sf_dir):
    area = metrics.pr_area(scored(spark, sf_dir))
    return area.withColumn("auc_pr", F.round("auc_pr", 9))


def _training(spark, sf_dir):
    needed = ["Year", "FlightDate", *features.CATEGORICAL, *features.NUMERIC, "Cancelled", "Diverted", "ArrDel15"]
    return features.training_rows(flights(spark, sf_dir, *needed))


@query
def split_sizes(spark, sf_dir):
    """Rows and late flights in the parts of the hash split and of the split by year, every row in one of each."""
    with scratch(spark, "training") as path:
        rows = cut(_training(spark, sf_dir).select("Year", *features.SPLIT_KEYS), path=path)
        last = rows.agg(F.max("Year")).first()[0] or 0
        by_hash = F.concat(F.lit("hash_"), features.hash_part(rows, keys=features.SPLIT_KEYS))
        by_year = features.year_part(rows, last - 2, last - 1, check_year=last, keys=features.SPLIT_KEYS)
        parts = rows.select("label", F.explode(F.array(by_hash, F.concat(F.lit("year_"), by_year))).alias("part"))
        return cut(parts.groupBy("part").agg(F.count("*").alias("rows"), F.count_if(F.col("label") == 1).alias("late")))


#: Share of the earlier years' rows that train where a query's SQL states it, and in the queries on the same model.
_DRAWN = 0.15


def _scored_test(spark, sf_dir):
    """All rows of the default split's test part, scored by logistic regression on drawn rows of the years before."""
    train, test = features.default_split(_training(spark, sf_dir), train_fraction=_DRAWN)
    return models.score(models.train(train, "lr"), test)


@query
def delay_model_scores(spark, sf_dir):
    """Logistic regression on the default split; the published predictions of its whole test part."""
    return models.predictions(_scored_test(spark, sf_dir))


@query
def delay_model_coverage(spark, sf_dir):
    """Flights that the model has scored, and late ones among them, per year and carrier."""
    rows = _scored_test(spark, sf_dir).groupBy("Year", "Reporting_Airline")
    return rows.agg(
        F.count("prediction").alias("Scored"), F.sum(F.col("label").cast("bigint")).alias("Late_Flights")
    )


@query
def model_comparison(spark, sf_dir):
    """Both kinds of model, with as many iterations each, on the same rows: all of the years before the last."""
    train, test = features.default_split(_training(spark, sf_dir))
    with scratch(spark, "comparison") as path:
        rows, test = models.training_table(train, f"{path}/train"), cut(test, path=f"{path}/test")
        fitted = {kind: models.train(rows, kind, written=True) for kind in ("lr", "gbt")}
        return models.compare(fitted, test)


@query
def rule_comparison(spark, sf_dir):
    """Two fixed rules through the comparison of models: the score as the probability, and its tenths."""

    def rule(late: str) -> PipelineModel:
        chosen = f"SELECT label, 1D - {late} AS punctual, {late} AS late, CAST({late} >= 0.5D AS DOUBLE) AS prediction FROM __THIS__"
        both = VectorAssembler(inputCols=["punctual", "late"], outputCol="probability")
        return PipelineModel(stages=[SQLTransformer(statement=chosen), both])

    with scratch(spark, "rules") as path:
        test = cut(scored(spark, sf_dir).select("label", "score"), path=path)
        out = models.compare({"score": rule("score"), "tenths": rule("(floor(score * 10) / 10)")}, test)
    return out.withColumns({c: F.round(c, 9) for c in ("auc_roc", "auc_pr", "f1")})


@query
def model_gradient(spark, sf_dir):
    """Features of a converged logistic regression, and those along which its loss has no slope left."""
    train, _ = features.default_split(_training(spark, sf_dir), train_fraction=_DRAWN)
    with scratch(spark, "training") as path:
        rows = models.training_table(train, path)
        slopes = models.gradient(models.train(rows, "lr", max_iter=200, written=True), rows)
    flat = F.count_if(F.abs("gradient") <= 1e-3)
    return slopes.groupBy("kind").agg(F.count("*").alias("features"), flat.alias("flat"))


@query
def feature_importance(spark, sf_dir):
    train, _ = features.default_split(_training(spark, sf_dir), train_fraction=_DRAWN)
    return models.importance(models.train(train, "lr"), spark)


@query
def feature_names(spark, sf_dir):
    """The features of the fitted model: one per category seen in training, one for others, and the numbers."""
    train, _ = features.default_split(_training(spark, sf_dir), train_fraction=_DRAWN)
    names = models.importance(models.train(train, "lr", max_iter=1), spark).select("feature")
    kind = F.when(F.col("feature").contains("_ohe_"), F.regexp_extract("feature", "^(.*)_ohe_", 1)).otherwise("number")
    return names.groupBy(kind.alias("kind")).agg(F.count("*").alias("features"))


# --- text and SQL -----------------------------------------------------------------------------


@query
def word_count(spark, sf_dir):
    return text.word_count(table(spark, sf_dir, "documents"), "text")


@query
def word_count_conversations(spark, sf_dir):
    return text.word_count(table(spark, sf_dir, "conversations"), "text")


@query
def event_lines(spark, sf_dir):
    """Event types and payloads as text files, read back line by line: words and how often they come."""
    with scratch(spark, "lines") as path:
        table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_type", "props")).write.text(path)
        return cut(text.word_count(files.read_lines(spark, path), "value"))


@query
def category_count(spark, sf_dir):
    sql.register({"event_rows": table(spark, sf_dir, "events")})
    return sql.category_count(spark, "event_rows", "event_type")


@query
def view_total_rows(spark, sf_dir):
    sql.register({"flight_rows": flights(spark, sf_dir, "Year")})
    return sql.total_rows(spark, "flight_rows")


@query
def preview_first_n(spark, sf_dir):
    return ranking.preview(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), 10, "event_id")


# --- events -----------------------------------------------------------------------------------

_STAMP = "yyyy-MM-dd HH:mm:ss"


def _click_payload(df: DataFrame) -> DataFrame:
    return events.to_payload(
        df.select("user_id", F.col("event_type").alias("action"), F.col("ts").cast("string").alias("ts")),
        "user_id", "action", "ts",
    )


def _flight_events(df: DataFrame) -> DataFrame:
    """Event rows in the raw form of a flight event."""
    return df.select(
        "event_id",
        F.col("ts").alias("event_timestamp"),
        F.col("event_type").alias("reporting_airline"),
        (F.floor("value").cast("bigint") % 60 - 20).alias("arr_delay"),
    )


_RAW_EVENT = struct(
    {"event_id": "bigint", "event_timestamp": "string", "reporting_airline": "string", "arr_delay": "bigint"}
)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema, path = table(spark, sf_dir, "events").schema, f"{sf_dir}/events.parquet"
    fs, jpath = hadoop_fs(spark, path)
    reader = spark.readStream.schema(schema)
    if fs.getFileStatus(jpath).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _stamped(windows: DataFrame) -> DataFrame:
    return windows.withColumns({c: F.date_format(c, _STAMP) for c in ("window_start", "window_end")})


@query
def events_parsed(spark, sf_dir):
    return events.parse_events(_click_payload(table(spark, sf_dir, "events")), CLICK_EVENT_SCHEMA)


@query
def event_rejects(spark, sf_dir):
    """Messages cut short, with a text where a number belongs, or without a time: good and rejected ones counted."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, sf_dir, "events").select(
        F.when(k % 4 == 1, F.expr("left(props, 4)"))
        .when(k % 4 == 2, F.lit('{"k": "two", "t": "2026-01-01"}'))
        .when(k % 4 == 3, F.concat(F.lit('{"k": '), k.cast("string"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"k": '), k.cast("string"), F.lit(', "t": "2026-01-01"}')))
        .cast("binary")
        .alias("value")
    )
    good, bad = events.split_rejects(rows, struct({"k": "int", "t": "string"}), time="t")
    counted = good.agg(F.count("*").alias("messages"), F.sum("k").alias("total")).withColumn("kind", F.lit("good"))
    refused = bad.agg(F.count("*").alias("messages"), F.lit(None).cast("bigint").alias("total"))
    return counted.unionByName(refused.withColumn("kind", F.lit("rejected")))


@query
def stream_accounting(spark, sf_dir):
    """A stream's messages, every seventh without a readable time: all of them are in windows or among the rejects."""
    raw = _flight_events(_event_stream(spark, sf_dir))
    stamp = F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.col("event_timestamp").cast("string"))
    payload = events.to_payload(raw.withColumn("event_timestamp", stamp), *_RAW_EVENT.fieldNames())
    good, bad = events.split_rejects(payload, _RAW_EVENT, time="event_timestamp")
    with scratch(spark, "accounting") as path:
        windows = live.live_metrics(events.enrich_events(good), "1 hour")
        sinks.start_serving_sink(
            windows, path, f"{path}/checkpoint/live", "live", every=None, mode="update"
        ).awaitTermination()
        sinks.start_serving_sink(bad, path, f"{path}/checkpoint/bad", "rejects", every=None).awaitTermination()
        counted = live.latest_state(spark.read.parquet(f"{path}/live")).agg(F.sum("events").alias("in_windows"))
        refused = spark.read.parquet(f"{path}/rejects").agg(F.count("*").alias("rejected"))
        return cut(counted.crossJoin(refused))


@query
def stream_late_rows(spark, sf_dir):
    """Events that come in three runs of a stream, later runs with older events too, every seventh without a time: what
    is in windows, late, and rejected, per run's part of the events."""
    rows = _flight_events(table(spark, sf_dir, "events"))
    stamp = F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.col("event_timestamp").cast("string"))
    with scratch(spark, "late") as path:
        for part in range(3):
            some = rows.where(F.col("event_id") % 3 == part).withColumn("event_timestamp", stamp)
            payload = events.to_payload(some, *_RAW_EVENT.fieldNames())
            payload.coalesce(1).write.mode("append").parquet(f"{path}/topic")
            source = spark.readStream.schema(payload.schema).parquet(f"{path}/topic")
            good, bad = events.split_rejects(source, _RAW_EVENT, time="event_timestamp")
            accounted.start_accounted_windows(
                events.enrich_events(good), f"{path}/live", f"{path}/checkpoint/live", "1 hour", 10 * 86_400, every=None, merge_at=2
            ).awaitTermination()
            sinks.start_serving_sink(bad, path, f"{path}/checkpoint/bad", "rejects", every=None).awaitTermination()
        windows = accounted.read_windows(spark, f"{path}/live")
        counted = windows.agg(F.sum("events").alias("in_windows"), F.sum("active_delays").alias("delays"), F.count("*").alias("windows"))
        late = accounted.read_late(spark, f"{path}/live").agg(
            *[F.count_if(F.col("event_id") % 3 == part).alias(f"late_{part}") for part in range(3)]
        )
        refused = spark.read.parquet(f"{path}/rejects").agg(F.count("*").alias("rejected"))
        return cut(counted.crossJoin(late).crossJoin(refused))


@query
def events_enriched(spark, sf_dir):
    out = events.enrich_events(_flight_events(table(spark, sf_dir, "events")))
    return out.withColumn("event_timestamp", F.date_format("event_timestamp", _STAMP))


@query
def events_flight_fields(spark, sf_dir):
    """Flight events with their departure half: flight id, clock label, clamped departure delay."""
    rows = table(spark, sf_dir, "events")
    raw = _flight_events(rows).join(rows.select("event_id", "user_id"), "event_id")
    raw = raw.withColumns(
        {
            "flight_number": F.col("user_id"),
            "crs_dep_hour": (F.col("event_id") % 24).cast("int"),
            "crs_dep_minute": (F.col("event_id") % 4 * 15).cast("int"),
            "dep_delay": F.col("arr_delay") + F.col("event_id") % 5 - 2,
        }
    )
    return events.enrich_events(raw).select("event_id", "flight_id", "crs_dep_time", "dep_delay_minutes", "arr_delay_minutes", "status")


@query
def live_metrics_batch(spark, sf_dir):
    rows = events.enrich_events(_flight_events(table(spark, sf_dir, "events")))
    return _stamped(live.live_metrics(rows, "1 hour"))


@query
def stream_live_metrics(spark, sf_dir):
    """The same windows from a stream of JSON messages, through an update-mode sink."""
    raw = _flight_events(_event_stream(spark, sf_dir))
    payload = events.to_payload(
        raw.withColumn("event_timestamp", F.col("event_timestamp").cast("string")), *_RAW_EVENT.fieldNames()
    )
    windows = live.live_metrics(events.enrich_events(events.parse_events(payload, _RAW_EVENT)), "1 hour")
    with scratch(spark, "live") as path:
        sinks.start_serving_sink(
            windows, path, f"{path}/checkpoint", "live_metrics", every=None, mode="update"
        ).awaitTermination()
        return cut(_stamped(live.latest_state(spark.read.parquet(f"{path}/live_metrics"))))


@query
def stream_json_sink(spark, sf_dir):
    """Click messages decoded from a stream into JSON files, read back."""
    parsed = events.parse_events(_click_payload(_event_stream(spark, sf_dir)), CLICK_EVENT_SCHEMA)
    with scratch(spark, "json") as path:
        sinks.start_json_sink(parsed, f"{path}/out", f"{path}/checkpoint", every=None).awaitTermination()
        back = spark.read.schema(CLICK_EVENT_SCHEMA).json(f"{path}/out")
        return cut(
            back.groupBy("action").agg(
                F.count("*").alias("events"), F.sum("user_id").alias("users"), F.min("ts").alias("first_ts")
            )
        )


@query
def stream_serving_sink(spark, sf_dir):
    """Enriched flight events of a stream in the serving table, read back per airline and status."""
    rows = events.enrich_events(_flight_events(_event_stream(spark, sf_dir)))
    with scratch(spark, "speed") as path:
        sinks.start_serving_sink(rows, path, f"{path}/checkpoint", every=None).awaitTermination()
        back = spark.read.parquet(f"{path}/flights_processed")
        return cut(
            back.groupBy("reporting_airline", "status").agg(
                F.count("*").alias("events"), F.sum("arr_delay_minutes").alias("minutes")
            )
        )
