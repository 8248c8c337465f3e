"""The seven aggregate tables and their one-scan form.

Each operator takes the flight fact and returns unrounded doubles; ``apply_contract`` rounds and
narrows for publication. ``extra`` adds further columns of ``rollup.OUTPUTS`` for later
re-aggregation (for example ``Operated_Flights``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from punctual.functions.flight import CANCELLED_SQL, DELAYED_SQL, UNKNOWN, cancellation_reason
from punctual.operators.lookup import with_names
from punctual.operators.rollup import MEASURES, OUTPUTS, mean, measures_used, rate_rollup, share
from punctual.runtime import cut

# Published measure columns per table.
AIRLINE = [
    "Total_Flights",
    "OnTime_Flights",
    "Delayed_Flights",
    "Delay_Rate_Pct",
    "Avg_Dep_Delay_Min",
    "Avg_Arr_Delay_Min",
    "Cancelled_Flights",
    "Cancellation_Rate_Pct",
]
CAUSES = [
    "Total_Delay_Minutes",
    "Carrier_Delay_Min",
    "Weather_Delay_Min",
    "NAS_Delay_Min",
    "Security_Delay_Min",
    "Late_Aircraft_Delay_Min",
    "Carrier_Pct",
    "Weather_Pct",
    "NAS_Pct",
    "Security_Pct",
    "Late_Aircraft_Pct",
]
HOURLY = ["Total_Flights", "Delayed_Flights", "Delay_Probability_Pct", "Avg_Delay_Minutes"]
ROUTES = ["Flight_Count", "Avg_AirTime_Min", "Distance_Miles", "Route_Delay_Rate_Pct"]
CALENDAR = ["Total_Flights", "Delayed_Flights", "Cancelled_Flights"]
REASONS = ["Cancelled_Flights"]

# Fact columns each table reads.
_RATE = ("Cancelled", "Diverted", "ArrDel15")
READS: dict[str, tuple[str, ...]] = {
    "airline_performance": ("Year", "Reporting_Airline", *_RATE, "DepDelayMinutes", "ArrDelayMinutes"),
    "airport_performance": (
        "Origin", "OriginCityName", "OriginState", "Dest", "DestCityName", "DestState",
        *_RATE, "DepDel15", "DepDelayMinutes",
    ),
    "delay_causes_monthly": (
        "Year", "Month", *_RATE,
        "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    ),
    "hourly_delays": ("Dep_Hour", *_RATE, "ArrDelayMinutes"),
    "route_traffic": ("Origin", "Dest", *_RATE, "AirTime", "Distance"),
    "calendar_delays": ("Year", "Month", "DayOfWeek", *_RATE, "ArrDelayMinutes"),
    "cancellation_reasons": ("Year", "Reporting_Airline", "CancellationCode", "Cancelled"),
}
READS["all_tables"] = tuple(dict.fromkeys(c for columns in READS.values() for c in columns))


def airline_performance(
    df: DataFrame, dim: DataFrame | None = None, extra: Iterable[str] = (), *, measures: Mapping[str, str] = MEASURES
) -> DataFrame:
    """Year x airline. ``dim`` (code, name) supplies names, else the code stands in."""
    out = rate_rollup(df, ["Year", "Reporting_Airline"], [*AIRLINE, *extra], measures=measures)
    out = out.withColumn("Airline_Name", F.col("Reporting_Airline"))
    if dim is not None:
        out = with_names(out, dim, "Reporting_Airline", names={"Airline_Name": "name"})
    return out.select("Year", "Reporting_Airline", "Airline_Name", *AIRLINE, *extra)


_ROUTE_ENDS = {
    "Origin": "Origin",
    "OriginCityName": "OriginCityName",
    "OriginState": "OriginState",
    "Dest": "Dest",
    "DestCityName": "DestCityName",
    "DestState": "DestState",
}
_AIRPORT_SUMS = ["flights", "operated", "late", "dep_late", "dep_minutes", "cancelled"]


def airport_performance(df: DataFrame, how: str = "left", *, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    """One row per airport with its departures and arrivals.

    ``how="left"`` keeps airports that have departures, ``"full"`` also those that only receive.
    The fact is scanned once, grouped by directed route; each route row then counts for its origin
    and for its destination, which replaces a join of two aggregates of the fact.
    """
    if how not in ("left", "full"):
        raise ValueError("how must be 'left' or 'full'")
    routes = rate_rollup(df, _ROUTE_ENDS, {m: m for m in _AIRPORT_SUMS}, measures=measures)
    ends = routes.selectExpr(
        "inline(array("
        "struct(Origin AS Airport_Code, OriginCityName AS city, OriginState AS state, 1 AS dep),"
        "struct(Dest AS Airport_Code, DestCityName AS city, DestState AS state, 0 AS dep)))",
        *_AIRPORT_SUMS,
    )
    departing, arriving = "CASE WHEN dep = 1 THEN {} END", "CASE WHEN dep = 0 THEN {} END"
    totals = ends.groupBy("Airport_Code").agg(
        *[F.expr(f"min({departing.format(c)})").alias(f"d_{c}") for c in ("city", "state")],
        *[F.expr(f"min({arriving.format(c)})").alias(f"a_{c}") for c in ("city", "state")],
        *[F.expr(f"sum({departing.format(m)})").alias(f"d_{m}") for m in _AIRPORT_SUMS],
        *[F.expr(f"sum({arriving.format(m)})").alias(f"a_{m}") for m in ("flights", "operated", "late")],
    )
    if how == "left":
        totals = totals.where("d_flights > 0")
    return totals.selectExpr(
        "Airport_Code",
        # The departures' labels; those of the arrivals only where nothing departs.
        "coalesce(CASE WHEN d_flights > 0 THEN d_city ELSE a_city END, '') AS Airport_City",
        "coalesce(CASE WHEN d_flights > 0 THEN d_state ELSE a_state END, '') AS Airport_State",
        "coalesce(d_flights, 0L) AS Total_Departures",
        "coalesce(a_flights, 0L) AS Total_Arrivals",
        f"{share('d_dep_late', 'd_operated')} AS Dep_Delay_Rate_Pct",
        f"{share('a_late', 'a_operated')} AS Arr_Delay_Rate_Pct",
        f"{mean('d_dep_minutes', 'd_operated')} AS Avg_Dep_Delay_Min",
        "coalesce(d_cancelled, 0L) AS Cancelled_Departures",
    )


def delay_causes_monthly(
    df: DataFrame, *, where: str = DELAYED_SQL, measures: Mapping[str, str] = MEASURES
) -> DataFrame:
    """Year x month over late flights: minutes and share per cause."""
    return rate_rollup(df, ["Year", "Month"], CAUSES, where=where, measures=measures)


def hourly_delays(df: DataFrame, extra: Iterable[str] = (), *, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    """Scheduled hour. The probability is late flights over all scheduled flights."""
    return rate_rollup(df, ["Dep_Hour"], [*HOURLY, *extra], measures=measures).orderBy("Dep_Hour")


def route_traffic(df: DataFrame, extra: Iterable[str] = (), *, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    """Directed route, busiest first."""
    out = rate_rollup(df, ["Origin", "Dest"], [*ROUTES, *extra], measures=measures)
    return out.select(
        "Origin", "Dest", F.concat_ws("-", "Origin", "Dest").alias("Route_Name"), *ROUTES, *extra
    ).orderBy(F.desc("Flight_Count"), "Origin", "Dest")


def calendar_delays(df: DataFrame, extra: Iterable[str] = (), *, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    """Year x month x day of week (1 = Monday); the rate is over operated flights."""
    columns = [*CALENDAR, *extra]
    outputs = {
        **{c: OUTPUTS[c] for c in columns},
        "Delay_Rate_Pct": OUTPUTS["Operated_Delay_Rate_Pct"],
        "Avg_Arr_Delay_Min": OUTPUTS["Avg_Arr_Delay_Min"],
    }
    keys = {"Year": "Year", "Month": "Month", "Day_Of_Week": "DayOfWeek"}
    return rate_rollup(df, keys, outputs, measures=measures).orderBy(*keys)


def cancellation_reasons(
    df: DataFrame, *, where: str = CANCELLED_SQL, measures: Mapping[str, str] = MEASURES
) -> DataFrame:
    """Year x airline x code over cancelled flights; a missing code is a group of its own."""
    keys = ["Year", "Reporting_Airline", "CancellationCode"]
    out = rate_rollup(df, keys, REASONS, where=where, measures=measures)
    return out.select(
        "Year",
        "Reporting_Airline",
        F.coalesce("CancellationCode", F.lit(UNKNOWN)).alias("Cancellation_Code"),
        cancellation_reason("CancellationCode").alias("Cancellation_Reason"),
        "Cancelled_Flights",
    ).orderBy("Year", "Reporting_Airline", "Cancellation_Code")


# The grains from which all seven tables follow. The others (year x airline, year x month, airport)
# are sums over these.
GRAINS: dict[str, tuple[str, ...]] = {
    "airline": ("Year", "Reporting_Airline", "CancellationCode"),
    "calendar": ("Year", "Month", "DayOfWeek"),
    "hour": ("Dep_Hour",),
    "route": tuple(_ROUTE_ENDS),
}
_TABLE_COLUMNS = [*AIRLINE, *CAUSES, *HOURLY, *ROUTES, *CALENDAR, "Operated_Delay_Rate_Pct", "Delayed_Departures"]


def grain_sums(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Sums of every measure at each of GRAINS, in one scan and one small shuffle; with ``by``, per value of these too.

    Grouping sets feed all grains into one partial aggregation, so a task emits at most its distinct
    keys per grain, whatever the row count. ``grain`` names the set a row belongs to.
    """
    used = measures_used([OUTPUTS[c] for c in _TABLE_COLUMNS], MEASURES)
    grains = {name: list(dict.fromkeys([*by, *grain])) for name, grain in GRAINS.items()}
    keys = list(dict.fromkeys(k for grain in grains.values() for k in grain))
    rows = df.selectExpr(*[f"`{k}`" for k in keys], *[f"{MEASURES[m]} AS {m}" for m in used])
    summed = rows.groupingSets(list(grains.values()), *keys).agg(
        F.grouping_id().alias("_set"), *[F.sum(m).alias(m) for m in used]
    )
    # grouping_id has one bit per key, first key highest, set when the key is not part of the set.
    names = F.lit(None)
    for name, grain in grains.items():
        bits = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in grain)
        names = F.when(F.col("_set") == bits, name).otherwise(names)
    return summed.select(names.alias("grain"), *keys, *used)


def all_tables(df: DataFrame, dim: DataFrame | None = None, how: str = "left") -> dict[str, DataFrame]:
    """All seven tables from one scan of the fact.

    The grain sums (thousands of rows) are written to the shared folder; each table reads its grain.
    """
    sums = cut(grain_sums(df), "grain")
    return tables_of({g: sums.where(F.col("grain") == g) for g in GRAINS}, dim, how)


def tables_of(at: Mapping[str, DataFrame], dim: DataFrame | None = None, how: str = "left") -> dict[str, DataFrame]:
    """The seven tables from the sums at each grain."""
    summed = {m: m for m in MEASURES}
    return {
        "agg_airline_performance": airline_performance(at["airline"], dim, measures=summed),
        "agg_airport_performance": airport_performance(at["route"], how, measures=summed),
        "agg_delay_causes_monthly": delay_causes_monthly(at["calendar"], where="late > 0", measures=summed),
        "agg_hourly_delays": hourly_delays(at["hour"], measures=summed),
        "agg_route_traffic": route_traffic(at["route"], measures=summed),
        "agg_calendar_delays": calendar_delays(at["calendar"], measures=summed),
        "agg_cancellation_reasons": cancellation_reasons(at["airline"], where="cancelled > 0", measures=summed),
    }
