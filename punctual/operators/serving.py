"""Dashboard questions over the aggregate tables.

Percentages over several rows are ratios of sums, never means of ratios.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctual.functions.flight import day_name, probability_pct, season
from punctual.functions.numeric import pct
from punctual.operators.population import slice_by
from punctual.operators.ranking import rank_by, share_of, top_n, yoy_growth
from punctual.operators.rollup import rate_rollup

# Targets of the overview cards.
RELIABILITY_TARGET_PCT = 75.0
CANCELLATION_TARGET_PCT = 3.0
ROUTE_MIN_FLIGHTS = 500


def airline_ranking(airline: DataFrame) -> DataFrame:
    """Airlines of each year by delay rate, worst first, with volumes and both mean delays."""
    ranked = rank_by(airline, "Delay_Rate_Pct", "Reporting_Airline", partition="Year")
    return ranked.select(
        "Year", "Rank", "Reporting_Airline", "Airline_Name", "Total_Flights", "Delayed_Flights",
        "Delay_Rate_Pct", "Avg_Dep_Delay_Min", "Avg_Arr_Delay_Min",
    )


def airline_ranking_all_years(flights: DataFrame) -> DataFrame:
    """The same over all years at once, from the fact."""
    columns = ["Total_Flights", "Delayed_Flights", "Delay_Rate_Pct", "Avg_Dep_Delay_Min", "Avg_Arr_Delay_Min"]
    return rank_by(rate_rollup(flights, ["Reporting_Airline"], columns), "Delay_Rate_Pct", "Reporting_Airline")


def top_airports(airport: DataFrame, n: int = 10, min_departures: int = 0) -> DataFrame:
    """Airports with the highest departure delay rate, optionally above a volume."""
    best = top_n(airport, "Dep_Delay_Rate_Pct", "Airport_Code", n, F.col("Total_Departures") >= min_departures)
    return best.select(
        "Rank", "Airport_Code", "Airport_City", "Dep_Delay_Rate_Pct", "Total_Departures", "Avg_Dep_Delay_Min"
    )


def peak_hours(hourly: DataFrame) -> DataFrame:
    """Hours by delay probability, highest first."""
    return rank_by(hourly, "Delay_Probability_Pct", "Dep_Hour")


def hourly_curve(hourly: DataFrame) -> DataFrame:
    return hourly.select("Dep_Hour", "Delay_Probability_Pct", "Avg_Delay_Minutes").orderBy("Dep_Hour")


# Cause labels per column.
_CAUSES = {
    "Late Aircraft": "Late_Aircraft_Delay_Min",
    "Carrier": "Carrier_Delay_Min",
    "NAS": "NAS_Delay_Min",
    "Weather": "Weather_Delay_Min",
    "Security": "Security_Delay_Min",
}


def cause_share(causes: DataFrame) -> DataFrame:
    """Minutes and share per cause over all given months; rank 1 is the dominant cause."""
    sums = causes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _CAUSES.values()])
    pairs = ", ".join(f"'{label}', {column}" for label, column in _CAUSES.items())
    long = sums.selectExpr(f"stack({len(_CAUSES)}, {pairs}) AS (Cause, Delay_Minutes)")
    return rank_by(share_of(long, "Delay_Minutes"), "Delay_Minutes", "Cause").withColumn(
        "Is_Dominant", F.col("Rank") == 1
    )


def dow_rates(calendar: DataFrame) -> DataFrame:
    """Day-of-week rollup: late flights over scheduled flights and, where known, over operated ones."""
    return _calendar_rates(calendar, ["Day_Of_Week"]).withColumn("Day_Name", day_name("Day_Of_Week"))


def month_rates(calendar: DataFrame) -> DataFrame:
    return _calendar_rates(calendar, ["Month"])


def season_rates(calendar: DataFrame) -> DataFrame:
    return _calendar_rates(calendar.withColumn("Season", season("Month")), ["Season"])


def _calendar_rates(calendar: DataFrame, keys: list[str]) -> DataFrame:
    has_operated = "Operated_Flights" in calendar.columns
    counts = ["Total_Flights", "Delayed_Flights", "Cancelled_Flights", *(["Operated_Flights"] if has_operated else [])]
    out = calendar.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
    out = out.withColumn("Scheduled_Delay_Rate_Pct", pct("Delayed_Flights", "Total_Flights"))
    if has_operated:
        out = out.withColumn("Operated_Delay_Rate_Pct", pct("Delayed_Flights", "Operated_Flights"))
    return out.orderBy(*keys)


def cancel_share(reasons: DataFrame) -> DataFrame:
    """Cancelled flights and share per code and reason."""
    sums = reasons.groupBy("Cancellation_Code", "Cancellation_Reason").agg(
        F.sum("Cancelled_Flights").alias("Cancelled_Flights")
    )
    return share_of(sums, "Cancelled_Flights").orderBy(F.desc("Cancelled_Flights"), "Cancellation_Code")


def airline_cancel_rate(airline: DataFrame) -> DataFrame:
    """Cancelled over scheduled per airline, over all given years."""
    sums = airline.groupBy("Reporting_Airline").agg(
        F.sum("Cancelled_Flights").alias("Cancelled_Flights"), F.sum("Total_Flights").alias("Total_Flights")
    )
    return sums.withColumn("Cancellation_Rate_Pct", pct("Cancelled_Flights", "Total_Flights"))


def airport_cancel_rate(airport: DataFrame) -> DataFrame:
    """Cancelled departures over departures per airport."""
    return airport.select(
        "Airport_Code",
        "Total_Departures",
        "Cancelled_Departures",
        pct("Cancelled_Departures", "Total_Departures").alias("Cancellation_Rate_Pct"),
    )


def top_routes(routes: DataFrame, n: int = 10) -> DataFrame:
    """Busiest directed routes with rate, distance and air time."""
    return top_n(routes, "Flight_Count", ["Origin", "Dest"], n).select(
        "Rank", "Route_Name", "Flight_Count", "Route_Delay_Rate_Pct", "Distance_Miles", "Avg_AirTime_Min"
    )


def delayed_routes(routes: DataFrame, n: int = 10, min_flights: int = ROUTE_MIN_FLIGHTS) -> DataFrame:
    """Most delayed routes among those with more than ``min_flights`` flights."""
    best = top_n(routes, "Route_Delay_Rate_Pct", ["Origin", "Dest"], n, F.col("Flight_Count") > min_flights)
    return best.select("Rank", "Route_Name", "Flight_Count", "Route_Delay_Rate_Pct")


def distance_vs_delay(routes: DataFrame) -> DataFrame:
    return routes.select("Route_Name", "Distance_Miles", "Route_Delay_Rate_Pct", "Flight_Count")


def distance_delay_correlation(routes: DataFrame) -> DataFrame:
    """Pearson correlation of distance and delay rate over routes, to six digits."""
    return routes.agg(
        F.count("*").alias("Routes"),
        F.round(F.corr(F.col("Distance_Miles").cast("double"), "Route_Delay_Rate_Pct"), 6).alias("Correlation"),
    )


def traffic_growth(airline: DataFrame) -> DataFrame:
    """Flights per year and change from the year before."""
    return yoy_growth(airline)


def kpi_cards(airline: DataFrame) -> DataFrame:
    """The overview cards as one row: totals, ratios of sums, and target flags."""
    sums = airline.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("Total_Flights", "Delayed_Flights", "OnTime_Flights", "Cancelled_Flights")
        ]
    )
    rate = pct("Delayed_Flights", F.col("Delayed_Flights") + F.col("OnTime_Flights"))
    return sums.select(
        "Total_Flights",
        "Delayed_Flights",
        rate.alias("System_Delay_Rate_Pct"),
        (100.0 - rate).alias("OnTime_Reliability_Pct"),
        F.col("Cancelled_Flights").alias("Total_Cancelled"),
        pct("Cancelled_Flights", "Total_Flights").alias("Cancellation_Rate_Pct"),
    ).withColumns(
        {
            "Reliability_Status": _status(F.col("OnTime_Reliability_Pct") > RELIABILITY_TARGET_PCT),
            "Cancellation_Status": _status(F.col("Cancellation_Rate_Pct") < CANCELLATION_TARGET_PCT),
        }
    )


def _status(met):
    return F.when(met, "On target").otherwise("Off target")


def minutes_per_late_flight(flights: DataFrame) -> DataFrame:
    """Mean arrival delay over late flights only, from the fact."""
    return rate_rollup(flights, [], ["Delayed_Flights", "Mean_Minutes_Per_Late_Flight"])


def high_risk_flights(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.count_if(F.col("Risk_Category") == "High").alias("High_Risk_Flights"))


def risk_distribution(predictions: DataFrame) -> DataFrame:
    """Flights per risk category with their share."""
    counts = predictions.groupBy("Risk_Category").agg(F.count("*").alias("Flights"))
    return share_of(counts, "Flights").orderBy("Risk_Category")


def flight_inspection(predictions: DataFrame, risk=None, airline=None, hour=None) -> DataFrame:
    """Scored flights under the page's three slicers, with the probability as a percentage."""
    rows = slice_by(predictions, Risk_Category=risk, Reporting_Airline=airline, Dep_Hour=hour)
    return rows.select(
        "FlightDate", "Reporting_Airline", "Origin", "Dest", "Dep_Hour",
        probability_pct(F.col("Delay_Probability").cast("double")).alias("Probability_Pct"),
        "Risk_Category", "Predicted_Delayed", "Actual_Delayed",
    )
