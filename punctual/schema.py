"""Column lists, types and table contracts. All values here are fixed by the data they describe."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The kept columns of the flight fact and their types.
FLIGHT_COLUMNS: dict[str, str] = {
    "Year": "int",
    "Month": "int",
    "DayofMonth": "int",
    "DayOfWeek": "int",
    "FlightDate": "date",
    "Reporting_Airline": "string",
    "Tail_Number": "string",
    "Flight_Number_Reporting_Airline": "string",
    "Origin": "string",
    "OriginCityName": "string",
    "OriginState": "string",
    "Dest": "string",
    "DestCityName": "string",
    "DestState": "string",
    "CRSDepTime": "double",
    "DepTime": "double",
    "DepDelay": "double",
    "DepDelayMinutes": "double",
    "DepDel15": "double",
    "CRSArrTime": "double",
    "ArrTime": "double",
    "ArrDelay": "double",
    "ArrDelayMinutes": "double",
    "ArrDel15": "double",
    "Cancelled": "double",
    "CancellationCode": "string",
    "Diverted": "double",
    "CRSElapsedTime": "double",
    "ActualElapsedTime": "double",
    "AirTime": "double",
    "Distance": "double",
    "CarrierDelay": "double",
    "WeatherDelay": "double",
    "NASDelay": "double",
    "SecurityDelay": "double",
    "LateAircraftDelay": "double",
}

# Columns computed by the ETL.
DERIVED_COLUMNS: dict[str, str] = {"Dep_Hour": "int", "Route": "string"}


_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


def struct(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


FLIGHT_SCHEMA = struct(FLIGHT_COLUMNS)

# JSON event layouts.
CLICK_EVENT_SCHEMA = struct({"user_id": "int", "action": "string", "ts": "string"})
PIPELINE_EVENT_SCHEMA = struct({"user_id": "int", "action": "string", "amount": "int", "ts": "string"})
FLIGHT_EVENT_SCHEMA = struct(
    {
        "event_timestamp": "string",
        "flight_id": "string",
        "reporting_airline": "string",
        "airline_name": "string",
        "origin": "string",
        "dest": "string",
        "crs_dep_hour": "int",
        "crs_dep_time": "string",
        "dep_delay_minutes": "int",
        "arr_delay_minutes": "int",
        "arr_del15": "int",
        "delay_cause": "string",
        "status": "string",
    }
)

# Spark has no unsigned types: each unsigned kind is the next wider signed type plus a range check.
KIND_TYPES = {
    "u8": "smallint",
    "u16": "int",
    "u32": "bigint",
    "u64": "bigint",
    "f32": "float",
    "text": "string",
    "date": "date",
}
KIND_MAX = {"u8": 255, "u16": 65535, "u32": 4294967295, "u64": None}


@dataclass(frozen=True)
class Contract:
    """A published table: column kinds in order, sort key (also unique key), rounding digits."""

    name: str
    columns: dict[str, str]
    keys: tuple[str, ...]
    unique: bool = True
    digits: int = 2

    @property
    def measures(self) -> list[str]:
        numeric = ("u8", "u16", "u32", "u64", "f32")
        return [c for c, kind in self.columns.items() if kind in numeric and c not in self.keys]

    @property
    def schema(self) -> T.StructType:
        return struct({c: KIND_TYPES[kind] for c, kind in self.columns.items()})


# Names, kinds and sort keys of the published tables.
CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract(
            "agg_airline_performance",
            {
                "Year": "u16",
                "Reporting_Airline": "text",
                "Airline_Name": "text",
                "Total_Flights": "u32",
                "OnTime_Flights": "u32",
                "Delayed_Flights": "u32",
                "Delay_Rate_Pct": "f32",
                "Avg_Dep_Delay_Min": "f32",
                "Avg_Arr_Delay_Min": "f32",
                "Cancelled_Flights": "u32",
                "Cancellation_Rate_Pct": "f32",
            },
            ("Year", "Reporting_Airline"),
        ),
        Contract(
            "agg_airport_performance",
            {
                "Airport_Code": "text",
                "Airport_City": "text",
                "Airport_State": "text",
                "Total_Departures": "u32",
                "Total_Arrivals": "u32",
                "Dep_Delay_Rate_Pct": "f32",
                "Arr_Delay_Rate_Pct": "f32",
                "Avg_Dep_Delay_Min": "f32",
                "Cancelled_Departures": "u32",
            },
            ("Airport_Code",),
        ),
        Contract(
            "agg_delay_causes_monthly",
            {
                "Year": "u16",
                "Month": "u8",
                "Total_Delay_Minutes": "u64",
                "Carrier_Delay_Min": "u64",
                "Weather_Delay_Min": "u64",
                "NAS_Delay_Min": "u64",
                "Security_Delay_Min": "u64",
                "Late_Aircraft_Delay_Min": "u64",
                "Carrier_Pct": "f32",
                "Weather_Pct": "f32",
                "NAS_Pct": "f32",
                "Security_Pct": "f32",
                "Late_Aircraft_Pct": "f32",
            },
            ("Year", "Month"),
        ),
        Contract(
            "agg_hourly_delays",
            {
                "Dep_Hour": "u8",
                "Total_Flights": "u32",
                "Delayed_Flights": "u32",
                "Delay_Probability_Pct": "f32",
                "Avg_Delay_Minutes": "f32",
            },
            ("Dep_Hour",),
        ),
        Contract(
            "agg_route_traffic",
            {
                "Origin": "text",
                "Dest": "text",
                "Route_Name": "text",
                "Flight_Count": "u32",
                "Avg_AirTime_Min": "f32",
                "Distance_Miles": "u32",
                "Route_Delay_Rate_Pct": "f32",
            },
            ("Origin", "Dest"),
        ),
        Contract(
            "agg_calendar_delays",
            {
                "Year": "u16",
                "Month": "u8",
                "Day_Of_Week": "u8",
                "Total_Flights": "u32",
                "Delayed_Flights": "u32",
                "Cancelled_Flights": "u32",
                "Delay_Rate_Pct": "f32",
                "Avg_Arr_Delay_Min": "f32",
            },
            ("Year", "Month", "Day_Of_Week"),
        ),
        Contract(
            "agg_cancellation_reasons",
            {
                "Year": "u16",
                "Reporting_Airline": "text",
                "Cancellation_Code": "text",
                "Cancellation_Reason": "text",
                "Cancelled_Flights": "u32",
            },
            ("Year", "Reporting_Airline", "Cancellation_Code"),
        ),
        Contract(
            "ml_delay_predictions",
            {
                "FlightDate": "date",
                "Reporting_Airline": "text",
                "Origin": "text",
                "Dest": "text",
                "Dep_Hour": "u8",
                "Actual_Delayed": "u8",
                "Predicted_Delayed": "u8",
                "Delay_Probability": "f32",
                "Risk_Category": "text",
            },
            ("FlightDate", "Reporting_Airline"),
            unique=False,
            digits=4,
        ),
    )
}
