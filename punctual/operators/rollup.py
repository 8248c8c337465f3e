"""One generic rollup: additive row measures, summed per key, then turned into counts, means and rates.

Every measure is a plain sum, so partial aggregation shrinks each input task to one row per group
before the shuffle, a hot key included. Text attributes that depend on the key join the grouping key
instead of going through ``first``/``min``: a text buffer would force a sort-based aggregate over
the whole fact. They are folded afterwards, on the grouped rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from punctual.functions.flight import CANCELLED_SQL, DELAYED_SQL, ONTIME_SQL, OPERATED_SQL

_NAME = re.compile(r"[a-z_0-9]+")


def count_if(predicate: str) -> str:
    return f"CASE WHEN {predicate} THEN 1 ELSE 0 END"


def value_if(predicate: str, value: str) -> str:
    return f"CASE WHEN {predicate} THEN {value} END"


def share(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) * 100.0D ELSE 0.0D END"


def mean(total: str, n: str) -> str:
    return f"CASE WHEN ({n}) > 0 THEN ({total}) / ({n}) ELSE 0.0D END"


def tally(n: str) -> str:
    return f"coalesce({n}, 0L)"


def whole(total: str) -> str:
    return f"CAST(coalesce({total}, 0) AS BIGINT)"


# Additive measures of one flight row.
MEASURES: dict[str, str] = {
    "flights": "1",
    "operated": count_if(OPERATED_SQL),
    "ontime": count_if(ONTIME_SQL),
    "late": count_if(DELAYED_SQL),
    "dep_late": count_if(f"{OPERATED_SQL} AND DepDel15 = 1"),
    "cancelled": count_if(CANCELLED_SQL),
    "dep_minutes": value_if(OPERATED_SQL, "coalesce(DepDelayMinutes, 0)"),
    "arr_minutes": value_if(OPERATED_SQL, "coalesce(ArrDelayMinutes, 0)"),
    "late_minutes": value_if(DELAYED_SQL, "coalesce(ArrDelayMinutes, 0)"),
    "air_minutes": value_if(OPERATED_SQL, "AirTime"),
    "air_flights": count_if(f"{OPERATED_SQL} AND AirTime IS NOT NULL"),
    "miles": "Distance",
    "miles_flights": count_if("Distance IS NOT NULL"),
    "carrier_min": value_if(DELAYED_SQL, "coalesce(CarrierDelay, 0)"),
    "weather_min": value_if(DELAYED_SQL, "coalesce(WeatherDelay, 0)"),
    "nas_min": value_if(DELAYED_SQL, "coalesce(NASDelay, 0)"),
    "security_min": value_if(DELAYED_SQL, "coalesce(SecurityDelay, 0)"),
    "late_aircraft_min": value_if(DELAYED_SQL, "coalesce(LateAircraftDelay, 0)"),
}

_ALL_CAUSES = "carrier_min + weather_min + nas_min + security_min + late_aircraft_min"

# Published columns, as expressions over summed measures.
OUTPUTS: dict[str, str] = {
    "Total_Flights": tally("flights"),
    "Flight_Count": tally("flights"),
    "OnTime_Flights": tally("ontime"),
    "Delayed_Flights": tally("late"),
    "Operated_Flights": tally("operated"),
    "Cancelled_Flights": tally("cancelled"),
    "Delay_Rate_Pct": share("late", "late + ontime"),
    "Operated_Delay_Rate_Pct": share("late", "operated"),
    "Route_Delay_Rate_Pct": share("late", "operated"),
    "Delay_Probability_Pct": share("late", "flights"),
    "Cancellation_Rate_Pct": share("cancelled", "flights"),
    "Avg_Dep_Delay_Min": mean("dep_minutes", "operated"),
    "Avg_Arr_Delay_Min": mean("arr_minutes", "operated"),
    "Avg_Delay_Minutes": mean("arr_minutes", "operated"),
    "Avg_AirTime_Min": mean("air_minutes", "air_flights"),
    "Distance_Miles": f"CAST(round({mean('miles', 'miles_flights')}, 0) AS INT)",
    "Total_Delay_Minutes": whole(_ALL_CAUSES),
    "Carrier_Delay_Min": whole("carrier_min"),
    "Weather_Delay_Min": whole("weather_min"),
    "NAS_Delay_Min": whole("nas_min"),
    "Security_Delay_Min": whole("security_min"),
    "Late_Aircraft_Delay_Min": whole("late_aircraft_min"),
    "Carrier_Pct": share("carrier_min", _ALL_CAUSES),
    "Weather_Pct": share("weather_min", _ALL_CAUSES),
    "NAS_Pct": share("nas_min", _ALL_CAUSES),
    "Security_Pct": share("security_min", _ALL_CAUSES),
    "Late_Aircraft_Pct": share("late_aircraft_min", _ALL_CAUSES),
    "Total_Departures": tally("flights"),
    "Delayed_Departures": tally("dep_late"),
    "Cancelled_Departures": tally("cancelled"),
    "Dep_Delay_Rate_Pct": share("dep_late", "operated"),
    "Total_Arrivals": tally("flights"),
    "Arr_Delay_Rate_Pct": share("late", "operated"),
    "Mean_Minutes_Per_Late_Flight": mean("late_minutes", "late"),
}


def measures_used(expressions: Iterable[str], measures: Mapping[str, str]) -> list[str]:
    """The measures named in a set of output expressions, in definition order."""
    words = {w for e in expressions for w in _NAME.findall(e)}
    return [m for m in measures if m in words]


def rate_rollup(
    df: DataFrame,
    keys: Mapping[str, str] | Iterable[str],
    outputs: Mapping[str, str] | Iterable[str],
    *,
    labels: Mapping[str, str] | None = None,
    where: str | None = None,
    measures: Mapping[str, str] | None = None,
) -> DataFrame:
    """Group by ``keys`` and return keys, labels and the named outputs.

    ``keys`` and ``labels`` map result names to row expressions (a plain list keeps names).
    ``outputs`` are names from OUTPUTS, or a mapping of result names to expressions over ``measures``.
    ``measures`` defaults to the house definitions; any additive row expressions may be passed.
    A label is an attribute determined by the key; should the data disagree, its smallest value wins.
    """
    measures = MEASURES if measures is None else measures
    keys = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    outputs = dict(outputs) if isinstance(outputs, Mapping) else {o: OUTPUTS[o] for o in outputs}
    labels = dict(labels or {})
    used = measures_used(outputs.values(), measures)

    if where:
        df = df.where(where)
    named = [f"{e} AS `{n}`" for n, e in {**keys, **labels}.items()]
    rows = df.selectExpr(*named, *[f"{measures[m]} AS {m}" for m in used])
    summed = _sum(rows, [*keys, *labels], used)
    if labels:
        summed = _sum(summed, list(keys), used, folded=list(labels))
    ready = [f"`{n}`" for n in [*keys, *labels]]
    return summed.selectExpr(*ready, *[f"{e} AS `{n}`" for n, e in outputs.items()])


def _sum(rows: DataFrame, keys: list[str], measures: list[str], folded: Iterable[str] = ()) -> DataFrame:
    folds = [F.min(label).alias(label) for label in folded]
    return rows.groupBy(*keys).agg(*folds, *[F.sum(m).alias(m) for m in measures])
