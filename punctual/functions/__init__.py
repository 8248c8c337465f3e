from punctual.functions.flight import (
    cancellation_reason,
    clock_label,
    day_name,
    delay_flag,
    delay_status,
    dep_hour,
    flight_id,
    is_delayed,
    is_operated,
    probability_pct,
    risk_category,
    route,
    season,
)
from punctual.functions.numeric import clamp_min, pct

__all__ = [
    "cancellation_reason",
    "clamp_min",
    "clock_label",
    "day_name",
    "delay_flag",
    "delay_status",
    "dep_hour",
    "flight_id",
    "is_delayed",
    "is_operated",
    "pct",
    "probability_pct",
    "risk_category",
    "route",
    "season",
]
