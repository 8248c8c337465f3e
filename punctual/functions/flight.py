"""Flight-level definitions shared by every table, query and model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from punctual.functions.numeric import _col

# The operating rules of the domain.
LATE_MINUTES = 15
RISK_LIMITS = {"Low": 0.15, "Medium": 0.30}
RISK_TOP = "High"
REASONS = {
    "A": "Carrier",
    "B": "Weather",
    "C": "National Aviation System (NAS)",
    "D": "Security",
}
UNKNOWN = "Unknown"
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11)}

# The population of every rate. Null Cancelled or Diverted makes it null, which counts as false.
OPERATED_SQL = "Cancelled = 0 AND Diverted = 0 AND ArrDel15 IS NOT NULL"
DELAYED_SQL = f"{OPERATED_SQL} AND ArrDel15 = 1"
ONTIME_SQL = f"{OPERATED_SQL} AND ArrDel15 = 0"
CANCELLED_SQL = "Cancelled = 1"


def is_operated() -> Column:
    return F.expr(OPERATED_SQL)


def is_delayed() -> Column:
    return F.expr(DELAYED_SQL)


def dep_hour(hhmm: Column | str) -> Column:
    """Scheduled hour 0-23 of an hhmm clock number; 2400 is hour 0."""
    return (F.floor(_col(hhmm) / 100) % 24).cast("int")


def route(origin: Column | str, dest: Column | str) -> Column:
    """Directed pair label; a null end is left out rather than making the label null."""
    return F.concat_ws("-", _col(origin), _col(dest))


def season(month: Column | str) -> Column:
    month = _col(month)
    return F.coalesce(*[F.when(month.isin(*months), name) for name, months in SEASON_MONTHS.items()])


def day_name(day: Column | str) -> Column:
    """Name of day 1 (Monday) to 7 (Sunday); anything else is null."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.try_element_at(names, F.when(_col(day).between(1, 7), _col(day).cast("int")))


def cancellation_reason(code: Column | str) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, _col(code)), F.lit(UNKNOWN))


def risk_category(probability: Column | str) -> Column:
    """Bucket of a probability that is already rounded for publication."""
    p, label = _col(probability), F.lit(RISK_TOP)
    for name, limit in sorted(RISK_LIMITS.items(), key=lambda item: -item[1]):
        label = F.when(p < limit, F.lit(name)).otherwise(label)
    return label


def probability_pct(probability: Column | str) -> Column:
    """0.3845 -> 38.5"""
    return F.round(_col(probability) * 100, 1)


def delay_flag(minutes: Column | str) -> Column:
    return (_col(minutes) >= LATE_MINUTES).cast("int")


def delay_status(minutes: Column | str) -> Column:
    return F.when(_col(minutes) >= LATE_MINUTES, "Delayed").otherwise("On-Time")


def flight_id(airline: Column | str, number: Column | str) -> Column:
    return F.concat(_col(airline), _col(number).cast("string"))


def clock_label(hour: Column | str, minute: Column | str) -> Column:
    """Zero-padded HH:MM."""
    return F.format_string("%02d:%02d", _col(hour), _col(minute))
