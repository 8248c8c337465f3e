"""What rows of late and cancelled flights hold, for ``make_flights``."""

LATE = {"ArrDel15": 1.0, "ArrDelay": 30.0, "ArrDelayMinutes": 30.0, "DepDel15": 1.0, "DepDelayMinutes": 20.0}
CANCELLED = {
    "Cancelled": 1.0, "ArrDel15": None, "ArrDelay": None, "ArrDelayMinutes": None, "DepDel15": None,
    "DepDelay": None, "DepDelayMinutes": None, "AirTime": None,
}
