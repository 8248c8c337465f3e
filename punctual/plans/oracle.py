"""DuckDB SQL with the same results as the registered queries, written from the definitions."""

from __future__ import annotations

_FLIGHTS = """
b1 AS (
  SELECT *,
    CAST(l_partkey % 25 AS INTEGER) AS hh,
    CAST(l_suppkey % 4 AS INTEGER) * 15 AS mi,
    CAST(floor(l_extendedprice) AS BIGINT) % 60 - 30 AS ad,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 1 ELSE 0 END AS cx,
    CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS dv0,
    100 * abs(sn.n_nationkey - dn.n_nationkey) + 50 AS dist,
    sn.n_name AS o_name, sr.r_name AS o_region, dn.n_name AS d_name, dr.r_name AS d_region
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation dn ON c_nationkey = dn.n_nationkey
  JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  JOIN region dr ON dn.n_regionkey = dr.r_regionkey),
b2 AS (
  SELECT *, CASE WHEN cx = 1 THEN 0 ELSE dv0 END AS dv, ad - (l_linenumber - 4) AS dd,
    CAST(floor(dist / CAST(8 AS DOUBLE)) AS BIGINT) + 30 AS crs
  FROM b1),
b3 AS (
  SELECT *, CASE WHEN cx = 0 AND dv = 0 THEN ad END AS arr, CASE WHEN cx = 0 THEN dd END AS dep FROM b2),
b4 AS (
  SELECT *,
    CASE WHEN arr IS NOT NULL THEN greatest(arr, 0) END AS arrm,
    CASE WHEN dep IS NOT NULL THEN greatest(dep, 0) END AS depm,
    CASE WHEN arr >= 15 THEN 1 WHEN arr IS NOT NULL THEN 0 END AS a15,
    CASE WHEN dep >= 15 THEN 1 WHEN dep IS NOT NULL THEN 0 END AS d15,
    CAST(l_partkey % 5 AS INTEGER) AS cause
  FROM b3),
f AS (
  SELECT
    CAST(year(l_shipdate) AS INTEGER) AS Year,
    CAST(month(l_shipdate) AS INTEGER) AS Month,
    CAST(day(l_shipdate) AS INTEGER) AS DayofMonth,
    CAST(isodow(l_shipdate) AS INTEGER) AS DayOfWeek,
    CAST(l_shipdate AS DATE) AS FlightDate,
    p_brand AS Reporting_Airline,
    CAST(l_suppkey AS VARCHAR) AS Tail_Number,
    CAST(l_partkey AS VARCHAR) AS Flight_Number_Reporting_Airline,
    o_name AS Origin, concat(o_name, ', ', o_region) AS OriginCityName, o_region AS OriginState,
    d_name AS Dest, concat(d_name, ', ', d_region) AS DestCityName, d_region AS DestState,
    CASE WHEN hh = 24 THEN 2400 ELSE hh * 100 + mi END AS CRSDepTime,
    dep AS DepDelay, depm AS DepDelayMinutes, d15 AS DepDel15,
    arr AS ArrDelay, arrm AS ArrDelayMinutes, a15 AS ArrDel15,
    cx AS Cancelled,
    CASE WHEN cx = 1 AND l_orderkey % 5 < 4
      THEN substring('ABCD', CAST(l_orderkey % 5 AS INTEGER) + 1, 1) END AS CancellationCode,
    dv AS Diverted, crs AS CRSElapsedTime, crs + arr - dep AS ActualElapsedTime,
    CASE WHEN arr IS NOT NULL THEN crs - 20 + l_linenumber END AS AirTime,
    dist AS Distance,
    CASE WHEN a15 = 1 THEN CASE cause WHEN 0 THEN arrm - 5 WHEN 4 THEN 5 ELSE 0 END END AS CarrierDelay,
    CASE WHEN a15 = 1 THEN CASE cause WHEN 1 THEN arrm - 5 WHEN 0 THEN 5 ELSE 0 END END AS WeatherDelay,
    CASE WHEN a15 = 1 THEN CASE cause WHEN 2 THEN arrm - 5 WHEN 1 THEN 5 ELSE 0 END END AS NASDelay,
    CASE WHEN a15 = 1 THEN CASE cause WHEN 3 THEN arrm - 5 WHEN 2 THEN 5 ELSE 0 END END AS SecurityDelay,
    CASE WHEN a15 = 1 THEN CASE cause WHEN 4 THEN arrm - 5 WHEN 3 THEN 5 ELSE 0 END END AS LateAircraftDelay,
    hh % 24 AS Dep_Hour,
    concat_ws('-', o_name, d_name) AS Route
  FROM b4),
g AS (
  SELECT *, Cancelled = 0 AND Diverted = 0 AND ArrDel15 IS NOT NULL AS op FROM f)
"""


def _pct(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * CAST(100 AS DOUBLE) ELSE 0 END"


def _mean(total: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST({total} AS DOUBLE) / CAST({n} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _hash(*keys: str, seed: int = 42) -> str:
    """The row hash: 13 hexadecimal digits of the MD5 of the seed and the keys, separated by the character 31."""
    text = " || ".join([f"'{seed}'", *(f"chr(31) || coalesce(CAST({k} AS VARCHAR), '<null>')" for k in keys)])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


_LATE = "count(*) FILTER (WHERE op AND ArrDel15 = 1)"
_OP = "count(*) FILTER (WHERE op)"
_CANCELLED = "count(*) FILTER (WHERE Cancelled = 1)"

_CAUSE_COLUMNS = {
    "Carrier": "CarrierDelay",
    "Weather": "WeatherDelay",
    "NAS": "NASDelay",
    "Security": "SecurityDelay",
    "Late_Aircraft": "LateAircraftDelay",
}

# One CTE per aggregate table.
_TABLES = f"""
airline_c AS (
  SELECT Year, Reporting_Airline, count(*) AS t, count(*) FILTER (WHERE op AND ArrDel15 = 0) AS o, {_LATE} AS l,
    {_CANCELLED} AS c, {_OP} AS n,
    sum(DepDelayMinutes) FILTER (WHERE op) AS dm, sum(ArrDelayMinutes) FILTER (WHERE op) AS am
  FROM g GROUP BY ALL),
airline AS (
  SELECT Year, Reporting_Airline, Reporting_Airline AS Airline_Name, t AS Total_Flights, o AS OnTime_Flights,
    l AS Delayed_Flights, {_pct("l", "(l + o)")} AS Delay_Rate_Pct,
    {_mean("dm", "n")} AS Avg_Dep_Delay_Min, {_mean("am", "n")} AS Avg_Arr_Delay_Min,
    c AS Cancelled_Flights, {_pct("c", "t")} AS Cancellation_Rate_Pct
  FROM airline_c),
deps AS (
  SELECT Origin AS code, min(OriginCityName) AS city, min(OriginState) AS state, count(*) AS t, {_OP} AS n,
    count(*) FILTER (WHERE op AND DepDel15 = 1) AS l, sum(DepDelayMinutes) FILTER (WHERE op) AS m, {_CANCELLED} AS c
  FROM g GROUP BY Origin),
arrs AS (
  SELECT Dest AS code, min(DestCityName) AS city, min(DestState) AS state, count(*) AS t, {_OP} AS n, {_LATE} AS l
  FROM g GROUP BY Dest),
airport_full AS (
  SELECT coalesce(d.code, a.code) AS Airport_Code, coalesce(d.city, a.city) AS Airport_City,
    coalesce(d.state, a.state) AS Airport_State,
    coalesce(d.t, 0) AS Total_Departures, coalesce(a.t, 0) AS Total_Arrivals,
    {_pct("d.l", "d.n")} AS Dep_Delay_Rate_Pct, {_pct("a.l", "a.n")} AS Arr_Delay_Rate_Pct,
    {_mean("d.m", "d.n")} AS Avg_Dep_Delay_Min, coalesce(d.c, 0) AS Cancelled_Departures
  FROM deps d FULL JOIN arrs a ON d.code = a.code),
airport AS (SELECT * FROM airport_full WHERE Total_Departures > 0),
causes_c AS (
  SELECT Year, Month, {", ".join(f"CAST(sum(coalesce({c}, 0)) AS BIGINT) AS {n}" for n, c in _CAUSE_COLUMNS.items())}
  FROM g WHERE op AND ArrDel15 = 1 GROUP BY Year, Month),
causes_t AS (SELECT *, Carrier + Weather + NAS + Security + Late_Aircraft AS t FROM causes_c),
causes AS (
  SELECT Year, Month, t AS Total_Delay_Minutes, {", ".join(f"{n} AS {n}_Delay_Min" for n in _CAUSE_COLUMNS)},
    {", ".join(f"{_pct(n, 't')} AS {n}_Pct" for n in _CAUSE_COLUMNS)}
  FROM causes_t),
hourly_c AS (
  SELECT Dep_Hour, count(*) AS t, {_LATE} AS l, {_OP} AS n, sum(ArrDelayMinutes) FILTER (WHERE op) AS m
  FROM g GROUP BY Dep_Hour),
hourly AS (
  SELECT Dep_Hour, t AS Total_Flights, l AS Delayed_Flights, {_pct("l", "t")} AS Delay_Probability_Pct,
    {_mean("m", "n")} AS Avg_Delay_Minutes
  FROM hourly_c),
routes_c AS (
  SELECT Origin, Dest, min(Route) AS r, count(*) AS t, {_OP} AS n, {_LATE} AS l,
    sum(AirTime) FILTER (WHERE op) AS air, count(AirTime) FILTER (WHERE op) AS an,
    sum(Distance) AS ds, count(Distance) AS dn
  FROM g GROUP BY Origin, Dest),
routes AS (
  SELECT Origin, Dest, r AS Route_Name, t AS Flight_Count, {_mean("air", "an")} AS Avg_AirTime_Min,
    CAST(round({_mean("ds", "dn")}, 0) AS INTEGER) AS Distance_Miles, {_pct("l", "n")} AS Route_Delay_Rate_Pct
  FROM routes_c),
calendar_c AS (
  SELECT Year, Month, DayOfWeek, count(*) AS t, {_LATE} AS l, {_CANCELLED} AS c, {_OP} AS n,
    sum(ArrDelayMinutes) FILTER (WHERE op) AS m
  FROM g GROUP BY Year, Month, DayOfWeek),
calendar AS (
  SELECT Year, Month, DayOfWeek AS Day_Of_Week, t AS Total_Flights, l AS Delayed_Flights, c AS Cancelled_Flights,
    {_pct("l", "n")} AS Delay_Rate_Pct, {_mean("m", "n")} AS Avg_Arr_Delay_Min
  FROM calendar_c),
reasons AS (
  SELECT Year, Reporting_Airline, coalesce(CancellationCode, 'Unknown') AS Cancellation_Code,
    CASE CancellationCode WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
      WHEN 'C' THEN 'National Aviation System (NAS)' WHEN 'D' THEN 'Security' ELSE 'Unknown' END
      AS Cancellation_Reason,
    count(*) AS Cancelled_Flights
  FROM f WHERE Cancelled = 1 GROUP BY Year, Reporting_Airline, CancellationCode),
s AS (
  SELECT *, CAST(ArrDel15 AS INTEGER) AS label,
    CAST(CAST(Flight_Number_Reporting_Airline AS BIGINT) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS score,
    CASE WHEN CAST(Flight_Number_Reporting_Airline AS BIGINT) % 100 >= 50 THEN 1 ELSE 0 END AS prediction
  FROM g WHERE op),
p AS (
  SELECT *, CAST(round(score, 4) AS FLOAT) AS pf,
    CASE WHEN CAST(CAST(round(score, 4) AS FLOAT) AS DOUBLE) < CAST(0.15 AS DOUBLE) THEN 'Low'
      WHEN CAST(CAST(round(score, 4) AS FLOAT) AS DOUBLE) < CAST(0.3 AS DOUBLE) THEN 'Medium'
      ELSE 'High' END AS Risk_Category
  FROM s)
"""


def _sql(body: str) -> str:
    """The body over the flight relation ``f`` (``g`` with the operated flag) and the tables."""
    return f"WITH {_FLIGHTS}, {_TABLES} {body}"


def _rounded(name: str, floats: list[str], others: str, digits: int = 2) -> str:
    """Half-up on the printed decimal, then to a 4-byte float and back."""
    exact = [
        f"CAST(CAST(round(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS FLOAT) AS DOUBLE) AS {c}"
        for c in floats
    ]
    return _sql(f"SELECT {others}, {', '.join(exact)} FROM {name}")


_U16 = "CAST(Year AS INTEGER) AS Year"
_CALENDAR_RATES = """
  SELECT {key} AS {name}, CAST(sum(t) AS BIGINT) AS Total_Flights, CAST(sum(l) AS BIGINT) AS Delayed_Flights,
    CAST(sum(c) AS BIGINT) AS Cancelled_Flights, CAST(sum(n) AS BIGINT) AS Operated_Flights,
    {scheduled} AS Scheduled_Delay_Rate_Pct, {operated} AS Operated_Delay_Rate_Pct{more}
  FROM calendar_c GROUP BY {key}"""


def _calendar_rates(key: str, name: str, more: str = "") -> str:
    return _sql(
        _CALENDAR_RATES.format(
            key=key, name=name, more=more, scheduled=_pct("sum(l)", "sum(t)"), operated=_pct("sum(l)", "sum(n)")
        )
    )


_SEASON = (
    "CASE WHEN Month IN (12, 1, 2) THEN 'Winter' WHEN Month IN (3, 4, 5) THEN 'Spring' "
    "WHEN Month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
)
_DAYS = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"

# Totals as the tables state them.
_TOTALS = {
    "agg_airline_performance": ("airline", "Total_Flights", "Delayed_Flights", "Cancelled_Flights"),
    "agg_airport_performance": ("airport", "Total_Departures", None, "Cancelled_Departures"),
    "agg_calendar_delays": ("calendar", "Total_Flights", "Delayed_Flights", "Cancelled_Flights"),
    "agg_hourly_delays": ("hourly", "Total_Flights", "Delayed_Flights", None),
    "agg_route_traffic": ("routes", "Flight_Count", None, None),
    "agg_cancellation_reasons": ("reasons", None, None, "Cancelled_Flights"),
}


def _totals(sources: list[str]) -> str:
    parts = [
        f"SELECT '{metric}' AS Metric, '{source}' AS Source, "
        f"CAST(coalesce(sum({column}), 0) AS BIGINT) AS Total FROM {_TOTALS[source][0]}"
        for source in sources
        for metric, column in zip(("flights", "delayed", "cancelled"), _TOTALS[source][1:], strict=True)
        if column
    ]
    agree = "min(Total) OVER (PARTITION BY Metric) = max(Total) OVER (PARTITION BY Metric)"
    return _sql(f"SELECT Metric, Source, Total, {agree} AS Agrees FROM ({' UNION ALL '.join(parts)})")


_LATER = ["agg_hourly_delays", "agg_calendar_delays"]
_RELEASED = (
    f"WITH early AS (SELECT * FROM ({_totals(list(_TOTALS)).replace('FROM b4)', 'FROM b4 WHERE year(l_shipdate) <= 1996)')})), "
    f"later AS (SELECT * FROM ({_totals(_LATER)})), seen(Release) AS (VALUES ('second'), ('newest')) "
    "SELECT 'first' AS Release, Metric, Source, Total FROM early "
    "UNION ALL SELECT Release, Metric, Source, Total FROM later, seen UNION ALL "
    f"SELECT Release, Metric, Source, Total FROM early, seen WHERE Source NOT IN ({', '.join(repr(n) for n in _LATER)})"
)

_TABLE_OF = {
    "agg_airline_performance": "airline",
    "agg_airport_performance": "airport",
    "agg_delay_causes_monthly": "causes",
    "agg_hourly_delays": "hourly",
    "agg_route_traffic": "routes",
    "agg_calendar_delays": "calendar",
    "agg_cancellation_reasons": "reasons",
}

_NUMERIC_TEXT = (
    "DepDelay", "DepDelayMinutes", "DepDel15", "ArrDelay", "ArrDelayMinutes", "ArrDel15", "Cancelled", "Diverted",
    "CRSDepTime", "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Distance",
    "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
)
_BAD = "CASE WHEN DayofMonth IN (1, 2) THEN NULL ELSE CAST(CarrierDelay AS DOUBLE) END"

_GRAIN_MEASURES = """
  count(*) AS flights, {op} AS operated, count(*) FILTER (WHERE op AND ArrDel15 = 0) AS ontime, {late} AS late,
  count(*) FILTER (WHERE op AND DepDel15 = 1) AS dep_late, {cancelled} AS cancelled,
  CAST(sum(DepDelayMinutes) FILTER (WHERE op) AS BIGINT) AS dep_minutes,
  CAST(sum(ArrDelayMinutes) FILTER (WHERE op) AS BIGINT) AS arr_minutes,
  CAST(sum(AirTime) FILTER (WHERE op) AS BIGINT) AS air_minutes,
  count(AirTime) FILTER (WHERE op) AS air_flights,
  CAST(sum(Distance) AS BIGINT) AS miles, count(Distance) AS miles_flights,
  CAST(sum(CarrierDelay) AS BIGINT) AS carrier_min, CAST(sum(WeatherDelay) AS BIGINT) AS weather_min,
  CAST(sum(NASDelay) AS BIGINT) AS nas_min, CAST(sum(SecurityDelay) AS BIGINT) AS security_min,
  CAST(sum(LateAircraftDelay) AS BIGINT) AS late_aircraft_min
""".format(op=_OP, late=_LATE, cancelled=_CANCELLED)

_EVENT = """
WITH e AS (
  SELECT event_id, event_type AS reporting_airline, CAST(floor(value) AS BIGINT) % 60 - 20 AS arr_delay, ts
  FROM events)
"""
_WINDOWS = _EVENT + f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
  n AS events, d AS active_delays, {_pct("d", "n")} AS delay_rate_pct
FROM (SELECT date_trunc('hour', ts) AS w, count(*) AS n, count(*) FILTER (WHERE arr_delay >= 15) AS d
  FROM e GROUP BY 1)
"""
_CELLS = {
    "tn": "count(*) FILTER (WHERE label = 0 AND prediction = 0)",
    "fp": "count(*) FILTER (WHERE label = 0 AND prediction = 1)",
    "fn": "count(*) FILTER (WHERE label = 1 AND prediction = 0)",
    "tp": "count(*) FILTER (WHERE label = 1 AND prediction = 1)",
}
_F1 = "CASE WHEN 2 * {a} + {b} + {c} > 0 THEN 2e0 * {a} / (2e0 * {a} + {b} + {c}) ELSE 0 END"
_F1_LATE, _F1_ONTIME = _F1.format(a="tp", b="fn", c="fp"), _F1.format(a="tn", b="fp", c="fn")

# Flights per month over the full grid of the years present.
_MONTHS = """
FROM (
  SELECT CAST(y AS INTEGER) AS Year, CAST(m AS INTEGER) AS Month, coalesce(n, 0) AS n
  FROM (SELECT unnest(range((SELECT min(Year) FROM f), (SELECT max(Year) + 1 FROM f))) AS y)
  CROSS JOIN (SELECT unnest(range(1, 13)) AS m)
  LEFT JOIN (SELECT Year, Month, count(*) AS n FROM f GROUP BY 1, 2) c ON c.Year = y AND c.Month = m)
"""


def _words(relation: str) -> str:
    return (
        f"SELECT word, count(*) AS \"count\" FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word "
        f"FROM {relation}) GROUP BY word"
    )


ORACLE: dict[str, str] = {
    "airline_performance": _sql("SELECT * FROM airline"),
    "airport_performance": _sql("SELECT * FROM airport"),
    "airport_performance_full": _sql("SELECT * FROM airport_full"),
    "delay_causes_monthly": _sql("SELECT * FROM causes"),
    "hourly_delays": _sql("SELECT * FROM hourly"),
    "route_traffic": _sql("SELECT * FROM routes"),
    "calendar_delays": _sql("SELECT * FROM calendar"),
    "cancellation_reasons": _sql("SELECT * FROM reasons"),
    "airline_named": _sql(
        "SELECT * EXCLUDE (code, name) REPLACE (coalesce(name, Reporting_Airline) AS Airline_Name) FROM airline "
        "LEFT JOIN (SELECT DISTINCT p_brand AS code, 'Carrier ' || p_brand AS name FROM part) "
        "ON code = Reporting_Airline"
    ),
    "airport_named": _sql(
        "SELECT Origin AS Airport_Code, coalesce(min(r_name), Origin) AS State, count(*) AS Total_Departures "
        "FROM f LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) "
        "ON n_name = Origin GROUP BY Origin"
    ),
    "airport_unknown_codes": _sql(
        "SELECT a.code AS Airport_Code, a.t AS Total_Departures, coalesce('Airport ' || n_name, a.code) AS Airport_Name, "
        "n_name || ' City' AS City, CASE WHEN n_name IS NOT NULL THEN a.state END AS State "
        "FROM deps a LEFT JOIN nation ON n_name = a.code AND n_nationkey % 3 <> 0"
    ),
    "carrier_season_rollup": _sql(
        f"SELECT Reporting_Airline, {_SEASON} AS Season, count(*) AS Flights, "
        "count(*) FILTER (WHERE ArrDelayMinutes > 20) AS Long_Delays, "
        f"{_pct('count(*) FILTER (WHERE ArrDelayMinutes > 20)', 'count(*)')} AS Long_Delay_Pct, "
        "count(*) FILTER (WHERE Diverted = 1) AS Diverted_Flights FROM f GROUP BY 1, 2"
    ),
    "one_pass_grains": _sql(
        "SELECT CASE WHEN GROUPING(Dep_Hour) = 0 THEN 'hour' WHEN GROUPING(Origin) = 0 THEN 'route' "
        "WHEN GROUPING(Month) = 0 THEN 'calendar' ELSE 'airline' END AS grain, "
        "Year, Reporting_Airline, CancellationCode, Month, DayOfWeek, Dep_Hour, "
        f"Origin, OriginCityName, OriginState, Dest, DestCityName, DestState, {_GRAIN_MEASURES} "
        "FROM g GROUP BY GROUPING SETS ((Year, Reporting_Airline, CancellationCode), (Year, Month, DayOfWeek), "
        "(Dep_Hour), (Origin, OriginCityName, OriginState, Dest, DestCityName, DestState))"
    ),
    "published_airline": _rounded(
        "airline",
        ["Delay_Rate_Pct", "Avg_Dep_Delay_Min", "Avg_Arr_Delay_Min", "Cancellation_Rate_Pct"],
        f"{_U16}, Reporting_Airline, Airline_Name, Total_Flights, OnTime_Flights, Delayed_Flights, Cancelled_Flights",
    ),
    "published_airport": _rounded(
        "airport",
        ["Dep_Delay_Rate_Pct", "Arr_Delay_Rate_Pct", "Avg_Dep_Delay_Min"],
        "Airport_Code, Airport_City, Airport_State, Total_Departures, Total_Arrivals, Cancelled_Departures",
    ),
    "published_causes": _rounded(
        "causes",
        [f"{n}_Pct" for n in _CAUSE_COLUMNS],
        f"{_U16}, CAST(Month AS SMALLINT) AS Month, Total_Delay_Minutes, "
        + ", ".join(f"{n}_Delay_Min" for n in _CAUSE_COLUMNS),
    ),
    "published_hourly": _rounded(
        "hourly",
        ["Delay_Probability_Pct", "Avg_Delay_Minutes"],
        "CAST(Dep_Hour AS SMALLINT) AS Dep_Hour, Total_Flights, Delayed_Flights",
    ),
    "published_routes": _rounded(
        "routes",
        ["Avg_AirTime_Min", "Route_Delay_Rate_Pct"],
        "Origin, Dest, Route_Name, Flight_Count, CAST(Distance_Miles AS BIGINT) AS Distance_Miles",
    ),
    "published_calendar": _rounded(
        "calendar",
        ["Delay_Rate_Pct", "Avg_Arr_Delay_Min"],
        f"{_U16}, CAST(Month AS SMALLINT) AS Month, CAST(Day_Of_Week AS SMALLINT) AS Day_Of_Week, Total_Flights, "
        "Delayed_Flights, Cancelled_Flights",
    ),
    "published_reasons": _sql("SELECT * FROM reasons"),
    "publish_all": _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS table_rows FROM {cte}" for name, cte in _TABLE_OF.items()
        )
    ),
    "release_versions": _RELEASED,
    "incremental_totals": _totals(list(_TOTALS)),
    "incremental_calendar": _sql("SELECT * FROM calendar"),
    "export_and_load": _totals(["agg_calendar_delays", "agg_hourly_delays"]),
    "reconcile_totals": _totals(list(_TOTALS)),
    "contract_violations": _sql(
        "SELECT 'agg_hourly_delays' AS \"Table\", Rule, \"Column\", Violations FROM ("
        "SELECT 'out_of_range' AS Rule, 'Delayed_Flights' AS \"Column\", "
        "count(*) FILTER (WHERE ArrDelay < 0) AS Violations FROM f UNION ALL "
        "SELECT 'not_a_percentage', 'Delay_Probability_Pct', "
        "count(*) FILTER (WHERE ArrDelay * 5 < 0 OR ArrDelay * 5 > 100) FROM f UNION ALL "
        "SELECT 'duplicate_key', 'Dep_Hour', count(*) - count(DISTINCT Dep_Hour) FROM f) WHERE Violations > 0"
    ),
    "airline_ranking": _sql(
        "SELECT Year, CAST(row_number() OVER (PARTITION BY Year ORDER BY Delay_Rate_Pct DESC, Reporting_Airline) "
        "AS INTEGER) AS Rank, Reporting_Airline, Airline_Name, Total_Flights, Delayed_Flights, Delay_Rate_Pct, "
        "Avg_Dep_Delay_Min, Avg_Arr_Delay_Min FROM airline"
    ),
    "airline_ranking_all_years": _sql(
        "SELECT *, CAST(row_number() OVER (ORDER BY Delay_Rate_Pct DESC, Reporting_Airline) AS INTEGER) AS Rank "
        "FROM (SELECT Reporting_Airline, CAST(sum(t) AS BIGINT) AS Total_Flights, "
        f"CAST(sum(l) AS BIGINT) AS Delayed_Flights, {_pct('sum(l)', 'sum(l + o)')} AS Delay_Rate_Pct, "
        f"{_mean('sum(dm)', 'sum(n)')} AS Avg_Dep_Delay_Min, {_mean('sum(am)', 'sum(n)')} AS Avg_Arr_Delay_Min "
        "FROM airline_c GROUP BY 1)"
    ),
    "top_airports": _sql(
        "SELECT CAST(row_number() OVER (ORDER BY Dep_Delay_Rate_Pct DESC, Airport_Code) AS INTEGER) AS Rank, "
        "Airport_Code, Airport_City, Dep_Delay_Rate_Pct, Total_Departures, Avg_Dep_Delay_Min FROM airport "
        "WHERE Total_Departures >= 10 ORDER BY Rank LIMIT 10"
    ),
    "peak_hours": _sql(
        "SELECT *, CAST(row_number() OVER (ORDER BY Delay_Probability_Pct DESC, Dep_Hour) AS INTEGER) AS Rank "
        "FROM hourly"
    ),
    "hourly_curve": _sql("SELECT Dep_Hour, Delay_Probability_Pct, Avg_Delay_Minutes FROM hourly"),
    "cause_share": _sql(
        f"SELECT *, {_pct('Delay_Minutes', 'sum(Delay_Minutes) OVER ()')} AS Share_Pct, "
        "CAST(row_number() OVER (ORDER BY Delay_Minutes DESC, Cause) AS INTEGER) AS Rank, "
        "row_number() OVER (ORDER BY Delay_Minutes DESC, Cause) = 1 AS Is_Dominant FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n.replace('_', ' ')}' AS Cause, CAST(sum({n}) AS BIGINT) AS Delay_Minutes FROM causes_c"
            for n in _CAUSE_COLUMNS
        )
        + ")"
    ),
    "dow_rates": _calendar_rates("DayOfWeek", "Day_Of_Week", f", {_DAYS}[DayOfWeek] AS Day_Name"),
    "month_rates": _calendar_rates("Month", "Month"),
    "season_rates": _calendar_rates(_SEASON, "Season"),
    "cancel_share": _sql(
        f"SELECT *, {_pct('Cancelled_Flights', 'sum(Cancelled_Flights) OVER ()')} AS Share_Pct FROM ("
        "SELECT Cancellation_Code, Cancellation_Reason, CAST(sum(Cancelled_Flights) AS BIGINT) AS Cancelled_Flights "
        "FROM reasons GROUP BY 1, 2)"
    ),
    "airline_cancel_rate": _sql(
        "SELECT Reporting_Airline, CAST(sum(c) AS BIGINT) AS Cancelled_Flights, CAST(sum(t) AS BIGINT) AS "
        f"Total_Flights, {_pct('sum(c)', 'sum(t)')} AS Cancellation_Rate_Pct FROM airline_c GROUP BY 1"
    ),
    "airport_cancel_rate": _sql(
        "SELECT Airport_Code, Total_Departures, Cancelled_Departures, "
        f"{_pct('Cancelled_Departures', 'Total_Departures')} AS Cancellation_Rate_Pct FROM airport"
    ),
    "top_routes": _sql(
        "SELECT CAST(row_number() OVER (ORDER BY Flight_Count DESC, Origin, Dest) AS INTEGER) AS Rank, Route_Name, "
        "Flight_Count, Route_Delay_Rate_Pct, Distance_Miles, Avg_AirTime_Min FROM routes ORDER BY Rank LIMIT 10"
    ),
    "delayed_routes": _sql(
        "SELECT CAST(row_number() OVER (ORDER BY Route_Delay_Rate_Pct DESC, Origin, Dest) AS INTEGER) AS Rank, "
        "Route_Name, Flight_Count, Route_Delay_Rate_Pct FROM routes WHERE Flight_Count > 100 ORDER BY Rank LIMIT 10"
    ),
    "distance_vs_delay": _sql("SELECT Route_Name, Distance_Miles, Route_Delay_Rate_Pct, Flight_Count FROM routes"),
    "distance_delay_correlation": _sql(
        "SELECT count(*) AS Routes, round(corr(CAST(Distance_Miles AS DOUBLE), Route_Delay_Rate_Pct), 6) "
        "AS Correlation FROM routes"
    ),
    "yoy_growth": _sql(
        "SELECT Year, Total_Flights, Total_Flights - p AS \"Change\", "
        "CAST(Total_Flights - p AS DOUBLE) / CAST(p AS DOUBLE) * CAST(100 AS DOUBLE) AS Growth_Pct FROM ("
        "SELECT y.Year, y.Total_Flights, z.Total_Flights AS p FROM (SELECT Year, CAST(sum(t) AS BIGINT) AS "
        "Total_Flights FROM airline_c GROUP BY 1) y LEFT JOIN (SELECT Year, CAST(sum(t) AS BIGINT) AS Total_Flights "
        "FROM airline_c GROUP BY 1) z ON z.Year = y.Year - 1)"
    ),
    "kpi_cards": _sql(
        "SELECT t AS Total_Flights, l AS Delayed_Flights, r AS System_Delay_Rate_Pct, 100 - r AS "
        "OnTime_Reliability_Pct, c AS Total_Cancelled, x AS Cancellation_Rate_Pct, "
        "CASE WHEN 100 - r > 75 THEN 'On target' ELSE 'Off target' END AS Reliability_Status, "
        "CASE WHEN x < 3 THEN 'On target' ELSE 'Off target' END AS Cancellation_Status FROM ("
        "SELECT CAST(sum(t) AS BIGINT) AS t, CAST(sum(l) AS BIGINT) AS l, CAST(sum(c) AS BIGINT) AS c, "
        f"{_pct('sum(l)', 'sum(l + o)')} AS r, {_pct('sum(c)', 'sum(t)')} AS x FROM airline_c)"
    ),
    "minutes_per_late_flight": _sql(
        f"SELECT {_LATE} AS Delayed_Flights, "
        f"{_mean('sum(ArrDelayMinutes) FILTER (WHERE op AND ArrDel15 = 1)', _LATE)} AS Mean_Minutes_Per_Late_Flight "
        "FROM g"
    ),
    "sliced_airlines": _sql(
        "SELECT * FROM airline WHERE Year IN (1996, 1998) AND Reporting_Airline IN ('Brand#1', 'Brand#12')"
    ),
    "population_counts": _sql(
        "SELECT 'operated' AS Population, Year, count(*) AS Flights FROM g WHERE op GROUP BY Year UNION ALL "
        "SELECT 'delayed', Year, count(*) FROM g WHERE op AND ArrDel15 = 1 GROUP BY Year UNION ALL "
        "SELECT 'cancelled', Year, count(*) FROM g WHERE Cancelled = 1 GROUP BY Year"
    ),
    "conform_flights": _sql(
        "SELECT Year, Month, DayofMonth, DayOfWeek, CAST(FlightDate AS VARCHAR) AS FlightDate, Reporting_Airline, "
        "Tail_Number, Flight_Number_Reporting_Airline, Origin, OriginCityName, OriginState, Dest, DestCityName, "
        "DestState, CancellationCode, Dep_Hour, Route, CAST(NULL AS DOUBLE) AS DepTime, "
        "CAST(NULL AS DOUBLE) AS CRSArrTime, CAST(NULL AS DOUBLE) AS ArrTime, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC_TEXT)
        + f", {_BAD} AS CarrierDelay FROM f"
    ),
    "dep_hour_route": _sql("SELECT Dep_Hour, Route, count(*) AS Flights FROM f GROUP BY 1, 2"),
    "csv_etl": _sql(
        f"SELECT Year, Month, count(*) AS Flights, count({_BAD}) AS Carrier_Values, sum({_BAD}) AS Carrier_Minutes, "
        "CAST(sum(ArrDelay) AS DOUBLE) AS Arr_Delay, CAST(0 AS BIGINT) AS Dep_Times, "
        "CAST(sum(Dep_Hour) AS BIGINT) AS Hour_Sum, min(Route) AS First_Route FROM f GROUP BY Year, Month"
    ),
    "csv_mixed_headers": _sql(
        "SELECT Year, Origin, Dest, count(*) AS Flights, CAST(sum(ArrDelay) AS DOUBLE) AS Minutes, "
        "count(CASE WHEN Year % 2 = 0 THEN Distance END) AS Distances FROM f GROUP BY 1, 2, 3"
    ),
    "csv_losses": _sql(
        "SELECT folder, count(*) AS Rows_In, count(*) FILTER (WHERE bad) AS Rejected, "
        "count(*) FILTER (WHERE folder = 'a' AND DayofMonth = 1) AS Lost_Values, "
        "CAST(CASE WHEN folder = 'a' THEN 1 ELSE 0 END AS BIGINT) AS Lossy_Columns, count(*) FILTER (WHERE bad) AS Lines, "
        "count(*) FILTER (WHERE NOT bad) AS Loaded, CAST(sum(ArrDelay) FILTER (WHERE NOT bad) AS DOUBLE) AS Minutes "
        "FROM (SELECT *, CASE WHEN Year % 2 = 0 THEN 'a' ELSE 'b' END AS folder, "
        "Year % 2 = 1 AND DayofMonth % 3 < 2 AS bad FROM f) GROUP BY folder"
    ),
    "csv_inferred": _sql(
        "SELECT Year, Origin, 'ArrDelay:int,CancellationCode:string,Distance:double,FlightDate:date,Nothing:string,"
        "Origin:string,Year:int' AS Kinds, CAST(sum(ArrDelay) AS BIGINT) AS Minutes, sum(Distance / CAST(4 AS DOUBLE)) AS Miles, "
        "count(CancellationCode) AS Codes, CAST(0 AS BIGINT) AS Nothings, CAST(max(FlightDate) AS VARCHAR) AS \"Last\" "
        "FROM f GROUP BY 1, 2"
    ),
    "parquet_by_year": _sql("SELECT * FROM calendar WHERE Year BETWEEN 1997 AND 1999"),
    "written_counts": _sql(
        "SELECT Year, count(*) AS Flights, CAST(sum(count(*)) OVER () AS BIGINT) AS Written FROM f GROUP BY Year"
    ),
    "batch_run": _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS table_rows FROM {cte}" for name, cte in _TABLE_OF.items()
        )
        + " UNION ALL SELECT 'flights', count(*) FROM f UNION ALL SELECT 'ml_delay_predictions', count(*) FROM g "
        "WHERE op AND Year = (SELECT max(Year) FROM g WHERE op)"
    ),
    "raw_manifest_months": _sql(f"SELECT Year, Month, n AS \"rows\", n > 0 AS ok {_MONTHS}"),
    "raw_manifest_files": _sql(f"SELECT Year, Month, n > 0 AS landed, n AS \"rows\", n > 0 AS ok {_MONTHS}"),
    "risk_buckets": _sql("SELECT score AS P, Risk_Category, count(*) AS Flights FROM p GROUP BY 1, 2"),
    "high_risk_flights": _sql("SELECT count(*) FILTER (WHERE Risk_Category = 'High') AS High_Risk_Flights FROM p"),
    "risk_distribution": _sql(
        f"SELECT Risk_Category, Flights, {_pct('Flights', 'sum(Flights) OVER ()')} AS Share_Pct "
        "FROM (SELECT Risk_Category, count(*) AS Flights FROM p GROUP BY 1)"
    ),
    "flight_inspection": _sql(
        "SELECT CAST(FlightDate AS VARCHAR) AS FlightDate, Reporting_Airline, Origin, Dest, Dep_Hour, "
        "CAST(CAST(Flight_Number_Reporting_Airline AS BIGINT) % 100 AS DOUBLE) AS Probability_Pct, Risk_Category, "
        "prediction AS Predicted_Delayed, label AS Actual_Delayed FROM p "
        "WHERE Risk_Category = 'High' AND Dep_Hour IN (17, 18)"
    ),
    "prediction_table": _sql(
        "SELECT CAST(FlightDate AS VARCHAR) AS FlightDate, Reporting_Airline, Origin, Dest, "
        "CAST(Dep_Hour AS SMALLINT) AS Dep_Hour, CAST(label AS SMALLINT) AS Actual_Delayed, "
        "CAST(prediction AS SMALLINT) AS Predicted_Delayed, CAST(pf AS DOUBLE) AS Delay_Probability, Risk_Category "
        "FROM p"
    ),
    "prediction_sample": _sql(
        "SELECT CAST(FlightDate AS VARCHAR) AS FlightDate, Reporting_Airline, Origin, Dest, "
        "CAST(Dep_Hour AS SMALLINT) AS Dep_Hour, CAST(label AS SMALLINT) AS Actual_Delayed, "
        "CAST(prediction AS SMALLINT) AS Predicted_Delayed, CAST(pf AS DOUBLE) AS Delay_Probability, Risk_Category "
        f"FROM p ORDER BY {_hash('FlightDate', 'Reporting_Airline', 'Origin', 'Dest', 'Dep_Hour', 'label')}, "
        "p.FlightDate, Reporting_Airline, Origin, Dest, Dep_Hour, label, prediction, pf, Risk_Category LIMIT 50000"
    ),
    "hash_sample": _sql(
        "SELECT Year, count(*) AS Flights FROM f WHERE "
        + _hash("FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest")
        + f" < 0.1 * {1 << 52} GROUP BY 1"
    ),
    "split_sizes": _sql(
        "SELECT part, count(*) AS \"rows\", count(*) FILTER (WHERE ArrDel15 = 1) AS late FROM (SELECT ArrDel15, unnest(["
        f"CASE WHEN h < 0.8 * {1 << 52} THEN 'hash_train' ELSE 'hash_test' END, "
        f"CASE WHEN Year = last THEN 'year_check' WHEN Year = last - 1 THEN 'year_test' WHEN h < 0.15 * {1 << 52} "
        "THEN 'year_train' ELSE 'year_rest' END]) AS part FROM (SELECT *, max(Year) OVER () AS last, "
        f"{_hash('FlightDate', 'Reporting_Airline', 'Origin', 'Dest', 'Dep_Hour', 'ArrDel15')} AS h FROM g WHERE op)) "
        "GROUP BY 1"
    ),
    "feature_names": _sql(
        "SELECT kind, count(DISTINCT value) + 1 AS features FROM (SELECT unnest([{'kind': 'Reporting_Airline', 'value': "
        "Reporting_Airline}, {'kind': 'Origin', 'value': Origin}, {'kind': 'Dest', 'value': Dest}], recursive := true) "
        "FROM (SELECT *, max(Year) OVER () AS last, "
        f"{_hash('FlightDate', 'Reporting_Airline', 'Origin', 'Dest', 'Dep_Hour', 'ArrDel15')} AS h FROM g WHERE op) "
        f"WHERE Year < last AND h < 0.15 * {1 << 52}) GROUP BY kind UNION ALL SELECT 'number', 5"
    ),
    "model_gradient": _sql(
        "SELECT kind, count(DISTINCT value) AS features, count(DISTINCT value) AS flat FROM (SELECT unnest(["
        "{'kind': 'Reporting_Airline', 'value': Reporting_Airline}, {'kind': 'Origin', 'value': Origin}, "
        "{'kind': 'Dest', 'value': Dest}], recursive := true) FROM (SELECT *, max(Year) OVER () AS last, "
        f"{_hash('FlightDate', 'Reporting_Airline', 'Origin', 'Dest', 'Dep_Hour', 'ArrDel15')} AS h FROM g WHERE op) "
        f"WHERE Year < last AND h < 0.15 * {1 << 52}) GROUP BY kind "
        "UNION ALL SELECT 'number', 5, 5 UNION ALL SELECT 'intercept', 1, 1"
    ),
    "rule_comparison": _sql(
        ", r AS (SELECT 'score' AS model, label, CAST(score AS DOUBLE) AS score FROM s "
        "UNION ALL SELECT 'tenths', label, floor(CAST(score AS DOUBLE) * 10) / 10 FROM s), "
        "steps AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n "
        "FROM r GROUP BY 1, 2), below AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM steps "
        "WINDOW w AS (PARTITION BY model ORDER BY score DESC)), areas AS (SELECT model, "
        "round(sum(CAST(p AS DOUBLE) * (tot - fp + n / 2e0)) / (sum(p) * any_value(tot)), 9) AS auc_roc, "
        "round(sum(p * (coalesce((tp - p) / nullif(CAST(tp - p + fp - n AS DOUBLE), 0), tp / CAST(tp + fp AS DOUBLE)) "
        "+ tp / CAST(tp + fp AS DOUBLE)) / 2) / sum(p), 9) AS auc_pr "
        "FROM (SELECT *, sum(n) OVER (PARTITION BY model) AS tot FROM below) GROUP BY 1), "
        f"cells AS (SELECT model, {', '.join(f'{e} AS {n}' for n, e in _CELLS.items())} FROM "
        "(SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM r) GROUP BY 1) "
        f"SELECT model, auc_roc, auc_pr, {_pct('(tp + tn)', '(tn + fp + fn + tp)')} / 100.0 AS accuracy, "
        f"round(({_F1_LATE} * (tp + fn) + {_F1_ONTIME} * (tn + fp)) / (tn + fp + fn + tp), 9) AS f1, "
        f"{_pct('tp', '(tp + fp)')} / 100.0 AS precision, {_pct('tp', '(tp + fn)')} / 100.0 AS recall, "
        f"{_pct('greatest(tp + fn, tn + fp)', '(tn + fp + fn + tp)')} / 100.0 AS majority_accuracy FROM areas JOIN cells USING (model)"
    ),
    "delay_model_coverage": _sql(
        "SELECT Year, Reporting_Airline, count(*) AS Scored, count(*) FILTER (WHERE ArrDel15 = 1) AS Late_Flights "
        "FROM g WHERE op AND Year = (SELECT max(Year) FROM g WHERE op) GROUP BY 1, 2"
    ),
    "confusion_matrix": _sql(
        "SELECT CAST(y AS INTEGER) AS label, CAST(q AS INTEGER) AS prediction, coalesce(n, 0) AS flights "
        "FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(y, q) LEFT JOIN "
        "(SELECT label, prediction, count(*) AS n FROM s GROUP BY 1, 2) c ON c.label = y AND c.prediction = q"
    ),
    "precision_recall": _sql(
        f"SELECT tn, fp, fn, tp, {_pct('(tp + tn)', '(tn + fp + fn + tp)')} AS accuracy_pct, "
        f"{_pct('tp', '(tp + fp)')} AS precision_pct, {_pct('tp', '(tp + fn)')} AS recall_pct, "
        f"{_F1_LATE} AS f1_late, ({_F1_LATE} * (tp + fn) + {_F1_ONTIME} * (tn + fp)) / (tn + fp + fn + tp) "
        f"AS f1_weighted FROM (SELECT {', '.join(f'{e} AS {n}' for n, e in _CELLS.items())} FROM s)"
    ),
    "roc_points": _sql(
        "SELECT bin, CAST(bin AS DOUBLE) / 20 AS threshold, tp AS true_positives, fp AS false_positives, "
        f"{_pct('tp', 'pos')} AS true_positive_rate_pct, {_pct('fp', 'neg')} AS false_positive_rate_pct, "
        f"{_pct('tp', '(tp + fp)')} AS precision_pct FROM (SELECT bin, "
        "CAST(sum(p) OVER (ORDER BY bin DESC) AS BIGINT) AS tp, CAST(sum(n) OVER (ORDER BY bin DESC) AS BIGINT) AS fp, "
        "sum(p) OVER () AS pos, sum(n) OVER () AS neg FROM (SELECT CAST(floor(score * 20) AS INTEGER) AS bin, "
        "count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM s GROUP BY 1))"
    ),
    "majority_baseline": _sql(
        "SELECT CASE WHEN 2 * p > n THEN 1 ELSE 0 END AS majority_class, n AS flights, "
        f"{_pct('greatest(p, n - p)', 'n')} AS accuracy_pct "
        "FROM (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS p FROM s)"
    ),
    "roc_auc_by_rank": _sql(
        "SELECT (ranks - p * (p + 1) / 2e0) / (CAST(p AS DOUBLE) * n) AS auc, p AS positives, n AS negatives FROM ("
        "SELECT sum(r) FILTER (WHERE label = 1) AS ranks, count(*) FILTER (WHERE label = 1) AS p, "
        "count(*) FILTER (WHERE label = 0) AS n FROM (SELECT label, rank() OVER (ORDER BY score) "
        "+ (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS r FROM s))"
    ),
    "pr_area": _sql(
        "SELECT round(sum(p * (coalesce((tp - p) / nullif(CAST(tp - p + fp - n AS DOUBLE), 0), tp / CAST(tp + fp AS DOUBLE)) "
        "+ tp / CAST(tp + fp AS DOUBLE)) / 2) / sum(p), 9) AS auc_pr, CAST(sum(p) AS BIGINT) AS positives FROM (SELECT p, n, "
        "sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp FROM (SELECT score, "
        "count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM s GROUP BY 1))"
    ),
    "word_count": _words("documents"),
    "word_count_conversations": _words("conversations"),
    "event_lines": _words("(SELECT concat_ws(' ', event_type, props) AS text FROM events)"),
    "category_count": 'SELECT event_type AS category, count(*) AS "count" FROM events GROUP BY 1',
    "view_total_rows": _sql("SELECT count(*) AS total_rows FROM f"),
    "preview_first_n": "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 10",
    "events_parsed": (
        "SELECT CAST(user_id AS INTEGER) AS user_id, event_type AS action, CAST(ts AS VARCHAR) AS ts FROM events"
    ),
    "event_rejects": (
        "SELECT kind, count(*) AS messages, CAST(sum(k) AS BIGINT) AS total FROM ("
        "SELECT CASE WHEN v % 4 <> 0 THEN 'rejected' ELSE 'good' END AS kind, "
        "CASE WHEN v % 4 = 0 THEN v END AS k "
        "FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS v FROM events)) GROUP BY 1"
    ),
    "events_enriched": _EVENT
    + "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, reporting_airline, arr_delay, "
    "greatest(arr_delay, 0) AS arr_delay_minutes, CASE WHEN arr_delay >= 15 THEN 1 ELSE 0 END AS arr_del15, "
    "CASE WHEN arr_delay >= 15 THEN 'Delayed' ELSE 'On-Time' END AS status FROM e",
    "stream_accounting": (
        "SELECT count(*) FILTER (WHERE event_id % 7 <> 0) AS in_windows, "
        "count(*) FILTER (WHERE event_id % 7 = 0) AS rejected FROM events"
    ),
    "events_flight_fields": _EVENT
    + "SELECT event_id, concat(reporting_airline, user_id) AS flight_id, "
    "printf('%02d:%02d', event_id % 24, event_id % 4 * 15) AS crs_dep_time, "
    "greatest(arr_delay + event_id % 5 - 2, 0) AS dep_delay_minutes, greatest(arr_delay, 0) AS arr_delay_minutes, "
    "CASE WHEN arr_delay >= 15 THEN 'Delayed' ELSE 'On-Time' END AS status FROM e JOIN events USING (event_id)",
    "stream_late_rows": _EVENT
    + ", t AS (SELECT *, event_id % 3 AS part, time_bucket(INTERVAL 1 HOUR, ts) AS w FROM e WHERE event_id % 7 <> 0), "
    "bound AS (SELECT p AS part, (SELECT max(ts) FROM t WHERE part < p) - INTERVAL 10 DAY AS b FROM (VALUES (0), (1), (2)) v(p)), "
    "judged AS (SELECT t.*, coalesce(w + INTERVAL 1 HOUR <= b, false) AS late FROM t JOIN bound USING (part)) "
    "SELECT CAST(count(*) FILTER (WHERE NOT late) AS BIGINT) AS in_windows, "
    "count(*) FILTER (WHERE NOT late AND arr_delay >= 15) AS delays, count(DISTINCT CASE WHEN NOT late THEN w END) AS windows, "
    + ", ".join(f"count(*) FILTER (WHERE late AND part = {p}) AS late_{p}" for p in range(3))
    + ", (SELECT count(*) FROM events WHERE event_id % 7 = 0) AS rejected FROM judged",
    "live_metrics_batch": _WINDOWS,
    "stream_live_metrics": _WINDOWS,
    "stream_json_sink": (
        "SELECT event_type AS action, count(*) AS events, CAST(sum(user_id) AS BIGINT) AS users, "
        "min(CAST(ts AS VARCHAR)) AS first_ts FROM events GROUP BY 1"
    ),
    "stream_serving_sink": _EVENT
    + "SELECT reporting_airline, CASE WHEN arr_delay >= 15 THEN 'Delayed' ELSE 'On-Time' END AS status, "
    "count(*) AS events, CAST(sum(greatest(arr_delay, 0)) AS BIGINT) AS minutes FROM e GROUP BY 1, 2",
}
ORACLE["prediction_table_vector"] = ORACLE["prediction_table"]
