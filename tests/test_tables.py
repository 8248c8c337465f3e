"""Hand-made rows for the corner cases of the aggregate tables."""

from __future__ import annotations

import pytest
from flights import CANCELLED, LATE
from hypothesis import HealthCheck, given, settings, strategies as st

from punctual.functions import dep_hour
from punctual.operators import checks, population, tables
from punctual.operators.rollup import rate_rollup


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_airline_counts_and_rates(make_flights):
    fact = make_flights({}, LATE, LATE, CANCELLED, {"Diverted": 1.0, "ArrDel15": None})
    row = one(tables.airline_performance(fact))
    assert (row["Total_Flights"], row["OnTime_Flights"], row["Delayed_Flights"], row["Cancelled_Flights"]) == (5, 1, 2, 1)
    assert row["Delay_Rate_Pct"] == pytest.approx(200 / 3)
    assert row["Cancellation_Rate_Pct"] == 20.0
    assert row["Avg_Arr_Delay_Min"] == 20.0
    assert row["Airline_Name"] == "AA"


def test_null_cancelled_is_not_operated_and_not_cancelled(make_flights):
    row = one(tables.airline_performance(make_flights({"Cancelled": None}, {})))
    assert (row["Total_Flights"], row["OnTime_Flights"], row["Cancelled_Flights"]) == (2, 1, 0)
    flags = [r["is_operated"] for r in population.with_operated(make_flights({"Cancelled": None}, {})).collect()]
    assert flags == [None, True]
    assert population.operated(make_flights({"Cancelled": None}, {})).count() == 1


def test_group_with_only_cancelled_flights_has_zero_means(make_flights):
    fact = make_flights(CANCELLED, CANCELLED)
    row = one(tables.airline_performance(fact))
    assert row["Delay_Rate_Pct"] == row["Avg_Dep_Delay_Min"] == row["Avg_Arr_Delay_Min"] == 0.0
    assert row["Cancellation_Rate_Pct"] == 100.0
    route = one(tables.route_traffic(fact))
    assert (route["Avg_AirTime_Min"], route["Route_Delay_Rate_Pct"]) == (0.0, 0.0)
    assert tables.delay_causes_monthly(fact).isEmpty()


def test_missing_delay_minutes_count_as_zero(make_flights):
    row = one(tables.airline_performance(make_flights({"DepDelayMinutes": None}, {"DepDelayMinutes": 10.0})))
    assert row["Avg_Dep_Delay_Min"] == 5.0


def test_missing_air_time_is_left_out_of_the_mean(make_flights):
    row = one(tables.route_traffic(make_flights({"AirTime": None}, {"AirTime": 30.0})))
    assert row["Avg_AirTime_Min"] == 30.0


def test_arrival_only_airport(make_flights):
    fact = make_flights({}, LATE, {"Origin": "CCC", "OriginCityName": None, "OriginState": None, "Dest": "AAA"})
    left = {r["Airport_Code"]: r for r in tables.airport_performance(fact).collect()}
    assert set(left) == {"AAA", "CCC"}
    assert left["AAA"]["Total_Arrivals"] == 1
    assert left["CCC"]["Total_Arrivals"] == 0 and left["CCC"]["Airport_City"] == ""
    assert left["AAA"]["Dep_Delay_Rate_Pct"] == 50.0
    full = {r["Airport_Code"]: r for r in tables.airport_performance(fact, how="full").collect()}
    assert set(full) == {"AAA", "BBB", "CCC"}
    assert full["BBB"]["Total_Departures"] == 0 and full["BBB"]["Total_Arrivals"] == 2
    assert full["BBB"]["Arr_Delay_Rate_Pct"] == 50.0 and full["BBB"]["Airport_City"] == "Beta, BE"
    with pytest.raises(ValueError):
        tables.airport_performance(fact, how="inner")


def test_disagreeing_city_names_still_give_one_airport(make_flights):
    fact = make_flights({}, {"OriginCityName": "Aaa, AL"})
    row = one(tables.airport_performance(fact))
    assert (row["Airport_City"], row["Total_Departures"]) == ("Aaa, AL", 2)


def test_unknown_cancellation_code_is_its_own_group(make_flights):
    coded = [{**CANCELLED, "CancellationCode": c} for c in ("A", "B", "B", None, "Z")]
    rows = tables.cancellation_reasons(make_flights({}, *coded)).collect()
    assert [(r["Cancellation_Code"], r["Cancellation_Reason"], r["Cancelled_Flights"]) for r in rows] == [
        ("A", "Carrier", 1),
        ("B", "Weather", 2),
        ("Unknown", "Unknown", 1),
        ("Z", "Unknown", 1),
    ]


def test_hour_wraps_and_null_hour_stays_null(spark, make_flights):
    hours = spark.createDataFrame([(2400.0,), (5.0,), (1530.0,), (2359.0,), (None,)], "t double")
    assert [r[0] for r in hours.select(dep_hour("t")).collect()] == [0, 0, 15, 23, None]
    rows = tables.hourly_delays(make_flights({"Dep_Hour": None}, {"Dep_Hour": 0})).collect()
    assert [(r["Dep_Hour"], r["Total_Flights"]) for r in rows] == [(None, 1), (0, 1)]
    broken = checks.contract_violations(tables.hourly_delays(make_flights({"Dep_Hour": None})), "agg_hourly_delays")
    assert [tuple(r) for r in broken.collect()] == [("agg_hourly_delays", "null_key", "Dep_Hour", 1)]


def test_causes_treat_null_as_zero(make_flights):
    fact = make_flights({**LATE, "CarrierDelay": 10.0, "NASDelay": 20.0}, {**LATE, "CarrierDelay": 30.0}, {})
    row = one(tables.delay_causes_monthly(fact))
    assert (row["Total_Delay_Minutes"], row["Carrier_Delay_Min"], row["Weather_Delay_Min"]) == (60, 40, 0)
    assert row["NAS_Pct"] == pytest.approx(100 / 3)


def test_empty_input(make_flights):
    empty = make_flights()
    outputs = tables.all_tables(empty)
    assert all(df.isEmpty() for df in outputs.values())
    assert tables.airline_performance(empty).isEmpty()
    overall = one(rate_rollup(empty, [], ["Total_Flights", "Delay_Rate_Pct", "Avg_Arr_Delay_Min"]))
    assert overall == {"Total_Flights": 0, "Delay_Rate_Pct": 0.0, "Avg_Arr_Delay_Min": 0.0}


_flight = st.fixed_dictionaries(
    {
        "Year": st.sampled_from([2023, 2024]),
        "Month": st.sampled_from([1, 2]),
        "DayOfWeek": st.sampled_from([1, 7]),
        "Reporting_Airline": st.sampled_from(["AA", "DL"]),
        "Origin": st.sampled_from(["AAA", "BBB", "CCC"]),
        "Dest": st.sampled_from(["AAA", "BBB", "CCC"]),
        "Dep_Hour": st.sampled_from([0, 23]),
        "Cancelled": st.sampled_from([0.0, 0.0, 1.0, None]),
        "Diverted": st.sampled_from([0.0, 0.0, 1.0]),
        "ArrDel15": st.sampled_from([0.0, 1.0, None]),
        "DepDel15": st.sampled_from([0.0, 1.0, None]),
        "ArrDelayMinutes": st.sampled_from([0.0, 20.0, None]),
        "CancellationCode": st.sampled_from(["A", None]),
    }
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_flight, min_size=1, max_size=40))
def test_one_scan_equals_single_tables_and_totals_agree(make_flights, rows):
    fact = make_flights(*rows)
    outputs = tables.all_tables(fact)
    for name, df in outputs.items():
        single = getattr(tables, name.removeprefix("agg_"))(fact)
        assert sorted(map(str, single.collect())) == sorted(map(str, df.collect())), name
        for column, kind in df.dtypes:
            if column.endswith("_Pct"):
                assert kind == "double" and df.where(f"{column} < 0 OR {column} > 100").isEmpty()
    assert checks.reconcile_totals(outputs).where("NOT Agrees").isEmpty()


def test_reconcile_reports_a_difference(make_flights):
    fact = make_flights({}, LATE)
    parts = {
        "agg_airline_performance": tables.airline_performance(fact),
        "agg_calendar_delays": tables.calendar_delays(make_flights({})),
    }
    bad = {r["Metric"] for r in checks.reconcile_totals(parts).where("NOT Agrees").collect()}
    assert bad == {"flights", "delayed"}


def test_slices(make_flights):
    fact = make_flights({}, {"Year": 2023}, {"Year": 2022, "Reporting_Airline": "DL"})
    assert population.slice_by(fact, Year=[2022, 2023], Reporting_Airline=None).count() == 2
    assert population.slice_by(fact, Reporting_Airline="DL").count() == 1
    assert population.in_years(fact, 2023).count() == 2
    assert population.in_years(fact, last=2022).count() == 1
