"""Golden numbers of one published month, and the ranking helpers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from punctual.functions import day_name, pct, probability_pct, risk_category, season
from punctual.operators import ranking, serving

# Published tables of January 2024.
CALENDAR = [
    (2024, 1, 1, 91299, 21578, 4561, 24.96, 22.6),
    (2024, 1, 2, 85106, 22875, 3993, 28.33, 25.18),
    (2024, 1, 3, 85719, 15946, 2209, 19.13, 14.1),
    (2024, 1, 4, 73913, 13563, 1857, 18.87, 12.95),
    (2024, 1, 5, 74105, 19039, 3323, 26.96, 21.37),
    (2024, 1, 6, 63514, 15287, 1985, 24.91, 18.48),
    (2024, 1, 7, 73615, 18122, 2461, 25.53, 19.04),
]
AIRLINES = [
    ("9E", 16972, 12448, 3771, 23.25, 706, 4.16),
    ("AA", 77346, 53597, 22292, 29.37, 1248, 1.61),
    ("AS", 17775, 10500, 3995, 27.56, 3119, 17.55),
    ("B6", 19580, 13607, 5565, 29.03, 334, 1.71),
    ("DL", 74384, 59792, 13930, 18.9, 478, 0.64),
    ("F9", 14379, 10231, 3814, 27.16, 311, 2.16),
    ("G4", 8596, 6497, 1869, 22.34, 193, 2.25),
    ("HA", 6576, 4737, 1738, 26.84, 96, 1.46),
    ("MQ", 20750, 14267, 5473, 27.73, 932, 4.49),
    ("NK", 20415, 14807, 5274, 26.26, 303, 1.48),
    ("OH", 16526, 11615, 3924, 25.25, 944, 5.71),
    ("OO", 56814, 41124, 13082, 24.13, 2384, 4.2),
    ("UA", 58855, 42344, 11659, 21.59, 4714, 8.01),
    ("WN", 115389, 85303, 26310, 23.57, 3566, 3.09),
    ("YX", 22914, 18091, 3714, 17.03, 1061, 4.63),
]
CAUSES = [(2024, 1, 9538664, 3111412, 979360, 1709694, 22616, 3715582)]


@pytest.fixture
def airline(spark):
    return spark.createDataFrame(
        AIRLINES,
        "Reporting_Airline string, Total_Flights long, OnTime_Flights long, Delayed_Flights long, "
        "Delay_Rate_Pct double, Cancelled_Flights long, Cancellation_Rate_Pct double",
    ).withColumns({"Year": F.lit(2024), "Airline_Name": F.col("Reporting_Airline"),
                   "Avg_Dep_Delay_Min": F.lit(0.0), "Avg_Arr_Delay_Min": F.lit(0.0)})


@pytest.fixture
def calendar(spark):
    return spark.createDataFrame(
        CALENDAR,
        "Year int, Month int, Day_Of_Week int, Total_Flights long, Delayed_Flights long, Cancelled_Flights long, "
        "Delay_Rate_Pct double, Avg_Arr_Delay_Min double",
    )


def test_kpi_cards(airline):
    row = serving.kpi_cards(airline).first()
    assert row["Total_Flights"] == 547271 and row["Delayed_Flights"] == 126410 and row["Total_Cancelled"] == 20389
    assert round(row["System_Delay_Rate_Pct"], 3) == 24.061
    assert row["OnTime_Reliability_Pct"] == 100 - row["System_Delay_Rate_Pct"]
    assert row["Reliability_Status"] == "On target" and row["Cancellation_Status"] == "Off target"


def test_kpi_cards_of_nothing(airline):
    row = serving.kpi_cards(airline.where("false")).first()
    assert row["Total_Flights"] == 0 and row["System_Delay_Rate_Pct"] == 0.0


def test_published_rates_follow_from_counts(airline):
    rates = airline.select(
        F.round(pct("Delayed_Flights", F.col("Delayed_Flights") + F.col("OnTime_Flights")), 2).alias("d"),
        F.round(pct("Cancelled_Flights", "Total_Flights"), 2).alias("c"),
        "Delay_Rate_Pct",
        "Cancellation_Rate_Pct",
    )
    assert rates.where("d != Delay_Rate_Pct OR c != Cancellation_Rate_Pct").isEmpty()


def test_airline_ranking(airline):
    ranked = serving.airline_ranking(airline).orderBy("Rank").collect()
    assert [r["Reporting_Airline"] for r in ranked[:5]] == ["AA", "B6", "MQ", "AS", "F9"]
    assert ranked[-1]["Reporting_Airline"] == "YX"


def test_day_of_week_rates(calendar):
    rows = serving.dow_rates(calendar).collect()
    assert [round(r["Scheduled_Delay_Rate_Pct"], 2) for r in rows] == [23.63, 26.88, 18.60, 18.35, 25.69, 24.07, 24.62]
    assert [r["Day_Name"] for r in rows][:2] == ["Monday", "Tuesday"]
    assert "Operated_Delay_Rate_Pct" not in rows[0].asDict()
    assert sum(r["Total_Flights"] for r in rows) == 547271


def test_cause_share(spark):
    causes = spark.createDataFrame(
        CAUSES,
        "Year int, Month int, Total_Delay_Minutes long, Carrier_Delay_Min long, Weather_Delay_Min long, "
        "NAS_Delay_Min long, Security_Delay_Min long, Late_Aircraft_Delay_Min long",
    )
    rows = serving.cause_share(causes.union(causes)).orderBy("Rank").collect()
    assert [(r["Cause"], round(r["Share_Pct"], 2)) for r in rows] == [
        ("Late Aircraft", 38.95),
        ("Carrier", 32.62),
        ("NAS", 17.92),
        ("Weather", 10.27),
        ("Security", 0.24),
    ]
    assert [r["Is_Dominant"] for r in rows] == [True, False, False, False, False]


def test_cancellation_shares(spark):
    reasons = spark.createDataFrame(
        [("A", "Carrier", 7000), ("A", "Carrier", 736), ("B", "Weather", 12085), ("C", "NAS", 568)],
        "Cancellation_Code string, Cancellation_Reason string, Cancelled_Flights long",
    )
    rows = serving.cancel_share(reasons).collect()
    assert [(r["Cancellation_Code"], round(r["Share_Pct"], 2)) for r in rows] == [("B", 59.27), ("A", 37.94), ("C", 2.79)]


def test_yoy_growth_leaves_gaps_open(spark):
    years = spark.createDataFrame([(2020, 100), (2021, 150), (2023, 60), (2021, 50)], "Year int, Total_Flights long")
    rows = ranking.yoy_growth(years).collect()
    assert [(r["Year"], r["Total_Flights"], r["Change"], r["Growth_Pct"]) for r in rows] == [
        (2020, 100, None, None),
        (2021, 200, 100, 100.0),
        (2023, 60, None, None),
    ]


def test_risk_edges(spark):
    p = spark.createDataFrame([(x,) for x in (0.0, 0.28, 0.14994, 0.14996, 0.15, 0.2999, 0.3, 1.0)], "p double")
    rows = p.select(risk_category(F.round("p", 4).cast("float"))).collect()
    assert [r[0] for r in rows] == ["Low", "Medium", "Low", "Medium", "Medium", "Medium", "High", "High"]
    assert spark.range(1).select(probability_pct(F.lit(0.3845))).first()[0] == 38.5


def test_seasons_and_day_names(spark):
    months = spark.range(1, 13).select(season("id"))
    assert [r[0] for r in months.collect()] == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    days = spark.range(0, 9).select(day_name("id"))
    assert [r[0] for r in days.collect()][::8] == [None, None]


def test_top_n_ties_and_having(spark):
    df = spark.createDataFrame([("b", 5, 9), ("a", 5, 9), ("c", 7, 1), ("d", 1, 9)], "k string, v int, n int")
    rows = ranking.top_n(df, "v", "k", 2, "n > 5").collect()
    assert [(r["Rank"], r["k"]) for r in rows] == [(1, "a"), (2, "b")]


def test_repeatable_limit_matches_brute_force(spark):
    random.seed(3)
    rows = [(random.randrange(40), random.choice("abc")) for _ in range(3000)] + [(7, "hot")] * 1500
    df = spark.createDataFrame(rows, "x int, y string")
    hashed = df.withColumn("h", ranking.row_hash(df)).collect()
    for n in (1, 10, 700, 2500, 4500, 9999):
        want = [(r["x"], r["y"]) for r in sorted(hashed, key=lambda r: (r["h"], r["x"], r["y"]))[:n]]
        for parts in (1, 7):
            got = [tuple(r) for r in ranking.repeatable_limit(df.repartition(parts), n).collect()]
            assert sorted(got) == sorted(want), (n, parts)
    keyed = df.withColumn("h", ranking.row_hash(df, ["x"])).collect()
    want = [(r["x"], r["y"]) for r in sorted(keyed, key=lambda r: (r["h"], r["x"], r["y"]))[:900]]
    got = [tuple(r) for r in ranking.repeatable_limit(df.repartition(3), 900, ["x"]).collect()]
    assert sorted(got) == sorted(want)


def test_hash_sample_does_not_depend_on_partitions(spark):
    df = spark.range(20000).select(F.col("id").alias("a"))
    first = ranking.hash_sample(df.repartition(3), 0.15).count()
    assert first == ranking.hash_sample(df.repartition(8), 0.15).count()
    assert 2700 < first < 3300
    assert 2500 < ranking.sample_rows(df, 0.15).count() < 3500
