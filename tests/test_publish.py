from __future__ import annotations

import pytest
from flights import CANCELLED, LATE
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from punctual.operators import checks, tables
from punctual.plans.batch import run_batch
from punctual.schema import CONTRACTS
from punctual.sources import files, publish as pub


@pytest.fixture
def fact(make_flights):
    return make_flights({}, LATE, {**CANCELLED, "CancellationCode": "B"}, {**LATE, "Reporting_Airline": "DL"})


def test_contract_types_and_order(fact):
    df = checks.apply_contract(tables.airline_performance(fact), "agg_airline_performance")
    assert df.schema.simpleString() == CONTRACTS["agg_airline_performance"].schema.simpleString()
    assert df.where("Reporting_Airline = 'AA'").first()["Cancellation_Rate_Pct"] == pytest.approx(33.33, abs=1e-4)


def test_contract_fills_measures_but_not_keys(spark):
    df = spark.createDataFrame([(None, None, 3, None, 1.005)], CONTRACTS["agg_hourly_delays"].schema)
    row = checks.apply_contract(df, "agg_hourly_delays").first()
    assert (row["Dep_Hour"], row["Total_Flights"], row["Delay_Probability_Pct"]) == (None, 0, 0.0)


def test_violations(spark):
    rows = [(3, 10, 11, 110.0, 1.0), (3, -1, 0, 5.0, 1.0), (300, 5_000_000_000, 0, -0.5, 1.0), (None, 1, 0, 0.0, 0.0)]
    df = spark.createDataFrame(
        rows,
        "Dep_Hour int, Total_Flights long, Delayed_Flights long, Delay_Probability_Pct double, Avg_Delay_Minutes double",
    )
    found = {(r["Rule"], r["Column"]): r["Violations"] for r in checks.contract_violations(df, "agg_hourly_delays").collect()}
    assert found == {
        ("null_key", "Dep_Hour"): 1,
        ("out_of_range", "Dep_Hour"): 1,
        ("out_of_range", "Total_Flights"): 2,
        ("not_a_percentage", "Delay_Probability_Pct"): 2,
        ("duplicate_key", "Dep_Hour"): 1,
    }


def test_number_that_does_not_fit_is_refused(spark):
    df = spark.createDataFrame([(70000, 1, 1, 0.0, 0.0)], "Dep_Hour int, Total_Flights long, Delayed_Flights long, Delay_Probability_Pct double, Avg_Delay_Minutes double")
    with pytest.raises(PySparkException):
        checks.apply_contract(df, "agg_hourly_delays").collect()


def test_publish_twice_gives_the_same_table(spark, fact, tmp_path, caplog):
    target = str(tmp_path / "serving")
    outputs = tables.all_tables(fact)
    for _ in range(2):
        counts = {name: pub.publish(df, name, target) for name, df in outputs.items()}
    assert counts["agg_airline_performance"] == 2
    assert pub.read_published(spark, "agg_airline_performance", target).count() == 2
    assert pub.publish(None, "agg_route_traffic", target) is None
    assert "no input for agg_route_traffic" in caplog.text
    assert pub.read_published(spark, "agg_nothing", target) is None


def test_export_then_publish_dir(spark, fact, tmp_path, caplog):
    exported, target = str(tmp_path / "csv"), str(tmp_path / "serving")
    for name, df in tables.all_tables(fact).items():
        path, rows = files.export_csv(checks.apply_contract(df, name), exported, name, CONTRACTS[name].keys)
        lines = (tmp_path / "csv" / f"{name}.csv").read_text().splitlines()
        assert path == f"{exported}/{name}.csv" and len(lines) == rows + 1
        assert lines[0] == ",".join(CONTRACTS[name].columns)
    (tmp_path / "csv" / "notes.csv").write_text("a\n1\n")
    first = pub.publish_dir(spark, exported, target)
    assert pub.publish_dir(spark, exported, target) == first
    assert "notes.csv names no published table" in caplog.text
    for name, df in tables.all_tables(fact).items():
        want, got = checks.apply_contract(df, name), pub.read_published(spark, name, target)
        assert sorted(map(str, want.collect())) == sorted(map(str, got.collect())), name


def test_export_of_an_empty_table_has_a_header(make_flights, tmp_path):
    empty = checks.apply_contract(tables.hourly_delays(make_flights()), "agg_hourly_delays")
    path, rows = files.export_csv(empty, str(tmp_path), "agg_hourly_delays")
    assert rows == 0


def test_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "agg_hourly_delays.csv").write_text(
        "Avg_Delay_Minutes,Dep_Hour,Delay_Probability_Pct,Delayed_Flights,Total_Flights\n1.5,7,10.0,1,10\n"
    )
    pub.publish_dir(spark, str(tmp_path), str(tmp_path / "t"))
    row = pub.read_published(spark, "agg_hourly_delays", str(tmp_path / "t")).first()
    assert (row["Dep_Hour"], row["Total_Flights"], row["Avg_Delay_Minutes"]) == (7, 10, 1.5)
    (tmp_path / "agg_hourly_delays.csv").write_text("Dep_Hour\n7\n")
    with pytest.raises(ValueError):
        pub.publish_dir(spark, str(tmp_path), str(tmp_path / "t"))


def test_catalog_tables(spark, fact):
    names = pub.create_tables(spark, "serving_test")
    assert set(names) == set(CONTRACTS) and pub.create_tables(spark, "serving_test") == names
    for _ in range(2):
        pub.publish(tables.hourly_delays(fact), "agg_hourly_delays", "catalog:serving_test")
    assert spark.table("serving_test.agg_hourly_delays").count() == 1
    assert pub.read_published(spark, "agg_hourly_delays", "catalog:serving_test").first()["Total_Flights"] == 4


def test_a_failed_write_leaves_the_old_table(spark, fact, tmp_path):
    target = str(tmp_path / "serving")
    pub.publish(tables.hourly_delays(fact), "agg_hourly_delays", target)
    broken = tables.hourly_delays(fact).withColumn("Total_Flights", F.expr("CAST(raise_error('stop') AS BIGINT)"))
    with pytest.raises(PySparkException):
        pub.publish(broken, "agg_hourly_delays", target)
    assert pub.read_published(spark, "agg_hourly_delays", target).first()["Total_Flights"] == 4
    assert [p.name for p in (tmp_path / "serving").iterdir()] == ["agg_hourly_delays"]


def test_a_batch_with_broken_totals_publishes_nothing(spark, sf_dir, tmp_path, monkeypatch):
    from punctual.plans import batch
    from punctual.plans.demo import COLUMNS, flights

    raw = flights(spark, sf_dir, *[c for c in COLUMNS if c not in ("Dep_Hour", "Route")])
    files.write_csv(raw.select(*[F.col(c).cast("string") for c in raw.columns]), str(tmp_path / "raw"))
    job = [str(tmp_path / x) for x in ("raw", "cleaned", "serving")]
    run_batch(spark, *job, kinds=())
    before = pub.read_published(spark, "agg_hourly_delays", job[2]).collect()
    right = tables.all_tables
    wrong = lambda *a: {n: df.withColumn("Total_Flights", F.col("Total_Flights") + 1) if n == "agg_hourly_delays" else df for n, df in right(*a).items()}
    monkeypatch.setattr(batch.tables, "all_tables", wrong)
    with pytest.raises(batch.BatchError, match="totals apart"):
        run_batch(spark, *job, kinds=())
    assert sorted(map(str, pub.read_published(spark, "agg_hourly_delays", job[2]).collect())) == sorted(map(str, before))


def test_batch(spark, sf_dir, tmp_path):
    from punctual.plans.demo import COLUMNS, flights

    raw = flights(spark, sf_dir, *[c for c in COLUMNS if c not in ("Dep_Hour", "Route")])
    files.write_csv(raw.select(*[F.col(c).cast("string") for c in raw.columns]), str(tmp_path / "raw"))
    result = run_batch(
        spark, str(tmp_path / "raw"), str(tmp_path / "cleaned"), str(tmp_path / "serving"), prediction_limit=50
    )
    assert result.fact_rows == raw.count()
    assert result.reconciled and not result.violations
    assert set(result.published) == set(CONTRACTS)
    assert result.published["ml_delay_predictions"] == 50
    assert 0 <= result.metrics["lr"]["auc_roc"] <= 1
