from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from punctual.schema import CLICK_EVENT_SCHEMA, FLIGHT_EVENT_SCHEMA, PIPELINE_EVENT_SCHEMA
from punctual.streaming import events, live, sinks

GOOD = ['{"user_id": 1, "action": "click", "ts": "2026-07-08T10:00:00"}', '{"user_id": 2, "action": "view"}']
BAD = ["{broken", "", '{"user_id": "oops", "action": "click"}', "[1]", None]


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("binary").alias("value"))


def test_parse_and_rejects(spark):
    df = messages(spark, GOOD + BAD)
    assert events.parse_events(df).count() == 7
    assert events.parse_events(df, keep_rejects=False).count() == 2
    good, bad = events.split_rejects(df, CLICK_EVENT_SCHEMA)
    assert good.columns == ["user_id", "action", "ts"]
    assert sorted(r["action"] for r in good.collect()) == ["click", "view"]
    assert sorted(str(r["text"]) for r in bad.collect()) == sorted(str(t) for t in BAD)
    proper, none = events.split_rejects(messages(spark, ['{"other": 1}', "{}"]))
    assert proper.count() == 2 and none.isEmpty()
    timed, untimed = events.split_rejects(df, CLICK_EVENT_SCHEMA, time="ts")
    assert (timed.count(), untimed.count()) == (1, 6)


def test_other_layouts(spark):
    pipeline = messages(spark, ['{"user_id": 1, "action": "purchase", "amount": 11, "ts": "2026-01-01T00:00:00"}'])
    assert events.parse_events(pipeline, PIPELINE_EVENT_SCHEMA).first()["amount"] == 11
    flight = messages(
        spark, [json.dumps({"event_timestamp": "2026-01-01T10:00:01Z", "flight_id": "AA1", "arr_del15": 1})]
    )
    row = events.with_event_time(events.parse_events(flight, FLIGHT_EVENT_SCHEMA)).first()
    assert str(row["event_timestamp"]) == "2026-01-01 10:00:01" and row["arr_del15"] == 1


def test_enrich(spark):
    rows = spark.createDataFrame(
        [("2026-01-01T10:00:00Z", "AA", 12, 7, 5, -4, 14), ("never", "DL", 3, 17, 30, 20, 15)],
        "event_timestamp string, reporting_airline string, flight_number int, crs_dep_hour int, crs_dep_minute int, "
        "dep_delay int, arr_delay int",
    )
    first, second = events.enrich_events(rows).collect()
    assert (first["dep_delay_minutes"], first["arr_delay_minutes"], first["arr_del15"]) == (0, 14, 0)
    assert (first["status"], first["flight_id"], first["crs_dep_time"]) == ("On-Time", "AA12", "07:05")
    assert (second["arr_del15"], second["status"], second["event_timestamp"]) == (1, "Delayed", None)


def stamped(spark, rows):
    return spark.createDataFrame(rows, "event_timestamp string, arr_del15 int")


def test_stream_equals_batch_and_drops_only_late_events(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    schema = stamped(spark, []).schema

    def run():
        stream = spark.readStream.schema(schema).json(str(source))
        windows = live.live_metrics(events.with_event_time(stream), "1 minute", "2 minutes")
        sinks.start_serving_sink(
            windows, str(target), str(tmp_path / "check"), "live", every=None, mode="update"
        ).awaitTermination()
        state = live.latest_state(spark.read.parquet(str(target / "live")))
        return {str(r["window_start"]): (r["events"], r["active_delays"], r["delay_rate_pct"]) for r in state.collect()}

    first = [("2026-01-01T10:00:10Z", 1), ("2026-01-01T10:00:50Z", 0), ("2026-01-01T10:01:00Z", 1)]
    stamped(spark, first).coalesce(1).write.mode("append").json(str(source))
    batch = live.live_metrics(events.with_event_time(stamped(spark, first)), "1 minute")
    want = {str(r["window_start"]): (r["events"], r["active_delays"], r["delay_rate_pct"]) for r in batch.collect()}
    assert run() == want == {"2026-01-01 10:00:00": (2, 1, 50.0), "2026-01-01 10:01:00": (1, 1, 100.0)}
    # Within the watermark: counted. An hour later the old window is closed and the straggler is dropped.
    stamped(spark, [("2026-01-01T10:00:59Z", 0), ("2026-01-01T11:30:00Z", 0)]).coalesce(1).write.mode("append").json(
        str(source)
    )
    assert run()["2026-01-01 10:00:00"] == (3, 1, pytest.approx(100 / 3))
    stamped(spark, [("2026-01-01T10:00:01Z", 1)]).coalesce(1).write.mode("append").json(str(source))
    assert run()["2026-01-01 10:00:00"] == (3, 1, pytest.approx(100 / 3))


def test_json_sink_is_exactly_once(spark, tmp_path):
    source, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    for text in GOOD:
        messages(spark, [text]).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("value binary").parquet(str(source))
        sinks.start_json_sink(events.parse_events(stream), str(out), str(check), every=None).awaitTermination()
    rows = spark.read.schema(CLICK_EVENT_SCHEMA).json(str(out)).collect()
    assert sorted(r["user_id"] for r in rows) == [1, 2]


def test_replayed_batch_is_not_doubled(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    spark.range(10).coalesce(1).write.parquet(str(source))
    for attempt in ("a", "b"):  # a lost checkpoint replays batch 0
        stream = spark.readStream.schema("id long").parquet(str(source))
        sinks.start_serving_sink(stream, str(target), str(tmp_path / attempt), every=None).awaitTermination()
    assert spark.read.parquet(str(target / "flights_processed")).count() == 10


def test_folders_stay_few_and_states_right(spark, tmp_path, monkeypatch):
    """A hundred batches of an update-mode sink, the last one written twice as after a failure."""
    root = str(tmp_path / "live")
    for n in range(100):
        sinks.merge_batches(spark, root, n, 8)
        rows = [(n % 7, n), (7 + n, n)] if n < 20 else [(n % 7, n)]
        spark.createDataFrame(rows, "window_start long, events long").coalesce(1).write.mode("overwrite").parquet(f"{root}/batch_id={n}")
        if n == 99:
            sinks.merge_batches(spark, root, n, 8)
        assert len(list((tmp_path / "live").glob("batch_id=*"))) <= 9
    state = {r["window_start"]: r["events"] for r in live.latest_state(spark.read.parquet(root)).collect()}
    want = {n % 7: n for n in range(100)} | {7 + n: n for n in range(20)}
    assert state == want


def test_a_stopped_merge_goes_on(spark, tmp_path):
    root = tmp_path / "live"
    for n in range(4):
        spark.createDataFrame([(n % 2, n)], "window_start long, events long").coalesce(1).write.parquet(f"{root}/batch_id={n}")
    merged = live.latest_state(spark.read.parquet(str(root)))
    merged.coalesce(1).write.parquet(f"{root}/_merged_4")  # complete, but the run ended here, one folder gone
    import shutil

    shutil.rmtree(root / "batch_id=0")
    sinks.merge_batches(spark, str(root), 4, 4)
    assert [p.name for p in root.glob("batch_id=*")] == ["batch_id=3"] and not list(root.glob("_merged*"))
    assert {r["window_start"]: r["events"] for r in live.latest_state(spark.read.parquet(str(root))).collect()} == {0: 2, 1: 3}


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        events.kafka_source(spark, "broker:9092", "flight-events")
