"""Live metrics per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctual.functions.numeric import pct


def live_metrics(df: DataFrame, window: str = "1 minute", watermark: str | None = "10 minutes") -> DataFrame:
    """Events, active delays and delay rate per tumbling window of ``event_timestamp``.

    A row without a time is in no window: take out such messages first, with ``split_rejects(..., time=...)``, and
    count them there.

    On a stream the watermark bounds how late an event may come and lets closed windows leave the
    state, which then holds a few counters per open window. Counters are summed inside each task first.
    """
    if watermark and df.isStreaming:
        df = df.withWatermark("event_timestamp", watermark)
    windows = df.groupBy(F.window("event_timestamp", window).alias("w")).agg(
        F.count("*").alias("events"), F.count_if(F.col("arr_del15") == 1).alias("active_delays")
    )
    return windows.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "events",
        "active_delays",
        pct("active_delays", "events").alias("delay_rate_pct"),
    )


def latest_state(updates: DataFrame) -> DataFrame:
    """The last published row of every window, from the batches of an update-mode sink.

    The newest row of a window is kept inside each task, so the shuffle has a row per window and task at most.
    """
    rest = [c for c in updates.columns if c not in ("window_start", "batch_id")]
    last = updates.groupBy("window_start").agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return last.select("window_start", *[F.col(f"_row.`{c}`").alias(c) for c in rest])
