"""Windows of a stream whose every event is accounted for: in a window, among the rejects, or among the late ones.

    <root>/data/<batch>-<id>/day=.../   sums per window of one micro-batch, or of several merged
    <root>/late/batch_id=<batch>/       events that came behind the watermark
    <root>/manifests/<batch>.json       which folders count, per day, and the newest event time; written last

Sums of a batch count from the moment its manifest is whole, and a batch that has one is not done again: a replay after
a failure neither doubles nor loses an event. Nothing is renamed.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from punctual.functions.numeric import pct
from punctual.pointers import delete_pointer, newest_pointer, pointer_numbers, read_pointer, write_pointer
from punctual.runtime import cut, hadoop_fs, scratch
from punctual.streaming.sinks import EVERY, _triggered

#: Folders of one day beyond which the day is merged.
MERGE_AT = 8


def start_accounted_windows(
    df: DataFrame,
    root: str,
    checkpoint: str,
    window: str = "1 minute",
    delay_seconds: int = 600,
    every: str | None = EVERY,
    merge_at: int = MERGE_AT,
) -> StreamingQuery:
    """Events (with ``event_timestamp`` and ``arr_del15``) into windows under ``root``; ``read_windows`` reads them.

    An event is late if its window ended ``delay_seconds`` or more before the newest event of the batches before its own
    (the rule of a watermark). Late events are written whole to ``late``. A row without a time is in no window and must
    be taken out before, with ``split_rejects(..., time=...)``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, root, batch_id, window, delay_seconds, merge_at)

    return _triggered(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), every).start()


def add_batch(batch: DataFrame, root: str, batch_id: int, window: str, delay_seconds: int, merge_at: int = MERGE_AT) -> None:
    """One micro-batch into the windows, unless it is there already. Reads the batch once, and no day it does not touch."""
    spark, root = batch.sparkSession, root.rstrip("/")
    number, before = newest_pointer(spark, f"{root}/manifests") or (-1, {"days": {}, "newest": None})
    if number >= batch_id:
        return
    days, newest = {d: list(f) for d, f in before["days"].items()}, before["newest"]
    with scratch(spark, "batch") as work:
        at = F.window("event_timestamp", window)
        rows = cut(batch.withColumns({"window_start": at["start"], "window_end": at["end"]}), path=work)
        late = F.lit(False)
        if newest is not None:
            late = F.unix_micros("window_end") <= newest - delay_seconds * 1_000_000
        rows.where(late).write.mode("overwrite").parquet(f"{root}/late/batch_id={batch_id}")
        sums = rows.where(~late).groupBy("window_start", "window_end").agg(
            F.count("*").alias("events"), F.count_if(F.col("arr_del15") == 1).alias("active_delays")
        )
        for day, folder in _written(sums, f"{root}/data/{batch_id:012d}-{uuid.uuid4().hex}").items():
            days.setdefault(day, []).append(folder)
        last = rows.agg(F.max(F.unix_micros("event_timestamp"))).first()[0]
    full = {day: folders for day, folders in days.items() if len(folders) >= merge_at}
    if full:
        merged = _summed(_read(spark, root, [f for folders in full.values() for f in folders]))
        days |= {d: [f] for d, f in _written(merged, f"{root}/data/{batch_id:012d}-{uuid.uuid4().hex}", len(full)).items()}
    newest = max((x for x in (newest, last) if x is not None), default=None)
    content = {"days": days, "newest": newest}
    if not write_pointer(spark, f"{root}/manifests", batch_id, content):  # the rest of a run that stopped while writing it
        delete_pointer(spark, f"{root}/manifests", batch_id)
        write_pointer(spark, f"{root}/manifests", batch_id, content)
    _tidy(spark, root)


def _written(sums: DataFrame, path: str, tasks: int | None = None) -> dict[str, str]:
    """Sums written by day; the folder of each day, relative to the root."""
    sums = sums.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    (sums.repartition(tasks, "day") if tasks else sums.coalesce(8)).write.partitionBy("day").parquet(path)
    fs, folder = hadoop_fs(sums.sparkSession, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return {n.removeprefix("day="): f"data/{path.rsplit('/', 1)[1]}/{n}" for n in names}


def _read(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    schema = "window_start timestamp, window_end timestamp, events long, active_delays long"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "window_end").agg(F.sum("events").alias("events"), F.sum("active_delays").alias("active_delays"))


def _tidy(spark: SparkSession, root: str) -> None:
    """Keeps the two newest manifests, and deletes the folders of older batches that neither names."""
    whole = [n for n in pointer_numbers(spark, f"{root}/manifests")]
    for number in whole[:-2]:
        delete_pointer(spark, f"{root}/manifests", number)
    kept = [read_pointer(spark, f"{root}/manifests", n) for n in whole[-2:]]
    if len(kept) < 2 or None in kept:
        return
    used = {f for m in kept for folders in m["days"].values() for f in folders}
    fs, folder = hadoop_fs(spark, f"{root}/data")
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if int(name.split("-")[0]) < whole[-1]:
            days = [s.getPath() for s in fs.listStatus(status.getPath()) if s.isDirectory()]
            gone = [d for d in days if f"data/{name}/{d.getName()}" not in used]
            for day in gone:
                fs.delete(day, True)
            if len(gone) == len(days):
                fs.delete(status.getPath(), True)


def read_windows(spark: SparkSession, root: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The windows as of the newest whole manifest: start, end, events, active_delays and delay_rate_pct.

    Only the folders of the days asked for (inclusive, ``yyyy-MM-dd`` of the window's start) are read.
    """
    root = root.rstrip("/")
    found = newest_pointer(spark, f"{root}/manifests")
    days = found[1]["days"] if found else {}
    folders = [f for day, some in sorted(days.items()) if (first_day or day) <= day <= (last_day or day) for f in some]
    return _summed(_read(spark, root, folders)).withColumn("delay_rate_pct", pct("active_delays", "events"))


def read_late(spark: SparkSession, root: str) -> DataFrame | None:
    """Late events of the batches that count, with their ``batch_id``; None before the first batch."""
    root = root.rstrip("/")
    found = newest_pointer(spark, f"{root}/manifests")
    return spark.read.parquet(f"{root}/late").where(F.col("batch_id") <= found[0]) if found else None


def newest_event(spark: SparkSession, root: str) -> datetime | None:
    found = newest_pointer(spark, f"{root.rstrip('/')}/manifests")
    micros = found[1]["newest"] if found else None
    return None if micros is None else datetime.fromtimestamp(micros / 1e6, timezone.utc)
