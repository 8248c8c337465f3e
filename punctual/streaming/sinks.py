"""Continuous sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from punctual.runtime import hadoop_fs
from punctual.streaming.live import latest_state

EVERY = "10 seconds"
#: Micro-batches of an update-mode sink between two merges.
MERGE_EVERY = 16


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Micro-batches at an interval, or (None) one run over everything available."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def json_sink(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append to JSON files; files and checkpoint together make every event land exactly once."""
    return df.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode(
        "append"
    )


def start_json_sink(df: DataFrame, path: str, checkpoint: str, every: str | None = EVERY) -> StreamingQuery:
    return _triggered(json_sink(df, path, checkpoint), every).start()


def start_serving_sink(
    df: DataFrame,
    target: str,
    checkpoint: str,
    table: str = "flights_processed",
    every: str | None = EVERY,
    mode: str = "append",
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """A stream into ``<target>/<table>``, without ever doubling a batch that is replayed after a failure.

    ``append`` writes one folder through Spark's file sink, whose log there names the files that count. ``update`` is
    for windows that change: each micro-batch becomes the partition ``batch_id=<n>``, and every ``merge_every``
    batches the partitions before it are merged into one that has the last row of each window (``latest_state``), so
    their number stays below ``merge_every`` + 2.
    """
    root = f"{target.rstrip('/')}/{table}"
    if mode == "append":
        sink = df.writeStream.format("parquet").option("path", root).option("checkpointLocation", checkpoint)
        return _triggered(sink.outputMode("append"), every).start()

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batches(batch.sparkSession, root, batch_id, merge_every)
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    return _triggered(writer, every).start()


def merge_batches(spark: SparkSession, root: str, batch_id: int, merge_every: int) -> None:
    """Merges the partitions of batches before ``batch_id``, which are all committed, into the last of them.

    The merged rows stand complete beside the partitions before any of these goes; a run that was stopped in between
    goes on from there.
    """
    fs, folder = hadoop_fs(spark, root)
    staged = hadoop_fs(spark, f"{root}/_merged_{batch_id}")[1]
    whole = hadoop_fs(spark, f"{root}/_merged_{batch_id}/_SUCCESS")[1]
    if not fs.exists(folder):
        return
    found = {s.getPath().getName(): s.getPath() for s in fs.listStatus(folder)}
    batches = sorted(int(n.removeprefix("batch_id=")) for n in found if n.startswith("batch_id="))
    before = [b for b in batches if b < batch_id]
    if not fs.exists(whole):
        if len(before) < merge_every:
            return
        state = latest_state(spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={b}" for b in before]))
        state.coalesce(1).write.mode("overwrite").parquet(staged.toString())
    for b in before:
        fs.delete(found[f"batch_id={b}"], True)
    fs.delete(hadoop_fs(spark, f"{staged.toString()}/_SUCCESS")[1], False)
    fs.rename(staged, hadoop_fs(spark, f"{root}/batch_id={batch_id - 1}")[1])
