"""Where the library keeps intermediate data: the shared folder named by the session."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_kept: list[tuple] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a folder in the session's warehouse.

    Executors must reach it. A warehouse on the driver's own disk will do only where all run on that machine, so on a
    cluster it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master) and hadoop_fs(spark, warehouse)[0].getScheme() == "file":
        raise ValueError(f"spark.checkpoint.dir is unset and the warehouse {warehouse} is a folder of one machine: name a shared one")
    return f"{warehouse}/_intermediate"


def visible_to_workers(spark: SparkSession) -> None:
    """Lets Python workers import the library from the folder the driver has it from.

    Enough where that folder exists on all machines; otherwise ship the package with ``--py-files``.
    """
    here = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [here, env.get("PYTHONPATH")]))


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder URI under the shared folder; nothing is ever reused or overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_fs(spark: SparkSession, path: str):
    """The file system of a URI and the Hadoop path object, for listing, renaming and deleting."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def kept_dir(spark: SparkSession, name: str) -> str:
    """A new folder for a result that a returned DataFrame still reads; deleted when the program ends."""
    path = fresh_dir(spark, name)
    _kept.append(hadoop_fs(spark, path))
    return path


@atexit.register
def _delete_kept() -> None:
    while _kept:
        fs, jpath = _kept.pop()
        with contextlib.suppress(Exception):  # the JVM may be gone already
            fs.delete(jpath, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder for data that only the block needs, such as a copy of the fact; deleted afterwards.

    Whatever leaves the block must no longer read it: ``cut`` the (small) result first.
    """
    path = fresh_dir(spark, name)
    try:
        yield path
    finally:
        fs, jpath = hadoop_fs(spark, path)
        fs.delete(jpath, True)


#: While the library writes: the largest generated method (HotSpot leaves one of more than 8,000 bytes to the interpreter;
#: Spark then splits it), the folders for which a task holds a file open (for more it sorts its rows by folder), and that
#: shuffle files go with the write that needed them, not when the driver happens to collect garbage.
WRITING = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

#: Where tasks read whole texts: rows that the Parquet reader holds, and that go to a Python worker, at once. At the
#: usual 4,096 and 10,000 a task holds some tens of MB of texts several times, beside the heap.
TEXTS = {"spark.sql.parquet.columnarReaderBatchSize": "1024", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """``wanted`` settings of the session inside the block; one that the session has itself stays."""
    added = [key for key in wanted if spark.conf.get(key, None) is None]
    for key in added:
        spark.conf.set(key, wanted[key])
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def writing(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Settings of the session for a write of wide rows or into folders."""
    return settings(spark, WRITING)


def cut(df: DataFrame, partition_by: str | None = None, path: str | None = None) -> DataFrame:
    """Materialise a result that several queries read, as a Parquet table (default: in the shared folder).

    Meant for aggregated tables. The files outlive the loss of any executor, so a lost task never
    scans the fact table again, and each reader loads only its columns and its ``partition_by`` part.
    """
    path = path or kept_dir(df.sparkSession, "cut")
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    with writing(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
