"""Releases: all tables of a folder change at once, and earlier versions stay readable.

    <target>/data/<version>-<id>/<table>/   the files of one release, never changed
    <target>/releases/<version>.json        what the release consists of, written last

A release is what its small file names. Readers take the newest file that is complete, so they see all old tables or all
new ones; nothing is ever renamed or overwritten, which suits object stores. A run that stops anywhere before the end
leaves the release before it in force, and files that no release names.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from punctual.operators.checks import apply_contract
from punctual.pointers import delete_pointer, newest_pointer, pointer_numbers, read_pointer, write_pointer
from punctual.runtime import hadoop_fs
from punctual.schema import CONTRACTS
from punctual.sources.publish import PublishError

log = logging.getLogger(__name__)


def release(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], target: str, carry: bool = True, contract: bool = True
) -> int:
    """Publish ``tables`` as one new version and return its number (from 1).

    Each table is written in its contract form, counted on the way and again in the target. A table that is None, or
    not given, is carried over from the version before (``carry``), by name, without copying. Two runs at a time write
    to different folders; the one that finds its number taken counts on.
    """
    target = target.rstrip("/")
    given = {name: df for name, df in tables.items() if df is not None}
    folder = f"data/{current_version(spark, target) + 1:08d}-{uuid.uuid4().hex}"
    with ThreadPoolExecutor(max_workers=max(1, len(given))) as pool:
        jobs = {n: pool.submit(_write, df, n, f"{target}/{folder}/{n}", contract) for n, df in given.items()}
        entries = {n: {"path": f"{folder}/{n}", "rows": job.result()} for n, job in jobs.items()}
    while True:
        before = current_version(spark, target)
        known = _entries(spark, target, before) if carry and before else {}
        if _point(spark, target, before + 1, {**known, **entries}):
            log.info("release %d of %s: %s", before + 1, target, sorted(entries))
            return before + 1


def _write(df: DataFrame, name: str, path: str, contract: bool) -> int:
    sent = Observation()
    rows = apply_contract(df, name).sortWithinPartitions(*CONTRACTS[name].keys) if contract else df
    rows.observe(sent, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    count, expected = rows.sparkSession.read.parquet(path).count(), sent.get["rows"]
    if count != expected:
        raise PublishError(f"{name}: {expected} rows sent, {count} found")
    return count


def _point(spark: SparkSession, target: str, version: int, entries: dict) -> bool:
    """Write the file of a version, unless there is one."""
    return write_pointer(spark, f"{target}/releases", version, {"version": version, "tables": entries})


def versions(spark: SparkSession, target: str) -> list[int]:
    """The complete versions, ascending."""
    return [v for v in _numbers(spark, target) if _read(spark, target, v) is not None]


def _numbers(spark: SparkSession, target: str) -> list[int]:
    return pointer_numbers(spark, f"{target.rstrip('/')}/releases")


def _read(spark: SparkSession, target: str, version: int) -> dict | None:
    return read_pointer(spark, f"{target.rstrip('/')}/releases", version)


def current_version(spark: SparkSession, target: str) -> int:
    """The newest number in use, 0 before the first release. A file that is not whole uses its number up."""
    return max(_numbers(spark, target), default=0)


def _entries(spark: SparkSession, target: str, upto: int) -> dict:
    found = newest_pointer(spark, f"{target.rstrip('/')}/releases", upto)
    return found[1]["tables"] if found else {}


def read_release(spark: SparkSession, target: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version (default: the newest complete one), empty before the first release."""
    target = target.rstrip("/")
    if version is not None and _read_or_none(spark, target, version) is None:
        raise PublishError(f"{target} has no release {version}")
    entries = _entries(spark, target, version or current_version(spark, target))
    return {name: spark.read.parquet(f"{target}/{e['path']}") for name, e in entries.items()}


def _read_or_none(spark: SparkSession, target: str, version: int) -> dict | None:
    return _read(spark, target, version) if version in _numbers(spark, target) else None


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Forget all but the newest ``keep`` complete versions, then delete the folders that no version names and that
    were begun before the oldest of them; returns their names. Folders of runs under way are newer and stay."""
    target, complete = target.rstrip("/"), versions(spark, target)
    kept = complete[-max(1, keep) :]
    if not kept:
        return []
    fs, folder = hadoop_fs(spark, f"{target}/data")
    for version in _numbers(spark, target):
        if version < kept[0]:
            delete_pointer(spark, f"{target}/releases", version)
    used = {e["path"].split("/")[1] for v in kept for e in _read(spark, target, v)["tables"].values()}
    gone = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name not in used and int(name.split("-")[0]) < kept[0]:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
