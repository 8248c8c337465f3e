"""Publishing tables under their contracts."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from punctual.operators.checks import apply_contract
from punctual.runtime import hadoop_fs
from punctual.schema import CONTRACTS
from punctual.sources.files import conform, read_raw_csv

log = logging.getLogger(__name__)

# Error conditions of a table or path that does not exist.
_ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"}


class PublishError(RuntimeError):
    """The target does not hold the rows that were sent."""


def publish(df: DataFrame | None, table: str, target: str, jdbc: Mapping[str, str] | None = None) -> int | None:
    """Replace a published table by the contract form of ``df`` and return its row count.

    ``target`` is a folder URI (the table is written to ``<target>/<table>``), ``catalog:<database>``,
    or ``jdbc``, then with JDBC options. A re-run gives the same table. None for ``df`` is skipped with a warning.
    Rows are counted while they are written and again in the target.
    """
    if df is None:
        log.warning("no input for %s; skipped", table)
        return None
    spark, sent = df.sparkSession, Observation()
    rows = apply_contract(df, table)
    if target != "jdbc":
        # One sorted file per task; the contract's key order gives readers min/max skipping.
        rows = rows.sortWithinPartitions(*CONTRACTS[table].keys)
    rows = rows.observe(sent, F.count(F.lit(1)).alias("rows"))
    if target == "jdbc":
        rows.write.format("jdbc").options(**{**jdbc, "dbtable": table, "truncate": "true"}).mode("overwrite").save()
        written = spark.read.format("jdbc").options(**{**jdbc, "dbtable": table}).load()
    elif target.startswith("catalog:"):
        database = target.removeprefix("catalog:")
        create_tables(spark, database, [table])
        rows.write.mode("overwrite").insertInto(f"{database}.{table}")
        written = spark.table(f"{database}.{table}")
    else:
        _replace(rows, f"{target.rstrip('/')}/{table}")
        written = spark.read.parquet(f"{target.rstrip('/')}/{table}")
    count, expected = written.count(), sent.get["rows"]
    if count != expected:
        raise PublishError(f"{table}: {expected} rows sent, {count} found")
    log.info("published %s (%d rows)", table, count)
    return count


def _replace(rows: DataFrame, path: str) -> None:
    """Write beside the table, then swap: until the new files are complete the old ones are served."""
    parent, _, name = path.rpartition("/")
    staged, old = f"{parent}/_new_{name}_{uuid.uuid4().hex}", f"{parent}/_old_{name}_{uuid.uuid4().hex}"
    fs, new = hadoop_fs(rows.sparkSession, staged)
    current, last = hadoop_fs(rows.sparkSession, path)[1], hadoop_fs(rows.sparkSession, old)[1]
    try:
        rows.write.parquet(staged)
        if fs.exists(current) and not fs.rename(current, last):
            raise PublishError(f"could not move {path}")
        if not fs.rename(new, current):
            fs.rename(last, current)
            raise PublishError(f"could not move the new files to {path}")
    finally:
        fs.delete(new, True)
    fs.delete(last, True)


def publish_all(tables: Mapping[str, DataFrame | None], target: str, **options) -> dict[str, int | None]:
    """Publish several tables at once: Spark runs their jobs side by side."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        counts = {name: pool.submit(publish, df, name, target, **options) for name, df in tables.items()}
        return {name: count.result() for name, count in counts.items()}


def publish_dir(spark: SparkSession, directory: str, target: str) -> dict[str, int | None]:
    """Publish every ``<table>.csv`` of a directory to the table of that name, replacing it.

    Columns are matched by name and must parse; files that name no contract are skipped with a warning.
    """
    fs, path = hadoop_fs(spark, directory)
    counts: dict[str, int | None] = {}
    for status in sorted(fs.listStatus(path), key=lambda s: s.getPath().getName()):
        name = status.getPath().getName()
        table = name.removesuffix(".csv")
        if not name.endswith(".csv"):
            continue
        if table not in CONTRACTS:
            log.warning("%s names no published table; skipped", name)
            continue
        counts[table] = publish(read_exported(spark, status.getPath().toString(), table), table, target)
    return counts


def read_exported(spark: SparkSession, path: str, table: str) -> DataFrame:
    """An exported CSV with its contract's types."""
    kinds = {f.name: f.dataType.simpleString() for f in CONTRACTS[table].schema}
    raw = read_raw_csv(spark, path)
    missing = [c for c in kinds if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    # The CSV form of an empty text is null; the contract's text columns are never null.
    typed = conform(raw, kinds, mode="strict", derive=False)
    texts = [c for c, kind in CONTRACTS[table].columns.items() if kind == "text"]
    return typed.na.fill("", subset=texts)


def create_tables(spark: SparkSession, database: str = "default", tables: list[str] | None = None) -> list[str]:
    """Create the published tables that do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in tables or list(CONTRACTS):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CONTRACTS[name].schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet")
    return list_tables(spark, database)


def list_tables(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def read_published(spark: SparkSession, table: str, target: str) -> DataFrame | None:
    """A published table, or None with a warning if it was never written."""
    try:
        if target.startswith("catalog:"):
            return spark.table(f"{target.removeprefix('catalog:')}.{table}")
        return spark.read.parquet(f"{target.rstrip('/')}/{table}")
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
        log.warning("%s is not published in %s", table, target)
        return None
