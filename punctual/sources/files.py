"""Scans and sinks over files. Every path is a URI of any file system the session can reach."""

from __future__ import annotations

import csv
import logging
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from punctual.functions.flight import dep_hour, route
from punctual.runtime import cut, hadoop_fs, scratch, settings, writing
from punctual.schema import FLIGHT_COLUMNS

log = logging.getLogger(__name__)


class HeaderError(ValueError):
    """Raw files whose headers differ, where they must not."""


def _first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, header): the first line of every raw file that has one, found by the tasks that read the files.

    Only lines that may be first ones leave the JVM: all of a file that can follow another one in a task, one of a larger
    file. A pass over the bytes without parsing them.
    """
    try:
        lines = spark.read.text(paths)
    except AnalysisException as error:
        raise FileNotFoundError(f"no raw files in {paths}") from error
    conf = spark._jsparkSession.sessionState().conf()
    whole = int(conf.filesMaxPartitionBytes()) - int(conf.filesOpenCostInBytes())
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        "value",
        (F.col("_metadata.file_block_start") == 0).alias("begins"),
        (F.col("_metadata.file_size") <= whole).alias("small"),
        (F.monotonically_increasing_id() % (1 << 33) == 0).alias("leads"),
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            kept, files = [], batch.column("file").to_pylist()
            for k, file in enumerate(files):
                if file != last:
                    kept.append(k)
                    last = file
            if kept:
                yield batch.take(pa.array(kept))

    first = lines.where("begins AND (small OR leads)").select("file", "value").mapInArrow(pick, "file string, value string")
    return first.select("file", F.regexp_replace("value", "^\ufeff", "").alias("header"))


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str] | None]:
    """The distinct headers, and their files if there are several (else None: they are all that ``paths`` name)."""
    apart = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()) * 31 // 32
    with settings(spark, {"spark.sql.files.openCostInBytes": str(apart)}):
        first = cut(_first_lines(spark, paths))
    headers = sorted(r["header"] for r in first.select("header").distinct().collect())
    if len(headers) < 2:
        return dict.fromkeys(headers)
    grouped = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return {r["header"]: [_literal(f) for f in r["files"]] for r in grouped.orderBy("header").collect()}


def _literal(uri: str) -> str:
    """A file's URI as a path that no reader takes for a pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(uri))


def header_names(header: str) -> list[str]:
    """Column names of a header line; an empty one is named by its place, as is a repeated one."""
    names = next(csv.reader([header]), [])
    folded = Counter(n.lower() for n in names)
    return [f"_c{k}" if not n else f"{n}{k}" if folded[n.lower()] > 1 else n for k, n in enumerate(names)]


#: Columns that ``read_raw_csv(..., audit=True)`` adds: the file, and the line of a row with a wrong number of fields.
FILE, LINE = "_file", "_line"


def read_raw_csv(spark: SparkSession, path: str | list[str], headers: str = "any", audit: bool = False) -> DataFrame:
    """Header CSVs by path or glob, every column as text; types are not guessed.

    Columns go by name in every file: files with the same header are read together, then the groups are united, a
    column that some lack being null there. ``headers="same"`` raises a HeaderError where headers differ. ``audit`` adds
    the file of each row (FILE) and the whole line where it has too few or too many fields (LINE, else null).
    """
    if headers not in ("any", "same"):
        raise ValueError("headers must be 'any' or 'same'")
    paths = [path] if isinstance(path, str) else list(path)
    groups = _headers(spark, paths)
    if headers == "same" and len(groups) > 1:
        raise HeaderError(f"{len(groups)} different headers, such as {[files[0] for files in groups.values()][:3]}")
    if not groups:  # only empty files
        return spark.createDataFrame([], f"{FILE} string, {LINE} string" if audit else "")
    parts = []
    for header, found in groups.items():
        fields = [StructField(n, StringType()) for n in header_names(header)]
        reader = spark.read.option("header", True)
        if audit:
            fields.append(StructField(LINE, StringType()))
            reader = reader.option("columnNameOfCorruptRecord", LINE)
        part = reader.schema(StructType(fields)).csv(found or paths)
        parts.append(part.withColumn(FILE, F.col("_metadata.file_path")) if audit else part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


#: What a text may be read as, in the order of preference: type, pattern, and whether the pattern alone decides.
KINDS = (
    ("int", r"^[+-]?\d+$"),
    ("bigint", r"^[+-]?\d+$"),
    ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"),
    ("date", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("timestamp", r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?$"),
    ("boolean", r"^(?i:true|false)$"),
)


def _readable(name: str) -> Column:
    """A bit for each of KINDS that a text can be read as; null for a null or blank one, which fits any."""
    value = F.trim(F.col(f"`{name}`"))
    bits = [F.when(value.rlike(p) & value.try_cast(kind).isNotNull(), 1 << k).otherwise(0) for k, (kind, p) in enumerate(KINDS)]
    return F.when(value != "", reduce(lambda a, b: a + b, bits))


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header CSVs with guessed types, columns by name in every file; the data are read once.

    A column gets the first of KINDS that all of its texts can be read as, else it stays text; one without any stays
    text too. The kinds of a column merge by a bitwise and: every task folds its rows while it writes them to the
    shared folder, from where the result is read.
    """
    raw = read_raw_csv(spark, path)
    if not raw.columns:
        return raw
    seen = Observation()
    written = cut(raw.observe(seen, *[F.bit_and(_readable(c)).alias(f"k{i}") for i, c in enumerate(raw.columns)]))
    found = seen.get
    typed = []
    for i, c in enumerate(written.columns):
        mask = found[f"k{i}"] or 0
        kind = next((kind for k, (kind, _) in enumerate(KINDS) if mask >> k & 1), None)
        value = F.col(f"`{c}`")
        typed.append((F.trim(value).try_cast(kind) if kind else value).alias(c))
    return written.select(*typed)


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def rows_to_table(spark: SparkSession, rows: list, columns) -> DataFrame:
    return spark.createDataFrame(rows, columns)


def _parse(value: Column, kind: str) -> Column:
    parsed = value.try_cast(kind)
    if kind == "int":
        # "12.00" counts as 12, which a strict text-to-int cast refuses.
        parsed = F.coalesce(parsed, F.regexp_extract(F.trim(value), r"^([+-]?\d+)\.\d*$", 1).try_cast("int"))
    return parsed


def _cells(df: DataFrame, columns: Mapping[str, str], mode: str) -> list[Column]:
    """The known columns by name with their types."""
    present, selected = set(df.columns), []
    for name, kind in columns.items():
        if name not in present:
            log.warning("column %s is absent; filled with null", name)
            value = F.lit(None).cast(kind)
        else:
            value = F.col(f"`{name}`")
            value = _parse(value.cast("string"), kind) if mode == "permissive" else value.cast(kind)
        selected.append(value.alias(name))
    return selected


def conform(
    df: DataFrame,
    columns: Mapping[str, str] = FLIGHT_COLUMNS,
    mode: str = "permissive",
    derive: bool = True,
) -> DataFrame:
    """Select the known columns by name with their types, and drop everything else.

    A known column that is absent becomes a typed null with a warning. ``permissive`` turns text
    that does not parse into null, ``strict`` lets it fail the job. ``derive`` adds Dep_Hour, Route.
    """
    if mode not in ("permissive", "strict"):
        raise ValueError("mode must be 'permissive' or 'strict'")
    out = df.select(*_cells(df, columns, mode))
    if derive:
        out = out.withColumns({"Dep_Hour": dep_hour("CRSDepTime"), "Route": route("Origin", "Dest")})
    return out


#: Names of the columns whose text did not parse.
LOST = "_lost"


def conform_audited(df: DataFrame, columns: Mapping[str, str] = FLIGHT_COLUMNS) -> DataFrame:
    """``conform`` of what ``read_raw_csv(..., audit=True)`` gives, with FILE, LINE and LOST.

    LOST lists the columns of a row whose text is neither blank nor of their type: they are null.
    """
    cells = _cells(df, columns, "permissive")
    present = [(n, kind) for n, kind in columns.items() if n in df.columns and kind != "string"]
    lost = [F.when((F.trim(F.col(f"`{n}`")) != "") & _parse(F.col(f"`{n}`"), kind).isNull(), n) for n, kind in present]
    return df.select(*cells, FILE, LINE, F.array_compact(F.array(F.lit(None).cast("string"), *lost)).alias(LOST))


def load_raw(
    spark: SparkSession,
    raw: str | list[str],
    cleaned: str,
    rejects: str,
    columns: Mapping[str, str] = FLIGHT_COLUMNS,
    files_per_year: int | None = None,
) -> DataFrame:
    """Raw CSV into the cleaned fact, rows with a wrong number of fields into ``rejects`` (file, line); what was lost.

    Returns per file (``file``) one row for the whole, with ``rows_in`` = ``rows_out`` + ``rejected``, and ``lost``, a
    map from column to the number of its texts that did not parse. The raw files are parsed once: rows, lines and lost
    columns are written together, everything else follows from there.
    """
    with scratch(spark, "audited") as work:
        rows = conform_audited(read_raw_csv(spark, raw, audit=True), columns)
        rows = cut(rows.withColumn("_kept", F.col(LINE).isNull()), "_kept", work)
        good = rows.where("_kept").drop("_kept", FILE, LINE, LOST)
        write_flights(good.withColumns({"Dep_Hour": dep_hour("CRSDepTime"), "Route": route("Origin", "Dest")}), cleaned, files_per_year=files_per_year)
        rows.where("NOT _kept").select(F.col(FILE).alias("file"), F.col(LINE).alias("line")).write.mode("overwrite").parquet(rejects)
        counted = rows.groupBy(F.col(FILE).alias("file")).agg(
            F.count("*").alias("rows_in"), F.count_if("_kept").alias("rows_out"), F.count_if(~F.col("_kept")).alias("rejected")
        )
        # values of kept rows alone: a rejected line is kept whole
        cells = rows.where("_kept").select(F.col(FILE).alias("file"), F.explode(LOST).alias("name"))
        cells = cells.groupBy("file", "name").agg(F.count("*").alias("n")).groupBy("file")
        lost = cells.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "n")))).alias("lost"))
        return cut(counted.join(lost, "file", "left"))


def write_flights(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    files_per_year: int | None = None,
    sort: tuple[str, ...] = (),
) -> int:
    """Parquet in directories ``Year=...``; returns the number of rows, counted during the write.

    ``overwrite`` replaces the dataset, ``replace_years`` only the years present in ``df``. Without
    ``files_per_year`` there is no shuffle: each input task writes its own years. With it, each
    year is spread evenly over that many tasks, which compacts an input of many small files.
    ``sort`` orders rows inside files for row-group skipping.
    """
    if files_per_year:
        # Row and input partition: copies of one row spread out too, and a retried task repeats itself.
        spread = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(files_per_year))
        df = df.withColumn("_spread", spread).repartition("Year", "_spread").drop("_spread")
    if sort:
        df = df.sortWithinPartitions("Year", *sort)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy("Year")
    if mode == "replace_years":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = writer.mode(mode)
    with writing(df.sparkSession):
        writer.parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str = "none") -> None:
    """A directory of CSV files, written in parallel; a ``compression`` such as ``gzip`` is undone by every reader."""
    with writing(df.sparkSession):
        df.write.mode("overwrite").option("header", header).option("compression", compression).csv(path)


#: Rows that one named CSV may have.
EXPORT_ROWS = 5_000_000


def export_csv(
    df: DataFrame, directory: str, name: str, keys: tuple[str, ...] = (), most_rows: int | None = EXPORT_ROWS
) -> tuple[str, int]:
    """One CSV file ``<directory>/<name>.csv`` with a header; returns its path and row count.

    For summary tables: the rows pass through one writer task, after the aggregation has run on
    all of them. More than ``most_rows`` are refused (write_csv has no such bound) before the target changes.
    """
    spark, seen = df.sparkSession, Observation()
    target, staging = f"{directory.rstrip('/')}/{name}.csv", f"{directory.rstrip('/')}/_writing_{name}"
    if most_rows is not None:
        # stops as soon as enough rows are seen, and sends one task no more than the bound
        if df.limit(most_rows + 1).count() > most_rows:
            raise ValueError(f"{name} has more than {most_rows} rows; write_csv writes them in parallel")
    one = df.repartition(1)
    if keys:
        one = one.sortWithinPartitions(*keys)
    one.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(staging)
    fs, staged = hadoop_fs(spark, staging)
    _, final = hadoop_fs(spark, target)
    part = next(s.getPath() for s in fs.listStatus(staged) if s.getPath().getName().startswith("part-"))
    fs.delete(final, False)
    if not fs.rename(part, final):
        raise OSError(f"could not move the written file to {target}")
    fs.delete(staged, True)
    rows = seen.get["rows"]
    log.info("exported %s (%d rows)", target, rows)
    return target, rows
