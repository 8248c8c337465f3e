"""Decoding and enriching events; the same functions serve batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from punctual.functions.flight import clock_label, delay_flag, delay_status, flight_id
from punctual.functions.numeric import clamp_min
from punctual.schema import CLICK_EVENT_SCHEMA

def kafka_source(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, **options: str
) -> DataFrame:
    """A topic from its earliest offsets. Needs the Kafka connector package on the session's class path.

    ``max_offsets`` bounds one micro-batch, where catching up on a long topic should go in small steps.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load()


_BROKEN = "_broken"


def _decode(df: DataFrame, schema: StructType, col: str) -> DataFrame:
    """``_text`` and ``_data``; a field of the latter holds the text of a message that does not fit the schema."""
    text = F.col(col).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    whole = StructType([*schema.fields, StructField(_BROKEN, StringType())])
    return df.withColumns({"_text": text, "_data": F.from_json(text, whole, options)})


def _is_reject(schema: StructType, time: str | None = None) -> Column:
    """No text, malformed JSON, JSON of another shape, a field of another type, or no readable time.

    A proper message whose known fields are all absent is none.
    """
    reject = F.col("_text").isNull() | F.col("_data").isNull() | F.col(f"_data.{_BROKEN}").isNotNull()
    return reject | F.col(f"_data.`{time}`").try_cast("timestamp").isNull() if time else reject


def _fields(schema: StructType) -> list[Column]:
    return [F.col(f"_data.`{f}`").alias(f) for f in schema.fieldNames()]


def parse_events(
    df: DataFrame, schema: StructType = CLICK_EVENT_SCHEMA, col: str = "value", keep_rejects: bool = True
) -> DataFrame:
    """Binary or text JSON to typed columns. A rejected message is a row of what could be read, or left out."""
    decoded = _decode(df, schema, col)
    if not keep_rejects:
        decoded = decoded.where(~_is_reject(schema))
    return decoded.select(*_fields(schema))


def split_rejects(
    df: DataFrame, schema: StructType = CLICK_EVENT_SCHEMA, col: str = "value", time: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(typed events, texts of the messages that could not be decoded).

    With ``time``, the field that windows go by, messages without a readable time are rejects too.
    """
    decoded, reject = _decode(df, schema, col), _is_reject(schema, time)
    return decoded.where(~reject).select(*_fields(schema)), decoded.where(reject).select(F.col("_text").alias("text"))


def with_event_time(df: DataFrame, col: str = "event_timestamp") -> DataFrame:
    """ISO text (with or without Z), or a time without zone, to a timestamp; other text becomes null."""
    return df.withColumn(col, F.col(col).try_cast("timestamp"))


def enrich_events(df: DataFrame) -> DataFrame:
    """Raw delays to the published event columns: clamped minutes, late flag, status, ids and labels.

    Reads ``dep_delay`` / ``arr_delay`` (signed minutes) and, where present, ``flight_number`` and
    ``crs_dep_minute``.
    """
    added = {
        "dep_delay_minutes": clamp_min("dep_delay"),
        "arr_delay_minutes": clamp_min("arr_delay"),
        "arr_del15": delay_flag("arr_delay"),
        "status": delay_status("arr_delay"),
    }
    added = {name: e for name, e in added.items() if name != "dep_delay_minutes" or "dep_delay" in df.columns}
    if "flight_number" in df.columns:
        added["flight_id"] = flight_id("reporting_airline", "flight_number")
    if "crs_dep_minute" in df.columns:
        added["crs_dep_time"] = clock_label("crs_dep_hour", "crs_dep_minute")
    return with_event_time(df.withColumns(added))


def to_payload(df: DataFrame, *columns: str) -> DataFrame:
    """The columns as a JSON message in a binary ``value`` column, as a topic delivers it."""
    return df.select(F.to_json(F.struct(*columns)).cast("binary").alias("value"))
