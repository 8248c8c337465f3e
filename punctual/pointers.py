"""Small numbered files that say what a folder consists of: written once, whole or ignored, never replaced."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from punctual.runtime import hadoop_fs


def _path(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/{number:012d}.json"


def write_pointer(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Write the file of a number; False if there is one."""
    fs, path = hadoop_fs(spark, _path(folder, number))
    try:
        out = fs.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    try:
        out.write(bytearray(json.dumps({**content, "complete": True}).encode()))
    finally:
        out.close()
    return True


def pointer_numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers in use, whole files or not, ascending."""
    fs, path = hadoop_fs(spark, folder)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName().removesuffix(".json") for s in fs.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def read_pointer(spark: SparkSession, folder: str, number: int) -> dict | None:
    """What the file of a number says, or None if it is not whole."""
    fs, path = hadoop_fs(spark, _path(folder, number))
    stream = fs.open(path)
    try:
        raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    try:
        found = json.loads(bytes(raw).decode())
    except ValueError:
        return None
    return found if isinstance(found, dict) and found.get("complete") else None


def newest_pointer(spark: SparkSession, folder: str, upto: int | None = None) -> tuple[int, dict] | None:
    """The newest whole file (of a number up to ``upto``) and its number."""
    for number in reversed([n for n in pointer_numbers(spark, folder) if upto is None or n <= upto]):
        found = read_pointer(spark, folder, number)
        if found is not None:
            return number, found
    return None


def delete_pointer(spark: SparkSession, folder: str, number: int) -> None:
    fs, path = hadoop_fs(spark, _path(folder, number))
    fs.delete(path, False)
