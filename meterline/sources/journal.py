"""Small numbered records in a folder: each number is given out once, and the highest one is the present state.

A record is a JSON file of one line. It is created under the next number and creation fails where that number exists,
so of several writers one gets it. Object stores without exclusive creation need a single writer, which the lease of a
lake gives. Records are read by the driver, one at a time, or all of them as a table by Spark.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_DIGITS = 9


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its type."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, place = file_system(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(place)) if fs.exists(place) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of the file system."""
    fs, place = file_system(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(place) or ()]


def changes(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time of a file or folder, and the length of all it holds."""
    fs, place = file_system(spark, path)
    return fs.getFileStatus(place).getModificationTime(), fs.getContentSummary(place).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, place = file_system(spark, path)
    if not fs.rename(place, file_system(spark, to)[1]):
        raise OSError(f"{path} could not be renamed to {to}")


def numbers(spark: SparkSession, folder: str) -> list[int]:
    found = (name.removesuffix(".json") for name in names(spark, folder) if name.endswith(".json"))
    return [int(name) for name in found if name.isdigit()]


def _path(folder: str, number: int) -> str:
    return f"{folder}/{number:0{_DIGITS}d}.json"


def create(spark: SparkSession, path: str, record: dict) -> bool:
    """Write a record; False if the path exists."""
    fs, place = file_system(spark, path)
    try:
        out = fs.create(place, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or fs.exists(place):
            return False
        raise
    try:
        out.write(bytearray(json.dumps(record, sort_keys=True).encode() + b"\n"))
    finally:
        out.close()
    return True


def append(spark: SparkSession, folder: str, record: dict, after: int) -> int | None:
    """Write the record that follows number ``after``; None if another writer has done so, or is doing so.

    Numbers whose writer died before the line was complete are passed over."""
    number = after + 1
    while not create(spark, _path(folder, number), {"number": number, **record}):
        if not abandoned(spark, folder, number):
            return None
        number += 1
    return number


def abandoned(spark: SparkSession, folder: str, number: int, seconds: float = 60) -> bool:
    """Whether a record has had no complete line for some time."""
    fs, place = file_system(spark, _path(folder, number))
    age = time.time() - fs.getFileStatus(place).getModificationTime() / 1000
    return read(spark, folder, number) is None and age > seconds


def read(spark: SparkSession, folder: str, number: int) -> dict | None:
    """A record, or None while it is being written."""
    fs, place = file_system(spark, _path(folder, number))
    stream = fs.open(place)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return json.loads(text) if text.endswith("\n") else None


def newest_first(spark: SparkSession, folder: str) -> Iterator[dict]:
    """Whole records from the highest number down."""
    for number in reversed(numbers(spark, folder)):
        record = read(spark, folder, number)
        if record is not None:
            yield record


def latest(spark: SparkSession, folder: str) -> dict | None:
    return next(newest_first(spark, folder), None)


def table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All records as rows."""
    if not numbers(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{folder}/*.json")
