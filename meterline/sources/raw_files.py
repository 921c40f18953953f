"""Raw trip files: CSV, JSON or Parquet in any folder depth, read as text columns.

CSV columns are found by header name. Spark itself matches a given CSV schema by position, so the
header lines are found first, files with the same header are
read together with a schema in that order, and every reader checks its header while it scans.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.trips import with_used_columns
from meterline.sources import journal
from meterline.sources.schemas import RAW_TABLE

FORMATS = ("csv", "json", "parquet")
SOURCE_FILE = "source_file"
_FILE_NOTICE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
_BAD_JSON = "_corrupt_record"
HEADS = 10_000  # files whose first lines the driver reads
_OPEN = 32  # of them at a time
_HEAD_BYTES = 4096  # read at once


def suffix_glob(*formats: str) -> str:
    """A file name pattern that takes a suffix in upper and lower case."""
    patterns = ["".join(f"[{c}{c.upper()}]" for c in name) for name in formats]
    return "*.{" + ",".join(patterns) + "}"


def file_options(*formats: str) -> dict[str, str]:
    return {
        "pathGlobFilter": suffix_glob(*(formats or FORMATS)),
        "recursiveFileLookup": "true",
    }


def literal_path(path: str) -> str:
    """A path whose pattern characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_notices(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path and format of each raw file; the contents are not read."""
    reader = spark.read.format("binaryFile").options(**file_options()).schema(_FILE_NOTICE)
    suffix = F.lower(F.substring_index("path", ".", -1))
    return reader.load(paths).select("path", suffix.alias("format"))


def new_file_stream(spark: SparkSession, path: str, max_bytes: int) -> DataFrame:
    """A stream with one row per file that has not been seen before, oldest first."""
    options = {
        **file_options(),
        "maxBytesPerTrigger": max_bytes,
        # The default leaves out files a week older than the newest one seen, such as a late copy.
        "maxFileAge": "36500d",
    }
    stream = spark.readStream.format("binaryFile").options(**options).schema(_FILE_NOTICE)
    return stream.load(path).select("path")


def csv_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """File and header line: a plain text scan, of which each task keeps one line a file."""
    lines = spark.read.options(**file_options("csv")).text(paths)
    starts = lines.where(F.col("_metadata.file_block_start") == 0)
    named = starts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"))
    # Lines of a split stay in order and only the first split is left, so the first is the header.
    return named.groupBy("path").agg(F.first("header").alias("header"))


def _text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _raw_names() -> list[str]:
    return [field.split()[0] for field in RAW_TABLE.split(",")]


def _header_names(line: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([line.lstrip("﻿")]))]


def _with_source(frame: DataFrame) -> DataFrame:
    return frame.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line as Spark's text reader gives it, or None of an empty file."""
    fs, place = journal.file_system(spark, path)
    stream = fs.open(place)
    try:
        line = spark._jvm.org.apache.hadoop.io.Text()
        read = spark._jvm.org.apache.hadoop.util.LineReader(stream, _HEAD_BYTES).readLine(line)
        return line.toString().removeprefix("\ufeff") if read else None
    finally:
        stream.close()


def _layouts(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str] | None]:
    """The files of each header line; of a single layout no files are listed, as all are meant.

    Up to ``HEADS`` files are opened for their first line, many at a time, and nothing else of them is read. More are
    scanned in tasks, which reads them whole."""
    notices = file_notices(spark, paths).where("format = 'csv'").select("path")
    names = [row.path for row in notices.limit(HEADS + 1).collect()]
    if len(names) > HEADS:
        return _scanned_layouts(spark, paths)
    files: dict[str, list[str] | None] = {}
    with ThreadPoolExecutor(_OPEN) as pool:
        for name, header in zip(names, pool.map(lambda name: _first_line(spark, name), names), strict=True):
            if header is not None:
                files.setdefault(header, []).append(literal_path(name))
    return files if len(files) > 1 else dict.fromkeys(files)


def _scanned_layouts(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str] | None]:
    """The names of files are kept only where there are several layouts, for the readers take them as lists."""
    headers = csv_headers(spark, paths).persist()  # a line a file, read once for both questions
    try:
        found = [row.header for row in headers.select("header").distinct().limit(2).collect()]
        if len(found) < 2:
            return dict.fromkeys(found)
        files: dict[str, list[str] | None] = {}
        for row in headers.toLocalIterator():
            # The metadata column shows a path as a URI, with special characters as %xx.
            files.setdefault(row.header, []).append(literal_path(unquote(row.path)))
        return files
    finally:
        headers.unpersist()


def csv_layouts(spark: SparkSession, paths: str | Sequence[str]) -> list[list[str] | None]:
    """The files of each layout, or None for all files."""
    return [files and sorted(files) for _, files in sorted(_layouts(spark, paths).items())] or [None]


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    frames = []
    for header, files in _layouts(spark, paths).items():
        reader = (
            spark.read.schema(_text_schema(_header_names(header)))
            .option("header", True)
            .option("enforceSchema", False)
        )
        if files is None:
            frames.append(reader.options(**file_options("csv")).csv(paths))
        else:
            frames.append(reader.csv(files))
    if not frames:
        return spark.createDataFrame([], _text_schema([*_raw_names(), SOURCE_FILE]))
    return _together([_with_source(frame) for frame in frames])


def read_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    names = ["VendorID", *_raw_names(), _BAD_JSON]
    reader = spark.read.schema(_text_schema(names)).options(**file_options("json"))
    return _with_source(reader.option("columnNameOfCorruptRecord", _BAD_JSON).json(paths))


def _merged(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """Frames whose files have types that merge, each as text. Where the types of a column differ, the files are
    halved in the order of names, which for dated files finds the change in few steps."""
    try:
        reader = spark.read.options(**file_options("parquet")).option("mergeSchema", True)
        frame = _with_source(reader.parquet(*paths))
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        notices = file_notices(spark, list(paths)).where("format = 'parquet'").select("path")
        files = sorted(literal_path(unquote(row.path)) for row in notices.collect())
        if len(files) < 2:
            raise
        half = len(files) // 2
        return _merged(spark, files[:half]) + _merged(spark, files[half:])
    return [frame.select(*[F.col(name).cast("string").alias(name) for name in frame.columns])]


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return _together(_merged(spark, [paths] if isinstance(paths, str) else paths))


_READERS = {"csv": read_csv, "json": read_json, "parquet": read_parquet}


def _together(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_raw(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All raw files under the paths as text columns, with the file each row came from."""
    present = {row.format for row in file_notices(spark, paths).select("format").distinct().collect()}
    frames = [read(spark, paths) for name, read in _READERS.items() if name in present]
    if not frames:
        return spark.createDataFrame([], _text_schema([*_raw_names(), SOURCE_FILE]))
    return with_used_columns(_together(frames))
