"""Versions of a table's schema, each valid from the batch that brought it, and a table whose batches keep their own types.

The log is a folder of numbered records. A batch whose columns are those of a record of the newest version adds none. Any
other batch adds one with its own schema, the schema of the table from then on, and what changed: columns that were added,
have another type, or are missing. The table's schema only grows: it has every column that any batch had, in the widest
type (int, bigint, double; date, timestamp; else text). Its version goes up when it changes, not for a missing column.

Each batch is stored under the number of its record, so that a folder holds files of one schema. A reader takes each
folder with the types it was written in and casts them to those of the newest version, which Parquet readers do not do
by themselves for bigint to double or number to text. Columns that a batch lacks are null. Integers beyond 2^53 lose
digits once their column is a double.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.sources import journal
from meterline.sources.catalog import schema_changes, united
from meterline.sources.layers import INGEST_BATCH, if_present

WRITTEN_AS = "schema_record"
_CHANGE = "column_name STRING, change STRING, known_type STRING, found_type STRING"
_RECORD = f"number BIGINT, version BIGINT, batch STRING, schema STRING, found STRING, changes ARRAY<STRUCT<{_CHANGE}>>"


class SchemaLost(RuntimeError):
    """Another writer has added a version in the meantime."""


def _log(root: str) -> str:
    return f"{root}/schema-log"


def _data(root: str) -> str:
    return f"{root}/data"


def _plain(schema: T.StructType) -> T.StructType:
    """Names and types; whether a column may be null is no change."""
    return T.StructType([T.StructField(field.name, field.dataType) for field in schema])


def _spelled(found: T.StructType, known: T.StructType) -> T.StructType:
    """Columns that differ from known ones in capitals only have the known spelling, as Spark resolves names."""
    names = {field.name.lower(): field.name for field in known}
    return T.StructType([T.StructField(names.get(f.name.lower(), f.name), f.dataType) for f in _plain(found)])


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def latest(spark: SparkSession, root: str) -> tuple[int, T.StructType] | None:
    """Version and schema of the table; None before the first batch."""
    record = journal.latest(spark, _log(root))
    return record and (record["version"], _schema(record["schema"]))


def register(spark: SparkSession, root: str, found: T.StructType, batch: str) -> int:
    """Note the schema of a batch, before its rows are written, and return the number of its record."""
    before = journal.latest(spark, _log(root))
    known = _schema(before["schema"]) if before else T.StructType()
    found = _spelled(found, known)
    for record in journal.newest_first(spark, _log(root)):
        if record["version"] != before["version"]:
            break
        if record["found"] == _ddl(found):
            return record["number"]
    table = united([known, found])
    changes = [row.asDict() for row in schema_changes(spark, known, found).collect()] if before else []
    # A column that is narrower than the table's is no change of the table.
    changes = [c for c in changes if c["change"] != "changed" or _type(table, c) != c["known_type"]]
    version = (before["version"] if before else 0) + (not before or _ddl(table) != before["schema"])
    record = {"version": version, "batch": batch, "schema": _ddl(table), "found": _ddl(found), "changes": changes}
    number = journal.append(spark, _log(root), record, before["number"] if before else 0)
    if number is None:
        raise SchemaLost(f"batch {batch}: the schema log of {root} has a newer record")
    return number


def _type(table: T.StructType, change: dict[str, str]) -> str:
    return next(f.dataType.simpleString() for f in table if f.name.lower() == change["column_name"])


def append(spark: SparkSession, root: str, frame: DataFrame, batch: str) -> int:
    """Append a batch with whatever columns it has; a second attempt replaces the first. Returns its record's number."""
    number = register(spark, root, frame.schema, batch)
    known = _schema(journal.read(spark, _log(root), number)["found"])
    spelled = frame.toDF(*[field.name for field in known])
    for path in journal.matching(spark, f"{_data(root)}/{WRITTEN_AS}=*/{INGEST_BATCH}={batch}"):
        if f"/{WRITTEN_AS}={number}/" not in path:  # of an attempt before another version
            journal.delete(spark, path)
    tagged = spelled.withColumns({WRITTEN_AS: F.lit(number), INGEST_BATCH: F.lit(batch)})
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(WRITTEN_AS, INGEST_BATCH).parquet(_data(root))
    return number


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """All batches under the newest version, or those up to a version under that one, with their ``ingest_batch``."""
    records = sorted(journal.newest_first(spark, _log(root)), key=lambda record: record["number"])
    if version is not None:
        records = [record for record in records if record["version"] <= version]
    if not records:
        raise ValueError(f"{root} has no version of its schema" + (f" up to {version}" if version is not None else ""))
    wanted = _schema(records[-1]["schema"])
    frames = [_under(spark, root, record, wanted) for record in records]
    present = [frame for frame in frames if frame is not None]
    nothing = spark.createDataFrame([], wanted).withColumn(INGEST_BATCH, F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, present) if present else nothing


def _under(spark: SparkSession, root: str, record: dict, wanted: T.StructType) -> DataFrame | None:
    """The batches of one record as the table has them; None if none was written."""
    schema = f"{record['found']}, {INGEST_BATCH} STRING"
    frame = if_present(lambda: spark.read.schema(schema).parquet(f"{_data(root)}/{WRITTEN_AS}={record['number']}"))
    if frame is None:
        return None
    have = {field.name for field in _schema(record["found"])}
    columns = [
        (F.col(_quoted(field.name)) if field.name in have else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in wanted
    ]
    return frame.select(*columns, INGEST_BATCH)


def history(spark: SparkSession, root: str) -> DataFrame:
    """(version, batch, column_name, change, known_type, found_type): a row a change, ``first`` for the first version."""
    records = journal.table(spark, _log(root), _RECORD)
    first = F.array(
        F.struct(
            F.lit("*").alias("column_name"),
            F.lit("first").alias("change"),
            F.lit(None).cast("string").alias("known_type"),
            F.lit(None).cast("string").alias("found_type"),
        )
    )
    # All records in one window: as many as the schema changed.
    oldest = F.min("number").over(Window.partitionBy(F.lit(0)))
    changes = F.when(F.col("number") == oldest, first).otherwise(F.col("changes"))
    return records.select("version", "batch", changes.alias("changes")).select("version", "batch", F.inline("changes"))
