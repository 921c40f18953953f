"""Tables in the session catalog: definitions, partitions, statistics and schema upkeep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.sources import raw_files
from meterline.sources.layers import INGEST_BATCH, Lake, published_folders, published_months
from meterline.sources.schemas import PARQUET_TABLES, RAW_TABLE

RAW_NAME = "raw_taxi_trips"


def raw_table_ddl(database: str, location: str) -> str:
    """CSV tables match columns by position, so files with another header fail; ``raw_view`` reads them by name."""
    return f"""
        CREATE TABLE IF NOT EXISTS {database}.{RAW_NAME} ({RAW_TABLE})
        USING csv OPTIONS (header 'true', sep ',', enforceSchema 'false', recursiveFileLookup 'true')
        LOCATION '{location}'
    """


def raw_view(spark: SparkSession, lake: Lake, name: str = RAW_NAME) -> DataFrame:
    """The columns of the raw table by header name, from raw files of every layout and format, as a view of the
    session. A column that no file has is NULL, and so is text that does not parse."""
    raw = raw_files.read_raw(spark, lake.raw)
    have = {column.lower(): column for column in raw.columns}
    columns = [
        F.col(have[field.name.lower()]).try_cast(field.dataType).alias(field.name)
        if field.name.lower() in have
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in T.StructType.fromDDL(RAW_TABLE)
    ]
    view = raw.select(*columns)
    view.createOrReplaceTempView(name)
    return view


def parquet_table_ddl(
    database: str, table: str, location: str, with_batches: bool = False
) -> str:
    """``with_batches`` adds the partition level that incremental ingest writes."""
    columns, keys = PARQUET_TABLES[table]
    fields = [f"{key} INT" for key in keys] + [f"{INGEST_BATCH} STRING"] * with_batches
    partitions = [*keys] + [INGEST_BATCH] * with_batches
    return f"""
        CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}, {", ".join(fields)})
        USING parquet OPTIONS (compression 'snappy')
        PARTITIONED BY ({", ".join(partitions)}) LOCATION '{location}'
    """


def create_tables(spark: SparkSession, lake: Lake, database: str) -> None:
    """The raw, processed and curated tables over the folders of a lake."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(raw_table_ddl(database, lake.raw))
    for table in PARQUET_TABLES:
        if table.startswith("curated_"):
            location, batches = lake.curated(table.removeprefix("curated_")), False
        else:
            location, batches = lake.processed, True
        spark.sql(parquet_table_ddl(database, table, location, batches))


def repair_partitions(spark: SparkSession, database: str, lake: Lake) -> None:
    """Make new partition folders known to the catalog; run after each load. Curated tables follow the newest
    publication, month by month; without one, their folders."""
    months = published_months(spark, lake)
    for table in PARQUET_TABLES:
        if months is None or not table.startswith("curated_"):
            spark.sql(f"MSCK REPAIR TABLE {database}.{table}")
        else:
            _follow(spark, f"{database}.{table}", lake, table.removeprefix("curated_"), months)


def _follow(spark: SparkSession, table: str, lake: Lake, name: str, months: dict[str, str]) -> None:
    known = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    wanted = {
        folder: f"{lake.version(version, name)}/{folder}"
        for version, folders in published_folders(months).items()
        for folder in folders
    }
    for folder in sorted(known | set(wanted)):
        partition = folder.replace("/", ", ")
        if folder not in wanted:
            spark.sql(f"ALTER TABLE {table} DROP PARTITION ({partition})")
        elif folder in known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({partition}) SET LOCATION '{wanted[folder]}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({partition}) LOCATION '{wanted[folder]}'")
    spark.catalog.refreshTable(table)


def compute_statistics(spark: SparkSession, table: str) -> None:
    """Row count and column statistics in the catalog, for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def sampled(spark: SparkSession, table: str, percent: float, seed: int) -> DataFrame:
    """A development sample of a table, the same for the same seed and files."""
    return spark.sql(f"SELECT * FROM {table} TABLESAMPLE ({percent} PERCENT) REPEATABLE ({seed})")


# --- schema discovery ------------------------------------------------------------------------


_WIDER = ("int", "bigint", "double")
_TIMES = ("date", "timestamp_ntz", "timestamp")


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds both: numbers and times widen, everything else is text."""
    for ladder in (_WIDER, _TIMES):
        names = (a.simpleString(), b.simpleString())
        if all(name in ladder for name in names):
            return max((a, b), key=lambda kind: ladder.index(kind.simpleString()))
    return a if a == b else T.StringType()


def united(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas by name, in the order first met."""
    kinds: dict[str, T.StructField] = {}
    for field in (field for schema in schemas for field in schema):
        known = kinds.get(field.name)
        kind = field.dataType if known is None else _wider(known.dataType, field.dataType)
        kinds[field.name] = T.StructField(field.name, kind)
    return T.StructType(list(kinds.values()))


def found_schema(spark: SparkSession, path: str, kind: str) -> T.StructType:
    """Types as all files and rows show them. CSV files are inferred layout by layout, as their columns are found by
    position, and then united by name."""
    if kind == "parquet":
        # Partition folders are part of the schema, and footers are read by tasks.
        return spark.read.option("mergeSchema", True).parquet(path).schema
    options = raw_files.file_options(kind)
    if kind == "json":
        return spark.read.options(**options).json(path).schema
    reader = spark.read.option("header", True).option("inferSchema", True)
    layouts = raw_files.csv_layouts(spark, path)
    if len(layouts) == 1:
        return reader.options(**options).csv(path).schema
    return united([reader.csv(files).schema for files in layouts])


def schema_report(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    rows = [
        (table, position, field.name, field.dataType.simpleString())
        for table, schema in schemas.items()
        for position, field in enumerate(schema)
    ]
    columns = "table_name STRING, position INT, column_name STRING, data_type STRING"
    return spark.createDataFrame(rows, columns)


def schema_changes(
    spark: SparkSession, known: T.StructType, found: T.StructType
) -> DataFrame:
    """Columns that were added, are missing, or have another type."""
    before = {field.name.lower(): field.dataType.simpleString() for field in known}
    after = {field.name.lower(): field.dataType.simpleString() for field in found}
    rows = [(name, "added", None, kind) for name, kind in after.items() if name not in before]
    rows += [(name, "missing", kind, None) for name, kind in before.items() if name not in after]
    rows += [
        (name, "changed", kind, after[name])
        for name, kind in before.items()
        if after.get(name, kind) != kind
    ]
    columns = "column_name STRING, change STRING, known_type STRING, found_type STRING"
    return spark.createDataFrame(rows, columns)


def follow_schema(spark: SparkSession, table: str, found: T.StructType) -> DataFrame:
    """Add new columns to a table and report every change; missing columns are only reported."""
    changes = schema_changes(spark, spark.table(table).schema, found)
    added = changes.filter("change = 'added'").collect()
    if added:
        columns = ", ".join(f"`{row.column_name}` {row.found_type}" for row in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return changes
