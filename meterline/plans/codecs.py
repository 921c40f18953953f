"""Bytes that the same trips take under each compression of Parquet, to choose one for a lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLAIN = "uncompressed"
CODECS = ("snappy", "gzip", "zstd", "lz4_raw")


def codec_sizes(spark: SparkSession, trips: DataFrame, folder: str, codecs: Sequence[str] = CODECS) -> DataFrame:
    """(codec, files, bytes, rows, share_of_plain), a row a codec and one for no compression.

    The trips are made once, without compression; each codec then copies these files without a shuffle, so that all have
    the same rows in the same order. The copies stay in ``folder``, which must be new."""

    def place(codec: str) -> str:
        return f"{folder}/codec={codec}"

    trips.write.option("compression", PLAIN).parquet(place(PLAIN))
    plain = spark.read.parquet(place(PLAIN))
    for codec in codecs:
        plain.write.option("compression", codec).parquet(place(codec))
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    codec = F.regexp_extract("path", "/codec=([^/]+)/", 1).alias("codec")
    sizes = names.load(folder).groupBy(codec).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    rows = spark.read.parquet(folder).groupBy("codec").agg(F.count(F.lit(1)).alias("rows"))
    known = sizes.join(rows, "codec", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))
    whole = known.where(F.col("codec") == PLAIN).select(F.col("bytes").alias("plain_bytes"))
    # One row, which is always there.
    return known.join(F.broadcast(whole)).select(
        "codec", "files", "bytes", "rows", F.round(F.col("bytes") / F.col("plain_bytes"), 4).alias("share_of_plain")
    )
