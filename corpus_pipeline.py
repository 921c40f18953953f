"""A corpus pipeline: quality, language, near duplicates, benchmark passages, packing.

Every stage works on all that the one before it kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import decontaminate, langid, packing, quality, simhash
from meterline.llm.common import stored, table
from meterline.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality posterior is one half or more; the source is the host, the language its path."""
    labels = table(spark, sf_dir, "labels")
    return quality.good_documents(docs, labels, F.col("source"), F.col("lang"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the stage's own input."""
    return langid.in_a_known_language(docs, langid.learn(langid.training_rows(docs)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id. Copies are what the SimHash operator
    links with its own shingles of three words and three bits."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the token ids of every document go; sequences of 4096."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("language id", language_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs


#: Several stages have learned models or hashes that SQL lacks. The stages' operators have tests of their own.
ORACLE_SQL = None
