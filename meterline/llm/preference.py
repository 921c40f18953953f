"""Preference pairs from conversations, with built-in functions only.

Conversations with the same first turn are paired in the order of their ids, the first with the second, the third with
the fourth and so on; the one with the smaller id is the chosen one. The longest
common prefix of turns is the prompt, rendered once; what follows in either is its completion. Output is by turn, so
that a conversation with a third of all turns is never gathered: the text of a part is its turns in the order of
(turn, copy). ``loss_from`` and ``loss_to`` mark the characters of a rendered turn that are trained on: what the
assistant says in a completion, with the end mark. They are null elsewhere (masked).

Pairing numbers conversations within ranges of (first turn, id), so that a first turn shared by a third of all
conversations is paired in many tasks, whatever their ids.

Defined results: null roles and texts are empty; turns are ordered by (turn, role, text) with nulls first, so that
repeated turns are numbered copies; a null conv_id is a conversation of its own, without partner; a conversation without partner has
an empty prompt, is all completion, and its rejected_id is null; equal conversations are all prompt; an empty table
gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored

END = "<|end|>\n"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, role, text); ``copy`` numbers the rows of one turn."""
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return rows.withColumn("copy", F.row_number().over(order))


def _digest() -> Column:
    return F.sha2(F.concat_ws("\x00", "role", "text"), 256)


def pairs(rows: DataFrame) -> DataFrame:
    """(conv_id, pair_id, rejected_id, side) of every conversation; side 0 is the chosen one.

    Conversations are ranged by (opening, id), so that a common opening fills many ranges. Each is numbered in its
    range, and the counts of an opening's ranges, one row a range, make that its number among all."""
    spark = rows.sparkSession
    order = F.struct(F.col("turn").isNotNull(), "turn", "copy")
    first = rows.groupBy("conv_id").agg(F.min_by(_digest(), order).alias("opening"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = first.where("conv_id IS NOT NULL").repartitionByRange(ranges, "opening", "conv_id")
    known = stored(known.withColumn("range", F.spark_partition_id()), "preference-openings")
    counts = known.groupBy("opening", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("opening").orderBy("range")) - F.col("n")
    place = F.row_number().over(Window.partitionBy("range", "opening").orderBy("conv_id"))
    numbered = known.withColumn("place", place).join(counts.withColumn("before", before), ["opening", "range"])
    met = numbered.groupBy("opening", F.floor((F.col("before") + F.col("place") - 1) / 2).alias("number")).agg(
        F.min("conv_id").alias("pair_id"), F.max("conv_id").alias("last")
    )
    met = met.withColumn("rejected_id", F.when(F.col("last") != F.col("pair_id"), F.col("last")))
    chosen = F.struct(F.col("pair_id").alias("conv_id"), F.lit(0).alias("side"))
    rejected = F.struct(F.col("rejected_id").alias("conv_id"), F.lit(1).alias("side"))
    both = met.select("pair_id", "rejected_id", F.explode(F.array(chosen, rejected)).alias("of")).where("of.conv_id IS NOT NULL")
    absent = first.where("conv_id IS NULL")
    nothing = F.lit(None).cast("long")
    return both.select("of.conv_id", "pair_id", "rejected_id", "of.side").unionByName(
        absent.select("conv_id", nothing.alias("pair_id"), nothing.alias("rejected_id"), F.lit(0).alias("side"))
    )


def rendered_pairs(conversations: DataFrame) -> DataFrame:
    """A row for each turn of each pair's prompt and completions."""
    rows = turns(conversations)
    sides = stored(pairs(rows), "preference-pairs")
    named = sides.withColumnRenamed("conv_id", "of")
    dealt = rows.join(named, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "copy")
    met = dealt.groupBy("pair_id", "turn", "copy").agg(
        F.count(F.lit(1)).alias("n"), F.min(_digest()).alias("low"), F.max(_digest()).alias("high")
    )
    parts = met.where("n < 2 OR low <> high").groupBy("pair_id").agg(F.min(place).alias("cut"))
    parts = stored(parts.withColumnRenamed("pair_id", "cut_pair"), "preference-cuts")
    cut = dealt.join(parts, F.col("pair_id").eqNullSafe(F.col("cut_pair")), "left")
    shared = F.col("cut").isNull() | (place < F.col("cut"))
    part = F.when(shared, "prompt").when(F.col("side") == 0, "chosen").otherwise("rejected")
    head = F.concat(F.lit("<|"), "role", F.lit("|>\n"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    kept = cut.withColumn("part", part).where("part <> 'prompt' OR side = 0")
    return kept.select(
        "pair_id",
        F.col("pair_id").alias("chosen_id"),
        "rejected_id",
        "part",
        "turn",
        "copy",
        "role",
        F.concat(head, "text", F.lit(END)).alias("rendered"),
        F.when(trained, F.length(head)).cast("long").alias("loss_from"),
        F.when(trained, F.length(head) + F.length("text") + len(END)).cast("long").alias("loss_to"),
    )
