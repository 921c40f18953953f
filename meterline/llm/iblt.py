"""Document fingerprints as invertible Bloom lookup sketches, with built-in functions only.

A text is the set of its paragraph digests; paragraphs longer than ``words`` words count as runs of that many words,
numbered from the start of the paragraph. A sketch has three tables of cells; a digest is added to one cell of each:
count, xor of digests, xor of check hashes. The sketch of one version less that of another holds only what differs.
Peeling takes a cell with one digest (count 1 or -1 and the right check hash), notes the digest and takes it out of
its three cells, until nothing is left. If something is left, the pair is sketched again with twice the cells.
Likeness is the share of common digests among all digests of both, computed from what was peeled.

Cells are rows, summed where the text already is: the digests are kept bucketed by row, so that no cell is ever
shuffled, however long a text is.

``fingerprint`` is the sketch with ``FIXED`` cells, as text. Defined results: null texts are empty; texts without
words have an empty sketch, and two empty sketches have likeness 1; rows equal in doc_id and text get the same
result, and the next document is the next row that differs; null ids come last; a single document is its own next;
an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored
from meterline.session import new_shared_path

WORDS = 8
FIXED = 12
SWEEPS = 4
_GROUP = ["k", "pair", "size", "cell"]


def digests(text: Column, words: int = WORDS) -> Column:
    """The set of paragraph digests of a text."""
    runs = F.regexp_extract_all(text, F.lit(rf"\S++(?:[^\S\n]++\S++){{0,{words - 1}}}"), F.lit(0))
    return F.array_distinct(F.transform(runs, lambda run: F.xxhash64(run)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(1)).bitwiseAND(0xFFFFFFFF)


def _cell(digest: Column, table: Column | int, size: Column) -> Column:
    each = (size / 3).cast("long")
    table = F.lit(table) if isinstance(table, int) else table
    return table * each + F.pmod(F.xxhash64(digest, table, size), each)


def sketched(sides: DataFrame) -> DataFrame:
    """Cells of (k, pair, size, plus, minus): the sketch of the digests in ``plus`` less that of those in ``minus``."""
    signed = F.concat(
        F.transform("plus", lambda d: F.struct(d.alias("digest"), F.lit(1).alias("n"))),
        F.transform("minus", lambda d: F.struct(d.alias("digest"), F.lit(-1).alias("n"))),
    )
    items = sides.select("k", "pair", "size", F.inline(signed))
    places = F.array(*[_cell(F.col("digest"), t, F.col("size")) for t in range(3)])
    added = items.select("k", "pair", "size", "digest", "n", F.explode(places).alias("cell"))
    return added.groupBy(*_GROUP).agg(
        F.sum("n").alias("n"), F.bit_xor("digest").alias("key"), F.bit_xor(_check(F.col("digest"))).alias("checks")
    )


def peeled(cells: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """(k, pair, size, cell, n, key, checks) after peeling. Cells -1 and -2 count the digests only in plus and minus.

    A step peels one of the three tables, where each digest has one cell, so none is taken out twice."""
    for step in range(3 * sweeps):
        each = (F.col("size") / 3).cast("long")
        here = F.floor(F.col("cell") / each) == step % 3
        pure = here & (F.col("cell") >= 0) & (F.abs("n") == 1) & (F.col("checks") == _check(F.col("key")))
        itself = F.struct("cell", "n", "key", "checks")
        zero = F.lit(0).cast("long")
        found = F.struct(
            F.when(F.col("n") == 1, -1).otherwise(-2).cast("long").alias("cell"),
            F.lit(1).cast("long").alias("n"),
            zero.alias("key"),
            zero.alias("checks"),
        )
        out = [
            F.struct(
                _cell(F.col("key"), t, F.col("size")).alias("cell"), (-F.col("n")).alias("n"), "key", "checks"
            )
            for t in range(3)
            if t != step % 3
        ]
        rows = F.when(pure, F.array(found, *out)).otherwise(F.array(itself))
        cells = (
            cells.select("k", "pair", "size", F.inline(rows))
            .groupBy(*_GROUP)
            .agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("checks").alias("checks"))
            .where("n <> 0 OR key <> 0 OR checks <> 0")
        )
    return cells


def bucketed(frame: DataFrame, key: str, label: str) -> DataFrame:
    """Written bucketed by a key. The table's name is dropped at once, its files stay in the shared folder."""
    spark = frame.sparkSession
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_shared_path(spark, label)
    frame.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    kept = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return kept


def likeness(versions: DataFrame, pairs: dict[str, tuple[str, str, float]], sweeps: int = SWEEPS) -> DataFrame:
    """(k, pair, near) for each row of ``versions``, which is bucketed by ``k``.

    ``pairs`` names two columns of digests and the share of digests expected to differ, which sets the first size."""
    sides = F.array(
        *[
            F.struct(
                F.lit(name).alias("pair"),
                F.col(plus).alias("plus"),
                F.col(minus).alias("minus"),
                (3 * F.ceil(5 / 6 * share * (F.size(plus) + F.size(minus)) + 2)).cast("long").alias("size"),
            )
            for name, (plus, minus, share) in pairs.items()
        ]
    )
    todo = versions.select("k", F.inline(sides))
    ready, grown = None, 1
    while True:
        sized = todo.withColumn("size", F.col("size") * grown)
        cells = peeled(sketched(sized), sweeps)
        one, two = F.col("cell") == -1, F.col("cell") == -2
        counts = cells.groupBy("k", "pair").agg(
            F.coalesce(F.sum(F.when(one, F.col("n"))), F.lit(0)).alias("only_plus"),
            F.coalesce(F.sum(F.when(two, F.col("n"))), F.lit(0)).alias("only_minus"),
            F.max(F.col("cell") >= 0).alias("failed"),
        )
        counts = stored(counts, "peeled")
        done = counts.where("NOT failed").select("k", "pair", "only_plus", "only_minus")
        ready = done if ready is None else ready.union(done)
        failed = counts.where("failed")
        if failed.isEmpty():
            break
        # Joined by the bucket key alone: with the pair as a second key all digests would be shuffled.
        failed = failed.groupBy("k").agg(F.collect_set("pair").alias("again"))
        again = versions.join(failed, "k").select("k", F.filter(sides, lambda s: F.array_contains("again", s["pair"])).alias("sides"))
        todo = again.select("k", F.inline("sides"))
        grown *= 2
    return ready


def order_of(rows: DataFrame) -> DataFrame:
    """(k, doc_id, n_chars, copies, user_k, user_chars): the user is the row whose next document this is.

    Rows are ranged by id; only the first row of each range is compared over all ranges."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = rows.groupBy("k").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies")
    )
    by = [F.col("doc_id").desc_nulls_last(), F.col("k")]
    ranged = distinct.repartitionByRange(ranges, *by).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    inside = Window.partitionBy("range").orderBy(*by)
    before = ranged.withColumns({"user_k": F.lag("k").over(inside), "user_chars": F.lag("n_chars").over(inside)})
    last = ranged.groupBy("range").agg(F.max_by(F.struct("k", "n_chars"), F.struct(*_ascending())).alias("last"))
    over = Window.orderBy("range")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = last.select(
        F.col("range").alias("at"),
        F.coalesce(F.lag("last").over(over), F.last("last").over(whole)).alias("previous"),
    )
    linked = before.join(ends, F.col("range") == F.col("at"))
    return linked.select(
        "k",
        "doc_id",
        "n_chars",
        "copies",
        F.coalesce("user_k", "previous.k").alias("user_k"),
        F.coalesce("user_chars", "previous.n_chars").alias("user_chars"),
    )


def _ascending() -> list[Column]:
    """The order of rows by id, descending and nulls last, as values that ascend."""
    return [
        F.col("doc_id").isNull().alias("absent"),
        (-F.coalesce(F.col("doc_id"), F.lit(0)) - 1).alias("down"),
        F.col("k").alias("tie"),
    ]


def fingerprint_text(cells: DataFrame) -> DataFrame:
    """(k, pair, sketch): the cells of a small sketch as text; a few characters a cell, in the order of cells."""
    shown = F.concat_ws(
        ":", F.hex("cell"), F.hex("n"), F.lower(F.hex("key")), F.lower(F.hex("checks"))
    )
    return cells.where("n <> 0 OR key <> 0 OR checks <> 0").groupBy("k", "pair").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat(F.lpad(F.col("cell").cast("string"), 4, "0"), F.lit("="), shown))), " ").alias("sketch")
    )


def edited_fingerprints(docs: DataFrame, words: int = WORDS, fixed: int = FIXED) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has its last third replaced by the start of the next document, by descending doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("k"), "doc_id", "text")
    order = stored(order_of(rows.select("k", "doc_id", F.length("text").alias("n_chars"))), "order")
    # Both uses of the texts read one exchange.
    placed = rows.select("k", "text").repartition("k").join(order.hint("shuffle_hash"), "k")
    asked = F.floor(F.col("user_chars") / 3).cast("int")
    given = placed.select(
        F.col("user_k").alias("k"),
        F.substring("text", F.lit(1), asked).alias("start"),
        digests(F.col("text"), words).alias("next"),
    )
    repeated = not order.where("copies > 1").isEmpty()
    if repeated:
        given = given.dropDuplicates(["k"])
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - cut), F.col("start"))
    joined = placed.join(given.hint("shuffle_hash"), "k").withColumn("edited", edited)
    versions = joined.select(
        "k",
        "doc_id",
        "copies",
        F.col("n_chars").cast("long"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text"), words).alias("own"),
        digests(F.col("edited"), words).alias("changed"),
        "next",
    )
    if repeated:
        versions = versions.dropDuplicates(["k"])
    kept = restored(bucketed(shortened(versions), "k", "fingerprint-versions"))
    found = _compared(kept, fixed)
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def shortened(versions: DataFrame) -> DataFrame:
    """``changed`` as the number of leading digests that are those of ``own``, and the rest."""
    differs = F.array_position(F.zip_with("own", "changed", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    alike = F.when(differs == 0, F.size("own")).otherwise(differs - 1).cast("int")
    counted = versions.withColumn("alike", alike)
    return counted.withColumn("rest", F.slice("changed", F.col("alike") + 1, F.size("changed"))).drop("changed")


def restored(versions: DataFrame) -> DataFrame:
    """The inverse of ``shortened``."""
    changed = F.concat(F.slice("own", F.lit(1), F.col("alike")), F.col("rest"))
    return versions.withColumn("changed", changed).drop("alike", "rest")


def _compared(versions: DataFrame, fixed: int) -> DataFrame:
    nothing = F.array().cast("array<bigint>")
    size = F.lit(fixed).cast("long")
    sides = F.array(
        *[
            F.struct(F.lit(p).alias("pair"), F.col(p).alias("plus"), nothing.alias("minus"), size.alias("size"))
            for p in ("own", "changed")
        ]
    )
    prints = fingerprint_text(sketched(versions.select("k", F.inline(sides))))
    prints = prints.groupBy("k").agg(
        F.max(F.when(F.col("pair") == "own", F.col("sketch"))).alias("fingerprint"),
        F.max(F.when(F.col("pair") == "changed", F.col("sketch"))).alias("edited_fingerprint"),
    )
    peels = likeness(versions, {"edited": ("own", "changed", 0.5), "next": ("own", "next", 1.0)})
    parts = {
        f"{pair}_{side}": F.max(F.when(F.col("pair") == pair, F.col(f"only_{side}")))
        for pair in ("edited", "next")
        for side in ("plus", "minus")
    }
    differ = peels.groupBy("k").agg(*[c.alias(n) for n, c in parts.items()])

    def near(pair: str, own: str) -> Column:
        common = F.col(own) - F.coalesce(F.col(f"{pair}_plus"), F.lit(0))
        every = F.col(own) + F.coalesce(F.col(f"{pair}_minus"), F.lit(0))
        return F.when(every == 0, 1.0).otherwise(common / every).cast("double")

    # The digests themselves stay where they are; only their number is joined.
    counted = versions.select("k", "doc_id", "copies", "n_chars", "edited_sha256", F.size("own").alias("own_digests"))
    full = counted.join(prints, "k", "left").join(differ, "k", "left")
    return full.select(
        "doc_id",
        "copies",
        "n_chars",
        "edited_sha256",
        F.coalesce("fingerprint", F.lit("empty")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("empty")).alias("edited_fingerprint"),
        near("edited", "own_digests").alias("near_edited"),
        near("next", "own_digests").alias("near_next"),
    )
