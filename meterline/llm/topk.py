"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector, block by block; no score is kept. A pass counts the scores of each query
in ``BINS`` cells of a range of scores, the counts of all blocks are added up, and the cell that holds the k-th best
score becomes the range of the next pass. When few enough scores are left, or the cell is one score wide, a last pass
keeps the scores from that cell on; ties go to the smaller id. A block sends only cells in which its own k-th score or
a better one lies, as the k-th of all cannot be worse.

Components become ``floor(256 * x)``, x as double, and scores are integers: products that a double holds exactly go
through matrix products of doubles, others through Python's integers; a score past 64 bits is an error.

Defined results: vectors that are null or hold null or non-finite components and rows without an id take no part; a
query's candidates are the rows with another id and as many components; a query with fewer than k candidates returns
them all; of rows that share a query's id the smallest vector is the query; as candidates repeated rows count as often
as they occur. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored

SCALE = 256
BIN_BITS = 10
BINS = 1 << BIN_BITS
ENOUGH = 64  # scores from the k-th cell on that need no finer cells
VECTORS = 32_768  # of a block, at most
LEAST_VECTORS = 1_024
QUERIES = 8_192
_SCORES = 1 << 21  # held at once
_EXACT = float(1 << 53)


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _length(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _matrices(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of components: the places of its rows, and their vectors."""
    lists = table["v"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes = np.diff(lists.offsets.to_numpy())
    starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    for width in np.unique(sizes):
        rows = np.flatnonzero(sizes == width)
        yield int(width), rows, flat[starts[rows][:, None] + np.arange(width)]


def _products(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact inner products, as 64-bit integers."""
    if not some.size or not others.size:
        return np.zeros((len(some), len(others)), np.int64)
    most = np.abs(some.astype(float)).max() * np.abs(others.astype(float)).max() * some.shape[1]
    if most < _EXACT:
        return (some.astype(float) @ others.astype(float).T).astype(np.int64)
    exact = some.astype(object) @ others.astype(object).T
    return exact.astype(np.int64)  # raises past 64 bits


def _scored(vectors: pa.Table, queries: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the block: places of some queries, places of vectors, their scores, and which are candidates."""
    if not vectors.num_rows or not queries.num_rows:
        return
    ids, asking = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy()
    known = {width: (rows, matrix) for width, rows, matrix in _matrices(vectors)}
    for width, places, matrix in _matrices(queries):
        if width not in known:
            continue
        rows, others = known[width]
        step = max(1, _SCORES // len(rows))
        for a in range(0, len(places), step):
            part = places[a : a + step]
            found = _products(matrix[a : a + step], others)
            yield part, rows, found, asking[part][:, None] != ids[rows][None, :]


def _counted(k: int):
    """Counts by query and cell of one block."""

    def run(_key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = ("query_id", "cell", "n")
        parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in names]
        state = {c: queries[c].to_numpy() for c in ("query_id", "top", "shift", "above")}
        for part, _rows, scores, others in _scored(vectors, queries):
            gap = state["top"][part][:, None] - scores
            cell = gap >> state["shift"][part][:, None]
            inside = others & (gap >= 0) & (cell < BINS)
            at = cell + np.arange(len(part))[:, None] * BINS
            counts = np.bincount(at[inside], minlength=len(part) * BINS).reshape(len(part), BINS)
            better = counts.cumsum(axis=1) - counts
            row, found = np.nonzero((counts > 0) & (better < k - state["above"][part][:, None]))
            for column, values in zip(parts, (state["query_id"][part][row], found, counts[row, found]), strict=True):
                column.append(values.astype(np.int64))
        return pa.table({name: np.concatenate(column) for name, column in zip(names, parts, strict=True)})

    return run


def _chosen(k: int):
    """Scores of one block from the query's floor on, the best k by score and id."""

    def run(_key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = ("query_id", "vec_id", "score")
        parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in names]
        if queries.num_rows and vectors.num_rows:
            asking, ids = queries["query_id"].to_numpy(), vectors["vec_id"].to_numpy()
            floor = queries["floor"].to_numpy()
            for part, rows, scores, others in _scored(vectors, queries):
                row, column = np.nonzero(others & (scores >= floor[part][:, None]))
                value, vec = scores[row, column], ids[rows[column]]
                order = np.lexsort((vec, -value, row))
                row, value, vec = row[order], value[order], vec[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                kept = rank < k
                for into, values in zip(parts, (asking[part[row]], vec, value), strict=True):
                    into.append(values[kept].astype(np.int64))
        return pa.table({name: np.concatenate(column) for name, column in zip(names, parts, strict=True)})

    return run


def _by_block(vectors: DataFrame, queries: DataFrame, v_blocks: int, q_blocks: int, run, schema: str) -> DataFrame:
    """Each block of queries meets each block of vectors once."""
    left = vectors.withColumn("v_block", F.expr(f"pmod(deal, {v_blocks})")).withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    )
    right = queries.withColumn("q_block", F.expr(f"CAST(pmod(xxhash64(query_id), {q_blocks}) AS INT)")).withColumn(
        "v_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(v_blocks - 1).cast("long")))
    )
    keys = ("q_block", "v_block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def top_k(vectors: DataFrame, asked: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows for every row for which ``asked`` holds.

    ``vectors`` has ``vec_id`` and ``embedding``.
    """
    spark = vectors.sparkSession
    e = F.col("embedding")
    whole = vectors.where(F.col("vec_id").isNotNull() & usable(e)).select(
        F.col("vec_id").cast("long"), integers(e).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"),
        F.xxhash64(F.monotonically_increasing_id()).alias("deal"),  # fixed by writing it
    )
    whole = stored(whole, "topk-vectors")
    n, longest = whole.agg(F.count("*"), F.max(_length(F.col("v")))).first()
    longest = (longest or 0.0) * (1 + 1e-9) + 1
    queries = whole.where("asked").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    top = (F.ceil(_length(F.col("v")) * longest) + 1).cast("long")  # no inner product is larger
    state = stored(
        queries.withColumn("top", top).select(
            "query_id", "v", "top",
            F.greatest(F.lit(0), F.ceil(F.log2(F.col("top") * 2.0 + 1)) - BIN_BITS).cast("int").alias("shift"),
            F.lit(0).cast("long").alias("above"), (-F.col("top")).alias("floor"), F.lit(False).alias("done"),
        ),
        "topk-state",
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v_blocks = max(1, -(-n // VECTORS), min(2 * tasks, n // LEAST_VECTORS))
    q_blocks = max(1, -(-state.count() // QUERIES))
    vectors = whole.select("vec_id", "v", "deal")
    while not state.where("NOT done").isEmpty():
        state = stored(_narrowed(vectors, state, k, v_blocks, q_blocks), "topk-state")
    found = _by_block(
        vectors, state.select("query_id", "v", "floor"), v_blocks, q_blocks, _chosen(k),
        "query_id long, vec_id long, score long",
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _narrowed(vectors: DataFrame, state: DataFrame, k: int, v_blocks: int, q_blocks: int) -> DataFrame:
    """One pass: the range of each query becomes the cell that holds its k-th best score."""
    open_ = state.where("NOT done")
    cells = _by_block(
        vectors, open_.drop("floor", "done"), v_blocks, q_blocks, _counted(k), "query_id long, cell long, n long"
    ).groupBy("query_id", "cell").agg(F.sum("n").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("query_id").orderBy("cell"))
    cells = cells.withColumn("so_far", so_far).join(open_.select("query_id", "above"), "query_id")
    need = F.lit(k) - F.col("above")
    kth = cells.where((F.col("so_far") >= need) & (F.col("so_far") - F.col("n") < need)).select(
        "query_id", "cell", "n", (F.col("above") + F.col("so_far") - F.col("n")).alias("better")
    )
    joined = state.join(kth, "query_id", "left")
    top = F.expr("top - shiftleft(cell, shift)")
    floor = F.expr("top - shiftleft(cell, shift) - shiftleft(1L, shift) + 1")
    hit = F.col("cell").isNotNull()  # else: done before, or fewer candidates than k
    return joined.select(
        "query_id", "v",
        F.when(hit, top).otherwise(F.col("top")).alias("top"),
        F.when(hit, F.greatest(F.lit(0), F.col("shift") - BIN_BITS)).otherwise(F.col("shift")).alias("shift"),
        F.when(hit, F.col("better")).otherwise(F.col("above")).alias("above"),
        F.when(hit, floor).otherwise(F.col("floor")).alias("floor"),
        (~hit | (F.col("shift") == 0) | (F.col("better") + F.col("n") <= ENOUGH)).alias("done"),
    )
