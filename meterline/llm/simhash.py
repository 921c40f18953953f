"""SimHash near-duplicates by a generalised pigeonhole.

Distinct fingerprints are linked when they differ in few bits. The bits are grouped by correlation into partitions;
each partition gets its own distance threshold, chosen by dynamic programming on estimated candidate counts so that
the thresholds add up to ``distance - partitions + 1``. Two fingerprints within ``distance`` then agree, up to the
threshold, on at least one partition. A threshold ``t`` is probed by masking every ``t``-subset of the partition's
bits, so that a probe is an equality of (mask, masked bits). Members of one bucket are verified in the task.

Buckets above ``bucket_rows`` are never gathered: all pairs in a bucket agree on its mask, so their differences lie in
the other bits, which are cut into ``distance + 1`` parts; one part agrees, and the bucket is dealt again on the
longer masks. With eleven free bits or fewer a bucket has at most 2048 distinct fingerprints, so this ends.

Defined results: null and empty texts, and texts without a word, have fingerprint zero and are linked to each other;
repeated rows and equal texts share a fingerprint and so a component; a null ``doc_id`` takes part in linking, its
component is the smallest non-null id, or null; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import fresh, stored, words

SEED = 42
BITS = 64
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64 hashes, repeats included."""
    tokens = words(text)
    if not tokens:
        return 0
    if len(tokens) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    runs = map(b" ".join, zip(*(tokens[i:] for i in range(shingle)), strict=False))
    ones, total = np.zeros(BITS, np.int64), 0
    while block := list(itertools.islice(runs, _BLOCK)):
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in block), "<u8", len(block))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.uint32
        )
        total += len(block)
    bits = (ones * 2 > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _printed(rows: DataFrame, shingle: int) -> DataFrame:
    """The rows, whose last column is ``text``, with ``fp`` in its place: 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], names=[*names, "fp"])

    names = rows.columns[:-1]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kinds, "fp long"]))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row."""
    return _printed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")), shingle)


# --- plan: partitions of correlated bits and their thresholds


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and how often each two bits are set together (64 x 64 counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64).astype("<u8")
            for at in range(0, len(values), _BLOCK):
                part = values[at : at + _BLOCK]
                bits = np.unpackbits(
                    part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
                ).astype(np.float32)
                together += np.rint(bits.T @ bits).astype(np.int64)
                n += len(part)
        flat = together.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(BITS * BITS), -1)), pa.array(np.append(flat, n))],
            names=["cell", "n"],
        )

    rows = nodes.select("fp").mapInArrow(run, "cell long, n long")
    counts = dict(rows.groupBy("cell").agg(F.sum("n")).collect())
    together = np.array([counts.get(i, 0) for i in range(BITS * BITS)], float)
    return int(counts.get(-1, 0)), together.reshape(BITS, BITS)


def grouped_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Greedy groups: the bit most correlated with a group's members joins it, until the group is full."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    left, groups = set(range(BITS)), []
    sizes = [BITS // parts + (i < BITS % parts) for i in range(parts)]
    for size in sizes:
        order = sorted(left)
        seed = max(order, key=lambda b: (correlation[b, order].max(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            order = sorted(left)
            best = max(order, key=lambda b: (correlation[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int] | tuple[int, ...]) -> int:
    return sum(1 << b for b in bits)


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 (partition not probed) upward that add up to ``total`` at the least cost.

    ``costs[i][t + 1]`` is the cost of threshold ``t`` in partition ``i``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, price in enumerate(row, -1):
                option = (cost + price, [*chosen, t])
                if spent + t not in following or option < following[spent + t]:
                    following[spent + t] = option
        best = following
    return best[total]


def probe_plan(
    nodes: DataFrame, distance: int, most_parts: int = 6, sample: int = 2000
) -> list[tuple[int, int]]:
    """(mask id, mask) of every probe. A sample of ``sample`` fingerprints estimates how many pairs come within a
    threshold on a partition; it affects the cost only, as any allocation finds every link."""
    n, together = bit_counts(nodes)
    picked = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    seen = np.array([r.fp for r in picked], np.int64).view(np.uint64)
    choices = []
    for parts in range(2, min(most_parts, distance + 2) + 1):
        groups = grouped_bits(n, together, parts)
        costs = []
        for group in groups:
            kept = seen & np.uint64(mask_of(group))
            near = np.zeros(distance + 1)
            for at in range(0, len(kept), 256):
                apart = np.bitwise_count(kept[at : at + 256, None] ^ kept[None, :])
                near += np.bincount(apart.ravel(), minlength=BITS + 1)[: distance + 1]
            near[0] -= len(kept)
            drawn = max(len(kept) * (len(kept) - 1), 1)
            row = [0.0]
            for t in range(distance + 1):
                even = sum(comb(len(group), k) for k in range(t + 1)) / 2.0 ** len(group)
                pairs = max(near[: t + 1].sum() / drawn, even) * n * n / 2
                row.append(pairs * 0.02 + n * comb(len(group), t))
            costs.append(row)
        cost, thresholds = allocate(costs, distance - parts + 1)
        choices.append((cost, parts, groups, thresholds))
    _, _, groups, thresholds = min(choices, key=lambda c: (c[0], c[1]))
    masks = []
    for group, t in zip(groups, thresholds, strict=True):
        if t >= 0:
            masks += [mask_of(group) & ~mask_of(out) for out in itertools.combinations(group, t)]
    return list(enumerate(masks))


# --- probe and verify


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _dealt(rows: DataFrame, masks: Column, key: str = "mask") -> DataFrame:
    """One row per fingerprint and mask; the bucket is (mask, masked bits)."""
    return rows.select("fp", F.explode(masks).alias(key)).select(
        "fp", key, F.col("fp").bitwiseAND(F.col(key)).alias("bits")
    )


def _longer(distance: int) -> Column:
    """The mask extended by each of ``distance + 1`` parts of the free bits, as an array; built-in functions only."""
    single = F.array(*[F.lit(_signed(1 << b)).cast("long") for b in range(BITS)])
    free = F.filter(single, lambda bit: F.col("mask").bitwiseAND(bit) == 0)
    parts = distance + 1
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda k: F.aggregate(
            F.filter(free, lambda bit, i: i % parts == k),
            F.col("mask"),
            lambda mask, bit: mask.bitwiseOR(bit),
        ),
    )


def _links_of(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, distance: int):
    """Links within buckets: all of them in small buckets, spanning ones in larger buckets."""
    left, right = [], []
    small = sizes <= 24
    group = np.repeat(np.arange(len(sizes)), sizes)
    for shift in range(1, int(sizes[small].max(initial=0))):
        a, b = values[:-shift], values[shift:]
        same = (group[:-shift] == group[shift:]) & small[group[:-shift]]
        same &= np.bitwise_count(a ^ b) <= distance
        left.append(a[same])
        right.append(b[same])
    for k in np.flatnonzero(~small):
        members = values[starts[k] : starts[k] + sizes[k]]
        todo = np.ones(len(members), bool)
        while todo.any():
            queue = [int(np.argmax(todo))]
            todo[queue[0]] = False
            while queue:
                at = queue.pop()
                open_ = np.flatnonzero(todo)
                near = open_[np.bitwise_count(members[open_] ^ members[at]) <= distance]
                todo[near] = False
                queue += near.tolist()
                left.append(np.full(len(near), members[at]))
                right.append(members[near])
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _verified(buckets: DataFrame, distance: int) -> DataFrame:
    """Links inside buckets of bounded size; a partition is sorted, so a bucket may run over two batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.empty(0, np.int64)] * 3
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [batch.column(i).to_numpy() for i in range(3)]
                mask, bits, fp = (np.concatenate([k, x]) for k, x in zip(kept, new, strict=True))
            else:
                mask, bits, fp = kept
            if not len(fp):
                continue
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1
            starts = np.append(0, cut)
            whole = len(fp) if batch is None else int(starts[-1])
            kept = [mask[whole:], bits[whole:], fp[whole:]]
            starts = starts[starts < whole]
            if not whole:
                continue
            sizes = np.diff(np.append(starts, whole))
            a, b = _links_of(fp[:whole].view(np.uint64), starts, sizes, distance)
            if len(a):
                a, b = a.view(np.int64), b.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["u", "v"]
                )

    dealt = buckets.select("mask", "bits", "fp").repartition("mask", "bits")
    return dealt.sortWithinPartitions("mask", "bits", "fp").mapInArrow(run, "u long, v long")


def links(nodes: DataFrame, distance: int = 3, bucket_rows: int = 2048) -> DataFrame:
    """Links (u < v) between distinct fingerprints that connect exactly what links at ``distance`` connect."""
    if bucket_rows < 2048:
        raise ValueError("buckets of up to 2048 fingerprints are verified in a task")
    masks = [_signed(m) for _, m in probe_plan(nodes, distance)]
    probes = _dealt(nodes, F.array(*[F.lit(m).cast("long") for m in masks]))
    found = []
    while True:
        probes = stored(probes, "simhash-probes")
        sizes = probes.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n"))
        over = sizes.where(F.col("n") > bucket_rows)
        large = stored(over.select("mask", "bits", _longer(distance).alias("longer")), "simhash-large")
        if large.isEmpty():
            found.append(_verified(probes, distance))
            break
        found.append(_verified(probes.join(large, ["mask", "bits"], "left_anti"), distance))
        probes = _dealt(probes.join(large, ["mask", "bits"]), F.col("longer"))
    united = found[0]
    for more in found[1:]:
        united = united.union(more)
    return united.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, by alternating large and small stars; root is the smallest node.

    Each round is written to the shared folder, so that a lost executor costs one round."""
    edges = stored(edges, "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v")
        large = large.where("u < v").distinct()
        down = large.select(F.col("v").alias("w"), F.col("u").alias("x"))  # w has smaller neighbours x
        smallest = down.groupBy("w").agg(F.min("x").alias("m"))
        small = down.join(smallest, "w").select(
            F.explode(
                F.array(
                    F.struct(F.col("m").alias("u"), F.col("x").alias("v")),
                    F.struct(F.col("m").alias("u"), F.col("w").alias("v")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.u", "e.v").where("u < v").distinct(), "stars")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 3, bucket_rows: int = 2048
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id reachable by links."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-prints")
    rooted = _rooted(nodes, distance, bucket_rows)
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_print = stored(rooted.join(ids, "root").select("fp", "component_id"), "print-components")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def _rooted(nodes: DataFrame, distance: int, bucket_rows: int) -> DataFrame:
    """The distinct fingerprints, with the ``root`` of their component."""
    roots = components(links(nodes, distance, bucket_rows)).toDF("node", "root")
    return nodes.join(roots, nodes.fp == roots.node, "left").select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


_NAMES = ["no_id", "id", "copy"]


def _named(docs: DataFrame) -> list[Column]:
    """What tells rows apart: (no_id, id, copy), none of them null; ``copy`` is a hash of the text."""
    doc_id = F.col("doc_id").cast("long")
    copy = F.xxhash64(F.col("text").cast("string"), F.col("text").isNull())
    return [doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), copy.alias("copy")]


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3, bucket_rows: int = 2048) -> DataFrame:
    """The rows, with all their columns, less near copies: of each component of linked fingerprints one row stays,
    that with the smallest id (null last), then the smallest hash of its text. Ids may be null or repeated; of rows
    with both the same id and the same text one stays. Texts without a word are one component."""
    named = docs.select(*_named(docs), F.col("text").cast("string").alias("text"))
    prints = stored(_printed(named, shingle), "named-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min(F.struct(*_NAMES)).alias("first")), "distinct-prints")
    keep = _rooted(nodes, distance, bucket_rows).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    names = [fresh(name, docs.columns) for name in _NAMES]
    keep = stored(keep, "kept-rows").toDF(*names)
    named = docs.select("*", *[c.alias(name) for c, name in zip(_named(docs), names, strict=True)])
    once = named.dropDuplicates(names)  # first, so that repeated rows are dropped in the map tasks
    return once.join(keep, names, "left_semi").select(*docs.columns)
