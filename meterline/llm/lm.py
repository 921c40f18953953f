"""Language-model scores by deleted interpolation.

A token's probability is a mixture of the bigram and unigram maximum-likelihood estimates and a uniform share. The
weights depend on how often the context occurs (a bucket for each power of two) and are learned by expectation
maximisation on a deleted part of the training rows, with counts that leave this part out.

Work is laid out so that tokens stay where they are read. Each task turns texts into *units*: up to ``UNIT_BYTES`` of
text as numbers of a local vocabulary. Every unit sends its distinct n-gram hashes with its counts to shards of
hash space, a shard adds them up and answers with the totals in the order asked. A frequent n-gram thus travels once
for each unit, not for each occurrence, and a shard holds about ``SHARD_KEYS`` keys whatever the skew. Units are kept
bucketed by unit, so that only the answers move. N-grams are told apart by 64-bit hashes.

Defined results: null texts are empty and have the end token only; a null ``doc_id`` is neither held out nor learned
from; repeated rows count as often as they occur; without training rows all counts are zero, so that the base is
log10(1) a token; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import id_crc, mixed, stored, words
from meterline.session import new_shared_path

UNIT_BYTES = 4 << 20
SHARD_KEYS = 2_000_000
BUCKETS = 48
FOLDS = 10
_STEPS = 4  # histogram cells an octave, for expectation maximisation
_END = 0
_UNIT = (
    "unit string, deleted boolean, n_keys long, doc_ids array<long>, held_out array<boolean>, "
    "learn array<boolean>, sizes array<int>, vocabulary binary, tokens binary"
)
_KEYS = "shard int, unit string, deleted boolean, ones binary, one_counts binary, twos binary, two_counts binary"
_ANSWERS = "unit string, deleted boolean, shard int, distinct long, total long, one_totals binary, two_totals binary"


def packed(values: np.ndarray) -> bytes:
    """Little-endian bytes, most significant first as planes, so that small numbers compress."""
    values = np.ascontiguousarray(values)
    wide = values.dtype.itemsize
    return values.view(np.uint8).reshape(-1, wide).T[::-1].tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(wide, -1)[::-1]
    return np.ascontiguousarray(planes.T).view(kind).ravel()


@dataclass
class _Builder:
    """Collects texts until the unit is full."""

    deleted: bool
    bytes: int = 0
    known: dict[bytes, int] = field(default_factory=lambda: {b"": _END})
    rows: list[tuple] = field(default_factory=list)
    parts: list[np.ndarray] = field(default_factory=list)

    def add(self, doc_id, held_out, learn, text) -> bool:
        found, known = words(text), self.known
        at = [known.setdefault(w, len(known)) for w in found]
        at.append(_END)
        self.parts.append(np.array(at, np.uint32))
        self.rows.append((doc_id, held_out, learn, len(at)))
        self.bytes += len(text or "") + 8
        return self.bytes >= UNIT_BYTES

    def batch(self) -> pa.RecordBatch:
        tokens = np.concatenate(self.parts)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.known), np.uint64, len(self.known))
        pairs = np.unique(pair_codes(tokens, len(hashes)))
        ids, held, learn, sizes = zip(*self.rows, strict=True)
        columns = [
            pa.array([uuid.uuid4().hex]),
            pa.array([self.deleted]),
            pa.array([len(pairs) + len(hashes)], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([learn], pa.list_(pa.bool_())),
            pa.array([sizes], pa.list_(pa.int32())),
            pa.array([packed(hashes)], pa.binary()),
            pa.array([packed(tokens)], pa.binary()),
        ]
        names = [f.split()[0] for f in _UNIT.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names=names)


def pair_codes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Context and token as one number; the context of a text's first token is the end token before it."""
    context = np.append(np.uint32(_END), tokens[:-1]).astype(np.int64)
    return context * size + tokens


def _units(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = {False: _Builder(False), True: _Builder(True)}
        for batch in batches:
            for doc_id, crc, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                doc_id, crc, text = doc_id.as_py(), crc.as_py(), text.as_py()
                held = crc is not None and crc % folds == held_out
                learn = crc is not None and not held
                deleted = learn and crc // folds % FOLDS == 0
                if open_[deleted].add(doc_id, held, learn, text):
                    yield open_[deleted].batch()
                    open_[deleted] = _Builder(deleted)
        for builder in open_.values():
            if builder.rows:
                yield builder.batch()

    rows = docs.select(F.col("doc_id").cast("long"), id_crc(F.col("doc_id")), F.col("text").cast("string"))
    return rows.mapInArrow(run, _UNIT)


def _kept_units(units: DataFrame, buckets: int) -> DataFrame:
    """Written bucketed by unit. The table's name is dropped at once, its files stay in the shared folder."""
    spark = units.sparkSession
    name = f"lm_units_{uuid.uuid4().hex}"
    path = new_shared_path(spark, "lm-units")
    units.write.bucketBy(buckets, "unit").option("path", path).saveAsTable(name)
    kept = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return kept


def _grams(hashes: np.ndarray, tokens: np.ndarray):
    """Sorted keys of the unit's unigrams and bigrams, and each token's place in both."""
    ones = mixed(hashes)
    order = np.argsort(ones, kind="stable")
    place = np.empty(len(ones), np.int64)
    place[order] = np.arange(len(ones))
    codes, of_token = np.unique(pair_codes(tokens, len(hashes)), return_inverse=True)
    twos = mixed(hashes[codes // len(hashes)] * np.uint64(0x9E3779B97F4A7C15) + hashes[codes % len(hashes)])
    order_two = np.argsort(twos, kind="stable")
    place_two = np.empty(len(twos), np.int64)
    place_two[order_two] = np.arange(len(twos))
    return ones[order], place[tokens], twos[order_two], place_two[of_token.ravel()]


def _asked(units: DataFrame, bits: int) -> DataFrame:
    """A row for each unit and shard with the keys of that stretch of hash space and the unit's training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
        for batch in batches:
            for at in range(batch.num_rows):  # one unit at a time
                row = batch.slice(at, 1).to_pylist()[0]
                hashes, tokens = unpacked(row["vocabulary"], np.uint64), unpacked(row["tokens"], np.uint32)
                learnt = np.repeat(np.array(row["learn"], bool), row["sizes"])
                ones, at_one, twos, at_two = _grams(hashes, tokens)
                counts = [
                    np.bincount(at[learnt], minlength=len(keys)).astype(np.uint32)
                    for at, keys in ((at_one, ones), (at_two, twos))
                ]
                cuts = [np.concatenate([[0], np.searchsorted(k, edges), [len(k)]]) for k in (ones, twos)]
                for shard in range(1 << bits):
                    (a, b), (c, d) = (cut[shard : shard + 2] for cut in cuts)
                    if a == b and c == d:
                        continue
                    cells = [shard, row["unit"], row["deleted"], packed(ones[a:b]), packed(counts[0][a:b])]
                    cells += [packed(twos[c:d]), packed(counts[1][c:d])]
                    kinds = [pa.int32(), pa.string(), pa.bool_(), *[pa.binary()] * 4]
                    names = [f.split()[0] for f in _KEYS.split(", ")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in zip(cells, kinds, strict=True)], names=names
                    )

    wanted = units.select("unit", "deleted", "learn", "sizes", "vocabulary", "tokens")
    return wanted.mapInArrow(run, _KEYS)


def _added(keys: list[np.ndarray], counts: list[np.ndarray], deleted: list[bool]):
    """For each unit the totals of its keys; in deleted units, without what deleted units hold. And the totals."""
    if not keys or not sum(map(len, keys)):
        return [b""] * len(keys), np.zeros(0)
    _, slot = np.unique(np.concatenate(keys), return_inverse=True)
    slot, flat = slot.ravel(), np.concatenate(counts).astype(float)
    total = np.bincount(slot, flat)
    part = np.repeat(np.array(deleted, bool), [len(k) for k in keys])
    left = total - np.bincount(slot[part], flat[part], len(total))
    answers, at = [], 0
    for own, out in zip(keys, deleted, strict=True):
        mine = slot[at : at + len(own)]
        both = [total[mine]] + ([left[mine]] if out else [])
        answers.append(packed(np.concatenate(both).astype(np.uint64)))
        at += len(own)
    return answers, total


def _answers(asked: DataFrame) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        data = rows.to_pydict()
        found = {}
        for kind in ("one", "two"):
            keys = [unpacked(k, np.uint64) for k in data[f"{kind}s"]]
            counts = [unpacked(c, np.uint32) for c in data[f"{kind}_counts"]]
            found[kind] = _added(keys, counts, data["deleted"])
        n, totals = rows.num_rows, found["one"][1]
        first = [i == 0 for i in range(n)]
        return pa.table(
            {
                "unit": pa.array(data["unit"], pa.string()),
                "deleted": pa.array(data["deleted"], pa.bool_()),
                "shard": pa.array(data["shard"], pa.int32()),
                "distinct": pa.array([int((totals > 0).sum()) if f else 0 for f in first], pa.int64()),
                "total": pa.array([int(totals.sum()) if f else 0 for f in first], pa.int64()),
                "one_totals": pa.array(found["one"][0], pa.binary()),
                "two_totals": pa.array(found["two"][0], pa.binary()),
            }
        )

    return asked.groupBy("shard").applyInArrow(run, _ANSWERS)


@dataclass
class Model:
    tokens: int  # N
    distinct: int  # V
    weights: np.ndarray  # a row a bucket: bigram, unigram, uniform


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, then one for each power of two."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(int) + 1, BUCKETS - 1), 0)


def _totals(answers: pa.Table, kind: str, size: int, deleted: bool) -> tuple[np.ndarray, np.ndarray]:
    """The totals in the order of the unit's sorted keys; shards are stretches of that order."""
    rows = sorted(zip(answers["shard"].to_pylist(), answers[f"{kind}_totals"].to_pylist(), strict=True))
    full, left = [np.zeros(0)], [np.zeros(0)]
    for _, data in rows:
        values = unpacked(data, np.uint64).astype(float) if data else np.zeros(0)
        half = len(values) // 2 if deleted else len(values)
        full.append(values[:half])
        left.append(values[half:])
    total = np.concatenate(full)
    if len(total) != size:
        raise ValueError("a unit got answers for other keys than it asked for")
    return total, np.concatenate(left)


def _looked_up(unit: dict, answers: pa.Table, leave_out: bool):
    """(context count, bigram count, unigram count) of each token of a unit."""
    hashes, tokens = unpacked(unit["vocabulary"], np.uint64), unpacked(unit["tokens"], np.uint32)
    ones, at_one, twos, at_two = _grams(hashes, tokens)
    one = _totals(answers, "one", len(ones), unit["deleted"])[leave_out]
    two = _totals(answers, "two", len(twos), unit["deleted"])[leave_out]
    own = one[at_one]
    place = np.flatnonzero(tokens == _END)[0]
    context = np.append(own[place], own[:-1])
    return context, two[at_two], own


def _ratio_cells(unit: dict, answers: pa.Table, n: float, v: int) -> pa.Table:
    context, two, one = _looked_up(unit, answers, leave_out=True)
    floor = 1 / (v + 1)

    def cell(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.rint(np.log2(np.maximum(p, 1e-300) / floor) * _STEPS) + 1000, 0).astype(np.int64)

    p2 = np.where(context > 0, two / np.maximum(context, 1), 0)
    keys = bucket_of(context) << 32 | cell(p2) << 16 | cell(one / max(n, 1))
    keys, counts = np.unique(keys, return_counts=True)
    return pa.table({"cell": pa.array(keys, pa.int64()), "n": pa.array(counts, pa.int64())})


def learned_weights(cells: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Mixture weights of each bucket by expectation maximisation; empty buckets get those of all together."""

    def ratio(cell: np.ndarray) -> np.ndarray:
        return np.where(cell > 0, 2.0 ** ((cell - 1000) / _STEPS), 0)

    bucket = cells >> 32
    p = np.stack([ratio(cells >> 16 & 0xFFFF), ratio(cells & 0xFFFF), np.ones(len(cells))], axis=1)

    def fitted(rows: np.ndarray, seen: bool) -> np.ndarray:
        weights = np.full(3, 1 / 3) if seen else np.array([0, 0.5, 0.5])
        for _ in range(rounds):
            share = p[rows] * weights
            share /= share.sum(axis=1, keepdims=True)
            weights = counts[rows] @ share
            weights /= weights.sum()
        weights = np.maximum(weights, [0, 1e-4, 1e-4])
        return weights / weights.sum()

    every = np.arange(len(cells))
    usual = fitted(every, True) if len(cells) else np.array([0.4, 0.5, 0.1])
    found = np.tile(usual, (BUCKETS, 1))
    for b in range(BUCKETS):
        rows = np.flatnonzero(bucket == b)
        if len(rows):
            found[b] = fitted(rows, b > 0)
    if not (bucket == 0).any():
        found[0] = [0, usual[1] + usual[0], usual[2]]
    return found


def _scored(unit: dict, answers: pa.Table, model: Model) -> pa.Table:
    context, two, one = _looked_up(unit, answers, leave_out=False)
    n, v = model.tokens, model.distinct
    weights = model.weights[bucket_of(context)]
    p = weights[:, 0] * two / np.maximum(context, 1) + weights[:, 1] * one / max(n, 1) + weights[:, 2] / (v + 1)
    sizes = np.array(unit["sizes"])
    starts = np.append(0, np.cumsum(sizes)[:-1])
    base = np.log10((one + 0.1) / (n + 0.1 * (v + 1)))
    return pa.table(
        {
            "doc_id": pa.array(unit["doc_ids"], pa.int64()),
            "held_out": pa.array(unit["held_out"], pa.bool_()),
            "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": pa.array(np.add.reduceat((one > 0).astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(len(sizes), n, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, starts)),
            "score": pa.array(np.add.reduceat(np.log10(p), starts)),
        }
    )


def score(docs: DataFrame, folds: int = 10, held_out: int = 0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = _kept_units(_units(docs, folds, held_out), partitions)
    keys = units.agg(F.sum("n_keys")).first()[0] or 0
    bits = max(0, (max(keys, 1) // SHARD_KEYS).bit_length())
    answers = stored(_answers(_asked(units, bits)), "lm-answers")
    n, v = answers.agg(F.sum("total"), F.sum("distinct")).first()
    n, v = n or 0, v or 0

    def cells(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [_ratio_cells(u, right, n, v) for u in left.to_pylist()]
        return pa.concat_tables(parts) if parts else pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})

    deleted = units.where("deleted")
    theirs = answers.where("deleted")
    learned = (
        deleted.groupBy("unit").cogroup(theirs.groupBy("unit")).applyInArrow(cells, "cell long, n long")
        .groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    )
    weights = learned_weights(learned["cell"].to_numpy(), learned["n"].to_numpy().astype(float))
    model = Model(int(n), int(v), weights)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.concat_tables([_scored(u, right, model) for u in left.to_pylist()])

    return units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(
        scored,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
