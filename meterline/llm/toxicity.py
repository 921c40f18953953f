"""Toxicity by a chain of linear classifiers.

Categories are predicted in a fixed order. Each is a logistic model on the presence of byte n-grams (of the text
with A-Z lower-cased and white space as spaces) and on the probabilities of the categories before it. Later models
are trained on out-of-fold probabilities: those of a model that did not see the row, nor any row of the same text, as
folds are dealt by a hash of the text. The n-grams of a category are the ``features`` ones whose presence differs most
(chi square) between rows with and without it; they are chosen once, from the rows of all folds.

The chain is fitted on the rows of at most ``fit_rows`` labelled ids, those with the smallest hash of the id, and on
at most twice as many rows where ids repeat. Every row is scored, over its whole text.

Defined results: null and empty texts have no n-grams and get the chain's base rates; null labels are taken as
0, rows without any label of the chain are not used, several labels of one id are averaged and rounded up at one
half; a category without rows of both kinds gets its share of rows as a constant; repeated rows are each scored;
an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import fit_logistic, logit, mixed, rolling, sigmoid, slices, stored

FIT_ROWS = 12_000
FEATURES = 512
WIDTH = 5
FOLDS = 4
_PIECE = 1_000_000
_FILTER_BITS = 22


def _fold_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[0, 9, 10, 11, 12, 13]] = 32
    return table


FOLD = _fold_table()


def grams(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every n-gram of the texts; a text is surrounded by spaces."""
    raw = [b" %b " % (t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    values = FOLD[np.frombuffer(b"".join(raw), np.uint8)]
    hashes = mixed(rolling(values, width))
    row = np.repeat(np.arange(len(raw)), sizes)
    if len(hashes) == 0:
        return np.zeros(0, np.int64), hashes
    inside = row[: len(hashes)] == row[width - 1 :]
    return row[: len(hashes)][inside], hashes[inside]


def distinct_grams(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) with each n-gram once a text."""
    row, value = grams(texts, width)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[first], value[first]


@dataclass
class Chain:
    categories: list[str]
    keys: np.ndarray  # sorted hashes of the n-grams used
    weights: list[np.ndarray]  # one a category: n-grams, earlier categories' log odds, intercept

    def presence(self, texts: list[str | None], width: int = WIDTH) -> np.ndarray:
        found = np.zeros((len(texts), len(self.keys)))
        if not len(self.keys):
            return found
        may = np.zeros(1 << _FILTER_BITS, bool)
        may[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        for start, end in slices((len(t or "") + 2 for t in texts), _PIECE):
            row, value = grams(texts[start:end], width)
            at = may[value >> np.uint64(64 - _FILTER_BITS)]
            row, value = row[at], value[at]
            slot = np.minimum(np.searchsorted(self.keys, value), len(self.keys) - 1)
            good = self.keys[slot] == value
            found[start + row[good], slot[good]] = 1
        return found

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return apply_chain(self.presence(texts), self.weights)


def apply_chain(x: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """Probabilities, a column a category; each model also sees the log odds of those before it."""
    found = np.zeros((len(x), 0))
    for w in weights:
        design = np.concatenate([x, np.clip(logit(found), -6, 6)], axis=1)
        found = np.concatenate([found, sigmoid(design @ w[:-1] + w[-1])[:, None]], axis=1)
    return np.round(found, 9)


def _constant(y: np.ndarray) -> bool:
    return not len(y) or y.min() == y.max()


def _model(x: np.ndarray, y: np.ndarray, ridge: float, start: np.ndarray | None = None) -> np.ndarray:
    if _constant(y):
        share = float(logit(np.array((y.sum() + 0.5) / (len(y) + 1))))
        return np.append(np.zeros(x.shape[1]), share)
    return fit_logistic(x, y, ridge, start=start)


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, ridge: float = 1.0) -> list[np.ndarray]:
    """A model a category; its inputs from earlier categories are out-of-fold probabilities."""
    earlier, weights = np.zeros((len(x), 0)), []
    for category in range(labels.shape[1]):
        design = np.concatenate([x, np.clip(logit(earlier), -6, 6)], axis=1)
        y = labels[:, category]
        unseen, w = np.zeros(len(x)), None
        for f in range(FOLDS):
            out = fold == f
            model = _model(design[~out], y[~out], ridge, w)
            unseen[out] = sigmoid(design[out] @ model[:-1] + model[-1])
            # A constant is no start for the next fold: steps from where all rows look alike go far astray.
            w = w if _constant(y[~out]) else model
        weights.append(_model(design, y, ridge, w))
        earlier = np.concatenate([earlier, unseen[:, None]], axis=1)
    return weights


def fit(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], fit_rows: int = FIT_ROWS, features: int = FEATURES
) -> Chain:
    """``categories`` gives each category's label, 0 or 1, from the columns of ``labels``, in the chain's order."""
    names = list(categories)
    marks = labels.select(F.col("doc_id").cast("long"), *[c.cast("double").alias(n) for n, c in categories.items()])
    marks = marks.where(F.col("doc_id").isNotNull() & F.coalesce(*names).isNotNull())
    marks = marks.groupBy("doc_id").agg(
        *[(F.avg(F.coalesce(n, F.lit(0.0))) >= 0.5).cast("int").alias(n) for n in names]
    )
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int").alias("fold")
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.array(*names).alias("y"), fold)

    k = len(names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            y = np.array(batch.column(2).to_pylist(), np.int64).reshape(len(texts), k)
            for start, end in slices((len(t or "") + 2 for t in texts), 4 * _PIECE):
                row, value = distinct_grams(texts[start:end])
                keys, slot = np.unique(value, return_inverse=True)
                seen = [np.bincount(slot, minlength=len(keys))]
                seen += [np.bincount(slot, y[start:end][row, c], len(keys)) for c in range(k)]
                columns = [pa.array(keys.view(np.int64))] + [pa.array(s.astype(np.int64)) for s in seen]
                yield pa.RecordBatch.from_arrays(columns, names=["gram", "n", *[f"n{c}" for c in range(k)]])

    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("y", F.lit(c))).alias(f"n{c}") for c in range(k)])
    whole = totals.first()
    n = whole.n
    fields = ", ".join(["gram long", "n long", *[f"n{c} long" for c in range(k)]])
    seen = sample.mapInArrow(count, fields).groupBy("gram").agg(
        F.sum("n").alias("n"), *[F.sum(f"n{c}").alias(f"n{c}") for c in range(k)]
    )
    seen = stored(seen.where("n >= 5"), "toxicity-grams")
    picked: set[int] = set()
    for c in range(k):
        positive = whole[f"n{c}"] or 0
        if not 0 < positive < n:
            continue
        a, b = F.col(f"n{c}").cast("double"), F.col("n") - F.col(f"n{c}")
        lean = a * (n - positive) - b * positive
        spread = F.col("n") * (n - F.col("n") + 0.5) * float(positive) * float(n - positive)
        best = seen.orderBy((lean * lean / spread).desc(), "gram").limit(features)
        picked |= {r.gram for r in best.select("gram").collect()}
    keys = np.sort(np.array(sorted(picked), np.int64).view(np.uint64))
    chain = Chain(names, keys, [])

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = chain.presence(batch.column(1).to_pylist())
            slots = [np.flatnonzero(r).astype(np.int32) for r in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(slots, pa.list_(pa.int32())), batch.column(3)],
                names=["doc_id", "y", "slots", "fold"],
            )

    design = sample.mapInArrow(present, "doc_id long, y array<int>, slots array<int>, fold int")
    table = design.orderBy(F.xxhash64("doc_id"), "doc_id", "slots").limit(2 * fit_rows).toArrow()
    y = np.array(table.column("y").to_pylist(), float).reshape(table.num_rows, k)
    x = np.zeros((table.num_rows, len(keys)))
    for i, slots in enumerate(table.column("slots").to_pylist()):
        x[i, slots] = 1
    chain.weights = fit_chain(x, y, table.column("fold").to_numpy())
    return chain


def score(docs: DataFrame, chain: Chain, least: float = 0.5) -> DataFrame:
    """(doc_id, p_<category>..., is_<category>...) of every row."""
    names = chain.categories

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                found.append(chain.probabilities(texts[at : at + 500]))
            p = np.concatenate(found) if found else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p[:, c]) for c in range(len(names))], *[pa.array(p[:, c] >= least) for c in range(len(names))]],
                names=["doc_id", *[f"p_{n}" for n in names], *[f"is_{n}" for n in names]],
            )

    fields = ["doc_id long", *[f"p_{n} double" for n in names], *[f"is_{n} boolean" for n in names]]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ", ".join(fields))
