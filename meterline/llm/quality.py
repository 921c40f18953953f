"""Document quality by hierarchical empirical Bayes.

A logistic model on features of a text gives each document's evidence: its log odds less those of the labelled rows.
The model's probabilities, summed over all documents by host and by path within the host, give the sites' shares of
good documents. Hosts are shrunk toward the global share, paths toward their host; the strengths come from the
spread of the shares between sites (method of moments), so a site with few documents says little. A document's
own probability is left out of its site's sums. The posterior adds the document's evidence to its path's prior.

The model is fitted on at most ``fit_rows`` labelled rows, those with the smallest hash of the id; everything
else covers all rows.

Defined results: null and empty texts have no words, which the features say; a null host or path is a site of its
own; labels that are null are not used, several labels of one id are averaged; without usable labels of both kinds
the evidence is zero and the posterior is one half; repeated rows count as often as they occur; an empty table
gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import fit_logistic, fresh, logit, stored

FIT_ROWS = 20_000
FEATURES = 16


def _classes() -> np.ndarray:
    """Byte classes, one column each: upper case, lower case, digits, sentence marks, other marks, high bytes."""
    table = np.zeros((256, 6))
    table[65:91, 0] = 1
    table[97:123, 1] = 1
    table[48:58, 2] = 1
    table[[ord(c) for c in ".,;:?'\"-()"], 3] = 1
    table[128:, 5] = 1
    marks = [b for b in range(33, 127) if not table[b].any()]
    table[marks, 4] = 1
    return table


CLASSES = _classes()


def features(text: str | None) -> np.ndarray:
    """What marks prose: letter case, marks, repetition of words, runs and lines, lengths."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = max(len(words), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES
    seen = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    size = max(len(raw), 1)
    letters = max(counts[0] + counts[1] + counts[5], 1)
    top = max(seen.values(), default=0)
    runs = sum(map(eq, words, words[1:]))
    repeated_lines = 1 - len(set(lines)) / max(len(lines), 1)
    distinct = len(seen) / n
    return np.array(
        [
            np.log1p(len(words)),
            counts[0] / letters,
            counts[2] / size,
            counts[3] / size,
            np.sqrt(counts[4] / size),
            min(counts[4] / n, 4.0),
            counts[5] / size,
            distinct,
            distinct * np.log1p(len(words)),
            top / n,
            runs / n,
            np.sqrt(runs / n),
            repeated_lines,
            min(len(raw) / n, 30.0),
            float(not words),
            min(raw.count(b"|") / n, 1.0),
        ]
    )


@dataclass
class Classifier:
    """Standardised features, their squares, and weights with the intercept last."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float  # log odds of the rows it was fitted on

    def design(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z], axis=1)

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = self.design(np.stack([features(t) for t in texts]))
        return np.round(x @ self.weights[:-1] + self.weights[-1] - self.base, 9)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Classifier:
    """At most ``fit_rows`` ids with their labels are broadcast, and as many rows of features reach the driver."""
    marks = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("double"))
    chosen = (
        marks.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))],
                names=["doc_id", "quality", "x"],
            )

    joined = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
    table = joined.mapInArrow(run, "doc_id long, quality double, x array<double>")
    table = table.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(2 * fit_rows).toArrow()
    y = table.column("quality").to_numpy()
    if not len(y) or y.min() == y.max():
        return Classifier(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(2 * FEATURES + 1), 0.0)
    x = np.stack(table.column("x").to_pylist())
    model = Classifier(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6), np.zeros(0), float(logit(y.mean())))
    model.weights = fit_logistic(model.design(x), y)
    return model


def _evidence(docs: DataFrame, model: Classifier, name: str) -> DataFrame:
    """The rows with all their columns and the model's evidence."""
    at = docs.columns.index("text")
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.evidence(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


def _strength(sites: DataFrame, parent: str) -> float:
    """How many documents the parent's share is worth: share * (1 - share) / variance between sites - 1."""
    share, own = F.col("good") / F.col("n"), F.col(parent)
    noise = own * (1 - own) / F.col("n")
    row = sites.where("n >= 2").agg(
        F.sum(F.col("n") * own * (1 - own)).alias("within"),
        F.sum(F.col("n") * ((share - own) * (share - own) - noise)).alias("between"),
        F.sum("n").alias("n"),
    ).first()
    if not row.n or not row.within:
        return 100.0
    between = max(row.between / row.n, 1e-6)
    return float(min(max(row.within / row.n / between - 1, 1.0), 10_000.0))


def site_priors(scored: DataFrame, base: float) -> tuple[DataFrame, float, float, float]:
    """(host, path, path_good, path_n, host_good, host_n) of each site, the global share and both strengths.

    The sums are whole millionths, so that they do not depend on the order of addition."""
    p = F.round(1e6 / (1 + F.exp(-(F.col("evidence") + base)))).cast("long")
    paths = scored.groupBy("host", "path").agg(F.sum(p).alias("good"), F.count(F.lit(1)).alias("n"))
    paths = stored(paths.select("host", "path", (F.col("good") / 1e6).alias("good"), "n"), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "hosts")
    whole = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    share = float(whole.good / whole.n) if whole.n else 0.5
    host_strength = _strength(hosts.withColumn("share", F.lit(share)), "share")
    host_mean = (F.col("host_good") + host_strength * share) / (F.col("host_n") + host_strength)
    named = hosts.select(F.col("host").alias("h"), F.col("good").alias("host_good"), F.col("n").alias("host_n"))
    sites = paths.join(named, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    path_strength = _strength(sites.withColumn("host_mean", host_mean), "host_mean")
    sites = sites.select(
        "host", "path", F.col("good").alias("path_good"), F.col("n").alias("path_n"), "host_good", "host_n"
    )
    return stored(sites, "sites"), share, host_strength, path_strength


def _posterior(evidence: Column, base: float, share: float, host_k: float, path_k: float) -> Column:
    """The document's posterior; its own probability is taken out of its sites' sums."""
    own = F.round(1e6 / (1 + F.exp(-(evidence + base)))) / 1e6
    host = (F.col("host_good") - own + host_k * share) / (F.col("host_n") - 1 + host_k)
    path = (F.col("path_good") - own + path_k * host) / (F.col("path_n") - 1 + path_k)
    prior = F.least(F.greatest(path, F.lit(1e-6)), F.lit(1 - 1e-6))
    return 1 / (1 + F.exp(-(evidence + F.log(prior / (1 - prior)))))


def posteriors(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, least: float = 0.5) -> DataFrame:
    """(doc_id, host, path, evidence, quality, keep) of every row; ``docs`` has doc_id, text, host, path."""
    named = docs.select(
        F.col("doc_id").cast("long"),
        F.col("host").cast("string"),
        F.col("path").cast("string"),
        F.col("text").cast("string"),
    )
    model = fit(named, labels, fit_rows)
    scored = stored(_evidence(named, model, "evidence").drop("text"), "evidence")
    sites, share, host_k, path_k = site_priors(scored, model.base)
    places = sites.withColumnsRenamed({"host": "site_host", "path": "site_path"})
    same = F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path"))
    quality = _posterior(F.col("evidence"), model.base, share, host_k, path_k)
    rows = scored.join(places, same).withColumn("quality", quality)
    return rows.select("doc_id", "host", "path", "evidence", "quality", (F.col("quality") >= least).alias("keep"))


def good_documents(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, fit_rows: int = FIT_ROWS, least: float = 0.5
) -> DataFrame:
    """The rows, with all their columns, whose posterior is ``least`` or more."""
    names = docs.columns
    evidence, h, p = (fresh(n, names) for n in ("evidence", "host", "path"))
    model = fit(docs, labels, fit_rows)
    scored = _evidence(docs, model, evidence)
    sited = scored.withColumns({h: host.cast("string"), p: path.cast("string")})
    narrow = stored(sited.select(F.col(evidence).alias("evidence"), F.col(h).alias("host"), F.col(p).alias("path")), "evidence")
    sites, share, host_k, path_k = site_priors(narrow, model.base)
    wanted = ["path_good", "path_n", "host_good", "host_n"]
    row = sited.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), evidence, h, p)
    same = F.col(h).eqNullSafe(F.col("site_host")) & F.col(p).eqNullSafe(F.col("site_path"))
    places = sites.select(F.col("host").alias("site_host"), F.col("path").alias("site_path"), *wanted)
    quality = _posterior(F.col(evidence), model.base, share, host_k, path_k)
    return row.join(places, same).where(quality >= least).select("row.*")
