"""Small helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import new_shared_path


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: cuts lineage, and Spark then knows its size."""
    path = new_shared_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name not used by the input."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(doc_id.cast("string"))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; bytes methods treat ASCII only, as wanted."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def slices(sizes: Iterable[int], budget: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs of rows holding about ``budget`` units each; a larger row is alone."""
    start = total = 0
    end = 0
    for end, size in enumerate(sizes, 1):
        if total and total + size > budget:
            yield start, end - 1
            start, total = end - 1, 0
        total += size
    if end > start:
        yield start, end


def arrow_rows(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], type=field.type) for field in schema], schema=schema
    )


def ascii_lower_table() -> np.ndarray:
    folded = np.arange(256, dtype=np.uint8)
    folded[65:91] += 32
    return folded


def rolling(values: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every run of ``width`` values; the result is shorter by ``width - 1``."""
    if len(values) < width:
        return np.empty(0, np.uint64)
    power = values.astype(np.uint64)  # hashes of runs of `have` values
    have, done, result = 1, 0, None
    scale = base
    rest = width
    while rest:
        if rest & 1:
            if result is None:
                result, done = power, have
            else:
                n = len(values) - done - have + 1
                result = result[:n] * np.uint64(scale) + power[done : done + n]
                done += have
        rest >>= 1
        if rest:
            n = len(values) - 2 * have + 1
            power = power[:n] * np.uint64(scale) + power[have : have + n]
            have *= 2
            scale = scale * scale & 0xFFFFFFFFFFFFFFFF
    return result


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that the high bits depend on all bits."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(33)
    v *= np.uint64(0xFF51AFD7ED558CCD)
    v ^= v >> np.uint64(33)
    return v


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30, start: np.ndarray | None = None
) -> np.ndarray:
    """Weights with the intercept last, by Newton steps; y may be fractional. The optimum is unique, so ``start``
    saves steps and does not change it."""
    n, width = x.shape
    design = np.concatenate([x, np.ones((n, 1))], axis=1)
    weights = np.zeros(width + 1) if start is None else start.copy()
    penalty = np.full(width + 1, ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(design @ weights)
        gradient = design.T @ (p - y) + penalty * weights
        scaled = design * np.sqrt(p * (1 - p) + 1e-9)[:, None]
        curvature = scaled.T @ scaled + np.diag(penalty)  # of one matrix with itself: half the work
        step = np.linalg.solve(curvature, gradient)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return weights
