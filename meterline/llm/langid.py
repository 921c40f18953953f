"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram's vector is the product (binding) of its letters'
vectors, the first rolled (permuted) twice and the second once. A text's vector is the sum (bundle) of its trigrams'
vectors, each weighted by the square root of its count. A language's prototype is the sum of the unit vectors of all
its training texts; a text gets the language whose prototype has the largest cosine.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is everything when no row can be
learned from. Equal cosines go to the language first by name. A null ``doc_id`` is neither held out nor learned from.
Repeated rows count as often as they occur. Texts are read whole, in pieces of bounded size. Only the named columns
are read. The score is the cosine, cut to 0..1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import code_points, id_crc, slices

SYMBOLS = 128  # 0: no letter; 1-26: a-z; the rest: other letters, by a hash
UNDETERMINED = "und"
_SCALE = float(1 << 24)
_PIECE = 400_000
_TABLE = 4_000_000  # cells


def _letters() -> np.ndarray:
    table = np.zeros(1 << 16, np.uint8)
    for cp in range(1 << 16):
        ch = chr(cp)
        if ch.isalpha():
            table[cp] = cp - 96 if "a" <= ch <= "z" else 27 + (cp * 40503 >> 4) % (SYMBOLS - 27)
    return table


@dataclass
class Encoder:
    """Turns texts into vectors; vectors of trigrams met so far are kept (at most SYMBOLS**3 of them)."""

    dimensions: int
    seed: int = 7
    known: int = 0
    table: np.ndarray = field(default_factory=_letters)

    def __post_init__(self):
        draw = np.random.default_rng(self.seed)
        self.letter = draw.choice(np.array([-1, 1], np.int8), (SYMBOLS, self.dimensions))
        self.place = np.full(SYMBOLS**3, -1, np.int32)

    def symbols(self, text: str) -> np.ndarray:
        points = code_points(f" {text.lower()} ")
        if len(points) and points.max() >= 1 << 16:
            high = points >= 1 << 16
            letters = np.array([chr(c).isalpha() for c in points[high].tolist()], bool)
            found = self.table[np.where(high, 0, points)]
            found[high] = np.where(letters, 27 + points[high] % (SYMBOLS - 27), 0)
            return found
        return self.table[points]

    def vectors(self, texts: list[str]) -> np.ndarray:
        """A row for each text."""
        return self.bundles(texts)[0]

    def bundles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row for each text, and its number of distinct trigrams."""
        codes, rows = [], []
        for i, text in enumerate(texts):
            for at in range(0, len(text), 4 * _PIECE):  # two characters of overlap
                s = self.symbols(text[max(0, at - 2) : at + 4 * _PIECE]).astype(np.int32)
                code = s[:-2] << 14 | s[1:-1] << 7 | s[2:]
                code = code[s[1:-1] > 0]
                codes.append(code)
                rows.append(np.full(len(code), i, np.int64))
        code, row = np.concatenate(codes or [[]]).astype(np.int64), np.concatenate(rows or [[]])
        if not len(code):
            return np.zeros((len(texts), self.dimensions), np.float32), np.zeros(len(texts), np.int64)
        marks = np.zeros(SYMBOLS**3, bool)
        marks[code] = True
        grams = np.flatnonzero(marks)
        self.place[grams] = np.arange(len(grams))
        a, b, c = grams >> 14, grams >> 7 & 127, grams & 127
        bound = np.roll(self.letter, 2, axis=1)[a] * np.roll(self.letter, 1, axis=1)[b]
        bound = (bound * self.letter[c]).astype(np.float32)
        found = np.zeros((len(texts), self.dimensions), np.float32)
        distinct = np.zeros(len(texts), np.int64)
        step = max(1, _TABLE // len(grams))  # texts whose table of counts is held at once
        for lo in range(0, len(texts), step):
            hi = min(lo + step, len(texts))
            i, j = np.searchsorted(row, (lo, hi))
            at = (row[i:j].astype(np.int64) - lo) * len(grams) + self.place[code[i:j]]
            counts = np.bincount(at, minlength=(hi - lo) * len(grams))
            weights = np.sqrt(counts, dtype=np.float32).reshape(hi - lo, len(grams))
            found[lo:hi] = weights @ bound
            distinct[lo:hi] = np.count_nonzero(weights, axis=1)
        return found, distinct


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray
    dimensions: int

    def predict(self, texts: list[str | None], encoder: Encoder) -> tuple[list[str], np.ndarray]:
        return self.measured(texts, encoder)[:2]

    def measured(self, texts: list[str | None], encoder: Encoder) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, the score and the number of distinct trigrams of each text."""
        names, scores, variety = [], [], []
        sizes = [len(t or "") + 1 for t in texts]
        for start, end in slices(sizes, _PIECE):
            part = texts[start:end]
            if not self.languages:
                names += [UNDETERMINED] * len(part)
                scores.append(np.zeros(len(part)))
                variety.append(np.zeros(len(part), np.int64))
                continue
            bundles, distinct = encoder.bundles([t or "" for t in part])
            variety.append(distinct)
            cosine = unit(bundles) @ self.prototypes.T
            best = cosine.argmax(axis=1)
            known = np.array([has_letter(t) for t in part], bool)
            names += [
                self.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)
            ]
            top = np.clip(cosine[np.arange(len(part)), best], 0, 1)
            scores.append(np.where(known, top, 0.0))
        if not scores:
            return names, np.zeros(0), np.zeros(0, np.int64)
        return names, np.concatenate(scores), np.concatenate(variety)


def learn(docs: DataFrame, dimensions: int = 512) -> Profiles:
    """Prototypes of all rows with a text and a language. One row per language and dimension reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(dimensions), {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in slices((len(t) + 1 for t in texts), _PIECE):
                rows = unit(encoder.vectors(texts[start:end]))
                own = np.array(langs[start:end], object)
                for lang in set(langs[start:end]):
                    sums[lang] = sums.get(lang, 0) + rows[own == lang].sum(axis=0, dtype=float)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * dimensions, pa.string()),
                    pa.array(np.arange(dimensions, dtype=np.int32)),
                    pa.array(np.rint(total * _SCALE).astype(np.int64)),
                ],
                names=["lang", "at", "total"],
            )

    usable = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    parts = usable.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(
        run, "lang string, at int, total long"
    )
    rows = parts.groupBy("lang", "at").agg(F.sum("total").alias("total")).collect()
    languages = sorted({r.lang for r in rows})
    prototypes = np.zeros((len(languages), dimensions))
    place = {lang: i for i, lang in enumerate(languages)}
    for r in rows:
        prototypes[place[r.lang], r.at] = r.total
    return Profiles(languages, unit(prototypes).astype(np.float32), dimensions)


def training_rows(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    return docs.where(id_crc(F.col("doc_id")) % folds != held_out)


def identify(docs: DataFrame, profiles: Profiles, folds: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(profiles.dimensions)
        for batch in batches:
            names, scores = profiles.predict(batch.column(2).to_pylist(), encoder)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    out = F.coalesce(id_crc(F.col("doc_id")) % folds == held_out, F.lit(False)).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long"), out, F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


ENOUGH = 40  # distinct trigrams from which on the whole floor holds


def floor(variety: np.ndarray, dimensions: int, deviations: float = 5.0) -> np.ndarray:
    """The least cosine of a text in a learned language, by its number of distinct trigrams.

    The cosine of unrelated vectors has a standard deviation of ``1 / sqrt(dimensions)``. That of a text in its own
    language grows with the number of trigrams, so texts with few of them get a share of the floor."""
    return deviations / np.sqrt(dimensions) * np.minimum(1, variety / ENOUGH)


def in_a_known_language(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The rows, with all their columns, whose text is in a learned language with a cosine of ``floor`` or more."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(profiles.dimensions)
        for batch in batches:
            names, scores, variety = profiles.measured(batch.column(at).to_pylist(), encoder)
            good = (np.array(names, object) != UNDETERMINED) & (scores >= floor(variety, profiles.dimensions))
            yield batch.filter(pa.array(good.astype(bool)))

    return docs.mapInArrow(run, docs.schema)
