"""Benchmark decontamination by the q-gram lemma and banded alignment.

Characters are folded one to one (simple lower case, white space to a space). A region within ``k`` edits of an item
of length L shares at least ``L - q + 1 - k * q`` of the item's q-grams, and their diagonals (text position less item
position) differ by at most ``k``. So hits are counted in bands of ``2 * (k + 1)`` diagonals that overlap by half,
bands that reach the bound are kept, and each is verified by aligning the whole item inside the band, ``k`` diagonals
wider on both sides. ``k`` is ``error`` times L, lowered where needed so that the bound is at least one.

Of an item of over ``WINDOW`` words each run of so many words, every ``STRIDE`` words, is searched for as well, so that
a passage of ``WINDOW + STRIDE`` words of an item is found wherever it is cut. Such a region is given where the whole
item does not match. Items of fewer than ``shortest`` characters besides white space, or shorter than q, are too short
for a budget of edits: they match where they stand folded, letter by letter, between characters that are no letters or digits.

The items are a stated query set. They are read in blocks of at most ``block_chars`` characters, each block against
all rows, so what a task holds is bounded whatever the size of the benchmark.

Defined results: items that are null or have no letter or digit are not searched
for; a null item_id is carried as it is; null and empty texts match nothing; equal items each match; repeated rows
each give their matches; of overlapping matches of an item that with fewest edits is given, then the first; long
texts are read whole, in pieces that overlap. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import code_points, mixed, rolling, slices, stored

Q = 10
ERROR = 0.07
SHORTEST = 24
WINDOW = 50
STRIDE = 25
_PIECE = 1_000_000
_TABLE_BITS = 23


def _folds() -> np.ndarray:
    table = np.arange(1 << 16, dtype=np.uint32)
    for cp in range(1 << 16):
        ch = chr(cp)
        if ch.isspace():
            table[cp] = 32
        elif len(low := ch.lower()) == 1:
            table[cp] = ord(low)
    return table


_FOLDS: list[np.ndarray] = []


def folded(text: str) -> np.ndarray:
    if not _FOLDS:
        _FOLDS.append(_folds())
    points = code_points(text)
    low = points < 1 << 16
    return np.where(low, _FOLDS[0][np.where(low, points, 0)], points)


@dataclass
class Item:
    item_id: int | None
    points: np.ndarray
    edits: int
    bound: int
    part_of: int = -1  # the place of the item it is a window of
    short: bool = False


def edit_budget(length: int, q: int = Q, error: float = ERROR) -> tuple[int, int]:
    """The edits allowed, and the q-grams that must then be shared."""
    edits = min(int(error * length), max(0, (length - q) // q))
    return edits, length - q + 1 - edits * q


def _windows(points: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of ``WINDOW`` words, one every ``STRIDE`` words and one at the end."""
    word = points != 32
    starts = np.flatnonzero(word & ~np.append(False, word[:-1]))
    ends = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
    last = len(starts) - WINDOW
    if last > 0:
        for i in sorted({*range(0, last, STRIDE), last}):
            yield points[starts[i] : ends[i + WINDOW - 1]]


def _spelled(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def items_of(rows: list[tuple[int | None, str | None]], q: int = Q, error: float = ERROR, shortest: int = SHORTEST):
    """Items, after them their windows."""
    found = []
    for item_id, text in rows:
        points = folded((text or "").strip())
        if not any(map(str.isalnum, text or "")):
            continue
        if (points != 32).sum() < shortest or len(points) < q:
            found.append(Item(item_id, points, 0, len(points), short=True))
        else:
            found.append(Item(item_id, points, *edit_budget(len(points), q, error)))
    windows = []
    for i, item in enumerate(found):
        for part in _windows(item.points):
            if len(part) >= q:
                windows.append(Item(item.item_id, part, *edit_budget(len(part), q, error), part_of=i))
    return found + windows


def _automaton(items: list[Item]):
    """Short items by their folded text, or None."""
    places: dict[str, list[int]] = {}
    for i, item in enumerate(items):
        if item.short:
            places.setdefault(_spelled(item.points), []).append(i)
    if not places:
        return None
    found = ahocorasick.Automaton()
    for text, of in places.items():
        found.add_word(text, (len(text), of))
    found.make_automaton()
    return found


class Index:
    """Where each q-gram occurs in the items."""

    def __init__(self, items: list[Item], q: int = Q):
        self.items, self.q = items, q
        nothing = np.zeros(0, np.uint64)
        grams = [nothing if i.short else mixed(rolling(i.points, q)) for i in items]
        self.short = _automaton(items)
        self.longest = max((len(i.points) for i in items), default=0)
        self.most_edits = max((i.edits for i in items), default=0)
        all_grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else item
        order = np.argsort(all_grams, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.keys, self.first, self.count = np.unique(all_grams[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << _TABLE_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - _TABLE_BITS)] = True
        self.edits = np.array([i.edits for i in items], np.int64)
        self.bounds = np.array([i.bound for i in items], np.int64)

    def hits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text position, item, item position) of every shared q-gram."""
        grams = mixed(rolling(points, self.q))
        at = np.flatnonzero(self.filter[grams >> np.uint64(64 - _TABLE_BITS)])
        slot = np.searchsorted(self.keys, grams[at])
        good = slot < len(self.keys)
        good[good] = self.keys[slot[good]] == grams[at][good]
        at, slot = at[good], slot[good]
        n = self.count[slot]
        posting = np.repeat(self.first[slot] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return np.repeat(at, n), self.item[posting], self.place[posting]


_FAR = 1 << 40


def banded_alignment(
    item: np.ndarray, text: np.ndarray, low: int | None = None, high: int | None = None
) -> tuple[int, int, int]:
    """(edits, start, end) of the best match of the whole item inside the text on the diagonals (text position less
    item position) from ``low`` to ``high``; the first end, then the latest start. All diagonals if none are given."""
    n = len(text)
    low = -len(item) if low is None else low
    high = n if high is None else high
    diagonals = np.arange(low, high + 1)
    row = np.where((diagonals >= 0) & (diagonals <= n), 0, _FAR)
    start = diagonals.copy()
    padded = np.concatenate([np.full(max(0, -low), -1, np.int64), text, np.full(max(0, high + len(item) - n), -1, np.int64)])
    shift = max(0, -low)
    for i, symbol in enumerate(item):
        at = i + low + shift
        swap = row + (padded[at : at + len(diagonals)] != symbol)
        drop = np.append(row[1:], _FAR) + 1
        use = swap <= drop
        best = np.where(use, swap, drop)
        origin = np.where(use, start, np.append(start[1:], 0))
        place = diagonals + i + 1
        best[(place < 0) | (place > n)] = _FAR
        level = best - diagonals
        least = np.minimum.accumulate(level)
        keep = np.maximum.accumulate(np.where(level == least, np.arange(len(diagonals)), 0))
        row, start = least + diagonals, origin[keep]
        row[(place < 0) | (place > n)] = _FAR
    end = int(row.argmin())
    return int(row[end]), int(start[end]), int(diagonals[end] + len(item))


def _short_matches(points: np.ndarray, index: Index) -> list[tuple[int, int, int, int, int]]:
    """Short items where no letter or digit stands before or after them."""
    if index.short is None:
        return []
    text = _spelled(points)
    found = []
    for last, (size, items) in index.short.iter(text):
        lo, hi = last + 1 - size, last + 1
        if not (lo and text[lo - 1].isalnum() and text[lo].isalnum()):
            if not (hi < len(text) and text[hi].isalnum() and text[last].isalnum()):
                found += [(i, lo, hi, 0, max(0, size - index.q + 1)) for i in items]
    return found


def matches(points: np.ndarray, index: Index) -> list[tuple[int, int, int, int, int]]:
    """(item, start, end, edits, shared q-grams) of every region of one text."""
    found = _short_matches(points, index)
    reach = index.longest + index.most_edits + index.q
    for at in range(0, max(len(points), 1), _PIECE):
        lo = max(0, at - 2 * reach)
        found += [(i, lo + s, lo + e, d, n) for i, s, e, d, n in _matches(points[lo : at + _PIECE], index)]
    return _disjoint(found, index.items)


def _bands(at: np.ndarray, item: np.ndarray, place: np.ndarray, index: Index):
    """(item, band, hits) of the bands that reach their bound."""
    width = index.edits[item] + 1
    band = (at - place + index.longest) // width
    key = np.concatenate([item << 40 | band + 1, item << 40 | band])
    key, hits = np.unique(key, return_counts=True)
    own = key >> 40
    good = hits >= index.bounds[own]
    return own[good], (key[good] & (1 << 40) - 1) - 1, hits[good]


def _matches(points: np.ndarray, index: Index):
    at, item, place = index.hits(points)
    if not len(at):
        return []
    found = []
    whole: dict[int, list[tuple[int, int]]] = {}
    for own, band, hits in zip(*_bands(at, item, place, index), strict=True):  # items come before their windows
        it = index.items[own]
        width = it.edits + 1
        left = band * width - index.longest
        lo = max(0, left - it.edits)
        hi = min(len(points), left + 2 * width + len(it.points) + it.edits)
        if any(s <= lo + 2 * width and hi - 2 * width <= e for s, e in whole.get(it.part_of, ())):
            continue
        if hi <= lo:
            continue
        edits, s, e = banded_alignment(it.points, points[lo:hi], left - it.edits - lo, left + 2 * width + it.edits - lo)
        if edits <= it.edits:
            found.append((int(own), int(lo + s), int(lo + e), edits, int(hits)))
            if it.part_of < 0:
                whole.setdefault(int(own), []).append((lo, hi))
    return found


def _disjoint(found, items: list[Item]):
    """Windows count for their item, after the whole of it; of what overlaps the best stays."""
    kept = []
    named = {(items[r[0]].part_of if items[r[0]].part_of >= 0 else r[0], items[r[0]].part_of >= 0, *r[1:]) for r in found}
    for item, _, *row in sorted(named, key=lambda r: (r[0], r[1], r[4], r[2], r[3], -r[5])):
        if not any(k[0] == item and row[0] < k[2] and k[1] < row[1] for k in kept):
            kept.append((item, *row))
    return kept


def blocks(benchmark: DataFrame, block_chars: int = 4_000_000) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in blocks of bounded size, one block at a time on the driver."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    total, longest = rows.agg(F.sum(F.length("text")), F.max(F.length("text"))).first()
    n = -(-(total or 0) // max(block_chars - (longest or 0), block_chars // 2))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    dealt = rows if n <= 1 else stored(rows.withColumn("block", block), "benchmark-blocks")
    for b in range(n):
        part = dealt if n <= 1 else dealt.where(F.col("block") == b).drop("block")
        yield [tuple(r) for r in part.orderBy("item_id", "text").collect()]


def contaminated_regions(
    docs: DataFrame, benchmark: DataFrame, q: int = Q, error: float = ERROR, block_chars: int = 4_000_000
) -> DataFrame:
    """(doc_id, item_id, start, length, edits, shared_qgrams) of every region; positions are in code points."""
    schema = "doc_id long, item_id long, start long, length long, edits int, shared_qgrams long"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    result = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, block_chars):
        items = items_of(block, q, error)
        if items:
            result = result.union(rows.mapInArrow(_finder(items, q), schema))
    return result


def _finder(items: list[Item], q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, q)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            found = _rows_with_matches(texts, index)
            columns = list(zip(*found, strict=True)) if found else [()] * 6
            ids = ids.take(pa.array(columns[0], pa.int64()))
            item_ids = [index.items[i].item_id for i in columns[1]]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(item_ids, pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array([e - s for s, e in zip(columns[2], columns[3], strict=True)], pa.int64()),
                    pa.array(columns[4], pa.int32()),
                    pa.array(columns[5], pa.int64()),
                ],
                names=["doc_id", "item_id", "start", "length", "edits", "shared_qgrams"],
            )

    return run


def _rows_with_matches(texts: list[str | None], index: Index):
    """(row, item, start, end, edits, shared) of a batch. Texts are searched together for hits, which are rare, and
    only those with enough of them one by one."""
    found = []
    least = min((item.bound for item in index.items if not item.short), default=1)
    for start, end in slices((len(t or "") + 1 for t in texts), _PIECE):
        part = [t or "" for t in texts[start:end]]
        if len(part) == 1:
            found += [(start, *m) for m in matches(folded(part[0]), index)]
            continue
        points = folded("\x00".join(part))
        grams = mixed(rolling(points, index.q))
        at = np.flatnonzero(index.filter[grams >> np.uint64(64 - _TABLE_BITS)])
        begin = np.append(0, np.cumsum([len(t) + 1 for t in part]))
        hits = np.diff(np.searchsorted(at, begin))
        for i in np.flatnonzero(hits >= least) if index.short is None else range(len(part)):
            own = points[begin[i] : begin[i + 1] - 1] if i + 1 < len(part) else points[begin[i] :]
            found += [(int(start + i), *m) for m in matches(own, index)]
    return found


def uncontaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, error: float = ERROR) -> DataFrame:
    """The rows, with all their columns, without a region that matches an item."""
    at = docs.columns.index("text")
    kept = docs
    for block in blocks(benchmark):
        items = items_of(block, q, error)
        if items:
            kept = kept.mapInArrow(_cleaner(items, q, at), docs.schema)
    return kept


def _cleaner(items: list[Item], q: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, q)
        for batch in batches:
            bad = {r[0] for r in _rows_with_matches(batch.column(at).to_pylist(), index)}
            yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

    return run
