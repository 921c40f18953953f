"""Packing token sequences by minimum bin slack.

Texts become token ids with an end id. Each is cut at multiples of the window, so that at most one piece of a text is
shorter than a window. Windows are then filled from the multiset of piece lengths: the longest remaining length comes
first, and a subset-sum dynamic program over a bitset finds the counts of the remaining lengths that fill the rest
best, read off backwards. A filling is repeated as long as its lengths last. Where even the best filling leaves more
than ``slack`` of a window, one more piece is cut to fill it, and its rest goes back to the multiset.

The plan knows lengths and counts only: at most ``window`` lengths, and for each a few ranges of ranks, whatever
the number of texts. Pieces get ranks within their length by counting within salted groups, so that a length shared
by a third of all pieces is ranked in many tasks.

Defined results: null and empty texts are their end id alone; equal rows are each packed; ids and texts of repeated
``doc_id`` may differ; a null ``doc_id`` is carried; an empty table gives an empty result. Only the named columns are
read. The ids are those of the whole text: words are looked up one by one only where the tokenizer treats them
one by one, and texts with special tokens or rare characters go through the tokenizer whole.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import slices, stored

WINDOW = 4096
END_ID = 2
SLACK = 0.01
_PIECE = 1_000_000
_MOST_WORDS = 600_000
# The tokenizer file's own pattern (a fixed value of the public vocabulary).
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|\n")  # the same on lower-cased ASCII, and line ends
_LATIN_WORD = regex.compile(_WORD.pattern + r"|\n")
_PLAIN = regex.compile(r"[\x21-\x7e\xa1-\xac\xae-įı-ſ]+")
_WHOLE = ("<|", "\x00", "\x1c", "\x1d", "\x1e", "\x1f")


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Numbers(dict):
    """Numbers of strings in the order in which they are first asked for; ``new`` lists those not yet worked on."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number

    def of(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def taken(self) -> list[str]:
        new, self.new = self.new, []
        return new


class WordIds:
    """Ids of texts, with those of words met before kept (at most ``_MOST_WORDS``)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)
        self.letters = _byte_letters()
        ends = [i for t, i in self.whole.get_vocab().items() if t.endswith("</w>")]
        self.ends = np.zeros(max(self.whole.get_vocab().values()) + 1, bool)
        self.ends[ends] = True
        self.forget()

    def forget(self) -> None:
        self.slot = Numbers()  # of words, which are runs of pieces
        self.size, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.piece = Numbers()
        self.piece["\n"] = 0  # ends a word and has no ids
        self.piece_size, self.piece_first = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.piece_ids = np.zeros(0, np.uint32)

    def _pieces(self) -> None:
        """Finds the ids of new pieces, and of words that only the whole tokenizer may cut, which are named after a mark."""
        new = self.piece.taken()
        if not new:
            return
        odd = np.array([p[0] == "\x00" for p in new])
        letters = self.letters
        spelled = [
            p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters) for p in new if p[0] != "\x00"
        ]
        runs = [spelled[i : i + 1000] for i in range(0, len(spelled), 1000)]
        found = self.model.encode_batch_fast(runs, is_pretokenized=True, add_special_tokens=False)
        flat = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, np.uint32) for e in found]])
        stops = np.flatnonzero(self.ends[flat]) + 1
        if len(stops) != len(spelled):
            raise ValueError("a word without an end")
        whole = [e.ids for e in self.whole.encode_batch_fast([p[1:] for p in new if p[0] == "\x00"], add_special_tokens=False)]
        inner = np.append(np.diff(np.append(0, stops)), np.array([len(w) for w in whole], np.int64))
        size, first = np.zeros((2, len(new)), np.int64)
        order = np.argsort(odd, kind="stable")
        size[order], first[order] = inner, len(self.piece_ids) + np.cumsum(inner) - inner
        self.piece_first = np.concatenate([self.piece_first, first])
        self.piece_size = np.concatenate([self.piece_size, size])
        self.piece_ids = np.concatenate([self.piece_ids, flat, *[np.array(w, np.uint32) for w in whole]])

    def _grow(self) -> None:
        """Finds the ids of new words, which are without white space. They are cut many at a time, a line each."""
        words = self.slot.taken()
        if not words:
            return
        kind = np.array([0 if w.isascii() else 1 if _PLAIN.fullmatch(w) else 2 for w in words])
        order = np.argsort(kind, kind="stable")
        counts = np.bincount(kind, minlength=3)
        sorted_words = [words[i] for i in order.tolist()]
        ascii_, latin, odd = (sorted_words[e - n : e] for e, n in zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True))
        parts = _ASCII_WORD.findall("\n".join([*ascii_, ""]).lower())
        parts += _LATIN_WORD.findall("\n".join([*latin, ""]).lower())
        parts += chain.from_iterable(("\x00" + w, "\n") for w in odd)
        at = self.piece.of(parts)
        self._pieces()
        ids, stop = spread(self.piece_ids, self.piece_first[at], self.piece_size[at])
        ends = stop[at == 0]
        inner = np.diff(np.append(0, ends))
        size, first = np.zeros((2, len(words)), np.int64)
        size[order], first[order] = inner, len(self.ids) + ends - inner
        self.first = np.concatenate([self.first, first])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found: list[np.ndarray | None] = [None] * len(texts)
        simple = []
        for i, text in enumerate(texts):
            if any(mark in text for mark in _WHOLE):
                found[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                simple.append(i)
        split = pc.utf8_split_whitespace(pa.array([texts[i] for i in simple], pa.large_string()))
        words = split.flatten().dictionary_encode()
        if len(self.slot) > _MOST_WORDS:
            self.forget()
        slots = self.slot.of(words.dictionary.to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
        try:
            self._grow()
        except BaseException:
            self.forget()  # numbers without ids are of no use to a later call
            raise
        ids, stop = spread(self.ids, self.first[slots], self.size[slots])
        edge = np.append(0, stop)[split.offsets.to_numpy()]
        for k, i in enumerate(simple):
            found[i] = ids[edge[k] : edge[k + 1]]
        return found


def spread(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` one after another, and where each ends."""
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    return values[np.repeat(first - (stop - size), size) + np.arange(total)], stop


_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """One for each file in a Python worker, so that tasks after the first find common words known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def ids_crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_PIECES = "doc_id long, text_key long, start long, length long, ids_crc32 long, doc_tokens long"
_NUMBERED = f"{_PIECES}, row long"


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of at most ``window`` ids of every text; ``row`` counts those of a task, to tell equal ones apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, done = encoder(tokenizer), 0
        for batch in batches:
            ids, keys, texts = (c.to_pylist() for c in batch.columns)
            for lo, hi in slices((len(t or "") + 1 for t in texts), _PIECE):
                rows = []
                for i, own in zip(range(lo, hi), words.encode([t or "" for t in texts[lo:hi]]), strict=True):
                    whole = np.append(own, np.uint32(end_id))
                    for start in range(0, len(whole), window):
                        part = whole[start : start + window]
                        rows.append((ids[i], keys[i], start, len(part), ids_crc(part), len(whole)))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                columns.append(pa.array(np.arange(done, done + len(rows))))
                done += len(rows)
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _NUMBERED.split(", ")])

    return _keyed(docs).mapInArrow(run, _NUMBERED)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), text.alias("text"))


# --- the plan


def best_filling(room: int, lengths: list[int], left: dict[int, int]) -> dict[int, int]:
    """Counts of ``lengths`` (descending) whose sum is at most ``room`` and as large as possible.

    ``reach`` has bit s set if s can be reached; the bitsets before each step are kept and read backwards."""
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        copies, lot = min(left[length], room // length), 1
        while copies:
            lot = min(lot, copies)
            after = (reach | reach << lot * length) & full
            if after != reach:
                steps.append((length, lot, reach))
                reach = after
            copies -= lot
            lot *= 2
        if reach >> room & 1:
            break
    target = reach.bit_length() - 1
    counts: dict[int, int] = defaultdict(int)
    for length, lot, before in reversed(steps):
        if not before >> target & 1:
            counts[length] += lot
            target -= lot * length
    return dict(counts)


@dataclass
class Plan:
    """Where pieces go. An entry: ranks ``first`` to ``stop`` of pieces of ``origin`` ids; their ids from ``at`` on,
    ``length`` of them, go to the windows from ``window`` on, ``each`` to a window, from ``offset`` on; ``done`` of
    the filling's pieces come before the first."""

    entries: list[tuple[int, int, int, int, int, int, int, int, int]] = field(default_factory=list)
    windows: int = 0


def minimum_slack(counts: dict[int, int], window: int = WINDOW, slack: float = SLACK) -> Plan:
    """Fills windows until no piece is left."""
    plan = Plan()
    pools: dict[int, list[list[int]]] = {n: [[n, 0, c, 0]] for n, c in counts.items() if c}
    left = {n: c for n, c in counts.items() if c}

    def take(length: int, each: int, times: int, offset: int) -> list[tuple[int, int, int, int]]:
        need, done, taken = each * times, 0, []
        left[length] -= need
        pool = pools[length]
        while done < need:
            origin, first, stop, at = pool[0]
            n = min(stop - first, need - done)
            plan.entries.append((origin, first, first + n, at, length, plan.windows, each, offset, done))
            taken.append((origin, first, first + n, at))
            pool[0][1] += n
            if pool[0][1] == stop:
                pool.pop(0)
            done += n
        if not left[length]:
            del left[length], pools[length]
        return taken

    while left:
        lengths = sorted(left, reverse=True)
        seed = lengths[0]
        left[seed] -= 1
        fill = best_filling(window - seed, lengths, left)
        left[seed] += 1
        fill[seed] = fill.get(seed, 0) + 1
        times = min(left[n] // each for n, each in fill.items())
        total = sum(n * each for n, each in fill.items())
        rest = window - total
        spare = [n for n in lengths if n > rest and left[n] - fill.get(n, 0) > 0]
        donor = None
        if rest > slack * window and spare:
            donor = spare[0]
            times = min(times, left[donor] // (fill.get(donor, 0) + 1))
        offset = 0
        for n, each in sorted(fill.items(), reverse=True):
            take(n, each, times, offset)
            offset += n * each
        if donor:
            _cut(plan, pools, left, donor, rest, times, offset)
        plan.windows += times
    return plan


def _cut(plan: Plan, pools, left, donor: int, rest: int, times: int, offset: int) -> None:
    """Fills ``rest`` ids of ``times`` windows with the starts of ``donor`` pieces; their ends stay to be packed."""
    left[donor] -= times
    pool, done = pools[donor], 0
    while done < times:
        origin, first, stop, at = pool[0]
        n = min(stop - first, times - done)
        plan.entries.append((origin, first, first + n, at, rest, plan.windows, 1, offset, done))
        pools.setdefault(donor - rest, []).append([origin, first, first + n, at + rest])
        left[donor - rest] = left.get(donor - rest, 0) + n
        pool[0][1] += n
        if pool[0][1] == stop:
            pool.pop(0)
        done += n
    if not left[donor]:
        del left[donor], pools[donor]


class Places:
    """Finds the entries of a piece from its length and rank."""

    def __init__(self, plan: Plan):
        by: dict[tuple[int, int], list] = defaultdict(list)
        for entry in sorted(plan.entries):
            by[entry[0], entry[3]].append(entry)
        self.by = {k: ([e[1] for e in v], v) for k, v in by.items()}

    def of(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(ids before it in the piece, length, window, offset) of each part of the piece."""
        found, at = [], 0
        while at < length:
            firsts, entries = self.by[length, at]
            _, first, stop, _, n, window, each, offset, done = entries[bisect_right(firsts, rank) - 1]
            if not first <= rank < stop:
                raise ValueError("a piece without a place")
            order = done + rank - first
            found.append((at, n, window + order // each, offset + order % each * n))
            at += n
        return found


def ranked(table: DataFrame, salts: int) -> DataFrame:
    """Pieces with their rank among those of the same length. Equal rows differ in ``row``, so they have many salts too."""
    named = ["doc_id", "text_key", "start", "row"]
    salted = table.withColumn("salt", F.pmod(F.xxhash64(*named), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy(*named)
    numbered = salted.withColumn("own", F.row_number().over(order) - 1)
    return numbered.join(sizes, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "salt")


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, slack: float = SLACK
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every packed piece."""
    table = stored(pieces(docs, tokenizer, window, end_id), "pieces")
    counts = {r.length: r.n for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = Places(minimum_slack(counts, window, slack))
    salts = max(16, sum(counts.values()) // 50_000)
    fields = _PIECES.split(", ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for *row, rank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = places.of(row[3], rank)
                for at, n, sequence, offset in parts:
                    crc = row[4] if len(parts) == 1 else None
                    rows.append((row[0], row[1], row[2] + at, n, crc, row[5], sequence, offset))
            if rows:
                names = [f.split()[0] for f in fields] + ["sequence_id", "offset"]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    wanted = [f.split()[0] for f in fields]
    placed = ranked(table, salts).select(*wanted, "rank").mapInArrow(run, f"{_PIECES}, sequence_id long, offset long")
    placed = stored(placed, "placed")
    return _with_crc(docs, placed, tokenizer, end_id).drop("text_key")


def _with_crc(docs: DataFrame, placed: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Checksums of the pieces that the plan cut; only their texts are tokenized again."""
    cut = placed.where("ids_crc32 IS NULL")
    spans = cut.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    spans = stored(spans, "cuts")
    if spans.isEmpty():
        return placed
    texts = _keyed(docs)
    same = texts.doc_id.eqNullSafe(spans.doc_id) & (texts.text_key.eqNullSafe(spans.text_key))
    asked = texts.join(spans, same).select(spans.doc_id, spans.text_key, "spans", "text")
    asked = asked.dropDuplicates(["doc_id", "text_key"])  # a repeated row is tokenized once, whatever its number of cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for batch in batches:
            ids, keys, spans, texts = (c.to_pylist() for c in batch.columns)
            for lo, hi in slices((len(t or "") + 1 for t in texts), _PIECE):
                rows = []
                for i, own in zip(range(lo, hi), words.encode([t or "" for t in texts[lo:hi]]), strict=True):
                    whole = np.append(own, np.uint32(end_id))
                    for span in spans[i]:
                        part = whole[span["start"] : span["start"] + span["length"]]
                        rows.append((ids[i], keys[i], span["start"], span["length"], ids_crc(part)))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["d", "k", "s", "n", "crc"])

    sums = asked.mapInArrow(run, "d long, k long, s long, n long, crc long")
    match = (
        F.col("doc_id").eqNullSafe(F.col("d"))
        & F.col("text_key").eqNullSafe(F.col("k"))
        & (F.col("start") == F.col("s"))
        & (F.col("length") == F.col("n"))
    )
    names = placed.columns
    mended = cut.join(sums, match).withColumn("ids_crc32", F.col("crc")).select(*names)
    return placed.where("ids_crc32 IS NOT NULL").union(mended)
