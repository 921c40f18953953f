"""Phrases of two and three words that occur together more often than their parts explain, by HAT-trie counting.

A task counts n-grams of local word ids in a trie of word ids whose leaves are hash containers. A container takes the
n-grams of a range of ids; over ``BURST`` entries it bursts into two ranges, or, once its range is one id, into a node
for the next word. When the entries pass ``ENTRIES``, whole subtrees under the root, those that save least first, are
written as sorted runs; the runs are merged by Spark within prefix partitions (language and first two words).

Two readings of the texts keep rare n-grams out of the runs. The first counts words, and two-word n-grams by a 64-bit
hash. Hashes that reach the least count set a bit in a bitmap of fixed size (``FILTER_BITS``): hashes and bits can
coincide, which adds to a count, so no frequent n-gram is missed. The second counts n-grams exactly, by their words,
but only those whose two-word parts all have their bit. A fuller bitmap (larger corpora) costs rows and no result.

Defined results: null texts are empty, a null language is ``und``, an empty language stays; repeated rows count as
often as they occur; a text of any length is taken whole, in stretches; ties go to the smaller phrase in UTF-8 byte
order; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import mixed, stored

LONGEST = 3
BURST = 16_384  # entries of a container
ENTRIES = 1_000_000  # of all containers of a task
WORD_BITS = 20
WORDS = 1 << 19  # known to a task at once
STRETCH = 2 << 20  # bytes of text counted at once
FILTER_BITS = 27
_CHUNK_BITS = 15  # of the bitmap, an aggregate's row
_MASK = (1 << WORD_BITS) - 1

# A-Z become a-z, a tab is a space, and . , ; : ! ? and U+000A to U+000D end a piece.
_BREAK = b"."
_FOLDED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"." * 10
)


class Container:
    """Counts of the n-grams whose word at ``depth`` lies in a range of ids; the words before are the same."""

    def __init__(self, depth: int):
        self.depth = depth
        self.counts: Counter[int] = Counter()
        self.seen = 0

    def add(self, codes: np.ndarray) -> None:
        self.counts.update(codes.tolist())
        self.seen += len(codes)

    def entries(self) -> int:
        return len(self.counts)

    def occurrences(self) -> int:
        return self.seen

    def parts(self) -> Iterator[Container]:
        yield self

    def burst(self, length: int) -> list[tuple[int, Container | Node]]:
        """(first code, child): two halves of the range, or a node for the next word."""
        keys = np.sort(np.fromiter(self.counts, np.int64, len(self.counts)))
        prefix = keys >> (length - 1 - self.depth) * WORD_BITS
        if prefix[0] == prefix[-1]:
            below = Container(self.depth + 1)
            below.counts, below.seen = self.counts, self.seen
            node = Node(length, int(keys[0]), below)
            node.settle(0)
            return [(int(keys[0]), node)]
        middle = prefix[len(prefix) // 2]
        if middle == prefix[0]:
            middle = prefix[np.searchsorted(prefix, middle, "right")]
        edge = int(middle) << (length - 1 - self.depth) * WORD_BITS
        low, high = Container(self.depth), Container(self.depth)
        for code, n in self.counts.items():
            side = low if code < edge else high
            side.counts[code] = n
            side.seen += n
        return [(int(keys[0]), low), (edge, high)]


class Node:
    """Children by their first code; the first child also takes what is smaller."""

    def __init__(self, length: int, first: int, child: Container):
        self.length = length
        self.starts, self.children = [first], [child]

    def add(self, codes: np.ndarray) -> None:
        """``codes`` ascend."""
        cuts = np.searchsorted(codes, self.starts[1:]).tolist()
        for i, (a, b) in reversed(list(enumerate(zip([0, *cuts], [*cuts, len(codes)], strict=True)))):
            if a < b:
                self.children[i].add(codes[a:b])
                self.settle(i)

    def settle(self, i: int) -> None:
        """Bursts the i-th child until its parts are small enough."""
        child = self.children[i]
        if isinstance(child, Container) and child.entries() > BURST:
            parts = child.burst(self.length)
            starts = [start for start, _ in parts]
            self.starts[i : i + 1] = [self.starts[i], *starts[1:]]
            self.children[i : i + 1] = [part for _, part in parts]
            for j in reversed(range(i, i + len(parts))):
                self.settle(j)

    def entries(self) -> int:
        return sum(c.entries() for c in self.children)

    def occurrences(self) -> int:
        return sum(c.occurrences() for c in self.children)

    def parts(self) -> Iterator[Container]:
        for child in self.children:
            yield from child.parts()

    def spilled(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(codes, counts) of whole subtrees, the ones with the fewest occurrences an entry first, until at most
        ``keep`` entries are left."""
        left = self.entries()
        share = [c.occurrences() / max(c.entries(), 1) for c in self.children]
        for i in np.argsort(share, kind="stable"):
            if left <= keep:
                return
            child = self.children[i]
            if child.entries():
                left -= child.entries()
                self.children[i] = Container(0)
                every = [part.counts for part in child.parts()]
                size = sum(map(len, every))
                codes = np.fromiter((c for part in every for c in part), np.int64, size)
                counts = np.fromiter((n for part in every for n in part.values()), np.int64, size)
                yield codes, counts


class _Known(dict):
    """Ids of words; the break is 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def _tokens(folded: bytes) -> list[bytes]:
    """Words, and a break where a piece ends."""
    return folded.replace(_BREAK, b" . ").split()


def _stretches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], bytes]]:
    """(language, tokens before it in the same text, folded text): about ``STRETCH`` bytes, cut between words."""
    for batch in rows:
        open_: dict[str, list[bytes]] = defaultdict(list)
        sizes: Counter[str] = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            folded = (text.as_py() or b"").translate(_FOLDED)
            if len(folded) > STRETCH:
                yield from ((lang, before, part) for before, part in _cut(folded))
            elif folded:
                open_[lang].append(folded)
                sizes[lang] += len(folded)
                if sizes[lang] > STRETCH:
                    yield lang, [], _BREAK.join(open_.pop(lang))
                    sizes[lang] = 0
        for lang, texts in open_.items():
            yield lang, [], _BREAK.join(texts)


def _cut(folded: bytes) -> Iterator[tuple[list[bytes], bytes]]:
    at, before = 0, []
    while at < len(folded):
        ends = [x for x in (folded.find(b" ", at + STRETCH), folded.find(_BREAK, at + STRETCH)) if x >= 0]
        end = min(ends, default=len(folded))
        part = folded[at:end]
        yield before, part
        tail = [*before, *part.replace(_BREAK, b" . ").rsplit(None, LONGEST - 1)[-(LONGEST - 1) :]]
        before = [t for piece in tail for t in piece.split()][-(LONGEST - 1) :]
        at = end


class _Counts:
    """The tries of a task, by language and length, and its words."""

    def __init__(self):
        self.restart()

    def restart(self) -> None:
        self.known = _Known()
        self.tries: dict[tuple[str, int], Node] = {}
        self.hashes = np.zeros(0, np.uint64)
        self.ones: dict[str, np.ndarray] = {}

    def ids(self, tokens: list[bytes]) -> np.ndarray:
        ids = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        if len(self.hashes) < len(self.known):
            more = list(self.known)[len(self.hashes) :]
            new = np.fromiter(map(xxhash.xxh64_intdigest, more), np.uint64, len(more))
            self.hashes = np.concatenate([self.hashes, new])
        return ids

    def count_words(self, lang: str, ids: np.ndarray) -> None:
        new = np.bincount(ids, minlength=len(self.known))
        old = self.ones.get(lang, np.zeros(0, np.int64))
        new[: len(old)] += old
        self.ones[lang] = new

    def pair_hashes(self, lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        return mixed(mixed(self.hashes[first] + seed) * np.uint64(0x9E3779B97F4A7C15) + self.hashes[second])

    def add(self, lang: str, length: int, codes: np.ndarray) -> None:
        if len(codes):
            trie = self.tries.get((lang, length))
            if trie is None:
                trie = self.tries[lang, length] = Node(length, 0, Container(0))
            trie.add(np.sort(codes))

    def full(self) -> bool:
        return sum(t.entries() for t in self.tries.values()) > ENTRIES

    def spilled(self, share: float) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
        for (lang, length), trie in self.tries.items():
            for codes, counts in trie.spilled(int(trie.entries() * share)):
                yield lang, length, codes, counts


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))


_FIRST = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("hash", pa.int64()), ("n", pa.int64())])
_SECOND = pa.schema([("lang", pa.string()), ("head", pa.binary()), ("tail", pa.binary()), ("n", pa.int64())])


def _first_reading(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and of two-word n-grams by hash, in runs sorted by hash."""
    counts = _Counts()

    def runs(share: float) -> Iterator[pa.RecordBatch]:
        for lang, _, codes, n in counts.spilled(share):
            hashes = counts.pair_hashes(lang, codes >> WORD_BITS, codes & _MASK).view(np.int64)
            order = np.argsort(hashes)
            nothing = [pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array(hashes[order]), pa.array(n[order])], schema=_FIRST)

    def words() -> Iterator[pa.RecordBatch]:
        every = pa.array(list(counts.known), pa.binary())
        for lang, n in counts.ones.items():
            found = np.flatnonzero(n)
            found = found[found > 0]  # not the break
            columns = [pa.array([lang] * len(found), pa.string()), every.take(pa.array(found))]
            columns += [pa.nulls(len(found), pa.int64()), pa.array(n[found])]
            yield pa.RecordBatch.from_arrays(columns, schema=_FIRST)

    for lang, before, text in _stretches(rows):
        ids = counts.ids([*before, *_tokens(text)])
        counts.count_words(lang, ids[len(before) :])
        first = max(1, len(before))  # the first end of a pair that is new
        a, b = ids[first - 1 : -1], ids[first:]
        counts.add(lang, 2, (a << WORD_BITS | b)[(a > 0) & (b > 0)])
        if len(counts.known) > WORDS:
            yield from runs(0)
            yield from words()
            counts.restart()
        elif counts.full():
            yield from runs(0.5)
    yield from runs(0)
    yield from words()


def _second_reading(bitmap):
    """Counts of n-grams of frequent pairs, in runs sorted by their words."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        bits = np.frombuffer(bitmap.value, np.uint8)

        def runs(share: float) -> Iterator[pa.RecordBatch]:
            every = pa.array(list(counts.known), pa.binary())
            for lang, length, codes, n in counts.spilled(share):
                word = [every.take(pa.array(codes >> (length - 1 - i) * WORD_BITS & _MASK)) for i in range(length)]
                head = pc.binary_join_element_wise(word[0], word[1], pa.scalar(b" ", pa.binary()))
                tail = word[2] if length == LONGEST else pa.nulls(len(n), pa.binary())
                columns = [pa.array([lang] * len(n), pa.string()), head, tail, pa.array(n)]
                batch = pa.RecordBatch.from_arrays(columns, schema=_SECOND)
                yield batch.sort_by([("head", "ascending"), ("tail", "ascending")])

        for lang, before, text in _stretches(rows):
            ids = counts.ids([*before, *_tokens(text)])
            a, b = ids[:-1], ids[1:]
            hit = (a > 0) & (b > 0)
            hit[hit] = _is_set(bits, counts.pair_hashes(lang, a[hit], b[hit]))
            new = max(0, len(before) - 1)  # pairs before end among the tokens before
            pairs = a << WORD_BITS | b
            counts.add(lang, 2, pairs[new:][hit[new:]])
            threes = pairs[:-1] << WORD_BITS | ids[2:]
            new = max(0, len(before) - 2)
            counts.add(lang, 3, threes[new:][(hit[:-1] & hit[1:])[new:]])
            if len(counts.known) > WORDS:
                yield from runs(0)
                counts.restart()
            elif counts.full():
                yield from runs(0.5)
        yield from runs(0)

    return run


def _is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _bitmap(hashes: DataFrame) -> bytes:
    """A bit for each hash, by its first bits: at most 2**(FILTER_BITS - 3) bytes, whatever the corpus."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    chunks = (
        hashes.select(F.shiftright(place, _CHUNK_BITS).alias("chunk"), place.bitwiseAND((1 << _CHUNK_BITS) - 1).alias("bit"))
        .groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    whole = bytearray(1 << FILTER_BITS - 3)
    wide = 1 << _CHUNK_BITS - 3
    for row in chunks.toLocalIterator():
        whole[row["chunk"] * wide : (row["chunk"] + 1) * wide] = row["bits"]
    return bytes(whole)


def phrase_counts(docs: DataFrame, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all words and of phrases of two and three words with f >= ``least``, and (lang, n)."""
    spark = docs.sparkSession
    texts = _texts(docs)
    # tasks have added up what they saw, so that rows go to their exchange as they are
    first = (
        texts.mapInArrow(_first_reading, "lang string, word binary, hash long, n long")
        .repartition("lang", "word", "hash").groupBy("lang", "word", "hash").agg(F.sum("n").alias("f"))
        .where(F.col("hash").isNull() | (F.col("f") >= least))
    )
    first = stored(first, "phrases-first")
    words = first.where("hash IS NULL").select("lang", F.col("word").cast("string").alias("phrase"), F.lit(1).alias("size"), "f")
    frequent = first.where("hash IS NOT NULL").select("hash")
    bitmap = spark.sparkContext.broadcast(_bitmap(frequent))
    # a phrase is merged where its first two words send it, so one exchange serves two and three words
    merged = (
        texts.mapInArrow(_second_reading(bitmap), "lang string, head binary, tail binary, n long")
        .repartition("lang", "head").groupBy("lang", "head", "tail").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    )
    phrases = stored(
        merged.select(
            "lang", F.concat_ws(" ", F.col("head").cast("string"), F.col("tail").cast("string")).alias("phrase"),
            F.when(F.col("tail").isNull(), 2).otherwise(3).alias("size"), "f",
        ),
        "phrases",
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return words.unionByName(phrases), totals


def collocations(docs: DataFrame, least: int = 10, best: int = 2000, scale: int = 1_000_000, share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``best`` phrases.

    A phrase's score is the lowest of its cuts' ``scale * a * a / (l * r)``, rounded down. A phrase inside a longer one
    that has at least ``share`` percent of its occurrences is dropped.
    """
    counts, totals = phrase_counts(docs, least)
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    longer = (
        found.where(F.col("size") > 2)
        .select("lang", F.explode(F.array(*[F.array_join(F.slice("words", i, 2), " ") for i in (1, 2)])).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    )
    kept = found.join(longer, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * share)
    )
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ").alias("right"),
    )
    parts = counts.where((F.col("f") >= least) & (F.col("size") < LONGEST))
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")}
    with_counts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumns(wide)
    score = F.expr(f"CAST((CAST(a * a AS DECIMAL(31,0)) * {scale}BD) div CAST(l * r AS DECIMAL(36,0)) AS BIGINT)")
    lowest = (
        with_counts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase").agg(F.min("cut").alias("cut"), F.max("a").alias("a"))
    )
    flat = lowest.select(
        "lang", "phrase", *[F.col(c).cast("long").alias(c[-1]) for c in ("a", "cut.l", "cut.r")], F.col("cut.score").alias("score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
