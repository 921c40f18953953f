"""Spelling variants by a bit-sliced position index.

Words of a block are numbered, and for each position and letter a bitset says which of them have that letter there. A
query word walks its letters once and tracks four sets of words, 64 words an operation: those equal so far, and those
with one error so far, which are a replaced letter (same positions), an extra letter of theirs (positions one further)
or an extra letter of the query's (one back). Words of the right length left in an error set are at distance one.

Blocks come from the pigeonhole principle: the shorter of two near words is cut in ``PARTS`` parts, one of which holds
the only error, so that both agree in all other letters. Rows with equal other letters share a block, blocks take about
``BLOCK`` rows (fewer where words are long), and a larger group is cut into blocks that all its rows query. A pair
that agrees outside two parts is kept for the first of them.

Defined results: null texts have no words; a null id is an empty text before the colon of the hashed text; repeated
rows count as often as they occur; a word of any length is taken whole; ties of a form go to the smaller word in
code-point order; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored

RUNS = "[A-Za-z\\u00C0-\\u00FF]+"
PARTS = 3
BLOCK = 2_048
LETTERS = 65_536  # about so many letters a block of long words
PAIRS = 1 << 20  # 64-bit words of a set held at once
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Only A-Z; ``lower`` does the same, faster, where all letters are ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def occurrences(docs: DataFrame, every: int = 97) -> DataFrame:
    """(word): the lower-cased letter runs of all texts; a run whose hash ``every`` divides loses a letter."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUNS), F.lit(0))).alias("run"),
    ).select("id", ascii_lower(F.col("run")).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    long_enough = words.where(F.length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _band(length: Column) -> Column:
    """Classes of shorter-word lengths that share blocks: each up to 64, then each power of two."""
    over = F.ceil(F.log2(length / 64.0)).cast("int")
    return F.when(length <= 64, length).otherwise(64 + over)


def _rows_of_band(band: int) -> int:
    longest = band if band <= 64 else 64 << (band - 64)
    return max(64, min(BLOCK, LETTERS // longest))


def _keyed(vocabulary: DataFrame) -> DataFrame:
    """(word, n, longer, part, start, key, band): each word as the shorter of a pair and as the longer."""
    word, size = F.col("word"), F.length("word")
    roles = vocabulary.select(
        "word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("longer")
    ).withColumn("size", size - F.col("longer").cast("int"))  # letters of the shorter word
    cut = roles.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(PARTS)]))).withColumns(
        {
            "start": F.floor(F.col("part") * F.col("size") / PARTS).cast("int"),
            "end": F.floor((F.col("part") + 1) * F.col("size") / PARTS).cast("int"),
        }
    )
    rest = word.substr(F.col("end") + F.col("longer").cast("int") + 1, size)
    key = F.xxhash64("size", "part", word.substr(F.lit(1), F.col("start")), rest)
    return cut.select("word", "n", "longer", "part", "start", key.alias("key"), _band(F.col("size")).alias("band"))


def _blocked(keyed: DataFrame) -> DataFrame:
    """Adds the block in which the row asks, and whether it is one of the block's words."""
    counts = {r["band"]: r["count"] for r in keyed.groupBy("band").count().collect()}  # at most some 90 bands
    if not counts:
        return keyed.drop("band").withColumns({"block": F.lit(0).cast("long"), "indexed": F.lit(True)})
    limit = F.create_map(*[F.lit(x) for b in counts for x in (b, _rows_of_band(b))])[F.col("band")]
    blocks = F.create_map(*[F.lit(x) for b, n in counts.items() for x in (b, -(-n // _rows_of_band(b)))])[F.col("band")]
    large = (
        keyed.groupBy("key", "band").count().where(F.col("count") > limit)
        .select("key", "band", F.ceil(F.col("count") / limit).cast("int").alias("pieces"))
    )
    dealt = keyed.join(large, ["key", "band"], "left").withColumn("own", F.expr("pmod(xxhash64(word), pieces)"))
    split = F.col("pieces").isNotNull()
    piece = F.when(split, F.sequence(F.lit(0), F.col("pieces") - 1)).otherwise(F.array(F.lit(-1)))
    several = dealt.withColumn("piece", F.explode(piece))
    block = F.when(split, F.xxhash64("key", "piece")).otherwise(F.xxhash64("band", F.pmod("key", blocks)))
    return several.select(
        "word", "n", "longer", "part", "start", "key", block.alias("block"),
        (~split | (F.col("own") == F.col("piece"))).alias("indexed"),
    )


class PositionIndex:
    """Bitsets by position and letter; ``letters`` holds a row of letters for each word, ``sizes`` their numbers."""

    def __init__(self, words: list[str]):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.wide = max(1, -(-len(words) // 64))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), self.sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.slots, row = np.unique(place << 32 | flat, return_inverse=True)
        self.bits = np.zeros((len(self.slots) + 1, self.wide), np.uint64)  # the last row: a letter no word has there
        np.bitwise_or.at(self.bits, (row, owner >> 6), np.uint64(1) << (owner & 63).astype(np.uint64))
        self.of_size = {}
        for size in np.unique(self.sizes):
            self.of_size[int(size)] = self._set(np.flatnonzero(self.sizes == size))

    def _set(self, members: np.ndarray) -> np.ndarray:
        found = np.zeros(self.wide, np.uint64)
        np.bitwise_or.at(found, members >> 6, np.uint64(1) << (members & 63).astype(np.uint64))
        return found

    def _having(self, place: int, letters: np.ndarray) -> np.ndarray:
        wanted = place << 32 | letters
        row = np.searchsorted(self.slots, wanted)
        row[(row == len(self.slots)) | (self.slots[np.minimum(row, len(self.slots) - 1)] != wanted)] = len(self.slots)
        return self.bits[row]

    def near(self, queries: np.ndarray, shorter: bool, longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of queries (rows of letters, all of one size) and of words at distance one.

        ``shorter``: find words with a letter less; ``longer``: words with as many or one more.
        """
        n, size = queries.shape
        equal = np.full((n, self.wide), ~np.uint64(0))
        replaced = np.zeros_like(equal)
        extra = equal.copy() if longer else None  # theirs: their first letter is the extra one
        missing = np.zeros_like(equal)  # an extra letter of the query's
        for i in range(size):
            letters = queries[:, i]
            here = self._having(i, letters)
            if shorter:
                before = self._having(i - 1, letters) if i else np.uint64(0)
                missing = missing & before | equal
            if longer:
                replaced = replaced & here | equal & ~here
                extra &= self._having(i + 1, letters)
            equal &= here
            if longer:
                extra |= equal
        nothing = np.zeros(self.wide, np.uint64)
        if longer:
            yield self._members(replaced & self.of_size.get(size, nothing))
            yield self._members(extra & self.of_size.get(size + 1, nothing))
        if shorter:
            yield self._members(missing & self.of_size.get(size - 1, nothing))

    @staticmethod
    def _members(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, word = np.nonzero(sets)
        bits = np.unpackbits(sets[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, bit = np.nonzero(bits)
        return row[hit], word[hit] * 64 + bit


_PAIRS = "word string, near string, near_n long, longer boolean, part int, start int"


def _near_in_block(rows: pa.Table) -> pa.Table:
    rows = rows.combine_chunks()
    indexed = np.flatnonzero(rows["indexed"].to_numpy())
    words = rows["word"].to_pylist()
    key, longer = rows["key"].to_numpy(), rows["longer"].to_numpy()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(indexed):
        index = PositionIndex([words[i] for i in indexed])
        step = max(1, PAIRS // index.wide)
        for role in (False, True):
            for size in np.unique(sizes[longer == role]):
                asking = np.flatnonzero((longer == role) & (sizes == size))
                for a in range(0, len(asking), step):
                    part = asking[a : a + step]
                    text = "".join([words[i] for i in part]).encode("utf-32-le")
                    letters = np.frombuffer(text, np.uint32).astype(np.int64).reshape(len(part), size)
                    for query, near in index.near(letters, shorter=role, longer=not role):
                        query, near = part[query], indexed[near]
                        # a pair belongs to the group both rows are in, with the shorter as the shorter
                        right = (key[query] == key[near]) & ((sizes[near] > size) == longer[near])
                        found.append((query[right], near[right]))
    query = np.concatenate([q for q, _ in found]) if found else np.empty(0, np.int64)
    near = np.concatenate([n for _, n in found]) if found else np.empty(0, np.int64)
    asked, other = rows.take(pa.array(query)), rows.take(pa.array(near))
    columns = {
        "word": asked["word"], "near": other["word"], "near_n": other["n"],
        "longer": asked["longer"], "part": asked["part"], "start": asked["start"],
    }
    return pa.table(columns)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for all pairs of words (word, n) at distance one, both ways round."""
    blocks = _blocked(_keyed(words))
    found = blocks.groupBy("block").applyInArrow(_near_in_block, _PAIRS)
    short = F.when(F.col("longer"), F.col("near")).otherwise(F.col("word"))
    long = F.when(F.col("longer"), F.col("word")).otherwise(F.col("near"))
    after = short.substr(F.col("start") + 1, F.length(short))
    after_extra = long.substr(F.col("start") + 2, F.length(long))
    one_more = F.length("word") != F.length("near")
    again = one_more & (F.col("part") > 0) & (after == after_extra)  # the part before has it as well
    return found.where(~again).select("word", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, by pointer doubling: a form's n is at least twice the word's, so paths
    have at most log2 of the largest n steps and the rounds are the logarithm of that."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stored(moved, "spelling-roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, factor: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts."""
    words = stored(vocabulary(occurrences(docs)), "spelling-words")
    pairs = near_words(words).select(
        "word", F.lit(None).cast("long").alias("n"), F.struct((-F.col("near_n")).alias("less"), "near").alias("near")
    )
    own = words.select("word", "n", F.lit(None).cast(pairs.schema["near"].dataType).alias("near"))
    best = own.unionByName(pairs).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), F.min("near").alias("near")
    )
    has = -F.col("near.less") >= factor * F.col("n")
    known = stored(
        best.select(
            "word", "n", "n_near", F.when(has, F.col("near.near")).alias("form"),
            F.when(has, -F.col("near.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
