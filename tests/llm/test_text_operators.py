from __future__ import annotations

import base64
import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meterline.llm import decontaminate, langid, lm, packing, quality, simhash, toxicity
from meterline.llm.common import rolling, slices, words
from tests.llm.frames import documents, nothing, rows, sentence


def _collected(frame):
    return [tuple(r) for r in frame.collect()]


def test_words_and_rolling_hash():
    assert words("Ab\x0bÄÖ  c d\n") == ["ab".encode(), "ÄÖ".encode(), "c d".encode()]
    values = np.arange(40) ** 2 % 17
    for width in (1, 3, 8, 10):
        base = 0x9E3779B97F4A7C15
        plain = [sum(int(values[i + j]) * pow(base, width - 1 - j, 2**64) for j in range(width)) % 2**64 for i in range(41 - width)]
        assert rolling(values, width).tolist() == plain
    assert list(slices([5, 5, 20, 1], 10)) == [(0, 2), (2, 3), (3, 4)]


# --- SimHash


def _plain_fingerprint(text):
    tokens = words(text)
    runs = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_components(prints):
    keys = sorted({fp for _, fp in prints})
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for doc_id, fp in prints:
        if doc_id is not None:
            least[find(fp)] = min(doc_id, least.get(find(fp), doc_id))
    return [(d, least.get(find(fp))) for d, fp in prints]


def test_simhash_matches_brute_force(spark):
    found = simhash.near_duplicates(documents(spark))
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in found.collect()]
    prints = [(r[0], _plain_fingerprint(r[1])) for r in rows()]
    key = str
    assert sorted([(d, fp) for d, fp, _ in got], key=key) == sorted(prints, key=key)
    assert sorted([(d, c) for d, _, c in got], key=key) == sorted(_plain_components(prints), key=key)


def test_links_of_a_dense_group_are_whole(spark):
    """More close fingerprints than a bucket may hold: buckets are dealt again, and components stay exact."""
    draw = np.random.default_rng(3)
    center = int(draw.integers(0, 2**63))
    values = {center}
    while len(values) < 2600:
        flips = draw.choice(18, draw.integers(0, 5), replace=False)
        values.add(center ^ sum(1 << int(b) for b in flips))
    values |= {int(v) for v in draw.integers(0, 2**63, 200)}
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    links = simhash.links(nodes)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    keys = np.array(sorted(values), np.uint64)
    seen, root = {}, 0
    for start in range(len(keys)):
        if start in seen:
            continue
        queue, root = [start], start
        seen[start] = root
        while queue:
            near = np.flatnonzero(np.bitwise_count(keys ^ keys[queue.pop()]) <= 3)
            for i in near.tolist():
                if i not in seen:
                    seen[i] = root
                    queue.append(i)
    plain = {int(keys[i]): int(keys[r]) for i, r in seen.items()}
    assert {v: got.get(v, v) for v in plain} == plain


def test_thresholds_are_exact_and_unequal():
    cost, thresholds = simhash.allocate([[0, 5, 9, 20], [0, 1, 2, 30], [0, 7, 8, 9]], 1)
    assert sum(thresholds) == 1 and cost == min(
        [0, 5, 9, 20][a + 1] + [0, 1, 2, 30][b + 1] + [0, 7, 8, 9][1 - a - b + 1]
        for a in range(-1, 3)
        for b in range(-1, 3)
        if -1 <= 1 - a - b <= 2
    )


def test_one_of_each_component_against_brute_force(spark):
    """Exact copies, copies with one of many words changed, null and repeated ids, texts without a word."""
    draw = random.Random(4)
    long = [sentence(draw, "en", 600).split() for _ in range(6)]
    data = [(r[0], r[1]) for r in rows()]
    for k, tokens in enumerate(long):
        for i in range(12):
            at = draw.randrange(600)
            data.append((None if i == 5 else 100 + 13 * k - i, " ".join([*tokens[:at], f"new{i}", *tokens[at + 1 :]])))
        data += [(100 + 13 * k, " ".join(tokens)), (None, " ".join(tokens)), (7, " ".join(tokens))]
    data += [(2, "two texts"), (2, "under one id"), (None, "without an id"), (None, "two of them"), (None, "two of them")]
    prints = [(i, _plain_fingerprint(t)) for i, (_, t) in enumerate(data)]
    groups = {}
    for i, component in _plain_components(prints):
        groups.setdefault(component, []).append(i)
    assert 20 < len(groups) < len(data) - 40
    docs = documents(spark, [(i, t, "en", "s", 1, None, None) for i, t in data])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    kept = _collected(kept.select("doc_id", "text"))
    assert len(kept) == len(groups)
    group_of = {(data[i][0], data[i][1]): g for g, members in groups.items() for i in members}
    assert sorted(group_of[row] for row in kept) == sorted(groups)
    for row in kept:
        ids = [data[i][0] for i in groups[group_of[row]] if data[i][0] is not None]
        assert row[0] == min(ids, default=None)
    assert simhash.one_of_each(nothing(spark)).count() == 0


def _crowd(monkeypatch):
    """(doc_id, fingerprint) of rows of which more than a bucket may hold agree on two of the four masks probed; the text
    is the fingerprint as a number."""
    monkeypatch.setattr(simhash, "probe_plan", lambda nodes, distance: [(i, 0xFFFF << 16 * i) for i in range(4)])
    text = F.col("text").cast("long").alias("fp")
    monkeypatch.setattr(simhash, "_printed", lambda named, shingle: named.select(*named.columns[:-1], text))
    draw = random.Random(6)
    shared = draw.getrandbits(40)
    prints = [(None if i % 50 == 7 else 9000 - i // 2, draw.getrandbits(24) << 40 | shared) for i in range(2600)]
    prints += [(i, draw.getrandbits(64)) for i in range(100)]
    assert len({fp for _, fp in prints if fp & 0xFFFF == shared & 0xFFFF}) > 2048
    return prints + prints[:5]


def _numbered(spark, prints):
    signed = [(i, str(fp - (fp >> 63 << 64))) for i, fp in prints]
    return documents(spark, [(i, t, "en", "s", 1, None, None) for i, t in signed])


def test_one_of_each_of_a_crowd_against_brute_force(spark, monkeypatch):
    prints = _crowd(monkeypatch)
    groups = {}
    for i, component in _plain_components([(i, fp) for i, (_, fp) in enumerate(prints)]):
        groups.setdefault(component, []).append(i)
    assert 500 < len(groups) < 2500
    kept = simhash.one_of_each(_numbered(spark, prints)).collect()
    group_of = {prints[i][1]: g for g, members in groups.items() for i in members}
    kept = {group_of[int(r.text) % 2**64]: r.doc_id for r in kept} if len(kept) == len(groups) else {}
    ids = {g: [prints[i][0] for i in members if prints[i][0] is not None] for g, members in groups.items()}
    assert kept == {g: min(found, default=None) for g, found in ids.items()}


def test_near_duplicates_of_a_crowd_against_brute_force(spark, monkeypatch):
    prints = _crowd(monkeypatch)
    found = simhash.near_duplicates(_numbered(spark, prints)).collect()
    assert sorted([(r.doc_id, r.fp % 2**64) for r in found], key=str) == sorted(prints, key=str)
    assert sorted([(r.doc_id, r.component_id) for r in found], key=str) == sorted(_plain_components(prints), key=str)


# --- language


def test_language(spark):
    docs = documents(spark)
    profiles = langid.learn(langid.training_rows(docs))
    assert profiles.languages == ["en", "fr"]
    got = {r.doc_id: r for r in langid.identify(docs, profiles).collect()}
    for doc_id, text, lang, *_ in rows():
        r = got[doc_id]
        assert r.held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if not text or not any(map(str.isalpha, text)):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif lang and len(text) > 40:
            assert r.lang_pred == lang
    kept = langid.in_a_known_language(docs, profiles)
    assert kept.columns == docs.columns and 40 not in [r.doc_id for r in kept.collect()]
    none = langid.learn(nothing(spark))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(nothing(spark), profiles).count() == 0


def test_texts_in_no_learned_language_go(spark):
    docs = documents(spark)
    profiles = langid.learn(docs)
    draw = random.Random(8)

    def drawn(alphabet, n):
        return " ".join("".join(draw.choices(alphabet, k=draw.randint(2, 9))) for _ in range(n))

    alphabets = [
        "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", [chr(0x430 + i) for i in range(32)],
        [chr(0x4E00 + i) for i in range(3000)],
    ]
    foreign = [drawn(a, n) for a in alphabets for n in (60, 300) for _ in range(10)]
    foreign += [base64.b64encode(draw.randbytes(600)).decode() for _ in range(10)]
    known = [sentence(draw, lang, n) for lang in ("en", "fr") for n in (3, 6, 40, 200) for _ in range(10)]
    data = [(i, t, None, None, None, None, None) for i, t in enumerate(known + foreign)]
    kept = langid.in_a_known_language(documents(spark, data), profiles)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(len(known)))


# --- language model


def test_language_model_matches_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "UNIT_BYTES", 3000)
    monkeypatch.setattr(lm, "SHARD_KEYS", 200)
    got = {(r.doc_id, r.n_tokens): r for r in lm.score(documents(spark)).collect()}
    end = b"\x00end"
    texts = [(r[0], words(r[1]) + [end]) for r in rows()]
    crc = {d: zlib.crc32(str(d).encode()) for d, _ in texts}
    learn = [t for d, t in texts if d is not None and crc[d] % 10]
    one, two = Counter(w for t in learn for w in t), Counter(p for t in learn for p in zip([end, *t], t))
    n, v = sum(one.values()), len(one)
    for doc_id, tokens in texts:
        r = got[doc_id, len(tokens)]
        assert r.train_tokens == n and r.held_out == (doc_id is not None and crc[doc_id] % 10 == 0)
        assert r.n_known == sum(w in one for w in tokens)
        assert r.base_score == pytest.approx(sum(log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
        assert r.score <= 0
    assert sum(two.values()) == n


def test_mixture_weights_find_the_mixture():
    draw = np.random.default_rng(0)
    cells = np.array([3 << 32 | 1040 << 16 | 1008, 3 << 32 | 0 << 16 | 1008, 3 << 32 | 0 << 16 | 0])
    weights = lm.learned_weights(cells, np.array([700.0, 200.0, 100.0]))[3]
    assert weights.sum() == pytest.approx(1) and weights[0] > weights[1] > weights[2]
    assert lm.unpacked(lm.packed(v := draw.integers(0, 2**60, 50).astype(np.uint64)), np.uint64).tolist() == v.tolist()


def test_language_model_of_nothing(spark):
    assert lm.score(nothing(spark)).count() == 0


# --- packing


def test_word_ids_are_those_of_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, words_, draw = Tokenizer.from_file(path), packing.WordIds(path), random.Random(8)
    marks = ["it's", "WE'LL", "'s", "a.b", "x1y22", "Ünï", "ß", "ſ", "µ", "²", "½", "İ", "日本", "\u2028", "\xa0", "\x85", "\x1c", "\t", " ", "\n", "--", "\x7f", "e\u0301"]
    texts = ["".join(draw.choices([*marks, *"abcXYZ 09.,"], k=draw.randint(0, 30))) for _ in range(3000)]
    for at in range(0, 3000, 500):  # words of earlier calls are known to later ones
        part = texts[at : at + 500]
        assert [i.tolist() for i in words_.encode(part)] == [whole.encode(t, add_special_tokens=False).ids for t in part]
        if at == 1000:
            words_.forget()


def test_packing_places_every_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    data = [*rows(), (90, "It's we'll <|endoftext|> Ünï ﬁ İstanbul 日本\x1cx ½ a...b", "en", "s", 1, None, None)]
    data += [(91, sentence(random.Random(9), "fr", 45), "fr", "s", 1, None, None)] * 150  # equal rows, cut in many ways
    got = _collected(packing.pack(documents(spark, data), path, window=64))
    want = Counter()
    for r in data:
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want[r[0], tuple(ids)] += 1
    by_doc = {}
    for doc_id, start, length, crc, total, sequence, offset in got:
        by_doc.setdefault((doc_id, total), []).append((start, length, crc))
    for (doc_id, ids), copies in want.items():
        parts = sorted(by_doc[doc_id, len(ids)])
        assert sum(n for _, n, _ in parts) == copies * len(ids)
        for start, n, crc in parts:
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
    windows = {}
    for *_, length, crc, total, sequence, offset in got:
        windows.setdefault(sequence, []).append((offset, length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    used = sum(len(ids) * c for (_, ids), c in want.items())
    assert len(windows) * 64 < used * 1.02 + 64
    assert packing.pack(nothing(spark), path).count() == 0


def test_best_filling_is_the_best():
    draw = np.random.default_rng(2)
    for _ in range(30):
        left = {int(n): int(c) for n, c in zip(draw.integers(3, 30, 4), draw.integers(1, 4, 4), strict=True)}
        room = int(draw.integers(10, 80))
        counts = packing.best_filling(room, sorted(left, reverse=True), left)
        sums = {0}
        for n, c in left.items():
            sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= room}
        assert sum(n * c for n, c in counts.items()) == max(sums)
        assert all(c <= left[n] for n, c in counts.items())


def test_equal_lengths_leave_little_padding():
    plan = packing.minimum_slack({2500: 1000, 4096: 3})
    assert plan.windows * 4096 <= (2500 * 1000 + 3 * 4096) * 1.011 + 4096


# --- decontamination


def test_contamination(spark):
    items = [(1, "The Quick brown fox, jumping over seven lazy dogs at noon"), (2, None), (3, "shorter"), (4, " " * 40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pad = "lorem ipsum dolor sit amet " * 20
    texts = {
        0: pad + items[0][1].upper() + pad,
        1: pad + items[0][1].replace("brown", "brwon") + pad,
        2: pad + "The Quick brown fox, jumping over " + pad,
        3: items[0][1].replace(" ", "\n"),
        4: pad,
    }
    data = [(i, t, "en", "s", 1, None, None) for i, t in texts.items()] + [(5, None, *[None] * 5), (6, "", *[None] * 5)]
    docs = documents(spark, data)
    got = sorted((r.doc_id, r.item_id, r.start, r.length, r.edits) for r in decontaminate.contaminated_regions(docs, benchmark).collect())
    n = len(items[0][1])
    assert [g[:3] for g in got] == [(0, 1, len(pad)), (1, 1, len(pad)), (3, 1, 0)]
    assert got[0][3:] == (n, 0) and 0 < got[1][4] <= 2 and got[2][3:] == (n, 0)
    kept = decontaminate.uncontaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]
    assert decontaminate.contaminated_regions(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated_regions(nothing(spark), benchmark).count() == 0


def test_short_items_and_passages_are_found():
    draw = random.Random(3)
    words_ = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(400)]
    long = " ".join(draw.choices(words_, k=100))
    pad = " ".join(draw.choices(words_, k=300))
    items = [(1, long), (2, "Paris is the capital."), (3, "The answer is 42 km/h"), (4, "..."), (None, "xyz")]
    index = decontaminate.Index(decontaminate.items_of(items))

    def found(text):
        return [(index.items[i].item_id, s, e) for i, s, e, *_ in decontaminate.matches(decontaminate.folded(text), index)]

    assert found(f"{pad} {long} {pad}") == [(1, len(pad) + 1, len(pad) + 1 + len(long))]  # its windows are not given again
    for a, b in ((0, 90), (10, 100), (5, 95), (20, 96)):
        part = " ".join(long.split()[a:b])
        ((item, s, e),) = found(f"{pad} {part} {pad}")
        assert item == 1 and s < len(pad) + 1 + len(part) and e > len(pad) + 1
    assert found(f"{pad} {' '.join(long.split()[40:60])} {pad}") == []
    assert found("see: PARIS is\tthe capital. So") == [(2, 5, 26)]
    assert found("the answer is 42 km/hour or xyzz ...") == []
    assert found("the answer is 42 km/h xyz") == [(3, 0, 21), (None, 22, 25)]
    got = decontaminate._rows_with_matches([pad, "Paris is the capital.", None, long], index)
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 0, 21), (3, 0, len(long))]


def test_regions_match_a_search_of_all_regions():
    """Every text that holds an item within its edits is found, and no other, by aligning each item over the whole text."""
    draw = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnop "))
    text_of = lambda n: "".join(draw.choice(letters, n)).strip()
    items = [(i, text_of(60 + 7 * i)) for i in range(6)]
    index = decontaminate.Index(decontaminate.items_of(items))
    for trial in range(60):
        own = list(items[trial % 6][1])
        for _ in range(trial % 9):
            at = int(draw.integers(len(own)))
            own[at : at + int(draw.integers(2))] = list(draw.choice(letters, int(draw.integers(2))))
        points = decontaminate.folded(text_of(80) + "".join(own) + text_of(80))
        want = {
            i for i, item in enumerate(index.items)
            if decontaminate.banded_alignment(item.points, points)[0] <= item.edits
        }
        assert {m[0] for m in decontaminate.matches(points, index)} == want


def test_banded_alignment_matches_the_plain_table():
    draw = np.random.default_rng(4)
    for _ in range(30):
        item, text = draw.integers(0, 3, 8), draw.integers(0, 3, 14)
        row = [0] * 15
        for i in range(8):
            new = [i + 1]
            for j in range(14):
                new.append(min(row[j] + int(item[i] != text[j]), row[j + 1] + 1, new[j] + 1))
            row = new
        edits, start, end = decontaminate.banded_alignment(item, text)
        assert edits == min(row) and end == row.index(edits) and 0 <= start <= end


# --- quality and toxicity


def _labelled(spark, n=160):
    draw = random.Random(9)
    data, labels = [], []
    for i in range(n):
        good, toxic = i % 4 != 0, i % 6 == 1
        text = sentence(draw, "en", 40) if good else "BUY!! " * 30
        text = text.replace(" ", " idiot ", 2) if toxic and good else text
        data.append((i, text, "en", f"src{i % 3}", 1, None, None))
        labels.append((i, int(good), int(toxic and good)))
    data += [(n, None, *[None] * 5), (n + 1, "", "en", "src0", 0, None, None), (None, "th er an", *[None] * 5)]
    labels += [(n, None, None), (None, 1, 1), (0, 0, 0)]
    return documents(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality(spark):
    docs, labels = _labelled(spark)
    sited = docs.withColumns({"host": F.col("source"), "path": F.col("lang")})
    got = quality.posteriors(sited, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.quality <= 1 for r in got)
    assert all(r.keep == (r.doc_id % 4 != 0) for r in got if r.doc_id is not None and r.doc_id < 160)
    kept = quality.good_documents(docs, labels, F.col("source"), F.col("lang"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in got if r.keep)
    assert all(r.quality == pytest.approx(0.5) for r in quality.posteriors(sited, labels.limit(0)).collect())
    assert quality.posteriors(sited.limit(0), labels).count() == 0


def test_sparse_sites_lean_on_their_parents(spark):
    scored = spark.createDataFrame(
        [("a", "x", 3.0)] * 50 + [("a", "y", -3.0)] + [("b", "x", -3.0)] * 50, "host string, path string, evidence double"
    )
    sites, share, host_k, path_k = quality.site_priors(scored, 0.0)
    found = {(r.host, r.path): r for r in sites.collect()}
    assert found["a", "y"].path_n == 1 and found["a", "y"].host_n == 51
    assert 0.4 < share < 0.6 and host_k >= 1 and path_k >= 1


def test_toxicity(spark):
    docs, labels = _labelled(spark)
    marks = {"junk": F.lit(1) - F.col("quality"), "toxic": F.col("toxic")}
    chain = toxicity.fit(docs, labels, marks)
    got = toxicity.score(docs, chain).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None and r.doc_id < 160:
            assert r.is_toxic == (r.doc_id % 6 == 1 and r.doc_id % 4 != 0)
            assert r.is_junk == (r.doc_id % 4 == 0)
    empty = toxicity.fit(docs, labels.limit(0), marks)
    assert toxicity.score(docs, empty).count() == docs.count()
    assert toxicity.score(nothing(spark), chain).count() == 0


def test_copies_of_a_text_share_a_fold(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "fit_chain", lambda x, y, fold: seen.update(x=x, fold=fold) or [])
    data = [(i % 90, f"copy number {i % 7} of a text", *[None] * 5) for i in range(180)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, junk int")
    toxicity.fit(documents(spark, data), labels, {"junk": F.col("junk")})
    folds = {}
    for row, fold in zip(seen["x"], seen["fold"], strict=True):
        folds.setdefault(row.tobytes(), set()).add(fold)
    assert len(seen["x"]) == 180 and len(folds) == 7 and all(len(f) == 1 for f in folds.values())


def test_chain_learns_from_unseen_predictions():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 2, (400, 3)).astype(float)
    first = x[:, 0]
    labels = np.stack([first, 1 - first], axis=1)
    weights = toxicity.fit_chain(x, labels, np.arange(400) % 4)
    p = toxicity.apply_chain(x, weights)
    assert ((p > 0.5) == labels.astype(bool)).all() and len(weights[1]) == len(weights[0]) + 1


