"""Spelling variants, exact top-k and collocations against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterline.llm import collocations, spelling, topk
from tests.llm.frames import documents, nothing, rows

# --- spelling variants


def _deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return a in _deletions(b) or b in _deletions(a)


def _plain_variants(data):
    seen = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            at = h % len(low)
            seen[low[:at] + low[at + 1 :] if h % 97 == 0 else low] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and x != w and _near(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    result = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(result, key=str)


def _words_with_errors(seed=2):
    draw = random.Random(seed)
    stems = ["Straße", "aaaaa", "aaaaaa", "abcdefgh", "ÀÉÎõü", "x" * 70, "ab" * 300, "colour", "color"]
    data = []
    for i in range(60):
        words = []
        for _ in range(40):
            w = list(draw.choice(stems))
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "É", "zz"])
            words.append("".join(w))
        data.append((i, " ".join(words) + "\n", "en", "s", 1, 0.5, "word"))
    return data


def test_variants_match_plain_python(spark):
    data = [*rows(), *_words_with_errors()]
    got = spelling.variants(documents(spark, data))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = _plain_variants(data)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(r[1] for r in want) and any(r[2] != r[1] and r[1] for r in want) and any(len(r[0]) > 100 for r in want)
    assert spelling.variants(nothing(spark)).count() == 0


def test_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_rows_of_band", lambda band: 3)
    words = sorted({r[0] for r in _plain_variants([*rows(), *_words_with_errors()])})
    frame = spark.createDataFrame([(w, 1 + i % 4) for i, w in enumerate(words)], "word string, n long")
    got = spelling.near_words(frame).collect()
    assert len(got) == len(set(got))
    assert {(r.word, r.near) for r in got} == {(a, b) for a in words for b in words if a != b and _near(a, b)}


def test_position_index_is_exact():
    draw = random.Random(8)
    words = sorted({"".join(draw.choices("abc", k=draw.randint(1, 7))) for _ in range(200)})
    index = spelling.PositionIndex(words)
    for size in range(1, 8):
        asked = [w for w in words if len(w) == size]
        letters = np.array([[ord(c) for c in w] for w in asked])
        found = set()
        for query, near in index.near(letters, True, True):
            found |= {(asked[q], words[k]) for q, k in zip(query, near, strict=True)}
        assert found == {(a, b) for a in asked for b in words if a != b and _near(a, b)}


# --- exact top-k


def _plain_top(data, k):
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in data
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if i % 50 == 0:
            asked[i] = min(v, asked.get(i, v))
    result = []
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))
        result += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(result)


@pytest.mark.parametrize("k", [5, 400])
def test_top_k_matches_plain_python(spark, k):
    draw = np.random.default_rng(3)
    data = [(i, draw.normal(size=6).tolist(), 1) for i in range(300)]
    data += [(i, [0.5] * 6, 1) for i in range(1000, 1500)]  # a common vector: ties at the k-th place
    data += [(50, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6], 1), data[3], data[100]]  # repeated ids and rows
    data += [(None, [1.0] * 6, 1), (2000, None, 1), (2050, [1.0, None, *[1.0] * 4], 1), (2100, [float("nan")] * 6, 1)]
    data += [(2150, [float("inf")] * 6, 1), (2200, [0.25, 0.5], 1), (2201, [-1.0, 1.0], 1), (2250, [], 1), (-50, [2.0] * 6, 1)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, score int").repartition(5)
    got = topk.top_k(frame, frame.vec_id % 50 == 0, k).collect()
    assert sorted(map(tuple, got)) == _plain_top(data, k)
    assert topk.top_k(frame.limit(0), frame.vec_id % 50 == 0).count() == 0


def test_large_components_are_exact():
    a = np.array([[2**31, -(2**31) + 1, 3]], np.int64)
    assert topk._products(a, a)[0, 0] == 2**62 + (2**31 - 1) ** 2 + 9
    with pytest.raises(OverflowError):
        topk._products(a * 4, a * 4)


# --- collocations


def _plain_phrases(data, least, best, share=50):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in data:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    result = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * c >= share * a for q, c in found.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


def _phrased():
    draw = random.Random(6)
    words = ["the", "of", "new", "York", "é", "a\x1cb", "|", "city", "THE"]
    data = []
    for i in range(50):
        text = "".join(draw.choice(words) + draw.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(200))
        data.append((i, text, draw.choice(["en", "", None]), "s", 1, 0.5, "phrase"))
    return [*rows(), *data, data[0]]


@pytest.mark.parametrize(("least", "best"), [(10, 2000), (3, 7)])
def test_collocations_match_plain_python(spark, least, best):
    data = _phrased()
    got = collocations.collocations(documents(spark, data), least, best)
    want = _plain_phrases(data, least, best)
    assert sorted(map(tuple, got.collect())) == want and want
    assert collocations.collocations(nothing(spark)).count() == 0


def test_bursts_spills_and_stretches_change_nothing(monkeypatch):
    """With tiny containers, memory, vocabularies and stretches the runs add up to the same counts."""
    import pyarrow as pa

    data = _phrased()
    batch = pa.record_batch(
        [pa.array([r[2] or "und" for r in data]), pa.array([(r[1] or "").encode() for r in data], pa.binary())], ["lang", "text"]
    )
    ones = type("Broadcast", (), {"value": b"\xff" * (1 << collocations.FILTER_BITS - 3)})

    def summed():
        words, hashes, exact = Counter(), Counter(), Counter()
        for part in collocations._first_reading(iter([batch])):
            for r in part.to_pylist():
                (words if r["hash"] is None else hashes)[r["lang"], r["word"], r["hash"]] += r["n"]
        for part in collocations._second_reading(ones)(iter([batch])):
            for r in part.to_pylist():
                exact[r["lang"], r["head"], r["tail"]] += r["n"]
        return words, hashes, exact

    usual = summed()
    for name, value in {"BURST": 4, "ENTRIES": 50, "WORDS": 12, "STRETCH": 40}.items():
        monkeypatch.setattr(collocations, name, value)
    assert summed() == usual


def test_products_past_64_bits(spark):
    """a * a * 1,000,000 is exact where it passes 64 bits."""
    a, left, right = 4_000_000_000, 5_000_000_000, 7_000_000_000
    row = spark.sql(
        f"SELECT CAST((CAST(a * a AS DECIMAL(31,0)) * 1000000BD) div CAST(l * r AS DECIMAL(36,0)) AS BIGINT) AS s FROM "
        f"(SELECT CAST({a} AS DECIMAL(18,0)) a, CAST({left} AS DECIMAL(18,0)) l, CAST({right} AS DECIMAL(18,0)) r)"
    ).first()
    assert row.s == 1_000_000 * a * a // (left * right)
