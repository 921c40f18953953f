from __future__ import annotations

import base64
import gzip
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from meterline.llm import iblt, preference, warc
from meterline.session import new_shared_path
from tests.llm.frames import documents, nothing, rows

PAGES = [
    (1, "http://a/1", "<p>one\r\n\r\nWARC/1.1</p>", 0),
    (2, "http://a/2 x", "<p>same</p>", 0),
    (3, None, "<p>same</p>", 0),
    (4, "http://a/4", None, 0),
    (5, "http://a/5", "", 0),
    (None, "http://a/6", "<p>same</p>", 0),
    (7, "http://a/7", "ü" * 5000, 0),
    (7, "http://a/7", "ü" * 5000, 0),
]


def _pages(spark, data=PAGES):
    return spark.createDataFrame(data, "page_id long, url string, html string, digest int").repartition(2)


def test_archives_read_back(spark):
    folder = new_shared_path(spark, "warc-test")
    index = warc.write_archives(_pages(spark), folder)
    got = warc.read_records(index, folder).collect()
    want = {}
    for page_id, _, html, _ in PAGES:
        body = (html or "").encode()
        want[page_id] = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    refers = {3: 2, None: 2, 5: 4}
    assert len(got) == len(PAGES)
    for r in got:
        assert (r.payload_bytes, r.payload_digest) == want[r.page_id]
        assert r.refers_to == refers.get(r.page_id)
        assert r.record_type == ("revisit" if r.page_id in refers else "response")
        if r.record_type == "response":
            assert bytes(r.payload) == next((h or "").encode() for p, _, h, _ in PAGES if p == r.page_id)
    some = index.where("page_id IN (1, 7)")
    assert sorted(r.page_id for r in warc.read_records(some, folder).collect()) == [1, 7, 7]


def test_archives_are_gzip_members_of_records(spark):
    folder = new_shared_path(spark, "warc-test")
    index = warc.write_archives(_pages(spark), folder).collect()
    files, base = warc.place(folder)
    for r in index:
        with files.open_input_file(f"{base}/{r.file}") as f:
            data = gzip.decompress(f.read_at(r.length, r.offset))
        fields, _ = warc.parsed(data)
        assert re.fullmatch(r"<urn:x-page:(\d+|null)>", fields["WARC-Record-ID"])
        assert fields["WARC-Payload-Digest"] == f"sha1:{r.digest}"


def test_small_payloads_stay_responses(spark):
    got = warc.round_trip(_pages(spark), least_bytes=100).collect()
    assert {r.record_type for r in got} == {"response"}
    assert warc.round_trip(_pages(spark, []).limit(0)).count() == 0


def test_ranges_are_read_together():
    spans = [("a", 0, 10), ("a", 12, 10), ("a", 200, 10), ("b", 210, 10), ("b", 220, 90)]
    assert [len(r) for r in warc.runs(spans, gap=5, most=50)] == [2, 1, 1, 1]


# --- preference pairs


def _conversations(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, part string")


def test_pairs_share_a_prompt(spark):
    data = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"), (1, 3, "assistant", "fine"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "more"), (2, 3, "assistant", "bad"),
        (3, 0, "user", "hi"), (3, 1, "assistant", None),
        (4, None, None, "x"), (4, 1, "assistant", "a"), (4, 1, "assistant", "a"),
        (9000, 0, "user", "hi"), (9000, 1, "assistant", "other"),
    ]
    got = preference.rendered_pairs(_conversations(spark, [(*r, "p") for r in data])).collect()
    shown = {}
    for r in sorted(got, key=lambda r: (r.turn is not None, r.turn or 0, r.copy)):
        shown.setdefault((r.chosen_id, r.rejected_id, r.part), []).append(r)
    texts = {k: "".join(r.rendered for r in v) for k, v in shown.items()}
    assert texts[1, 2, "prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\nmore<|end|>\n"
    assert texts[1, 2, "chosen"] == "<|assistant|>\nfine<|end|>\n" and texts[1, 2, "rejected"] == "<|assistant|>\nbad<|end|>\n"
    assert texts[3, 9000, "prompt"] == "<|user|>\nhi<|end|>\n" and (3, 9000, "rejected") in texts
    assert texts[4, None, "chosen"] == "<||>\nx<|end|>\n" + "<|assistant|>\na<|end|>\n" * 2
    r = shown[1, 2, "chosen"][0]
    assert r.rendered[r.loss_from : r.loss_to] == "fine<|end|>\n"
    assert all(r.loss_from is None for r in shown[1, 2, "prompt"])
    assert preference.rendered_pairs(_conversations(spark, []).limit(0)).count() == 0


def test_pairs_follow_the_ids_of_an_opening(spark):
    """Null ids have no partner, and sparse ids are paired in their order."""
    for ids in ([7, None], [7, 9, None], sorted(hash((i, 3)) % 10**15 for i in range(301))):
        data = [(i, 0, "user", "hi", "p") for i in ids] + [(5, 0, "user", "else", "p")]
        got = preference.pairs(preference.turns(_conversations(spark, data))).collect()
        known = [i for i in ids if i is not None]
        want = {(5, 5, None, 0)} | {(None, None, None, 0) for i in ids if i is None}
        for a in range(0, len(known), 2):
            pair = known[a : a + 2]
            want |= {(x, pair[0], pair[1] if len(pair) > 1 else None, side) for side, x in enumerate(pair)}
        assert len(got) == len(want) and {(r.conv_id, r.pair_id, r.rejected_id, r.side) for r in got} == want


def test_native_plans_have_no_python(spark):
    docs = documents(spark)
    frame = preference.rendered_pairs(_conversations(spark, [(1, 0, "user", "a", "b")]))
    for f in (frame, iblt.edited_fingerprints(docs)):
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# --- fingerprints


def _pieces(text, words=8):
    return set(re.findall(rf"\S+(?:[^\S\n]+\S+){{0,{words - 1}}}", text or "", re.ASCII))


def test_fingerprints_match_plain_sets(spark):
    got = iblt.edited_fingerprints(documents(spark)).collect()
    distinct = sorted({(r[0], r[1] or "") for r in rows()}, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = {}
    for i, (doc_id, text) in enumerate(distinct):
        after = distinct[(i + 1) % len(distinct)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]

        def near(a, b):
            a, b = _pieces(a), _pieces(b)
            return len(a & b) / len(a | b) if a | b else 1.0

        want[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), near(text, edited), near(text, after))
    assert len(got) == len(rows())
    prints = {}
    texts = {r[0]: r[1] or "" for r in rows()}
    for r in got:
        n, sha, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(after)
        prints.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    assert iblt.edited_fingerprints(nothing(spark)).count() == 0


def test_a_sketch_too_small_is_made_larger(spark):
    data = [(1, list(range(200)), list(range(100, 300))), (2, [1, 2], [2, 1]), (3, [], [])]
    versions = spark.createDataFrame(data, "k long, own array<long>, other array<long>")
    found = iblt.likeness(versions, {"p": ("own", "other", 0.05)}, sweeps=3)
    got = {r.k: (r.only_plus, r.only_minus) for r in found.collect()}
    assert got[1] == (100, 100) and got.get(2, (0, 0)) == (0, 0)


def test_order_over_ranges(spark):
    data = [(i * 7 % 101, i) for i in range(101)] + [(None, 500)]
    frame = spark.createDataFrame(data, "doc_id long, n_chars int").withColumn("k", F.xxhash64("doc_id"))
    got = {r.doc_id: r for r in iblt.order_of(frame).collect()}
    chars = dict(data)
    for doc_id in range(100):
        assert got[doc_id].user_chars == chars[doc_id + 1]
    assert got[None].user_chars == chars[0] and got[100].user_chars == 500


def test_shortened_versions_are_restored(spark):
    rows = [
        (1, [1, 2, 3, 4], [1, 2, 7, 4]),
        (2, [1, 2], [1, 2]),
        (3, [], [5]),
        (4, [5], []),
        (5, [], []),
        (6, [1, 2], [1, 2, 3]),
        (7, [1, 2, 3], [1, 2]),
    ]
    frame = spark.createDataFrame(rows, "k long, own array<long>, changed array<long>")
    short = iblt.shortened(frame)
    assert {r.k: (r.alike, r.rest) for r in short.collect()} == {
        1: (2, [7, 4]), 2: (2, []), 3: (0, [5]), 4: (0, []), 5: (0, []), 6: (2, [3]), 7: (2, []),
    }
    assert sorted(map(tuple, iblt.restored(short).select("k", "own", "changed").collect())) == rows
