"""Sizes under each compression."""

from __future__ import annotations

from meterline.plans import codecs
from tests.trip_rows import processed


def test_every_codec_has_the_same_rows(spark, tmp_path):
    trips = processed(spark, *[{"tip_amount": f"{i % 7}.00"} for i in range(200)])
    found = {r.codec: r for r in codecs.codec_sizes(spark, trips, str(tmp_path / "sizes")).collect()}
    assert set(found) == {codecs.PLAIN, *codecs.CODECS}
    assert {r.rows for r in found.values()} == {200}
    assert found[codecs.PLAIN].share_of_plain == 1
    assert all(r.bytes > 0 and r.files >= 1 for r in found.values())


def test_no_trips(spark, tmp_path):
    found = codecs.codec_sizes(spark, processed(spark, {}).limit(0), str(tmp_path / "sizes"), ("zstd",)).collect()
    assert {(r.codec, r.rows) for r in found} == {("uncompressed", 0), ("zstd", 0)}
