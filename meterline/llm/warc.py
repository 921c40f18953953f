"""WARC archives with an index that is written first.

Each task writes its pages as gzip members to one archive in the shared folder and returns one index row for each
record: file, offset, length, URL, digest. Spark commits the index, so records of a failed attempt are never
referred to, and a retried task writes a file of its own. Readers select index rows, deal them out by file and
stretch of the file, sort by offset, and read runs of near records at once.

Of records with equal payloads of at least ``least_bytes`` the one with the smallest page_id is a response, the
others are revisits without payload that name it.

Defined results: null html is an empty payload; a null url is written as ``urn:x-page:<page_id>``; rows that share a
page_id and a payload with the response are responses too; a null page_id is a revisit where an equal payload has an
id, else a response; an empty table gives an empty index. Files are opened with pyarrow's file systems (local,
HDFS, S3, GCS), as Spark has no reader of byte ranges. Only the named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored
from meterline.session import new_shared_path

DATE = "2024-01-01T00:00:00Z"  # archives of the same pages are equal byte for byte
GAP = 64 << 10
CHUNK = 8 << 20
SHARE = 64 << 20  # bytes of archives that a reading task has on average
INDEX = (
    "page_id long, url string, file string, offset long, length long, digest string, payload_bytes long, record_type string"
)
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it (s3a becomes s3)."""
    if re.match(r"file:/*", path):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, response_id: int | None, digest: str) -> bytes:
    """One WARC record; a revisit if ``response_id`` is given."""
    revisit = response_id is not None
    block = _HTTP if revisit else _HTTP + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or record_name(page_id)[1:-1])
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_name(response_id)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields and the payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than its header says")
    return fields, block.partition(b"\r\n\r\n")[2]


def page_of(name: str | None) -> int | None:
    tail = name[len("<urn:x-page:") : -1] if name else "null"
    return None if tail == "null" else int(tail)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 4) -> DataFrame:
    """Writes the archives; returns the stored index."""
    body = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("body"))
    keyed = rows.select("page_id", "url", "body", F.sha1("body").alias("sha"))
    copies = (
        keyed.where(F.length("body") >= least_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("sha").alias("copied"), "response_id")
    )
    copies = stored(copies, "warc-copies")  # its size decides how Spark joins it
    known = keyed.join(copies, (F.col("sha") == F.col("copied")) & (F.length("body") >= least_bytes), "left")
    known = known.select("page_id", "url", "body", "response_id")
    file_system, base = place(folder)
    file_system.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    files, at = place(folder)
                    out = files.open_output_stream(f"{at}/{name}", compression=None)
                found = []
                for page_id, url, payload, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    refers = response if response != page_id else None
                    digest = digest_of(payload)
                    data = gzip.compress(record(page_id, url, payload, refers, digest), level, mtime=0)
                    out.write(data)
                    kind = "response" if refers is None else "revisit"
                    found.append((page_id, url, name, offset, len(data), digest, len(payload), kind))
                    offset += len(data)
                columns = zip(*found, strict=True)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
                names = [f.split()[0] for f in INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
                )
        finally:
            if out is not None:
                out.close()

    return stored(known.mapInArrow(run, INDEX), "warc-index")


def runs(spans: Iterable[tuple[str, int, int]], gap: int = GAP, most: int = CHUNK) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted (file, offset, length) in runs that are read at once: same file, small gaps, bounded size."""
    run: list[tuple[str, int, int]] = []
    for span in spans:
        if run:
            file, offset, length = run[-1]
            near = span[0] == file and span[1] - (offset + length) <= gap
            if not near or span[1] + span[2] - run[0][1] > most:
                yield run
                run = []
        run.append(span)
    if run:
        yield run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of the selected index rows.

    A revisit's payload is null; its length and digest are those of the full payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = place(folder)
        for batch in batches:
            spans = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for group in runs(spans):
                with files.open_input_file(f"{base}/{group[0][0]}") as source:
                    start = group[0][1]
                    data = source.read_at(group[-1][1] + group[-1][2] - start, start)
                yield _batch([parsed(gzip.decompress(data[o - start : o - start + n])) for _, o, n in group])

    chosen = index.select("file", "offset", "length", (F.col("offset") / CHUNK).cast("long").alias("stretch"))
    # A number of tasks by the bytes to read: from the size of the index alone, adaptive execution would plan one.
    spark = index.sparkSession
    asked = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(asked / SHARE))
    dealt = chosen.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length").mapInArrow(
        run,
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def _batch(records: list[tuple[dict[str, str], bytes]]) -> pa.RecordBatch:
    rows = []
    for fields, payload in records:
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and (digest_of(payload) != digest or len(payload) != int(fields["X-Payload-Length"])):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        refers = page_of(fields.get("WARC-Refers-To"))
        whole = payload if kind == "response" else None
        rows.append(
            (page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], whole, int(fields["X-Payload-Length"]), digest, kind, refers)
        )
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes an archive record for every page and reads the archives back."""
    folder = new_shared_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, least_bytes)
    found = read_records(index, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
