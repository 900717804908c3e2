"""WARC archives: write, normalise monolithic gzip, read back through an index.

``write_archives`` puts records into archives that are each one gzip stream,
as careless tools leave them: no record can be reached without inflating all
before it. ``normalise`` inflates such a stream once, in chunks, rewrites every
record as its own gzip member, and writes a sidecar index of offsets.
``read_back`` opens the members by the index alone and checks digests.

Of records with equal payloads (of at least ``min_bytes``), the one with the
smallest page_id is a response and the others are revisits of it.

Edge cases: a NULL html is an empty payload; rows with the smallest page_id of
a payload that repeat are all responses; a NULL page_id is a response that
nobody refers to; a NULL url is named by the page_id; control characters in a
url are escaped; an empty table gives no archives; extra columns are ignored.

Scale: the choice of responses shuffles ids and digests only, with partial
aggregation. A task writes archives of at most ``archive_bytes`` of records,
and all three steps hold one record's header and one chunk in memory (reading
back: one record). Archives and manifests lie in the shared folder; a path
names the task attempt, and a manifest names only files of committed tasks, so
a lost executor's half-written files are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import shared_path, stored, table, text_bytes

ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile("[\x00-\x20\x7f-\xa0]")

_MANIFEST = "path string, records long"
_PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, member_offset long, member_length long"


def decided(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to`` (NULL: a response)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), F.sha1(html).alias("digest"))
    ids = rows.where(F.col("page_id").isNotNull() & (F.length("html") >= min_bytes)).select("page_id", "digest").distinct()
    first = ids.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id")).where("first_id < last_id")
    again = ids.join(first, "digest").where("page_id > first_id").select("page_id", "digest", F.col("first_id").alias("refers_to"))
    return rows.join(again, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record with its two line ends."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    target = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    block = _HTTP + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def _own_file(base: str, suffix: str) -> str:
    task = TaskContext.get()
    return f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}{suffix}"


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))]
    cols = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)], [n for n, _ in fields])


def write_archives(rows: DataFrame, base: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Manifest (``path, records``) of archives of one gzip stream each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        store.create_dir(root, recursive=True)
        out = None
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in (0, 1)), text_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                if out is None:
                    name, records, size = _own_file("", ".warc.gz"), 0, 0
                    out, deflate = store.open_output_stream(root + name, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = record(page_id, url, html, refers_to)
                out.write(deflate.compress(raw))
                records, size = records + 1, size + len(raw)
                if size >= archive_bytes:
                    out.write(deflate.flush())
                    out.close()
                    out = None
                    yield _rows([(base + name, records)], _MANIFEST)
        if out is not None:
            out.write(deflate.flush())
            out.close()
            yield _rows([(base + name, records)], _MANIFEST)

    return rows.mapInArrow(run, _MANIFEST)


def inflated(source) -> Iterator[bytes]:
    """Chunks of a gzip stream (of one member or many), each inflated once."""
    inflate, waiting = zlib.decompressobj(31), b""
    begun = False
    while raw := waiting or source.read(CHUNK):
        waiting, begun = b"", True
        while raw:
            out = inflate.decompress(raw, CHUNK)
            if out:
                yield out
            raw = inflate.unconsumed_tail
            if inflate.eof:
                waiting, raw = inflate.unused_data, b""
                inflate, begun = zlib.decompressobj(31), False
            elif not out and not raw:
                break
    if begun:
        raise ValueError("the gzip stream is cut off")


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """(headers, parts of the record's bytes) of each record; the parts must be
    used up before the next record."""
    buffer = b""

    def more() -> bool:
        nonlocal buffer
        chunk = next(chunks, b"")
        buffer += chunk
        return bool(chunk)

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("the archive ends within a record's header")
                return
        head = headers(buffer[:end])
        left = end + 4 + int(head["content-length"]) + 4

        def parts() -> Iterator[bytes]:
            nonlocal buffer, left
            while left:
                if not buffer and not more():
                    raise ValueError("the archive ends within a record")
                part, buffer = buffer[:left], buffer[left:]
                left -= len(part)
                yield part

        yield head, parts()


def normalise(manifest: DataFrame, base: str, level: int = 6) -> DataFrame:
    """Manifest of the normalised archives; beside each lies ``<path>.idx``
    with a line (offset, length, type, page_id) a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                raw_store, raw_path = fs.FileSystem.from_uri(path)
                name, at, records = _own_file("", ".warc.gz"), 0, 0
                with raw_store.open_input_stream(raw_path, compression=None) as source, store.open_output_stream(root + name, compression=None) as out, store.open_output_stream(f"{root}{name}.idx") as index:
                    for head, parts in split_records(inflated(source)):
                        member = zlib.compressobj(level, zlib.DEFLATED, 31)
                        for part in parts:
                            out.write(member.compress(part))
                        out.write(member.flush())
                        size = out.tell() - at
                        index.write(f"{at}\t{size}\t{head['warc-type']}\t{head.get('x-page-id', '')}\n".encode())
                        at, records = at + size, records + 1
                yield _rows([(base + name, records)], _MANIFEST)

    return manifest.mapInArrow(run, _MANIFEST)


def read_back(manifest: DataFrame) -> DataFrame:
    """One row per record, read member by member at the index's offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, root = fs.FileSystem.from_uri(path)
                out: list[tuple] = []
                with store.open_input_file(root) as archive, store.open_input_stream(f"{root}.idx") as index:
                    for line in index.read().splitlines():
                        at, size = map(int, line.split(b"\t")[:2])
                        archive.seek(at)
                        raw = zlib.decompress(archive.read(size), 31)
                        end = raw.index(b"\r\n\r\n")
                        head = headers(raw[:end])
                        block = raw[end + 4 : end + 4 + int(head["content-length"])]
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        digest, response = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"] == "response"
                        if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{path}: the payload at {at} doesn't match its digest")
                        number = lambda k: int(head[k]) if k in head else None  # noqa: B023, E731
                        out.append((number("x-page-id"), number("x-payload-length"), digest, head["warc-type"], number("x-refers-to-page"), path, at, size))
                        if len(out) >= 4096:
                            yield _rows(out, _PAGES)
                            out = []
                yield _rows(out, _PAGES)

    return manifest.mapInArrow(run, _PAGES)


def round_trip(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    base = shared_path(pages.sparkSession, "warc")
    spread = lambda m: m.repartition(max(1, m.count()))  # noqa: E731  a task for each archive
    raw = stored(write_archives(decided(pages, min_bytes), f"{base}/raw", archive_bytes), "manifest")
    whole = stored(normalise(spread(raw), f"{base}/members"), "manifest")
    return read_back(spread(whole))


def op4_warc_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 in SQL: five hex digits are 20 bits, four base32 digits.
ORACLE_SQL = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT r, page_id, octet_length(b) AS n, sha1(b) AS x FROM p),
g AS (SELECT r, i, CAST('0x' || substr(x, 1 + 5 * i, 5) AS INTEGER) AS v FROM h, range(8) AS t(i)),
d AS (SELECT r, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 15) & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 10) & 31), 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 5) & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v & 31), 1), '' ORDER BY i) AS payload_digest
      FROM g GROUP BY r),
f AS (SELECT x, min(page_id) AS first_id FROM h GROUP BY x)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM h JOIN d USING (r) JOIN f USING (x)
"""
