import base64
import gzip
import hashlib
import io

import pytest
from pyarrow import fs

from txpipe.llm import common, warc

SCHEMA = "page_id long, url string, html string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS digest", "1 AS refers_to", "'y' AS path")


def brute(rows, min_bytes=0):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payloads:
        if i is not None and len(p) >= min_bytes:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payloads:
        again = i is not None and p in first and i > first[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


ROWS = [(i, f"https://e.example/{i % 5}", ["<p>é😀</p>", "", "x" * 70_000, "same"][i % 4]) for i in range(60)]
ROWS += [(100, None, None), (101, "http://a b\r\n\x00", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, None, "same"), (None, "u", "only here"), (3, "u", "same"), (7, "again", "same"), (200, "u", "y" * 3_000_000)]


@pytest.mark.parametrize("min_bytes,archive_bytes", [(0, 1 << 20), (5, 100_000)])
def test_round_trip_matches_brute_force(spark, min_bytes, archive_bytes):
    got = warc.round_trip(table(spark, ROWS).repartition(3), min_bytes, archive_bytes)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(ROWS, min_bytes)


def test_archives_are_monolithic_then_one_member_a_record(spark):
    base = common.shared_path(spark, "warc-test")
    raw = common.stored(warc.write_archives(warc.decided(table(spark, ROWS)).coalesce(1), f"{base}/raw"), "m")
    whole = common.stored(warc.normalise(raw, f"{base}/members"), "m")
    (before,), (after,) = raw.collect(), whole.collect()
    assert before["records"] == after["records"] == len(ROWS)
    local = lambda p: fs.FileSystem.from_uri(p)[1]
    with open(local(before["path"]), "rb") as f:
        mono = f.read()
    with open(local(after["path"]), "rb") as f:
        members = f.read()
    assert gzip.decompress(mono) == gzip.decompress(members)
    with open(local(after["path"]) + ".idx") as f:
        index = [line.split("\t") for line in f]
    place = 0
    for offset, size, kind, _ in index:
        assert int(offset) == place
        place += int(size)
        one = gzip.decompress(members[int(offset) : place])
        assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n") and f"WARC-Type: {kind}".encode() in one
    assert place == len(members) and len(index) == len(ROWS)


def test_inflate_takes_many_members_and_finds_cuts():
    data = [b"a" * 3_000_000, b"", b"bc"]
    whole = b"".join(map(gzip.compress, data))
    assert b"".join(warc.inflated(io.BytesIO(whole))) == b"".join(data)
    with pytest.raises(ValueError):
        list(warc.inflated(io.BytesIO(whole[:-9])))
    with pytest.raises(ValueError):
        for _, parts in warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"])):
            list(parts)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
