"""Benchmark decontamination with one Aho-Corasick automaton.

The test items are normalised into windows of ``WINDOW`` words, and one
automaton over all windows scans each normalised text once. Every match is
mapped back to code-point offsets of the original text.

Normal form: A-Z in lower case; a word is a run of letters a-z, digits and
characters beyond ASCII. Matching runs on UTF-8 bytes (latin-1 strings hold
one byte a character), so ill-formed text cannot break it.

Edge cases: NULL or empty text has no words and is clean; an item without
words has no window; repeated items count once per item_id; a NULL item_id is
listed as ``null``; repeated documents each get a row; columns beyond the ones
read are ignored.

Scale: the documents are never shuffled. The items are broadcast in blocks of
at most ``block_bytes`` (measured with an aggregate first); with more than one
block each block scans the documents and the hit runs meet by row.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import map_batches, table, text_bytes

WINDOW = 10
BLOCK_BYTES = 4 << 20
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

SCHEMA = "row_key long, doc_id long, n_words long, hits array<struct<start:long,stop:long>>, items array<string>, spans string"


def words(raw: bytes) -> list[bytes]:
    return raw.translate(_NORMAL).split()


def automaton(items: list[tuple[str, bytes]], window: int = WINDOW):
    """Automaton over `` w1 w2 .. wn `` strings; payload: (n words, item ids)."""
    import ahocorasick

    windows: dict[str, tuple[int, set]] = {}
    for item_id, raw in items:
        ws = words(raw)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            key = (b" " + b" ".join(ws[i : i + n]) + b" ").decode("latin-1")
            windows.setdefault(key, (n, set()))[1].add(item_id)
    out = ahocorasick.Automaton()
    for key, (n, ids) in windows.items():
        out.add_word(key, (n, frozenset(ids)))
    if windows:
        out.make_automaton()
    return out if windows else None


def merge(runs) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def hits_of(text: str, found) -> tuple[list[tuple[int, int]], list[str]]:
    """Merged runs of hit words and the items of a normalised text's matches."""
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    runs, items = [], set()
    for end, (n, ids) in found:
        stop = int(np.searchsorted(spaces, end))
        runs.append((stop - n, stop))
        items |= ids
    return merge(runs), sorted(items)


def original_spans(raw: bytes, runs: list[tuple[int, int]]) -> str:
    """Code-point spans in the original text of runs of word numbers."""
    at = [m.span() for m in _WORD.finditer(raw)]
    firsts = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    code = lambda byte: int(firsts[byte - 1]) if byte else 0
    return ",".join(f"{code(at[a][0])}:{code(at[b - 1][1])}" for a, b in runs)


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The items, in lists of bounded size; the size is measured first."""
    tests = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = tests.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / (block_bytes * 0.7)))
    for b in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # at most about block_bytes
        yield blocks, [(r["item_id"], r["text"].encode()) for r in rows]


def _matches(machine, raw: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
    """Number of words, merged runs of hit words, items."""
    ws = words(raw)
    text = (b" " + b" ".join(ws) + b" ").decode("latin-1")
    found = list(machine.iter(text)) if machine is not None and ws else []
    return len(ws), *(hits_of(text, found) if found else ([], []))


def _scan(docs: DataFrame, items, window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def make():
        machine = automaton(shared.value, window)

        def step(batch: pa.RecordBatch):
            rows = []
            for key, doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
                n, runs, which = _matches(machine, raw)
                rows.append((key, doc_id, n, [{"start": a, "stop": b} for a, b in runs], which, original_spans(raw, runs) if runs else ""))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["row_key", "doc_id", "n_words", "hits", "items", "spans"])

        return step

    return map_batches(docs, make, SCHEMA)


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``row_key, doc_id, n_words, hits`` (runs of word
    numbers), ``items`` (ids as sorted strings), ``spans`` (``start:end`` code
    points in the original text)."""
    docs = documents.select(F.monotonically_increasing_id().alias("row_key"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = None
    for blocks, items in blocks_of(benchmark, block_bytes):
        part = _scan(docs, items, window)
        found = part if found is None else found.unionByName(part)
    if blocks == 1:
        return found
    ends = lambda s: tuple(map(int, s.split(":")))
    joined_runs = F.udf(lambda runs: merge((r["start"], r["stop"]) for r in runs), "array<struct<start:long,stop:long>>")
    joined_spans = F.udf(lambda spans: ",".join(f"{a}:{b}" for a, b in merge(ends(x) for s in spans for x in s.split(",") if x)), "string")
    return found.groupBy("row_key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), joined_runs(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), joined_spans(F.collect_list("spans")).alias("spans"),
    )


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, r: acc + r["stop"] - r["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without any hit word, columns as they came: one filter a
    block of items, no shuffle."""
    text = documents.columns.index("text")
    for _, items in blocks_of(benchmark, block_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            machine = automaton(shared.value, window)

            def step(batch: pa.RecordBatch):
                yield batch.filter(pa.array([not _matches(machine, raw)[1] for raw in text_bytes(batch.column(text))], pa.bool_()))

            return step

        documents = map_batches(documents, make, documents.schema)
    return documents


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


#: Windows of items and documents as strings, joined on equality.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bi AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS s FROM bi),
ns AS (SELECT DISTINCT n FROM bw),
di AS (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n),
dw AS (SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM di),
m AS (SELECT k, i, dw.n, item_id FROM dw JOIN bw USING (n, s)),
h AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM m) GROUP BY k),
it AS (SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN it USING (k)
"""

