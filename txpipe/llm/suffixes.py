"""Repeated passages by a distributed merge sort of sampled suffixes.

Every byte covered by a ``SPAN``-byte string that also starts elsewhere is
removed. All strings of ``SPAN`` bytes are decided exactly; only suffixes at
anchors are sorted:

1. The anchor of the string at p is the place q in [p, p + WINDOW) with the
   least hash of 16 bytes (the first of equals). It depends on the string
   alone, so equal strings have anchors at equal distance d = q - p. Strings
   with one anchor are consecutive: an item is an anchor and its range of d.
2. All these strings hold the ``CORE`` bytes after the anchor. Items whose core
   hash occurs once in the corpus cannot repeat and go; equal items (by hash of
   all their bytes) become one with a count.
3. The items' suffixes (from the anchor on, as far as their strings reach) are
   sorted: each task sorts its own and front-codes them (shared length with the
   one before, rest), runs are exchanged by ranges of the sort order, and a
   loser tree merges the runs of a range. Losers keep the length they share
   with the last winner, so no known prefix is compared again. The merge gives
   the shared length of neighbours.
4. For each d, items in a stretch of neighbours that share SPAN - d bytes have
   equal strings exactly if the d bytes before the anchor are equal, too; that
   is a running hash. Items that meet an equal string, or have a count, give
   repeated ranges of d, which go back to all places of equal items.

Edge cases: NULL and empty texts have 0 bytes; texts shorter than the span
never repeat; overlapping repeats in one text count; repeated rows are places
of their own; a NULL doc_id stays NULL; an empty table gives no rows; extra
columns are ignored.

Scale: hashes and places are shuffled for all anchors, bytes only for one
representative of each item, texts (compressed) twice by row. Equal items are
counted with partial aggregates. Items of a core with over ``HOT`` different ones
are not merged, as they could fill one range: they are cut by d into
``STEP``-wide pieces, equal pieces (by hash) are counted, and where a piece that
occurs once shares its suffix with others, its single strings are counted by
hash; their texts are shuffled twice more. So a range of the merge holds about
``RANGE_BYTES`` and at most ``HOT`` items of any core; the sample of suffixes that
ranges come from grows with their number (``SAMPLES_A_RANGE``).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import map_batches, stored, table, text_bytes, with_row_keys

SPAN = 400
WINDOW = 256
GRAM = 16
CORE = SPAN - WINDOW + 1
HOT = 20_000
STEP = 32
CHUNK = 1 << 20  # bytes of text looked at together
RUN_BYTES = 24 << 20  # bytes of items that a task sorts together
BLOB_BYTES = 512 << 10
RANGE_BYTES = 16 << 20
SAMPLE_ONE_IN, SAMPLES, SAMPLES_A_RANGE = 1024, 4096, 16

_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_META = np.dtype([("kh", "<i8"), ("ch", "<i8"), ("lcp", "<u2"), ("tail", "<u2"), ("lo", "<u2"), ("hi", "<u2"), ("shift", "<u2"), ("many", "<u2")])


# -- anchors ---------------------------------------------------------------


def _gram_hash(buf: bytes) -> np.ndarray:
    words = np.empty(len(buf) - 7, np.uint64)
    for o in range(8):
        part = np.frombuffer(buf, "<u8", (len(buf) - o) // 8, o)
        words[o::8] = part[: len(words[o::8])]
    n = len(buf) - GRAM + 1
    h = words[:n] * _M[0]
    h ^= words[8 : 8 + n] * _M[1]
    h ^= h >> np.uint64(29)
    h *= _M[2]
    h ^= h >> np.uint64(32)
    return h


def _window_minima(key: np.ndarray, n: int, width: int) -> np.ndarray:
    """Least key of each of the first n windows."""
    need = n + width - 1
    blocks = np.full(need + -need % width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:need] = key[:need]
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def super_windows(texts: list[bytes], span: int = SPAN, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(text number, anchor, least and largest distance) of the items of some
    texts; places are bytes of the texts joined."""
    empty = tuple(np.empty(0, np.int64) for _ in range(4))
    buf = b"".join(texts)
    if len(buf) < span:
        return empty
    sizes = np.array([len(t) for t in texts])
    key = _gram_hash(buf)
    bits = np.uint64(max(1, (len(key) - 1).bit_length()))
    key = ((key >> bits) << bits) | np.arange(len(key), dtype=np.uint64)
    n = len(buf) - span + 1
    q = (_window_minima(key, n, window) & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    owner, ends = np.repeat(np.arange(len(texts)), sizes)[:n], np.cumsum(sizes)
    p = np.flatnonzero(ends[owner] - np.arange(n) >= span)  # strings within one text
    if not len(p):
        return empty
    q = q[p]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(q) != 0) | (np.diff(p) != 1)]))
    last = np.concatenate([first[1:] - 1, [len(p) - 1]])
    return owner[p[first]], q[first], q[first] - p[last], q[first] - p[first]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield at, i
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, len(texts)


def anchors(docs: DataFrame, span: int = SPAN, window: int = WINDOW) -> DataFrame:
    """``id_key, row_key, kh`` (hash of the core), ``ch`` (hash of all bytes and the
    range), ``q, lo, hi`` (in the text), and for a few a ``sample`` of bytes."""
    core = span - window + 1

    def make():
        import xxhash

        digest, signed = xxhash.xxh3_64_intdigest, lambda x: x - (1 << 64) if x >> 63 else x

        def step(batch: pa.RecordBatch):
            ids, keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), text_bytes(batch.column(2))
            for a, b in _chunks(texts):
                part = texts[a:b]
                owner, q, lo, hi = super_windows(part, span, window)
                if not len(q):
                    continue
                buf = b"".join(part)
                starts = np.cumsum([0, *map(len, part)])[:-1]
                kh = [signed(digest(buf[i : i + core])) for i in q.tolist()]
                ch = [signed(digest(buf[i - h : i - l + span], h)) for i, l, h in zip(q.tolist(), lo.tolist(), hi.tolist(), strict=True)]
                sample = [buf[i : i + span] if c % SAMPLE_ONE_IN == 0 else None for i, c in zip(q.tolist(), ch, strict=True)]
                cols = [pa.array(ids[a:b][owner]), pa.array(keys[a:b][owner]), pa.array(kh, pa.int64()), pa.array(ch, pa.int64()), pa.array((q - starts[owner]).astype(np.int32)), pa.array(lo.astype(np.int16)), pa.array(hi.astype(np.int16)), pa.array(sample, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["id_key", "row_key", "kh", "ch", "q", "lo", "hi", "sample"])

        return step

    return map_batches(docs.select("id_key", "row_key", "text"), make, "id_key long, row_key long, kh long, ch long, q int, lo short, hi short, sample binary")


# -- front-coded runs ------------------------------------------------------


def shared_length(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, of which ``at`` bytes are known."""
    n = min(len(a), len(b))
    while at < n and a[at : at + 32] == b[at : at + 32]:
        at += 32
    if at >= n:
        return n
    for x, y in zip(a[at : at + 32], b[at : at + 32], strict=False):
        if x != y:
            return at
        at += 1
    return min(at, n)


def front_code(items: list[tuple]) -> tuple[bytes, bytes, bytes]:
    """Sorted items (suffix, left, lo, hi, shift, many, kh, ch) as meta, tails
    and lefts."""
    meta, tails, before = np.zeros(len(items), _META), [], b""
    for i, (suffix, left, lo, hi, shift, many, kh, ch) in enumerate(items):
        n = shared_length(before, suffix)
        meta[i] = (kh, ch, n, len(suffix) - n, lo, hi, shift, many)
        tails.append(suffix[n:])
        before = suffix
    return meta.tobytes(), b"".join(tails), b"".join(x[1] for x in items)


def _runs(items: list[tuple], splitters: list[bytes], reach: int) -> Iterator[tuple[int, list[tuple]]]:
    """Sorted items by range, in blobs of bounded size."""
    items.sort()
    at, size, here = 0, 0, None
    for i, item in enumerate(items):
        own = bisect_right(splitters, item[0][:reach])
        if i > at and (own != here or size > BLOB_BYTES):
            yield here, items[at:i]
            at, size = i, 0
        here, size = own, size + len(item[0]) + len(item[1])
    if items:
        yield here, items[at:]


def item_runs(found: DataFrame, splitters: list[bytes], span: int = SPAN, window: int = WINDOW) -> DataFrame:
    """Front-coded sorted runs of the representatives' suffixes:
    ``range, run, seq, meta, tails, lefts``."""
    shared = found.sparkSession.sparkContext.broadcast(splitters)
    core = span - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import zstandard

        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        name, turn, held, items = os.urandom(8).hex(), 0, 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            for k, (own, part) in enumerate(_runs(items, shared.value, core)):
                coded = [pack.compress(x) for x in front_code(part)]
                yield pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([f"{name}-{turn}"]), pa.array([k], pa.int32()), *[pa.array([x], pa.binary()) for x in coded]], ["range", "run", "seq", "meta", "tails", "lefts"])

        for batch in batches:
            for packed, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = unpack.decompress(packed)
                for r in places:
                    q, lo, hi = r["q"], r["lo"], r["hi"]
                    items.append((text[q : q + span - lo], text[q - hi : q], lo, hi, 0, r["many"], r["kh"], r["ch"]))
                    held += span + hi - lo + 100
                if held > RUN_BYTES:
                    yield from flush()
                    turn, held, items = turn + 1, 0, []
        yield from flush()

    return found.select("z", "places").mapInArrow(run, "range int, run string, seq int, meta binary, tails binary, lefts binary")


# -- merge -----------------------------------------------------------------


def read_run(blobs: list[tuple[np.ndarray, bytes]], first: int) -> Iterator[tuple[int, bytes, int]]:
    """(shared length with the suffix before, suffix, item number) of a run."""
    before, number = b"", first
    for meta, tails in blobs:
        at, fresh = 0, True
        for n, tail in zip(meta["lcp"].tolist(), meta["tail"].tolist(), strict=True):
            suffix = before[:n] + tails[at : at + tail]
            at += tail
            yield (shared_length(before, suffix) if fresh else n), suffix, number
            fresh, before, number = False, suffix, number + 1


def merge_runs(runs: list[Iterator[tuple[int, bytes, int]]]) -> Iterator[tuple[int, int]]:
    """(shared length with the item before, item number) in sorted order.

    A loser tree: a node keeps the head that lost there and the length it
    shares with the winner. Of two heads, the one that shares more with the
    last output is smaller; only equal lengths need a look at the bytes beyond."""
    size = 1
    while size < len(runs):
        size *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (size - len(runs))
    shared = [0] * size  # with the last winner that passed the head's node
    tree = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length becomes that with the winner."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        n = shared_length(x, y, shared[a])
        if x[n : n + 1] <= y[n : n + 1]:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, tree[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while heads[winner] is not None:
        yield shared[winner], heads[winner][2]
        heads[winner] = next(runs[winner], None)
        if heads[winner] is not None:
            shared[winner] = heads[winner][0]
        node = (winner + size) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


def repeated_ranges(lcp: np.ndarray, lo: np.ndarray, hi: np.ndarray, many: np.ndarray, lefts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, least and largest distance) of the repeated strings of sorted
    items; lcp[i] is the length that items i - 1 and i share."""
    n, width = len(lcp), int(hi.max()) + 1
    back = np.zeros((n, width), np.uint8)  # byte at distance d + 1 before the anchor
    for i, left in enumerate(lefts):
        back[i, : len(left)] = np.frombuffer(left, np.uint8)[::-1]
    hit = np.zeros((n, width + 2), bool)
    rolled = np.zeros(n, np.uint64)
    for d in range(width):
        if d:
            rolled = rolled * _M[0] + back[:, d - 1] + np.uint64(1)
        own = np.flatnonzero((lo <= d) & (d <= hi))
        if not len(own):
            continue
        stretch = np.cumsum(lcp < span - d)[own].astype(np.uint64)
        key = rolled[own] ^ (rolled[own] >> np.uint64(31))
        key = (key * _M[1]) ^ (stretch * _M[2])
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(own), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        hit[own, d + 1] = again | many[own]
    edge = np.diff(hit.astype(np.int8), axis=1)
    item, start = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    return item, start, stop - 1


def merged(runs: DataFrame, span: int = SPAN) -> DataFrame:
    """``kh, ch, lo, hi``: repeated ranges of distance of the items."""

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        metas, lefts, readers, n = [], [], [], 0
        for _, own in part.sort_values(["run", "seq"]).groupby("run"):
            blobs, first = [], n
            for coded, tails, left in zip(own["meta"], own["tails"], own["lefts"], strict=True):
                meta = np.frombuffer(unpack.decompress(coded), _META)
                blobs.append((meta, unpack.decompress(tails)))
                raw, at = unpack.decompress(left), 0
                for hi in meta["hi"].tolist():
                    lefts.append(raw[at : at + hi])
                    at += hi
                metas.append(meta)
                n += len(meta)
            readers.append(read_run(blobs, first))
        order = np.array(list(merge_runs(readers)), np.int64).reshape(-1, 2)
        meta = np.concatenate(metas)[order[:, 1]]
        lo, hi, shift = (meta[c].astype(np.int64) for c in ("lo", "hi", "shift"))
        item, start, stop = repeated_ranges(order[:, 0], lo, hi, meta["many"] > 0, [lefts[i] for i in order[:, 1]], span)
        return pd.DataFrame({"kh": meta["kh"][item], "ch": meta["ch"][item], "from_d": start + shift[item], "to_d": stop + shift[item]})

    return runs.groupBy("range").applyInPandas(merge, "kh long, ch long, from_d int, to_d int")


# -- crowded cores -----------------------------------------------------------


def _from_texts(found: DataFrame, emit, schema: str) -> DataFrame:
    """Rows (tuples) that ``emit(text, place, signed digest)`` yields for each of
    ``places`` in a compressed text; ``id_key, row_key`` come first."""
    names = [c.split()[0] for c in schema.split(", ")]

    def make():
        import xxhash
        import zstandard

        unpack = zstandard.ZstdDecompressor()

        def digest(raw: bytes, seed: int = 0) -> int:
            x = xxhash.xxh3_64_intdigest(raw, seed)
            return x - (1 << 64) if x >> 63 else x

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

        def step(batch: pa.RecordBatch):
            rows = []
            for a, b, packed, places in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                text = unpack.decompress(packed)
                for r in places:
                    rows += [(a, b, *row) for row in emit(text, r, digest)]
                    if len(rows) > 50_000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)

        return step

    return map_batches(found.select("id_key", "row_key", "z", "places"), make, schema)


def crowded_ranges(docs: DataFrame, kinds: DataFrame, span: int = SPAN, step_width: int = STEP) -> DataFrame:
    """``kh, ch, from_d, to_d`` as ``merged`` gives them, by counting hashes."""
    fine = span - step_width + 1

    def cut(text, r, digest):
        q, lo, hi = r["q"], r["lo"], r["hi"]
        for shift in range(lo // step_width * step_width, hi + 1, step_width):
            a, b, x = max(lo - shift, 0), min(hi - shift, step_width - 1), q - shift
            yield r["kh"], r["ch"], x, shift, a, b, r["n"], digest(text[x - b : x + span - a], b), digest(text[x : x + fine], shift)

    def strings(text, r, digest):
        for d in range(r["lo"], r["hi"] + 1):
            p = r["x"] - d
            yield r["kh"], r["ph"], r["shift"] + d, r["n"], digest(text[p : p + span])

    def at_rows(rows: DataFrame, *columns: str) -> DataFrame:
        return _one_each(_packed(docs)).join(rows.groupBy("id_key", "row_key").agg(F.collect_list(F.struct(*columns)).alias("places")), ["id_key", "row_key"])

    longs = "id_key long, row_key long, kh long, "
    cuts = _from_texts(at_rows(kinds, "q", "lo", "hi", "n", "kh", "ch"), cut, longs + "ch long, x long, shift long, lo long, hi long, n long, ph long, sh long")
    pieces = stored(cuts, "pieces")
    one = F.first(F.struct("id_key", "row_key", "x", "shift", "lo", "hi", "sh")).alias("at")
    single = stored(pieces.groupBy("kh", "ph").agg(F.sum("n").alias("n"), one).select("kh", "ph", "n", "at.*"), "piece-kinds")
    # Equal strings lie in pieces of equal suffix; the counted pieces are there to meet.
    mixed = single.groupBy("kh", "sh").agg(F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1").select("kh", "sh")
    open_ = single.join(mixed, ["kh", "sh"], "left_semi")
    rows = _from_texts(at_rows(open_, "kh", "ph", "x", "shift", "lo", "hi", "n"), strings, longs + "ph long, d long, n long, h long")
    each = stored(rows, "strings")
    twice = each.groupBy("kh", "h").agg(F.sum("n").alias("total")).where("total > 1").select("kh", "h")
    hits = each.where("n = 1").join(twice, ["kh", "h"], "left_semi").groupBy("kh", "ph").agg(F.collect_set("d").alias("ds"))
    edges = lambda by: F.sort_array(F.filter("ds", lambda d: ~F.array_contains(F.col("ds"), d + by)))
    parts = hits.select("kh", "ph", F.explode(F.arrays_zip(edges(-1).alias("a"), edges(1).alias("b"))).alias("r")).select("kh", "ph", F.col("r.a").alias("from_d"), F.col("r.b").alias("to_d"))
    whole = single.where("n > 1").select("kh", "ph", (F.col("shift") + F.col("lo")).alias("from_d"), (F.col("shift") + F.col("hi")).alias("to_d"))
    found = pieces.select("kh", "ph", "ch").join(parts.unionByName(whole), ["kh", "ph"])
    return found.select("kh", "ch", F.col("from_d").cast("int"), F.col("to_d").cast("int"))


# -- the whole -------------------------------------------------------------


def _packed(docs: DataFrame) -> DataFrame:
    """``id_key, row_key, doc_id, z``: texts compressed, as they are shuffled by row."""

    def make():
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)

        def step(batch: pa.RecordBatch):
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([pack.compress(t) for t in text_bytes(batch.column(3))], pa.binary())], ["id_key", "row_key", "doc_id", "z"])

        return step

    return map_batches(docs.select("id_key", "row_key", "doc_id", "text"), make, "id_key long, row_key long, doc_id long, z binary")


def _one_each(packed: DataFrame) -> DataFrame:
    """One text of the rows that share both keys; repeats go before the exchange."""
    return packed.groupBy("id_key", "row_key").agg(F.first("z").alias("z"))


def covered(docs: DataFrame, span: int = SPAN, window: int = WINDOW, hot: int = HOT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``id_key, row_key, cover``: byte stretches (start, stop) of repeated strings."""
    every = stored(anchors(docs, span, window), "anchors")
    # Stored, so that the join's sides are plain exchanges, and a hot core can be split.
    cores = stored(every.groupBy("kh").agg(F.count("*").alias("n")).where("n > 1").select("kh"), "cores")
    places = stored(every.join(cores, "kh", "left_semi"), "places")
    kinds = places.groupBy("kh", "ch").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("id_key", "row_key", "q", "lo", "hi")])
    kinds = stored(kinds, "items")
    crowded = stored(kinds.groupBy("kh").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("kh"), "crowded")
    few = kinds.join(crowded, "kh", "left_anti")
    place = F.struct("q", "lo", "hi", (F.col("n") > 1).cast("int").alias("many"), "kh", "ch")
    chosen = few.groupBy("id_key", "row_key").agg(F.collect_list(place).alias("places"))
    total = few.agg(F.sum(F.col("hi") - F.col("lo") + span).alias("n")).first()["n"] or 0
    ranges = max(1, total // range_bytes)
    drawn = places.where("sample is not null").join(crowded, "kh", "left_anti").groupBy("kh", "ch").agg(F.first(F.substring("sample", 1, span - window + 1)).alias("sample"))
    drawn = drawn.orderBy(F.xxhash64("kh", "ch")).limit(max(SAMPLES, SAMPLES_A_RANGE * ranges)).collect()
    sample = sorted(bytes(r["sample"]) for r in drawn)
    splitters = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    texts = _one_each(_packed(docs)).join(chosen, ["id_key", "row_key"])
    again = merged(item_runs(texts, splitters, span, window), span)
    if crowded.head(1):
        again = again.unionByName(crowded_ranges(docs, kinds.join(crowded, "kh", "left_semi"), span))
    again = again.distinct()
    # Repeated rows have equal places and share one cover.
    spots = places.select("id_key", "row_key", "kh", "ch", "q").distinct()
    cover = spots.join(again, ["kh", "ch"]).select("id_key", "row_key", (F.col("q") - F.col("to_d")).alias("start"), (F.col("q") - F.col("from_d") + span).alias("stop"))
    return cover.groupBy("id_key", "row_key").agg(F.collect_list(F.struct("start", "stop")).alias("cover"))


def removed_runs(cover: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((c["start"], c["stop"]) for c in cover or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def deduplicate(documents: DataFrame, span: int = SPAN, window: int = WINDOW, hot: int = HOT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``doc_id, n_bytes, runs`` (removed byte stretches), ``kept`` (bytes)."""
    docs = with_row_keys(documents, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = _packed(docs).join(covered(docs, span, window, hot, range_bytes), ["id_key", "row_key"], "left")

    def make():
        import zstandard

        unpack = zstandard.ZstdDecompressor()

        def step(batch: pa.RecordBatch):
            rows = []
            for doc_id, z, cover in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text, runs = unpack.decompress(z), removed_runs(cover)
                kept = b"".join(text[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(text)], strict=True)) if runs else text
                rows.append((doc_id, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 5, kinds, strict=True)], names)

        return step

    return map_batches(both.select("doc_id", "z", "cover"), make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_front_coded_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))
