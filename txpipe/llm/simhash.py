"""SimHash near-duplicates by vantage-point trees, exact within a distance.

Fingerprints: XXH64 (seed 42) of every word shingle, a bit is set if it is set
in over half of the hashes. Only distinct fingerprints take part in the search,
so groups of equal texts collapse before any shuffle by key.

Search: a vantage-point tree from a bounded sample of the distinct fingerprints
parts all of them into shards (inside: distance to the vantage point at most
its radius). Each fingerprint lives in one shard and also visits, as a query,
every shard that the triangle bound cannot rule out. In a shard the same rule
goes on in numpy down to small blocks, which are compared in full. Shards are
cut into bounded blocks of residents and visitors, so a dense cluster is shared
by many tasks. A block returns a spanning forest of its links, never all pairs.
Components come from min-label star contraction, each round written to the
shared folder.

Edge cases: NULL, empty or blank texts have fingerprint 0 and link like any
other; fewer words than the shingle length form one shingle; repeated rows
share a component; a NULL doc_id never names a component (NULL if a component
has no other); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txpipe.llm.common import map_batches, stored, table, text_bytes, with_row_keys

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SAMPLE = 8192  # fingerprints from which the tree is built
SHARD = 8192  # distinct fingerprints aimed at in a shard, at least
SHARDS = 16  # more would send each fingerprint to ever more of them; a shard's own tree goes on without copies
BLOCK = 1 << 19  # residents or visitors in one task at most
DENSE = 1 << 21  # pairs compared in full at once

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a text's UTF-8 bytes."""
    import xxhash

    ws, digest = raw.translate(_LOWER).split(), xxhash.xxh64_digest
    if not ws:
        return 0
    parts = zip(*(ws[i:] for i in range(shingle)), strict=False) if len(ws) >= shingle else [ws]
    hashes = np.frombuffer(b"".join([digest(b" ".join(p), SEED) for p in parts]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``id_key, row_key, doc_id, fp`` per row of keyed documents."""

    def make():
        def step(batch: pa.RecordBatch):
            fps = [fingerprint(raw, shingle) for raw in text_bytes(batch.column(3))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps, pa.int64())], ["id_key", "row_key", "doc_id", "fp"])

        return step

    return map_batches(documents.select("id_key", "row_key", F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "id_key long, row_key long, doc_id long, fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def build_tree(sample: np.ndarray, leaf: int, max_bits: int) -> list[tuple]:
    """Nodes (vantage, radius, inside, outside); a leaf is (shard number,).

    A part is left whole if a split would send nearly all of it both ways."""
    nodes: list[tuple] = []
    shards = 0

    def grow(points: np.ndarray) -> int:
        nonlocal shards
        at = len(nodes)
        nodes.append(())
        if len(points) > leaf:
            best = None
            for vantage in points[:: max(1, len(points) // 5)][:5]:
                d = distance(points, vantage)
                radius = int(np.median(d))
                inside = int((d <= radius).sum())
                both = int((np.abs(d.astype(np.int64) - radius) <= max_bits).sum())
                if 0 < inside < len(points) and both < 0.9 * len(points) and (best is None or both < best[0]):
                    best = (both, vantage, radius, d)
            if best:
                _, vantage, radius, d = best
                a = grow(points[d <= radius])
                nodes[at] = (vantage, radius, a, grow(points[d > radius]))
                return at
        nodes[at] = (shards,)
        shards += 1
        return at

    grow(sample)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, slack: int) -> list[tuple[int, np.ndarray]]:
    """(shard, positions of the points that reach it) with triangle slack."""
    out, todo = [], [(0, np.arange(len(points)))]
    while todo:
        k, own = todo.pop()
        if not len(own):
            continue
        node = nodes[k]
        if len(node) == 1:
            out.append((node[0], own))
        else:
            d = distance(points[own], node[0]).astype(np.int64)
            todo += [(node[2], own[d <= node[1] + slack]), (node[3], own[d > node[1] - slack])]
    return out


def _tree_search(homes: np.ndarray, guests: np.ndarray, h: np.ndarray, g: np.ndarray, bits: int, link) -> None:
    """Calls link(home positions, guest positions) with all pairs in reach."""
    if not len(h) or not len(g):
        return
    if len(h) > 64 and len(h) * len(g) > DENSE // 8:
        d = distance(homes[h], homes[h[len(h) // 2]]).astype(np.int64)
        radius = int(np.median(d))
        e = distance(guests[g], homes[h[len(h) // 2]]).astype(np.int64)
        near, far = e <= radius + bits, e > radius - bits
        inside = d <= radius
        if not inside.all() and near.sum() + far.sum() < 1.9 * len(g):
            _tree_search(homes, guests, h[inside], g[near], bits, link)
            _tree_search(homes, guests, h[~inside], g[far], bits, link)
            return
    step = max(1, DENSE // len(g))
    for at in range(0, len(h), step):
        part = h[at : at + step]
        i, j = np.nonzero(distance(homes[part][:, None], guests[g][None, :]) <= bits)
        if len(i):
            link(part[i], g[j])


class Forest:
    """Union-find over positions, a whole array of links at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            keep = a != b
            a, b = a[keep], b[keep]
            if len(a):
                np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
                while not np.array_equal(up := self.parent[self.parent], self.parent):
                    self.parent = up


def shard_links(homes: np.ndarray, guests: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) that connect what is within ``bits``."""
    every = np.unique(np.concatenate([homes, guests]))
    at_home, at_guest, forest = np.searchsorted(every, homes), np.searchsorted(every, guests), Forest(len(every))
    _tree_search(homes, guests, np.arange(len(homes)), np.arange(len(guests)), bits, lambda i, j: forest.join(at_home[i], at_guest[j]))
    moved = np.flatnonzero(forest.parent != np.arange(len(every)))
    return every[moved], every[forest.parent[moved]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE, shard: int = SHARD, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """``u, v`` over a table of distinct fingerprints ``fp``: edges that span
    the same components as all pairs within ``max_bits``."""
    spark = distinct.sparkSession
    n = distinct.count()
    drawn = distinct.orderBy(F.xxhash64("fp")).limit(sample).collect()  # the documented bound
    points = np.array([r["fp"] for r in drawn], np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(build_tree(points, max(16, math.ceil(len(points) * max(shard / max(1, n), 1 / shards))), max_bits))

    def make():
        def step(batch: pa.RecordBatch):
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            home = np.full(len(own), -1, np.int32)
            for k, at in route(tree.value, own, 0):
                home[at] = k
            for k, at in route(tree.value, own, max_bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(own[at].view(np.int64)), pa.array(home[at] == k)], ["shard", "fp", "home"])

        return step

    visits = stored(map_batches(distinct.select("fp"), make, "shard int, fp long, home boolean"), "visits")
    counts = visits.groupBy("shard").agg(F.sum(F.col("home").cast("long")).alias("h"), F.count("*").alias("g"))
    sizes = counts.select("shard", F.ceil(F.col("h") / F.lit(block)).cast("int").alias("nh"), F.ceil(F.col("g") / F.lit(block)).cast("int").alias("ng"))
    salt = lambda n: F.pmod(F.xxhash64(F.col("fp"), F.lit(7)), n).cast("int")
    parts = visits.join(sizes, "shard").where("nh > 0")
    span = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    guests = parts.select("shard", span(F.col("nh")).alias("hb"), salt(F.col("ng")).alias("gb"), "fp", F.lit(False).alias("home"))
    homes = parts.where("home").select("shard", salt(F.col("nh")).alias("hb"), span(F.col("ng")).alias("gb"), "fp", "home")

    def search(_, part: pd.DataFrame) -> pd.DataFrame:
        fps = part["fp"].to_numpy(np.int64).view(np.uint64)
        home = part["home"].to_numpy(bool)
        u, v = shard_links(fps[home], fps[~home], max_bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return homes.unionByName(guests).groupBy("shard", "hb", "gb").applyInPandas(lambda key, part: search(key, part), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge: alternating large and small
    stars on min labels until nothing changes. Aggregates are partial; the
    joins are plain equi-joins, which adaptive execution splits if skewed."""
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
        after = stored(small.where("u != v").distinct(), "edges")
        mark = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
        if edges.agg(*mark).first() == after.agg(*mark).first():
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = after


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, id_key, row_key, fp, root`` (a component's name) and
    ``component_id`` (its smallest doc_id) per row."""
    prints = stored(fingerprints(with_row_keys(documents, "doc_id", "text"), shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(named.join(names, "root").select("fp", "root", "component_id"), "fp")


def keep_first(documents: DataFrame) -> DataFrame:
    """One row of each component, columns as they came: that with the smallest
    doc_id; of rows that share it, one."""
    found = near_duplicates(documents)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "id_key", "row_key")).alias("r")
    chosen = found.groupBy("root").agg(first).select("r.id_key", "r.row_key")
    keyed = with_row_keys(documents, F.struct(*documents.columns).alias("row")).join(chosen, ["id_key", "row_key"], "left_semi")
    turn = F.row_number().over(Window.partitionBy("id_key", "row_key").orderBy(F.lit(1)))
    return keyed.withColumn("turn", turn).where("turn = 1").select("row.*")


def op9_simhash_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
