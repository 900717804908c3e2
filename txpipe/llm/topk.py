"""Exact top-k inner products with block-at-a-time pruning.

Rows sorted by id are cut into shards and each shard into blocks of
consecutive rows. A block keeps its rows as a forward index (a dense matrix)
and, for each dimension ("term"), the largest and smallest component. For a
query the blocks are ordered by the sum over terms of the largest product that
a row in it could reach; blocks are scored in that order until the bound falls
below the k-th best score. Equal bounds are still scored, so ties are exact.

Queries come in blocks, too, and meet every shard as (shard, query block)
groups of bounded size; each returns k rows a query, and a window over those
picks the result.

Edge cases: vectors that are NULL, empty, or hold a NULL or a non-finite
component (also after scaling), and rows without an id, take no part; vectors
of other lengths count as padded with zeros; repeated candidates are results
each; repeated equal queries are answered once; fewer candidates than k give
all of them; an empty table gives no rows. Scores beyond 64 bits are cut to the
nearest long; all else is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txpipe.llm.common import table

SCALE = 256.0
K = 5
EVERY = 50
SHARD = 16_384
BLOCK = 256
QUERIES = 1_024

_OUT = "query_id long, query_key long, vec_id long, score long"


def vectors(embeddings: DataFrame, scale: float = SCALE) -> DataFrame:
    """``vec_id, x`` of the rows that take part; x is scaled, not yet floored."""
    scaled = F.transform("embedding", lambda e: e.cast("double") * scale)
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    rows = embeddings.select(F.col("vec_id").cast("long"), scaled.alias("x"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", finite))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for row, x in zip(out, column, strict=True):
        row[: len(x)] = x
    return np.floor(out)


def search(shard: pd.DataFrame, queries: pd.DataFrame, k: int, block: int) -> pd.DataFrame:
    """The k best rows of a shard for each query."""
    if not len(shard) or not len(queries):
        return pd.DataFrame({"query_id": [], "query_key": [], "vec_id": [], "score": []}).astype("int64")
    width = max(shard["x"].map(len).max(), queries["x"].map(len).max())
    shard = shard.sort_values("vec_id", kind="stable")
    ids, m, q = shard["vec_id"].to_numpy(), _matrix(shard["x"], width), _matrix(queries["x"], width)
    if np.abs(m).max() * np.abs(q).max() * width >= 2.0**53:  # beyond exact doubles
        whole = lambda a: np.array([[int(v) for v in row] for row in a], object)
        m, q = whole(m), whole(q)
    starts = np.arange(0, len(ids), block)
    high, low = np.maximum.reduceat(m, starts), np.minimum.reduceat(m, starts)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    out = []
    for query_id, key, vector, bound in zip(queries["vec_id"].to_numpy(), queries["query_key"].to_numpy(), q, bounds, strict=True):
        best_ids, best = np.empty(0, np.int64), np.empty(0, m.dtype)
        for b in np.argsort(-bound, kind="stable"):
            if len(best) == k and bound[b] < best[-1]:
                break
            own, scores = ids[starts[b] : starts[b] + block], m[starts[b] : starts[b] + block] @ vector
            other = own != query_id
            if len(best) == k:
                other &= scores >= best[-1]
            if other.any():
                best_ids, best = np.concatenate([best_ids, own[other]]), np.concatenate([best, scores[other]])
                order = np.lexsort((best_ids, -best))[:k] if best.dtype != object else np.array(sorted(range(len(best)), key=lambda i: (-best[i], best_ids[i]))[:k])
                best_ids, best = best_ids[order], best[order]
        out += [(int(query_id), int(key), int(i), min(max(int(s), -(2**63)), 2**63 - 1)) for i, s in zip(best_ids, best, strict=True)]
    return pd.DataFrame(out, columns=["query_id", "query_key", "vec_id", "score"]).astype("int64")


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` over ``vec_id, x`` tables."""
    n, nq = rows.count(), queries.count()
    shards, blocks = max(1, math.ceil(n / shard)), max(1, math.ceil(nq / query_block))
    # Equal rows tie, so that k of them are enough for any query; other rows of one id split by their content.
    few = rows.groupBy("vec_id", "x").agg(F.count("*").alias("n")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k))))).select("vec_id", "x")
    ranged = few.repartitionByRange(shards, "vec_id", F.xxhash64("x")).withColumn("shard", F.spark_partition_id())
    left = ranged.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keyed = queries.dropDuplicates(["vec_id", "x"]).withColumn("query_key", F.xxhash64("x"))
    right = keyed.withColumn("qb", F.pmod(F.xxhash64("vec_id", "query_key"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = left.groupBy("shard", "qb").cogroup(right.groupBy("shard", "qb")).applyInPandas(lambda a, b: search(a, b, k, block), _OUT)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_block_at_a_time_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS (SELECT vec_id, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, d.vec_id, sum(q.c * d.c) AS score
      FROM p q JOIN p d ON q.i = d.i AND q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rk <= 5
"""
