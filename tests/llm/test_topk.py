import math
import random

import pytest

from txpipe.llm import topk


def brute(rows, k=5, every=50):
    good = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v):
            good.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if i % every == 0}:
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def table(rows, spark):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS shard", "'a' AS x")


@pytest.mark.parametrize("sizes", [(10_000, 256, 1000), (60, 7, 2)])
def test_matches_brute_force(spark, sizes):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(rng.choice([8, 8, 8, 5]))]) for i in range(400)]
    rows += [(i, [float(rng.randint(0, 1))] * 8) for i in range(400, 520)]  # many ties
    rows += [(520, None), (521, []), (522, [1.0, None]), (550, [float("nan")] * 8), (600, [float("inf")] + [0.0] * 7), (601, [1e307] * 8), (None, [1.0] * 8), (523, [1.0] * 8), (523, [1.0] * 8), (-50, [1.0] * 8)]
    v = topk.vectors(table(rows, spark))
    shard, block, queries = sizes
    got = topk.top_k(v, v.where("vec_id % 50 = 0"), shard=shard, block=block, query_block=queries)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(0, [3.0e13 + 1, -7.0e3]), (1, [2.0, 5.0e3]), (2, [2.0, 5.0e3 + 1]), (3, [-1.0, 0.5])]
    v = topk.vectors(table(rows, spark))
    assert sorted(map(tuple, topk.top_k(v, v.where("vec_id % 50 = 0")).collect())) == brute(rows)


def test_fewer_candidates_and_empty_table(spark):
    v = topk.vectors(table([(0, [1.0]), (1, [2.0])], spark))
    assert topk.top_k(v, v.where("vec_id % 50 = 0")).count() == 1
    none = topk.vectors(table([], spark))
    assert topk.top_k(none, none).count() == 0


def test_a_repeated_id_is_split_over_shards(spark, monkeypatch):
    rng = random.Random(12)
    data = [(i, [rng.randint(-9, 9) for _ in range(4)]) for i in range(20)]
    data += [(7, [i % 40 - 20, i // 40, 1, 2]) for i in range(300)] + [(8, [9, 9, 9, 9])] * 200
    df = spark.createDataFrame(data, "vec_id long, x array<bigint>").repartition(3)
    queries = df.where("vec_id in (3, 11)")
    kept = topk.search

    def watched(shard, own, k, block):
        assert len(shard) < 200
        return kept(shard, own, k, block)

    monkeypatch.setattr(topk, "search", watched)
    got = sorted(map(tuple, topk.top_k(df, queries, k=4, shard=50, block=8).collect()))
    want = []
    for q, x in ((i, x) for i, x in data[:20] if i in (3, 11)):
        best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in data if i != q)[:4]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)
