import random

import numpy as np
import xxhash

from txpipe.llm import simhash


def brute_print(text, n=3):
    ws = text.encode().lower().split() if text else []
    if not ws:
        return 0
    parts = [b" ".join(ws[i : i + n]) for i in range(len(ws) - n + 1)] or [b" ".join(ws)]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=3):
    """rows: (doc_id, fingerprint) -> component of each fingerprint."""
    prints = sorted({f for _, f in rows})
    parent = dict(zip(prints, prints))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    names = {}
    for d, f in rows:
        if d is not None:
            names[root(f)] = min(names.get(root(f), d), d)
    return {f: names.get(root(f)) for f in prints}


def texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    out = ["One", "one TWO", "a\x0bb\x0cc d", "x" * 100_000, "w " * 30_000]
    for _ in range(40):
        ws = [word() for _ in range(rng.randint(30, 120))]
        out.append(" ".join(ws))
        for _ in range(rng.randint(0, 4)):
            copy = list(ws)
            copy[rng.randrange(len(copy))] = word()
            out.append("  ".join(copy))
    return out


def test_prints_and_components_match_brute_force(docs):
    df = docs(texts())
    rows = [(r["doc_id"], brute_print(r["text"])) for r in df.collect()]
    names = brute_components(rows)
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted(((d, f, names[f]) for d, f in rows), key=str)


def test_one_row_of_each_component_stays(docs):
    df = docs(texts())
    rows = [(r["doc_id"], brute_print(r["text"])) for r in df.collect()]
    names = brute_components(rows)
    out = simhash.keep_first(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.where("doc_id is not null").collect()) == sorted({n for n in names.values() if n is not None})


def test_shards_find_every_link(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    flip = lambda x: x ^ (np.uint64(1) << rng.integers(0, 64, len(x), dtype=np.uint64))
    chain = [base, flip(flip(base[:200])), flip(flip(flip(base[100:300])))]
    dense = base[0] ^ rng.integers(0, 256, 200, dtype=np.uint64)  # a cluster within 8 bits
    points = np.unique(np.concatenate([*chain, dense]))
    want = brute_components([(int(p), int(p)) for p in points])
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    for shard, block in ((64, 50), (10_000, 10_000)):
        edges = [(r["u"] % 2**64, r["v"] % 2**64) for r in simhash.links(df, 3, sample=256, shard=shard, block=block).collect()]
        assert all((a ^ b).bit_count() <= 64 for a, b in edges)
        parent = {int(p): int(p) for p in points}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        groups = {}
        for p in parent:
            groups.setdefault(root(p), set()).add(p)
        wanted = {}
        for p in parent:
            wanted.setdefault(want[p], set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_long_chain_of_components(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000)], "u long, v long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert roots == {i: 0 for i in range(1, n + 1)}


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_first(no_docs).count() == 0
