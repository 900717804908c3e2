import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from txpipe.llm import collocations as C
from txpipe.llm import quotient as Q


def brute(rows, least, top, share=80):
    f = defaultdict(Counter)
    for text, lang in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            ws = re.findall("[^\x20\x09]+", piece)
            for n in range(1, 5):
                f[lang or "und"].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, c in f.items():
        total = sum(a for p, a in c.items() if len(p) == 1)
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cands.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(len(q) > len(p) and 100 * b >= share * a and inside(q) for q, b in cands.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, total, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def corpus(seed, n=250):
    rng = random.Random(seed)
    words = ["New", "york", "São", "paulo", "the", "of", "😀", "x\x01y", "a", "A", "it's", "\xa0b", "quick", "fox", "1,5", "end.", "odd?!", "tab\tbed"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(["New York City Hall", rng.choice(words), "the quick fox", rng.choice(words)]) + rng.choice([" ", "  ", "\n", " ", " ", ", "]) for _ in range(rng.randint(0, 25)))
        rows.append((text, rng.choice(["en", "en", "fr", None])))
    return rows + [(None, "en"), ("", "fr"), ("only here", "zz")] + [("said twice the same", "en")] * 9


SCHEMA = "text string, lang string, ids string, id int, a int, word string, block string, n int"


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", "z", 3) for r in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in C.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("options", [{}, {"block": 200}, {"block": 200, "fan": 4}])
def test_equals_the_definition(spark, options):
    rows = corpus(1)
    assert run(spark, rows, least=5, top=40, **options) == brute(rows, 5, 40)


def test_ranks_within_shares_of_a_language(spark, monkeypatch):
    monkeypatch.setattr(C, "RANK_ROWS", 7)
    monkeypatch.setattr(C, "ID_ROWS", 4)
    rows = corpus(2)
    assert run(spark, rows, least=3, top=6) == brute(rows, 3, 6)


@pytest.mark.parametrize("rows", [[], [(None, None), ("", "en")], [("one two three", "en")], [("a " * 40, "en")]])
def test_small_tables(spark, rows):
    assert run(spark, rows) == brute(rows, 30, 2_000)


def test_no_row_of_a_block_is_large(spark):
    """A block's words and text are many rows, and its filters are made from a stream of them."""
    rng = random.Random(3)
    rows = [(" ".join(rng.choice(["the", "quick", "fox", f"w{rng.randint(0, 20_000)}", "end."]) for _ in range(150_000)), "en"), ("the quick fox. " * 40, "fr")]
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", "z", 3) for r in rows], SCHEMA).coalesce(1)
    blocked = C.blocks(df).cache()
    texts = blocked.where("word IS NULL").selectExpr("block", "place", "length(ids) AS size").collect()
    assert len(texts) > 2 and max(r["size"] for r in texts) <= 4 * C.TEXT_NUMBERS
    assert blocked.where("ids IS NULL").selectExpr("max(length(word)) AS m").first()["m"] < 10
    plan = C.filters(blocked, C.vocabulary(blocked), 15, 2)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "collect_list" not in plan
    blocked.unpersist()
    assert run(spark, rows, parts=1) == brute(rows, 30, 2_000)


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 13), (3, 17), (4, 16), (4, 17), (3, 31), (4, 32), (2, 32), (4, 1)])
def test_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(n * 100 + bits)
    ids = rng.integers(0, min(1 << bits, 60), (3_000, n)).astype(np.uint64)
    ids[:5] = (1 << bits) - 1
    assert (Q.restored(Q.permuted(list(ids.T), bits), n, bits) == ids).all()
    want = Counter(map(tuple, ids.tolist()))
    for skip in (0, 1, 6):
        total = n * bits
        if skip > total:
            continue
        halves = [Q.counted(Q.permuted(list(h.T), bits), np.full(len(h), 400)) for h in np.array_split(ids, 2)]
        shards = defaultdict(list)
        for keys, counts in halves:
            for shard, body in Q.sharded(keys, counts, total, skip):
                shards[shard].append(body)
        got = Counter()
        for shard, bodies in shards.items():
            keys, counts = Q.merged(bodies, total, shard)
            assert (np.lexsort((keys[1], keys[0])) == np.arange(len(counts))).all()
            got.update(dict(zip(map(tuple, Q.restored(keys, n, bits).tolist()), counts.tolist(), strict=True)))
        assert got == Counter({k: 400 * v for k, v in want.items()})


def test_an_entry_takes_little_more_than_its_remainder():
    rng = np.random.default_rng(9)
    ids = rng.integers(0, 1 << 13, (100_000, 4)).astype(np.uint64)
    keys, counts = Q.counted(Q.permuted(list(ids.T), 13))
    assert len(Q.encoded(keys, counts, 52, 0)) < 5.6 * len(counts)  # 52 bits less 17 of the quotient, and three for runs and counts
