import hashlib
import random
from collections import Counter

import pytest

from txpipe.llm import suffixes


def brute(rows, span):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(t[p : p + span] for _, t in texts for p in range(len(t) - span + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - span + 1):
            if counts[t[p : p + span]] > 1:
                gone[p : p + span] = b"\1" * span
        kept = bytes(c for c, g in zip(t, gone) if not g)
        starts = sum(1 for k in range(len(t)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(t), sum(gone), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(n=70, seed=5):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab é") for _ in range(60)) for _ in range(6)]
    out = []
    for _ in range(n):
        s = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 50)))
        for _ in range(rng.randint(0, 4)):
            x, a = rng.choice(passages), rng.randint(0, 20)
            s += x[a : a + rng.randint(5, 60)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 9)))
        out.append(s)
    return [*out, "a" * 300, "ab" * 90, out[3], out[3], "word " * 400]


@pytest.mark.parametrize("span,window,hot", [(40, 24, 20_000), (40, 24, 3), (30, 12, 2), (33, 17, 0)])
def test_removed_bytes_match_brute_force(docs, span, window, hot):
    df = docs(texts()).repartition(4)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = suffixes.deduplicate(df, span, window, hot, range_bytes=3000).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, span)


def test_edges_and_repeated_rows_at_full_span(spark, docs, no_docs):
    long = "".join(random.Random(1).choice("abcdefghij ") for _ in range(900))
    df = docs([long, "x" + long[100:500] + "y", "x" + long[100:499] + "y"]).unionByName(docs([long], edges=False))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, suffixes.deduplicate(df).collect()), key=str) == brute(rows, 400)
    assert suffixes.deduplicate(no_docs).count() == 0


def test_merge_gives_order_and_shared_lengths():
    rng = random.Random(8)
    pool = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    for n_runs in (1, 2, 5, 8):
        runs = [sorted(pool[i::n_runs]) for i in range(n_runs)]
        named, readers = [], []
        for run in runs:
            meta, tails, _ = suffixes.front_code([(s, b"", 0, 0, 0, 0, 0, 0) for s in run])
            cut = len(run) // 2
            second = suffixes.front_code([(s, b"", 0, 0, 0, 0, 0, 0) for s in run[cut:]])
            import numpy as np

            meta = np.frombuffer(meta, suffixes._META)
            size = int(meta["tail"][:cut].sum())
            blobs = [(meta[:cut], tails[:size]), (np.frombuffer(second[0], suffixes._META), second[1])]
            readers.append(suffixes.read_run(blobs, len(named)))
            named += run
        out = list(suffixes.merge_runs(readers))
        order = [named[i] for _, i in out]
        assert order == sorted(pool)
        for (shared, _), a, b in zip(out[1:], order, order[1:]):
            n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert shared == n


def test_equal_strings_have_anchors_at_equal_distance():
    rng = random.Random(2)
    shared = bytes(rng.choice(b"abcd ") for _ in range(600))
    texts_ = [bytes(rng.choice(b"abcd ") for _ in range(rng.randint(0, 300))) + shared + b"tail" * 10 for _ in range(5)]
    at = []
    for t in texts_:
        _, q, lo, hi = suffixes.super_windows([b"other text first" * 40, t])
        begin = 640 + t.index(shared)
        found = {p: d for a, l, h in zip(q, lo, hi) for d in range(l, h + 1) for p in [a - d]}
        at.append([found[begin + k] for k in range(200)])
    assert all(x == at[0] for x in at)


def test_repeated_rows_share_one_cover(docs):
    rng = random.Random(4)
    page = "".join(rng.choice("abcdefghij ") for _ in range(400))
    df = docs([page], edges=False)
    for _ in range(5):
        df = df.unionByName(df)  # 32 rows of one doc_id
    keyed = suffixes.with_row_keys(df, "doc_id", "text")
    cover = suffixes.covered(keyed, 40, 24).collect()
    assert len(cover) == 1
    assert len(cover[0]["cover"]) == len({tuple(c) for c in cover[0]["cover"]}) <= len(page)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, suffixes.deduplicate(df, 40, 24).collect()), key=str) == brute(rows, 40)


def test_a_core_never_fills_a_range_of_the_merge(docs, monkeypatch):
    import numpy as np
    import zstandard

    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = word(250)
    df = docs([word(110) + passage + word(110) for _ in range(30)]).repartition(3)
    kept, most = suffixes.item_runs, []

    def watched(*args):
        runs, counts = kept(*args), Counter()
        for r in runs.select("meta").collect():
            counts.update(np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["meta"])), suffixes._META)["kh"].tolist())
        most.append(max(counts.values(), default=0))
        return runs

    monkeypatch.setattr(suffixes, "item_runs", watched)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = suffixes.deduplicate(df, 100, 64, 5, 3000).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 100)
    assert max(most) <= 5
