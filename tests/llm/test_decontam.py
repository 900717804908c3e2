import random
import re

import pytest

from txpipe.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, items, window=10):
    windows = {}
    for item, text in items:
        ws = WORD.findall((text or "").translate(LOWER))
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        ws, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if ids := windows.get(tuple(ws[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        out.append((doc_id, len(ws), len(hit), sorted(found)))
    return out


@pytest.fixture()
def case(spark, docs):
    rng = random.Random(7)
    vocabulary = ["Alpha", "beta", "ÉTÉ", "été", "x1", "9", "naïve", "ΣΑ", "q"]
    word = lambda: rng.choice(vocabulary)
    join = lambda ws: "".join(w + rng.choice([" ", "-", "\n", ", ", "_"]) for w in ws)
    items = [(i, join(word() for _ in range(rng.randint(0, 25)))) for i in range(30)] + [(30, None), (31, ""), (31, "q q q"), (2, "repeated id with other words q x1 9")]
    texts = []
    for _ in range(120):
        text = join(word() for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.6:
            text += (rng.choice(items)[1] or "").upper()
        texts.append(text + join(word() for _ in range(5)))
    return docs(texts), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS row_key"), items


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_windows_match_brute_force(case, block_bytes):
    df, benchmark, items = case
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    key = lambda x: tuple(map(str, x))
    got = [(r["doc_id"], r["n_words"], sum(h["stop"] - h["start"] for h in r["hits"]), list(r["items"])) for r in decontam.scan(df, benchmark, block_bytes=block_bytes).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, items), key=key)


def test_spans_point_into_the_original(spark, docs):
    passage = "One two three four five six seven eight nine TEN eleven"
    df = docs([f"é😀 before. {passage}! after"], edges=False)
    row = decontam.scan(df, spark.createDataFrame([(1, passage)], "item_id long, text string")).first()
    a, b = map(int, row["spans"].split(":"))
    assert df.first()["text"][a:b] == passage


def test_clean_keeps_clean_rows_whole(case):
    df, benchmark, items = case
    clean = {k: n for k, _, n, _ in brute([(r["doc_id"], r["text"]) for r in df.collect()], items)}
    for size in (1 << 20, 600):
        out = decontam.clean(df, benchmark, block_bytes=size)
        assert out.columns == df.columns
        assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in df.collect() if not clean[r["doc_id"]])


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.digest(decontam.scan(docs(["a"]), none)).where("contaminated").count() == 0
    assert decontam.scan(no_docs, none).count() == 0 and decontam.clean(docs(["a"]), none).count() == 7
