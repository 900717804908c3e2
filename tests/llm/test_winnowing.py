import hashlib
import random

import pytest
from pyspark.sql import functions as F

from txpipe.llm import winnowing as W


def brute(text):
    """Chosen (hash, place) pairs by the definition."""
    codes = [ord(c) for c in text] + [0] * (W.K - len(text))
    grams = [sum(c * W.BASE ** (W.K - 1 - j) for j, c in enumerate(codes[i : i + W.K])) % W.MODULUS for i in range(len(codes) - W.K + 1)]
    out = set()
    for i in range(max(1, len(grams) - W.WINDOW + 1)):
        h, place = min((h, -p) for p, h in enumerate(grams[i : i + W.WINDOW], i))
        out.add((-place, h))
    return sorted(out)


def shown(pairs):
    return ",".join(f"{h}:{p}" for p, h in pairs)


def near(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b)


def expected(rows):
    """Result rows for (doc_id, text, hash of the row) by the definition."""
    rows = sorted(((d, t or "", k) for d, t, k in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    out = []
    for i, (d, t, _) in enumerate(rows):
        other, h = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - h] + other[:h]
        a, b, c = brute(t), brute(edited), brute(other)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(a), shown(b), near(a, b), near(a, c)))
    return sorted(out, key=str)


def run(df):
    got = W.compared(df).select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256), W.shown(F.col("chosen")), W.shown(F.col("edited_chosen")), "near_edited", "near_next")
    return sorted((tuple(r) for r in got.collect()), key=str)


def with_hash(df):
    text = F.coalesce("text", F.lit(""))
    return [tuple(r) for r in df.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("long"), text)).collect()]


def texts(rng, n):
    bits = ["the quick ", "brown fox", "\n", " ", "é", "😀", "á", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "jumps over ", "x", "0123456789"]
    return ["".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 2, 5, 20, 60]))) for _ in range(n)]


def test_equals_the_definition_with_edge_rows(docs):
    df = docs(texts(random.Random(5), 80)).repartition(7)
    assert run(df) == expected(with_hash(df))


def test_segments_of_a_long_text_join_without_a_seam(docs, monkeypatch):
    rng = random.Random(6)
    long = "".join(rng.choice("ab cd\n😀") for _ in range(3_000))
    monkeypatch.setattr(W, "SEGMENT", 64)
    df = docs([long, long[:1_500] + "!" + long[1_500:], "z" * 500], edges=False)
    assert run(df) == expected(with_hash(df))


def test_match_guarantee(docs):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = word(W.K + W.WINDOW - 1)
    for _ in range(20):
        a, b = brute(word(50) + shared + word(40)), brute(word(10) + shared + word(70))
        assert {h for _, h in a} & {h for _, h in b}


def test_many_equal_rows_follow_one_another(spark, monkeypatch):
    monkeypatch.setattr(W, "COPIES", 3)
    df = spark.createDataFrame([(5, "said very often indeed, and again and again")] * 11 + [(4, "the next of the last one of them"), (None, "no id"), (9, None)], "doc_id long, text string")
    got = run(df.repartition(5))
    assert got == expected(with_hash(df))
    assert sum(r[6] == 1.0 for r in got if r[0] == 5) == 10


@pytest.mark.parametrize("rows", [[], [(1, "only one row, so it is its own next")], [(None, None)]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == expected(with_hash(df))


def test_plan_runs_no_python_and_shuffles_a_text_once(docs):
    plan = W.compared(docs(["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_texts_of_few_grams_without_a_low_hash(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("abcdef é", k=rng.randint(0, 45)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["f"] for r in docs.select("doc_id", W.shown(W.fingerprint(F.col("text"))).alias("f")).collect()}
    for i, text in rows:
        codes = [ord(c) for c in text] + [0] * (W.K - len(text))
        grams = [sum(c * pow(W.BASE, W.K - 1 - j, W.MODULUS) for j, c in enumerate(codes[p : p + W.K])) % W.MODULUS for p in range(len(codes) - W.K + 1)]
        windows = range(max(len(grams) - W.WINDOW, 0) + 1)
        chosen = sorted({min(range(s, min(s + W.WINDOW, len(grams))), key=lambda p: (grams[p], -p)) for s in windows})
        assert got[i] == ",".join(f"{grams[p]}:{p}" for p in chosen)
