import random
import zlib

import numpy as np
import pytest

from txpipe.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def held_out_scores(spark, op, column):
    got = op(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", column).collect()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    return np.array([r["score"] for r in rows]), np.array([r["predicted"] for r in rows]), np.array([r[column] for r in rows])


def test_quality_held_out_accuracy(spark):
    score, predicted, label = held_out_scores(spark, quality.op2_quality_positive_unlabelled, "quality")
    assert (predicted == (score >= 0.5)).all() and (predicted == label).mean() > 0.97
    assert predicted[label == 1].mean() > 0.98 and predicted[label == 0].mean() < 0.1


def test_toxicity_held_out_accuracy(spark):
    score, predicted, label = held_out_scores(spark, toxicity.op7_toxicity_string_kernel, "toxic")
    assert (predicted == (score >= 0.5)).all() and (predicted == label).mean() > 0.96
    assert predicted[label == 0].mean() < 0.02 and predicted[label == 1].mean() > 0.85


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0.7, 0.08, 20_000), rng.normal(0.3, 0.1, 20_000)
    count = lambda x: np.histogram(x, 256, (0, 1))[0].astype(float)
    for prior in (0.6, 0.85):
        k = int(prior * 20_000)
        mixed = np.concatenate([good[:k], bad[: 20_000 - k]])
        assert abs(quality.estimate_prior(count(rng.normal(0.7, 0.08, 20_000)), count(mixed)) - prior) < 0.04


def test_nonnegative_risk_learns_without_negatives():
    rng = np.random.default_rng(2)
    positive, negative = rng.normal(1, 0.5, (3000, 4)), rng.normal(-1, 0.5, (600, 4))
    net = quality.fit_nonnegative(positive[:1500], np.concatenate([positive[1500:], negative[:300]]), 1500 / 1800)
    assert (net.score(positive) >= 0.5).mean() > 0.97 and (net.score(negative[300:]) < 0.5).mean() > 0.97


def toy(n=400, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["re", "th", "on", "er", "ing", "ne"]) for _ in range(rng.randint(1, 4)))
    bad = ["dumbhead", "blockface", "fuzzbrain"]
    rows, marks = [], []
    for i in range(n):
        ws, toxic = [word() for _ in range(60)], int(rng.random() < 0.3)
        if toxic:
            ws.insert(rng.randrange(60), rng.choice(bad))
        poor = int(rng.random() < 0.3)
        rows.append((i, " ".join(w + "###" if poor else w for w in ws)))
        if i % 2:
            marks.append((i, 1 - poor, toxic))
    return rows, marks


@pytest.fixture()
def small(spark, docs):
    rows, marks = toy()
    marks += [(None, 1, 0), (1, 0, 1), (1, 1, 0), (99_999, 1, 1), (3, None, None)]
    return docs([t for _, t in rows]), spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS score", "'x' AS f")


def test_scores_on_edge_rows(small, no_docs, spark):
    df, labels = small
    none = spark.createDataFrame([], labels.schema)
    for op, modulus, at in ((quality, 3, 1), (toxicity, 5, 0)):
        rows = op.scores(df, labels).collect()
        assert len(rows) == df.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
        for r in rows:
            text = "" if r["doc_id"] is None else str(r["doc_id"])
            assert r["held_out"] == (zlib.crc32(text.encode()) % modulus == at)
        assert len({r["score"] for r in rows if r["doc_id"] == 1003}) == 1
        assert op.scores(df, none).count() == df.count() and op.scores(no_docs, labels).count() == 0


def test_labels_of_held_out_rows_are_not_learnt(small):
    from pyspark.sql import functions as F

    df, labels = small
    for op, column, modulus, at in ((quality, "quality", 3, 1), (toxicity, "toxic", 5, 0)):
        held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus == at
        other = labels.withColumn(column, F.when(held, 1 - F.col(column)).otherwise(F.col(column)))
        pairs = lambda x: sorted((str(r["doc_id"]), round(r["score"], 9)) for r in op.scores(df, x).collect())  # noqa: B023, E731
        assert pairs(labels) == pairs(other)


def test_keep_good_drops_rejected_rows_only(small):
    df, labels = small
    rows = {r["doc_id"]: r for r in quality.scores(df, labels).collect()}
    out = quality.keep_good(df, labels)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in df.collect() if rows[r["doc_id"]]["predicted"] == 1)


def brute_kernel(a, b):
    def phi(w):
        f, letters = {}, toxicity._fold(w)
        for i in range(len(letters)):
            for j in range(i + 1, len(letters)):
                for k in range(j + 1, len(letters)):
                    if k - i <= 4 and j - i <= 3 and k - j <= 3:
                        key = (letters[i], letters[j], letters[k])
                        f[key] = f.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return f

    x, y = phi(a), phi(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return (dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5) ** toxicity.POWER


def test_kernel_matches_brute_force_and_tolerates_insertions():
    words = ["idiot", "idxiot", "iddiot", "moron", "mor0n", "été", "a", "the", "worthless", "worthles"]
    got = toxicity.Kernel(words).values(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(got[i, j] - brute_kernel(a, b)) < 1e-4
    kernel = toxicity.Words(toxicity.Kernel(["idiot"]))
    exact, inserted, gapped, dotted, leet, other = kernel.values(["you idiot", "you idxiot", "you i d i o t !", "i.d.i.o.t", "1d10t", "nice weather"])[:, 0]
    assert exact > 0.999 and gapped > 0.999 and dotted > 0.999 and leet > 0.999 and inserted > 0.35 and other == 0


def test_toxic_words_found_in_toy_texts(small):
    df, labels = small
    rows, _ = toy()
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scores(df, labels).collect()}
    bad = ["dumbhead", "blockface", "fuzzbrain"]
    assert np.mean([got[i] == any(b in t for b in bad) for i, t in rows]) > 0.97


def test_fully_labelled_table_keeps_good_rows(spark, docs):
    rows, _ = toy()
    df = docs([t for _, t in rows], edges=False)
    labels = spark.createDataFrame([(i, int("###" not in t)) for i, t in rows], "doc_id long, quality int")
    got = {r["doc_id"]: r["predicted"] for r in quality.scores(df, labels).collect()}
    assert np.mean([got[i] == int("###" not in t) for i, t in rows]) > 0.9


def test_insults_anywhere_in_long_words_and_beside_punctuation():
    kernel = toxicity.Words(toxicity.Kernel(["idiot", "scumbag"]))
    rng = random.Random(3)
    plain = "".join(rng.choice("bcfghjklnpqrvwxz") for _ in range(150))
    texts = [plain + "idiot" + plain, " ".join(plain + "idiot" + plain), "listen...idiot", "a/idiot,scumbag", "漢" * 200 + "idiot" + "字" * 90, plain]
    got = kernel.values(texts)
    assert (got[:5, 0] > toxicity.CLOSE).all() and got[3, 1] > 0.999 and got[2, 0] > 0.999
    assert got[5].max() < toxicity.LEAST and (got[:5, 2] > 0).all()


def test_stretches_of_a_giant_word_come_in_bounded_sets(monkeypatch):
    monkeypatch.setattr(toxicity, "TOGETHER", 50)
    rng = random.Random(4)
    word = "".join(rng.choice("abcdefgh") for _ in range(700))
    sets = list(toxicity.word_sets(word))
    assert max(map(len, sets)) <= 200 and set().union(*sets) == {word[i : i + n] for n in toxicity.STRETCHES for i in range(len(word) - n + 1)}


def test_words_by_bytes_equal_words_by_characters():
    import time

    drop = {c: None for c in range(33, 127) if not chr(c).isalnum()}
    looks = {ord(d): c for d, c in zip("0134578", "oieastb", strict=True)}

    def plain(text):
        lower = text.lower()
        text = " ".join(lower.translate(drop | looks).split())
        out = text.split(" ") + [m.replace(" ", "") for m in toxicity._SINGLES.findall(" " + text)]
        return out + [w for w in lower.translate(dict.fromkeys(drop, " ") | looks).split() if len(w) > 2]

    rng = random.Random(8)
    letters = "abIZ019 .,!-_~\t\n\x00\x7f\x85\xa0\u2003éÄß漢字🙂\u0301İ"
    texts = ["", "été i d i o t", *("".join(rng.choices(letters, k=rng.randint(1, 200))) for _ in range(500))]
    assert [toxicity.words(t) for t in texts] == [plain(t) for t in texts]
    long = "листен été, wörter 漢字 " * 40_000

    def seconds(f):
        least = []
        for _ in range(3):
            begun = time.process_time()
            f(long)
            least.append(time.process_time() - begun)
        return min(least)

    assert seconds(toxicity.words) < 0.8 * seconds(plain)
