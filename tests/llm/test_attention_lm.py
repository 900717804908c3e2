import math
import zlib
from collections import Counter

import numpy as np
import pytest

from txpipe.llm import attention_lm as lm


def brute_base(rows):
    tokens = lambda t: [*(t or "").encode().translate(lm._LOWER).split(), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, t in rows for ws in [tokens(t)]), key=str)


def case(docs):
    return docs(["The cat sat", "the CAT sat on é 日本 \x0b mats", "É the", "x" * 50_000, "the cat " * 9_000, *[f"word{i % 7} the {i}" for i in range(60)]])


@pytest.mark.parametrize("block_bytes", [8 << 20, 300])
def test_baseline_matches_brute_force(docs, monkeypatch, block_bytes):
    monkeypatch.setattr(lm, "STEPS", 5)
    df = case(docs).repartition(3)
    got = lm.scores(df, block_bytes=block_bytes).collect()
    key = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    assert sorted(((*(r[k] for k in key), round(r["base_score"], 6)) for r in got), key=str) == brute_base([(r["doc_id"], r["text"]) for r in df.collect()])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def small_model(context=8):
    rng = np.random.default_rng(0)
    counts = np.zeros(lm.VOCABULARY, np.int64)
    counts[:200] = rng.integers(1, 1000, 200)
    sample = [rng.integers(0, 200, 50) for _ in range(5)]
    model = lm.Attention(counts, sample, context=context)
    ids = np.concatenate(sample)
    first = np.zeros(len(ids), bool)
    first[::50] = True
    model.set_pairs(model.count_pairs(ids, first))
    for name in model.p:
        model.p[name] = model.p[name] + rng.normal(0, 0.1, model.p[name].shape).astype(np.float32)
    return model, rng


def test_each_id_is_scored_once_with_its_window():
    model, rng = small_model()
    texts = [rng.integers(0, 300, n) for n in (1, 3, 4, 5, 8, 9, 40)]
    got = model.scores(np.concatenate(texts), np.array([len(t) for t in texts]), batch=3)
    half, p = model.context // 2, model.p
    for text, score in zip(texts, got):
        stream, want = np.concatenate([[lm.END], text[:-1]]), 0.0
        for t, target in enumerate(text):
            x = p["e"][model.input[stream[max(0, t // half * half - half) : t + 1]]].astype(float)
            s = (x[-1] @ p["q"]) @ (x @ p["k"]).T / math.sqrt(x.shape[1]) + p["r"][np.arange(len(x))[::-1]]
            a = np.exp(s - s.max())
            h = x[-1] + (a / a.sum()) @ (x @ p["v"]) @ p["o"]
            z = h @ p["u"] + p["b"]
            want += (z[model.of[target]] - np.log(np.exp(z).sum())) / math.log(10) + float(model.within_class(stream[t : t + 1], np.array([target]))[0])
        assert abs(score - want) < 1e-3 * max(1, abs(want))


def test_probabilities_of_all_ids_sum_to_one():
    model, _ = small_model()
    every = np.arange(lm.VOCABULARY)
    for before in (lm.END, 5, 40_000):
        within = 10.0 ** model.within_class(np.full(lm.VOCABULARY, before), every).astype(float)
        assert np.allclose(np.bincount(model.of, within, lm.CLASSES), 1, atol=1e-3)


def test_training_gradient_lowers_the_loss():
    model, rng = small_model(context=16)
    texts = [np.tile(rng.integers(0, 200, 6), 12) for _ in range(40)]
    flat, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    before = model.scores(flat, sizes).sum()
    model.train(texts, steps=150)
    assert model.scores(flat, sizes).sum() > 0.8 * before  # log10: nearer to 0


def test_held_out_texts_beat_single_ids(spark):
    rows = lm.op8_attention_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").collect()
    words = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / words > -4.6  # ids by their counts alone: about -6


def test_empty_table(no_docs):
    assert lm.scores(no_docs).count() == 0


def test_every_training_id_is_learned_and_classed(docs):
    df = case(docs).repartition(3).selectExpr("doc_id", "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 10 = 0 AS held_out", "text")
    rows = lm.stored(lm.blocks(df, None, 16, 300), "t-blocks")
    counts, whole = lm.id_counts(rows.where(rows.kind == lm._IDS)), rows.where(rows.kind == lm._DOCS)
    speller = lm.Speller(None)
    lists = [speller.ids(lm.split_words((r["text"] or "").encode())) for r in df.collect() if not r["held_out"]]
    texts = [np.append(np.frombuffer(b"".join(ids), "<u2"), lm.END).astype(np.int64) for ids in lists]
    table, rank = lm.neighbour_table(whole, counts), lm.ranked(counts)[1]
    want = np.zeros_like(table)
    for ids in texts:
        np.add.at(want.reshape(-1), lm.neighbour_counts(rank, np.concatenate([[lm.END], ids[:-1]]), ids), 1)
    assert (table == want).all() and table.sum() == 2 * counts.sum()
    model = lm.Attention(counts, [], neighbours=table)
    flat, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    before = model.scores(flat, sizes).sum()
    assert lm.learn_all(whole, model) == sum(-(-len(t) // lm.CONTEXT) for t in texts)  # no sample
    assert model.scores(flat, sizes).sum() > before


def test_gradient_is_the_slope_of_the_loss():
    model, rng = small_model()
    texts = [rng.integers(0, 300, n) for n in (1, 7, 8, 9, 60)]
    inputs, target, there = model.windows(np.concatenate(texts), np.array([len(t) for t in texts]))
    adam = lm.Adam(model)
    model._gradient(inputs, target, there, adam.gradient, adam.room)

    def loss(p):
        x = p["e"][inputs]
        distance = np.arange(model.context)[:, None] - np.arange(model.context)
        s = (x @ p["q"]) @ (x @ p["k"]).transpose(0, 2, 1) / math.sqrt(x.shape[2]) + p["r"][np.maximum(distance, 0)]
        a = np.exp(s) * (distance >= 0)
        z = (x + a / a.sum(2, keepdims=True) @ (x @ p["v"]) @ p["o"]) @ p["u"] + p["b"]
        return -(np.take_along_axis(z, target[:, :, None].astype(int), 2)[:, :, 0] - np.log(np.exp(z).sum(2)))[there].mean()

    wide = {k: a.astype(float) for k, a in model.p.items()}
    for name in wide:
        way = rng.normal(0, 1, wide[name].shape)
        slope = (loss(wide | {name: wide[name] + 1e-4 * way}) - loss(wide | {name: wide[name] - 1e-4 * way})) / 2e-4
        assert abs((adam.gradient[name] * way).sum() - slope) < 1e-3 * max(0.05, abs(slope))


def test_exponents_beyond_the_bound_are_clipped():
    model, rng = small_model()
    bias, mask = model._bias(model.context)
    for scale in (1, 100):
        s = rng.normal(0, scale, (3, model.context, model.context)).astype(np.float32)
        want = np.exp(np.clip(s + bias, -60, 60)) * mask
        assert np.allclose(model._weights(s.copy(), bias, mask), want, rtol=1e-5)


def test_blocks_hold_each_word_in_its_place():
    texts = [b"", b" \t\n", b"One two\x0bTWO\x0c one ", b"", "é É 　日本\x1c x".encode(), b"\x00 two", b"x" * 5_000]
    block = lm.Block(texts, [True, False, True, True, True, False, True], 3)
    assert block.n_words.tolist() == [len(lm.split_words(t)) for t in texts]
    assert [block.words[i] for i in block.sequence] == [w for t in texts for w in lm.split_words(t)]
    assert len(set(block.words)) == len(block.words) == len(block.hashes) and block.words[block.end] == b""
    assert block.counts[block.end] == 5 and block.counts[block.words.index(b"two")] == 2
    speller = lm.Speller(None)
    flat, sizes = speller.spelled(block.words)
    alone = [speller.encode(" " + w.decode("utf-8", "replace")).tolist() for w in block.words]
    assert flat.tolist() == sum(alone, []) and sizes.tolist() == [len(a) for a in alone]
    assert [len(s) for s in speller.spelled([])] == [0, 0]
