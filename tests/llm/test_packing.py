import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from txpipe.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    bits = ["the", "Thing", "'s", "'LL", " ", "\n", "é", "ß", "İ", "Σας", "日本", "½", "x²", "12", "!!", "\x1c", "\x85", "<|endoftext|>", "<|", "\x00", "don't", "É", "€"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_encoder_equals_the_tokenizer(tokenizer):
    texts = random_texts(400)
    got = packing.Encoder(packing.tokenizer_path()).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("max_open", [2048, 5])
def test_every_id_in_one_piece(docs, tokenizer, max_open):
    texts = [*random_texts(60), "word " * 9000, " ".join(f"w{i}" for i in range(4096))]
    df = docs(texts).repartition(3)
    rows = packing.pack(df, capacity=256, max_open=max_open).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for d in df.dropDuplicates(["doc_id"]).collect():
        ids, repeats = ids_of(tokenizer, d["text"]), 2 if d["doc_id"] == 1003 else 1
        pieces = sorted(by_doc[d["doc_id"]], key=lambda r: r["start"])
        covered = np.zeros(len(ids), int)
        for r in pieces:
            covered[r["start"] : r["start"] + r["length"]] += 1
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        assert (covered == repeats).all()
    for part in by_sequence.values():
        part.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in part] == [0, *np.cumsum([r["length"] for r in part])[:-1].tolist()]
        n = sum(r["length"] for r in part)
        assert n == 256 or n & (n - 1) == 0  # no padding


def test_level_with_the_least_growth_is_chosen():
    rng = np.random.default_rng(0)
    packer = packing.Packer(0, capacity=32)
    for _ in range(2000):
        packer.levels[1:32] = rng.integers(0, 4, 31)
        size = int(rng.integers(1, 32))
        cost = {}
        for level in range(32 - size + 1):
            if level and not packer.levels[level]:
                continue
            after = packer.levels.copy()
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] += 1
            cost[level] = int((after[1:32] ** 2).sum())
        best = packer.level_for(size)
        assert cost[best] == min(cost.values()) and best == max(k for k in cost if cost[k] == cost[best])


def test_same_rows_same_result(docs):
    df = docs(random_texts(30)).coalesce(1)
    assert packing.pack(df).collect() == packing.pack(df).collect()


def test_empty_table(no_docs):
    assert packing.pack(no_docs).count() == 0
