import random

import corpus_pipeline
from txpipe.llm import decontam, packing, quality, secrets, simhash
from txpipe.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "packing"]
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == docs.columns
        steps.append((docs, out))
        docs = out
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    before, after = steps[0]
    assert ids(after) == ids(quality.scores(before, labels).where("predicted = 1"))
    before, after = steps[1]
    groups = {}
    for r in simhash.near_duplicates(before).collect():
        groups.setdefault(r["component_id"], []).append(r["doc_id"])
    assert ids(after) == sorted(min(g) for g in groups.values())
    before, after = steps[2]
    assert ids(after) == ids(decontam.digest(decontam.scan(before, benchmark)).where("not contaminated"))
    before, after = steps[3]
    assert ids(after) == ids(before)
    assert secrets.digest(secrets.scan(after, ["doc_id"])).where("n_assign + n_access + n_hex > 0").count() == 0
    before, after = steps[4]
    want = sorted(map(tuple, packing.pack(before).groupBy("doc_id").sum("length").collect()))
    assert sorted(map(tuple, after.groupBy("doc_id").sum("length").collect())) == want and len(want) == before.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).groupBy("doc_id").sum("length").collect())) == want


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_edge_cases_through_all_stages(spark, docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    plain = [" ".join(rng.choices(words, k=60)) for _ in range(20)]
    long_text = " ".join(rng.choices(words, k=60_000)) + " password=averysecretvalue1"
    table = docs([*plain, plain[0], plain[1] + " password=hunter2hunter2", long_text])
    out, kept = table, []
    for name, stage in corpus_pipeline.STAGES[1:]:  # the classifier may reject any of these
        before, out = out, stored(stage(spark, out, SF), name)
        if name != "packing":
            assert out.columns == table.columns
        kept.append({r["doc_id"] for r in out.select("doc_id").distinct().collect()})
    assert stored(corpus_pipeline.quality_classifier(spark, table, SF), "edges").columns == table.columns
    deduped, clean, redacted, packed = kept
    assert 0 in deduped and 20 not in deduped  # an exact copy goes, the least id stays
    assert {1000, 1001, 1002} & deduped == {1000}  # no words: one group, its least id stays
    assert {1003, None, 22} <= deduped and clean == redacted == packed == deduped
    texts = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
    assert "averysecretvalue1" not in texts[22] and len(texts[22]) > 100_000 and texts[1000] is None
    pieces = out.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r[1] == r[2] for r in pieces) and len(pieces) == len(packed)
