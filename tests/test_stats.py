import math
import random

from pyspark.sql import functions as F

from helpers import plan_text
from txpipe.operators.labels import label_frauds
from txpipe.operators.stats import amount_histogram, correlation_long
from txpipe.sources.fixture import load_transactions


def brute_corr(rows, i, j):
    xy = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
    n = len(xy)
    if n < 2:
        return None
    ma, mb = math.fsum(x for x, _ in xy) / n, math.fsum(y for _, y in xy) / n
    caa, cbb = math.fsum((x - ma) ** 2 for x, _ in xy), math.fsum((y - mb) ** 2 for _, y in xy)
    return math.fsum((x - ma) * (y - mb) for x, y in xy) / math.sqrt(caa * cbb) if caa > 0 and cbb > 0 else None


def test_correlation_over_many_batches_and_tasks(spark):
    rng = random.Random(4)
    rows = []
    for k in range(3000):
        x = rng.gauss(1e6 + k, 50)
        rows.append((x, None if rng.random() < 0.2 else 3 * x + rng.gauss(0, 900), rng.gauss(0, 1) + k / 1500, 7.0, None))
    df = spark.createDataFrame(rows, "ma double, mb double, c double, d double, e double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        out = correlation_long(df, df.columns, digits=9)
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 15 and "Window" not in plan_text(out)
    for (a, b), v in got.items():
        want = brute_corr(rows, df.columns.index(a), df.columns.index(b))
        assert (v is None) == (want is None) and (v is None or abs(v - want) < 1e-8), (a, b, v, want)


def test_histogram_counts_every_row(spark):
    tx = load_transactions(spark, "/root/testdata/sf0.001")
    rows = amount_histogram(tx, 10).collect()
    assert sum(r["n"] for r in rows) == tx.count() and {r["bucket"] for r in rows} <= set(range(10))


def test_labelling_runs_few_jobs_and_leaves_nothing_cached(spark):
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    lab = label_frauds(load_transactions(spark, "/root/testdata/sf0.001"))
    assert lab.agg(F.sum("TX_FRAUD")).first()[0] > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_large_side_tables_shuffle_instead_of_broadcast(spark):
    tx = load_transactions(spark, "/root/testdata/sf0.001")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(label_frauds(tx).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lab = label_frauds(tx)
        assert "BroadcastHashJoin" not in plan_text(lab) and sorted(lab.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
