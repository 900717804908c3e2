import json
import os
import time

import pytest
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.session import work_path
from txpipe.sources.messages import parse_messages
from txpipe.streaming import hourly as H
from txpipe.streaming import scoring as SC


def _msg(i, ts, amount=10.0, fraud=0):
    m = {c: 0 for c in S.message_schema().fieldNames()}
    m.update(index=i, TRANSACTION_ID=i, TX_DATETIME=ts, CUSTOMER_ID=1, TERMINAL_ID=2, TX_AMOUNT=amount, TX_FRAUD=fraud)
    return json.dumps(m)


def test_malformed_go_to_dead_letter(spark):
    lines = [_msg(1, "2024-01-01 10:00:00.000001"), "{not json", json.dumps({"TRANSACTION_ID": 5}), _msg(2, "2024-01-01 11:00:00")]
    good, dead = parse_messages(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r[0] for r in good.select("TRANSACTION_ID").collect()) == [1, 2]
    assert dead.count() == 2
    ts = good.where("TRANSACTION_ID = 1").select("TX_DATETIME").collect()[0][0]
    assert ts.microsecond == 1


def _write(path, name, lines):
    path = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_scoring_with_bad_rows_and_restart(spark):
    base = work_path(spark, "t-stream")
    inp = base + "/in"
    _write(inp, "a.txt", [_msg(i, f"2024-01-01 10:{i:02d}:00", amount=150.0, fraud=1) for i in range(5)] + ["garbage"])
    args = dict(source_path=inp, source_options={"maxFilesPerTrigger": "1"})
    SC.await_all([SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + "/ckpt", **args)], 300)
    SC.await_all([SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + "/ckpt", **args)], 300)
    _write(inp, "b.txt", [_msg(i, f"2024-01-01 12:{i:02d}:00", fraud=0) for i in range(5, 9)])
    SC.await_all([SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + "/ckpt", **args)], 300)
    out = SC.scored_rows(spark, base + "/sink")
    assert out.count() == 9 and out.select("TRANSACTION_ID").distinct().count() == 9
    assert SC.dead_letters(spark, base + "/sink").count() == 1
    assert out.where("prediction = 1.0").count() == 5


def test_late_rows_behind_watermark_are_dropped(spark):
    base = work_path(spark, "t-late")
    sink = base + "/scored"
    rows = [(1, "2024-01-01 10:00:00", 1, 0, 0.0), (2, "2024-01-01 13:30:00", 1, 1, 1.0)]
    late = [(3, "2024-01-01 10:10:00", 1, 1, 1.0), (4, "2024-01-01 13:40:00", 1, 0, 0.0)]
    schema = "TRANSACTION_ID long, TX_DATETIME string, CUSTOMER_ID long, TX_FRAUD long, prediction double"
    rows, late = [(*r, True) for r in rows], [(*r, True) for r in late]
    schema += ", ok boolean"
    spark.createDataFrame(rows, schema).withColumn("TX_DATETIME", F.col("TX_DATETIME").cast("timestamp")).coalesce(1).write.parquet(sink)
    agg = H.hourly_aggregate(H.scored_source(spark, sink, 1), watermark="10 minutes")
    SC.await_all([H.start_upsert_log(agg, base + "/log", base + "/ckpt")], 300)
    spark.createDataFrame(late, schema).withColumn("TX_DATETIME", F.col("TX_DATETIME").cast("timestamp")).coalesce(1).write.mode("append").parquet(sink)
    SC.await_all([H.start_upsert_log(agg, base + "/log", base + "/ckpt")], 300)  # restart from checkpoint
    hours = {r["window_start"].hour: r for r in H.latest_state(spark, base + "/log").collect()}
    assert hours[10]["nx_fraud_transactions"] == 0  # the 10:10 fraud row came after the watermark passed 13:20
    assert hours[13]["nx_fraud_transactions"] == 1
    assert hours[13]["nx_transactions"] == round(2 / 30, 2)


def test_progress_log_keeps_every_batch(spark):
    base = work_path(spark, "t-progress")
    inp = base + "/in"
    for k in range(4):
        _write(inp, f"{k}.txt", [_msg(10 * k + i, f"2024-01-02 1{k}:{i:02d}:00") for i in range(3)])
    log = H.ProgressLog(spark, base + "/progress")
    spark.streams.addListener(log)
    try:
        q = SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + "/ckpt", "text", inp, {"maxFilesPerTrigger": "1"})
        SC.await_all([q], 300)
        time.sleep(3)  # listeners are told a little later
    finally:
        spark.streams.removeListener(log)
    rows = H.progress_rows(spark, base + "/progress", q).collect()
    assert sum(r["num_input_rows"] for r in rows) == 12 and {r["batch_id"] for r in rows} >= {0, 1, 2, 3}


def test_values_of_the_wrong_type_go_to_the_dead_letter(spark):
    def bad(**change):
        return json.dumps(json.loads(_msg(1, "2024-01-01 10:00:00")) | change)

    lines = [_msg(0, "2024-01-01 10:00:00"), bad(TX_DATETIME="not-a-date"), bad(CUSTOMER_ID="x7"), bad(TX_AMOUNT="much"), bad(TX_DATETIME=None), bad(CUSTOMER_ID=None)]
    good, dead = parse_messages(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r["TRANSACTION_ID"] for r in good.collect()) == [0, 1]  # a NULL customer is no error
    assert dead.count() == 4


def test_a_stream_that_has_not_ended_raises(spark):
    base = work_path(spark, "t-timeout")
    for k in range(30):
        _write(base + "/in", f"{k}.txt", [_msg(k, "2024-01-02 10:00:00")])
    q = SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + "/ckpt", "text", base + "/in", {"maxFilesPerTrigger": "1"})
    with pytest.raises(TimeoutError):
        SC.await_all([q], 0.5)
    assert not q.isActive


def test_rerun_batch_adds_nothing(spark):
    base = work_path(spark, "t-rerun")
    _write(base + "/in", "a.txt", [_msg(i, "2024-01-02 10:00:00") for i in range(5)] + ["bad"])
    for ckpt in ("/ckpt1", "/ckpt2"):  # a lost checkpoint runs batch 0 again
        q = SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + ckpt, "text", base + "/in")
        SC.await_all([q], 300)
    assert SC.scored_rows(spark, base + "/sink").count() == 5 and SC.dead_letters(spark, base + "/sink").count() == 1


def test_a_batch_lost_between_write_and_commit_counts_once(spark):
    """The state a crash leaves after a batch's files are written: no entry in the
    checkpoint's commit log. Both streams run again; sink and hours stay."""
    base = work_path(spark, "t-replay")
    for k in range(3):
        _write(base + "/in", f"{k}.txt", [_msg(10 * k + i, f"2024-01-02 1{k}:{i:02d}:00", amount=150.0, fraud=1) for i in range(4)] + ["bad"])

    def both():
        q = SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + "/ckpt", "text", base + "/in", {"maxFilesPerTrigger": "1"})
        SC.await_all([q], 300)
        agg = H.hourly_aggregate(H.scored_source(spark, base + "/sink", 1))
        SC.await_all([H.start_upsert_log(agg, base + "/log", base + "/agg")], 300)
        return sorted(H.latest_state(spark, base + "/log").collect())

    def drop_last_commit(ckpt):
        folder = (base + ckpt + "/commits").removeprefix("file:")
        last = max((n for n in os.listdir(folder) if n.isdigit()), key=int)
        for name in (last, f".{last}.crc"):
            os.remove(os.path.join(folder, name))

    want = both()
    assert [r["nx_fraud_transactions"] for r in want] == [4, 4, 4]
    drop_last_commit("/ckpt")
    assert both() == want
    drop_last_commit("/ckpt")
    drop_last_commit("/agg")
    _write(base + "/in", "3.txt", [_msg(40, "2024-01-02 12:30:00", amount=150.0, fraud=1)])
    got = both()
    assert [r["nx_fraud_transactions"] for r in got] == [4, 4, 5]
    assert SC.scored_rows(spark, base + "/sink").count() == 13 and SC.dead_letters(spark, base + "/sink").count() == 3


def test_compacted_log_gives_the_same_state(spark):
    path = work_path(spark, "t-compact")
    rows = [(h, b, float(b)) for b in range(6) for h in range(b + 1)]
    df = spark.createDataFrame(rows, "h int, batch_id long, n double").selectExpr("timestamp'2024-01-01' + make_interval(0,0,0,0,h) AS window_start", "timestamp'2024-01-01' + make_interval(0,0,0,0,h+1) AS window_end", "n", "batch_id")
    df.where("batch_id < 4").write.partitionBy("batch_id").parquet(path)
    want = sorted(H.latest_state(spark, path).collect())
    assert H.compact_log(spark, path) == 3 and sorted(H.latest_state(spark, path).collect()) == want
    df.where("batch_id >= 4").write.mode("append").partitionBy("batch_id").parquet(path)
    assert {r["n"] for r in H.latest_state(spark, path).collect()} == {5.0}


def _folders(path, prefix):
    path = path.removeprefix("file:")
    return sorted(int(n.removeprefix(prefix)) for n in os.listdir(path) if n.startswith(prefix))


def test_log_stays_short_over_many_batches(spark):
    path = work_path(spark, "t-many")
    hours = "h int, n double"
    for b in range(50):
        rows = spark.createDataFrame([(h, float(b)) for h in {b % 3, 3 + b}], hours).coalesce(1)
        rows = rows.selectExpr("timestamp'2024-01-01' + make_interval(0,0,0,0,h) AS window_start", "timestamp'2024-01-01' + make_interval(0,0,0,0,h+1) AS window_end", "n")
        H.append_batch(rows, b, path)
        if b % 5 == 4:
            assert H.compact_log(spark, path) == b
            assert len(_folders(path, "batch_id=")) <= 10 and len(_folders(path + "-compact", "upto=")) <= 2
    want = {3 + b: float(b) for b in range(50)} | {k: float(max(b for b in range(50) if b % 3 == k or 3 + b == k)) for k in range(3)}
    got = H.latest_state(spark, path).selectExpr("cast((unix_timestamp(window_start) - unix_timestamp(timestamp'2024-01-01')) / 3600 AS int) AS h", "n")
    assert dict(map(tuple, got.collect())) == want
    assert H.compact_log(spark, path) == 49  # nothing new: the snapshot is left as it is
    assert H.compact_log(spark, path + "-none") is None


def test_a_reader_outlives_a_compaction(spark):
    path = work_path(spark, "t-reader")

    def batch(b):
        H.append_batch(spark.sql(f"SELECT timestamp'2024-01-01' AS window_start, timestamp'2024-01-01 01:00:00' AS window_end, {b}.0D AS n"), b, path)

    batch(0)
    batch(1)
    early = H.latest_state(spark, path)  # planned, not yet run
    H.compact_log(spark, path)
    batch(2)
    assert early.first()["n"] == 1.0
    early = H.latest_state(spark, path)
    H.compact_log(spark, path)  # removes batches 0 and 1, which the first snapshot covers
    assert _folders(path, "batch_id=") == [2] and early.first()["n"] == 2.0
    batch(1)  # an old batch that runs again
    assert H.latest_state(spark, path).first()["n"] == 2.0


def test_live_table_is_read_while_the_stream_runs(spark):
    base = work_path(spark, "t-live")
    for k in range(6):
        _write(base + "/in", f"{k}.txt", [_msg(10 * k + i, f"2024-01-02 1{k % 3}:{k}{i}:00", amount=150.0, fraud=1) for i in range(4)])
    SC.await_all([SC.start_scoring(spark, SC.rule_scorer(100.0), base + "/sink", base + "/ckpt", "text", base + "/in", {"maxFilesPerTrigger": "1"})], 300)
    agg = H.hourly_aggregate(H.scored_source(spark, base + "/sink", 1))
    q = H.start_live_table(agg, "t_live", base + "/log", base + "/agg", compact_every=2)
    seen = []
    while q.isActive:
        if spark.catalog.tableExists("t_live"):
            rows = spark.table("t_live").collect()
            assert len({r["window_start"] for r in rows}) == len(rows)  # one row per hour
            seen.append(sum(r["nx_fraud_transactions"] for r in rows))
    SC.await_all([q], 300)
    assert seen == sorted(seen) and len(set(seen)) > 1
    assert spark.sql("SELECT sum(nx_fraud_transactions) FROM t_live").first()[0] == 24
    spark.catalog.dropTempView("t_live")


def test_progress_log_writes_one_file_for_many_events(spark):
    from types import SimpleNamespace

    path = work_path(spark, "t-buffer")
    log = H.ProgressLog(spark, path, every=4)
    for b in range(10):
        log.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(id="q", batchId=b, timestamp="t", numInputRows=1, processedRowsPerSecond=None)))
    assert H.progress_rows(spark, path).count() == 8 and len(_parquet_files(path)) == 2
    log.onQueryTerminated(None)
    assert sorted(r["batch_id"] for r in H.progress_rows(spark, path).collect()) == list(range(10))
    assert len(_parquet_files(path)) == 3


def _parquet_files(path):
    return [n for n in os.listdir(path.removeprefix("file:")) if n.endswith(".parquet")]


def test_messages_are_written_in_time_order(spark):
    from txpipe.sources.fixture import load_transactions
    from txpipe.sources.messages import to_messages, write_messages

    path = work_path(spark, "t-order")
    write_messages(to_messages(load_transactions(spark, "/root/testdata/sf0.01")), path)
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if "/part-" in f.path)
    times = [json.loads(line)["TX_DATETIME"] for f in files for line in store.open_input_stream(f).read().decode().splitlines()]
    assert len(times) == 10000 and times == sorted(times)


def test_unseen_or_null_label_does_not_stop_scoring(spark):
    from pyspark.ml import Pipeline

    from txpipe.operators import model as M
    from txpipe.operators.features import build_features
    from txpipe.operators.labels import label_frauds
    from txpipe.sources.fixture import load_transactions

    feats = build_features(label_frauds(load_transactions(spark, "/root/testdata/sf0.001")))
    idx = M.label_indexer(feats)
    model = Pipeline(stages=M.pipeline("random_forest", idx).getStages()).fit(feats)
    base = work_path(spark, "t-label")
    inp = base + "/in"
    lines = [_msg(1, "2024-01-03 10:00:00", fraud=7), _msg(2, "2024-01-03 11:00:00", fraud=0)]
    null_label = json.loads(_msg(3, "2024-01-03 12:00:00"))
    null_label["TX_FRAUD"] = None
    _write(inp, "a.txt", lines + [json.dumps(null_label)])
    q = SC.start_scoring(spark, model, base + "/sink", base + "/ckpt", "text", inp, {"maxFilesPerTrigger": "1"})
    SC.await_all([q], 300)
    out = {r["TRANSACTION_ID"]: r for r in SC.scored_rows(spark, base + "/sink").collect()}
    assert sorted(out) == [1, 2, 3]
    assert out[1]["TX_FRAUD"] == 7 and out[3]["TX_FRAUD"] is None  # label carried through unchanged
    assert all(out[i]["prediction"] in (0.0, 1.0) for i in out)
    assert {"indexedFeatures", "rawPrediction", "probability", "predictedLabel", "probability_fraud"} <= set(out[1].asDict())


def test_files_of_inputs_and_log_do_not_follow_the_rows(spark):
    """A file is a micro-batch, so their number is fixed; so is that of a batch's files in the log."""
    from txpipe.plans import q_stream as Q

    start = F.timestamp_seconds(F.col("id") + 1_704_067_200)
    rows = spark.range(0, 4_000, 1, 40).select(F.col("id").alias("TRANSACTION_ID"), start.alias("TX_DATETIME"))
    path = work_path(spark, "t-slices").removeprefix("file:")
    Q.write_inputs(rows, path)
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(files) == Q.INPUT_SLICES
    said = [json.loads(x)["TRANSACTION_ID"] for f in files for x in open(os.path.join(path, f))]
    assert said == list(range(4_000))  # all rows, file names in time order
    hours = spark.range(0, 400, 1, 40).select((F.timestamp_seconds(F.col("id") * 3_600)).alias("window_start"), F.col("id").alias("n"))
    log = work_path(spark, "t-log-files").removeprefix("file:")
    H.append_batch(hours, 0, log)
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{log}/batch_id=0")) <= H.LOG_FILES
    assert spark.read.parquet(log).count() == 400
