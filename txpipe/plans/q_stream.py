"""Streaming queries (R1-R8, S8, S10-S13). Each writes the feature table as
JSON messages into several files of a fresh folder, runs the stream with
``maxFilesPerTrigger=1`` and ``availableNow``, and returns what the sink
holds as a batch DataFrame."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import Window
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.operators import model as M
from txpipe.operators.features import build_features
from txpipe.plans import oracle as O
from txpipe.plans.common import labelled
from txpipe.plans.registry import query
from txpipe.session import stored, work_path
from txpipe.sources.messages import to_messages, write_messages
from txpipe.streaming import hourly as H
from txpipe.streaming import scoring as SC

FILE_SOURCE = {"maxFilesPerTrigger": "1"}
#: Input files of a run. A file is a micro-batch, read by many tasks, and each of
#: those leaves a file in the sink, a micro-batch of the hourly stream: files by
#: size would mean micro-batches without bound.
INPUT_SLICES = 8
FEAT_SQL = O.with_(O.TX, O.PICKS, O.LAB, O.features_cte()) + f"SELECT {', '.join(S.FEATURE_TABLE)} FROM feat"
HOURLY_RULE_SQL = (
    O.labelled_prefix()
    + """SELECT date_trunc('hour', TX_DATETIME) AS window_start,
       date_trunc('hour', TX_DATETIME) + INTERVAL 1 HOUR AS window_end,
       round(count(CUSTOMER_ID) / 30.0, 2) AS nx_transactions,
       count(*) FILTER (WHERE TX_FRAUD = 1) AS nx_fraud_transactions,
       count(*) FILTER (WHERE TX_FRAUD = 1 AND TX_AMOUNT > 100) AS correct_fraud_predictions,
       count(*) FILTER (WHERE TX_FRAUD = 0 AND TX_AMOUNT > 100) AS false_positive_predictions
FROM lab GROUP BY 1, 2"""
)


def _features(spark, sf):
    return build_features(labelled(spark, sf))


def write_inputs(feats, path: str, since: str | None = None, until: str | None = None, mode: str = "overwrite") -> None:
    """Messages in time order; the range sort gives ``INPUT_SLICES`` files, each
    a time slice (the replay order of the reference's producer)."""
    df = feats
    if until is not None:
        df = df.where(F.col("TX_DATETIME") < F.lit(until).cast("timestamp"))
    write_messages(to_messages(df, since=since, slices=INPUT_SLICES), path, mode=mode)


def _run_scoring(spark, scorer, in_path, sink, ckpt):
    SC.await_all([SC.start_scoring(spark, scorer, sink, ckpt, "text", in_path, FILE_SOURCE)])


@query("r1_stream_parse_flatten", FEAT_SQL)
def r1(spark, sf):
    """Parsed and flattened rows land in the Parquet sink."""
    base = work_path(spark, "r1")
    write_inputs(_features(spark, sf), f"{base}/in")
    _run_scoring(spark, lambda df: df, f"{base}/in", f"{base}/sink", f"{base}/ckpt")
    return SC.scored_rows(spark, f"{base}/sink").select(*S.FEATURE_TABLE)


@query("r3_restart_exactly_once", FEAT_SQL)
def r3(spark, sf):
    """Run, re-run with nothing new, add files, run again on the same
    checkpoint: every row once."""
    base = work_path(spark, "r3")
    feats = stored(_features(spark, sf), "r3-features")
    cut = "2024-01-15 00:00:00"
    write_inputs(feats, f"{base}/in", until=cut)
    for _ in range(2):
        _run_scoring(spark, lambda df: df, f"{base}/in", f"{base}/sink", f"{base}/ckpt")
    write_inputs(feats, f"{base}/in", since=cut, mode="append")
    _run_scoring(spark, lambda df: df, f"{base}/in", f"{base}/sink", f"{base}/ckpt")
    return SC.scored_rows(spark, f"{base}/sink").select(*S.FEATURE_TABLE)


R2_SQL = (
    O.labelled_prefix()
    + """SELECT TRANSACTION_ID, TX_FRAUD, true AS prediction_is_a_label, true AS label_text_follows, true AS probability_follows, true AS same_as_batch
FROM lab"""
)


@query("r2_stream_model_scoring", R2_SQL)
def r2(spark, sf):
    """A random forest pipeline fitted on the batch features, saved,
    loaded, and applied to the message stream."""
    base = work_path(spark, "r2")
    feats = stored(_features(spark, sf), "r2-features")
    idx = M.label_indexer(feats)
    model = Pipeline(stages=M.pipeline("random_forest", idx).getStages()).fit(feats)
    M.save(model, f"{base}/model")
    write_inputs(feats, f"{base}/in")
    _run_scoring(spark, M.load(f"{base}/model"), f"{base}/in", f"{base}/sink", f"{base}/ckpt")
    out = SC.scored_rows(spark, f"{base}/sink")
    batch = M.load(f"{base}/model").transform(feats).select("TRANSACTION_ID", F.col("prediction").alias("batch_prediction"))
    return out.join(batch, "TRANSACTION_ID", "left").select(
        "TRANSACTION_ID", "TX_FRAUD", F.col("prediction").isin(0.0, 1.0).alias("prediction_is_a_label"),
        (F.col("predictedLabel") == F.element_at(F.array(*map(F.lit, idx.labels)), F.col("prediction").cast("int") + 1)).alias("label_text_follows"),
        (F.col("probability_fraud").between(0, 1) & ((F.col("probability_fraud") > 0.5) == (F.col("prediction") == 1))).alias("probability_follows"),
        F.coalesce(F.col("prediction") == F.col("batch_prediction"), F.lit(False)).alias("same_as_batch"),
    )


def _scored_sink(spark, sf, base):
    write_inputs(_features(spark, sf), f"{base}/in")
    _run_scoring(spark, SC.rule_scorer(100.0), f"{base}/in", f"{base}/sink", f"{base}/ckpt")
    return f"{base}/sink"


def _hourly_log(spark, sf, key: str) -> str:
    base = work_path(spark, key)
    sink = _scored_sink(spark, sf, base)
    agg = H.hourly_aggregate(H.scored_source(spark, sink, 1))
    SC.await_all([H.start_upsert_log(agg, f"{base}/log", f"{base}/agg-ckpt")])
    return f"{base}/log"


@query("r4_hourly_stream_complete", HOURLY_RULE_SQL)
def r4(spark, sf):
    """Hourly counts over the scored sink read as a stream, all
    hours; they come through the log, not through the driver's memory."""
    return H.latest_state(spark, _hourly_log(spark, sf, "r4"))


@query("s12_live_table_by_name", HOURLY_RULE_SQL)
def s12(spark, sf):
    """The hours under a table name that SQL reads, one row per hour;
    the log behind it is compacted as it grows."""
    base = work_path(spark, "s12")
    agg = H.hourly_aggregate(H.scored_source(spark, _scored_sink(spark, sf, base), 1))
    SC.await_all([H.start_live_table(agg, "hourly_frauds", f"{base}/log", f"{base}/agg-ckpt", compact_every=3)])
    return spark.sql("SELECT * FROM hourly_frauds")


@query("r5_hourly_update_rows", HOURLY_RULE_SQL)
def r5(spark, sf):
    """Update mode gives a row per changed hour and micro-batch; the
    last row of each hour among them."""
    rows = spark.read.parquet(_hourly_log(spark, sf, "r5"))
    last = Window.partitionBy("window_start").orderBy(F.desc("batch_id"))
    return rows.withColumn("turn", F.row_number().over(last)).where("turn = 1").drop("turn", "batch_id")


@query("r6_latest_state_upsert", HOURLY_RULE_SQL)
def r6(spark, sf):
    """Update-mode changes upserted by hour; the latest row per hour, read
    from a compacted log."""
    log = _hourly_log(spark, sf, "r6")
    H.compact_log(spark, log)
    return H.latest_state(spark, log)


LATE_SQL = (
    O.labelled_prefix()
    + """, marked AS (SELECT *, date_trunc('hour', TX_DATETIME) AS hour, TRANSACTION_ID % 7 = 0 AS late FROM lab),
first AS (SELECT date_trunc('millisecond', max(TX_DATETIME)) - INTERVAL 5 DAY AS mark FROM marked WHERE NOT late),
final AS (SELECT date_trunc('millisecond', max(TX_DATETIME)) - INTERVAL 5 DAY AS mark FROM marked),
kept AS (SELECT marked.* FROM marked, first WHERE NOT late OR hour + INTERVAL 1 HOUR > mark)
SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end,
       round(count(CUSTOMER_ID) / 30.0, 2) AS nx_transactions,
       count(*) FILTER (WHERE TX_FRAUD = 1) AS nx_fraud_transactions,
       count(*) FILTER (WHERE TX_FRAUD = 1 AND TX_AMOUNT > 100) AS correct_fraud_predictions,
       count(*) FILTER (WHERE TX_FRAUD = 0 AND TX_AMOUNT > 100) AS false_positive_predictions,
       (SELECT count(DISTINCT hour) FROM kept, final WHERE hour + INTERVAL 1 HOUR > mark) AS state_rows,
       (SELECT count(DISTINCT hour) FROM marked, first WHERE late AND hour + INTERVAL 1 HOUR <= mark) AS late_hours_dropped
FROM kept GROUP BY hour"""
)


@query("r5_watermark_late_rows", LATE_SQL)
def r5_late(spark, sf):
    """R5/Q8 with a watermark of five days: every seventh transaction comes in a
    second run, after all others. Of those, the hours behind the watermark are
    dropped, and the state store ends with the hours before it closed."""
    base = work_path(spark, "r5-late")
    feats = stored(_features(spark, sf), "r5-features")
    late = F.pmod(F.col("TRANSACTION_ID"), F.lit(7)) == 0
    for rows in (feats.where(~late), feats.where(late)):
        write_inputs(rows, f"{base}/in", mode="append")
        _run_scoring(spark, SC.rule_scorer(100.0), f"{base}/in", f"{base}/sink", f"{base}/ckpt")
        agg = H.hourly_aggregate(H.scored_source(spark, f"{base}/sink"), watermark="5 days")
        hours = H.start_upsert_log(agg, f"{base}/log", f"{base}/agg-ckpt")
        SC.await_all([hours])
    state_rows, dropped = H.state_counts(hours)
    return H.latest_state(spark, f"{base}/log").select("*", F.lit(state_rows).cast("bigint").alias("state_rows"), F.lit(dropped).cast("bigint").alias("late_hours_dropped"))
