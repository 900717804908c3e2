"""Hourly counts over the scored stream.

The scored sink folder is read as a stream with an explicit schema (no
inference), grouped by a tumbling 1-hour window, and kept as running state.
``watermark`` (off by default, as in the reference) bounds the state and
drops events later than the watermark (Q8).

Readers want the latest value per hour. Update mode appends every change,
so its sink holds several rows per hour (Q6). ``start_upsert_log``
writes each micro-batch's changed hours to a Parquet log partitioned by
batch id (a re-run batch overwrites its own partition), and
``latest_state`` returns, per hour, the row of the highest batch id.
``compact_log`` folds the log into a snapshot and removes what the snapshot
before covers, so the number of files does not grow with the batches.
``start_live_table`` keeps a table name on that state while the stream runs;
rows stay in files, not in the driver's memory.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txpipe.operators.stats import hourly_measures

LOG_FILES = 4  # of a batch

SCORED_SCHEMA = T.StructType(
    [
        T.StructField("TRANSACTION_ID", T.LongType()),
        T.StructField("TX_DATETIME", T.TimestampType()),
        T.StructField("CUSTOMER_ID", T.LongType()),
        T.StructField("TX_FRAUD", T.LongType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("ok", T.BooleanType()),
    ]
)


def scored_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The scored rows of the sink as a stream, fixed schema. Only files of
    committed batches are read, each once."""
    r = spark.readStream.schema(SCORED_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path).where("ok").drop("ok")


def hourly_aggregate(scored: DataFrame, watermark: str | None = None, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding, ``slide`` < ``window``) hourly counts."""
    src = scored.withWatermark("TX_DATETIME", watermark) if watermark else scored
    w = F.window("TX_DATETIME", window, slide or window)
    return src.groupBy(w.alias("window")).agg(*hourly_measures(F.col("TX_FRAUD"), F.col("prediction")))


def flatten_window(df: DataFrame) -> DataFrame:
    """``window.start`` / ``window.end`` as plain columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def start_upsert_log(agg: DataFrame, log_path: str, checkpoint: str, available_now: bool = True, compact_every: int = 0, table: str | None = None) -> StreamingQuery:
    """Per micro-batch, the changed hours go to ``log_path`` under
    ``batch_id=<id>``; idempotent when a batch is re-run. The log is compacted
    after every ``compact_every`` batches, if given."""
    spark = agg.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        append_batch(flatten_window(batch), batch_id, log_path)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_log(spark, log_path)
        if table:
            latest_state(spark, log_path).createOrReplaceTempView(table)

    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def start_live_table(agg: DataFrame, name: str, log_path: str, checkpoint: str, available_now: bool = True, compact_every: int = 20) -> StreamingQuery:
    """The latest row per hour under a table name of the session, as of the
    last micro-batch; read it with ``spark.table(name)`` or SQL while the stream
    runs (S13). A read that has begun stays valid for a compaction or more."""
    return start_upsert_log(agg, log_path, checkpoint, available_now, compact_every, name)


def append_batch(rows: DataFrame, batch_id: int, log_path: str) -> None:
    """One micro-batch's rows as a folder of the log, in place of an earlier try:
    a few files, not one for each partition of the state."""
    tagged = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).repartition(LOG_FILES, "window_start")
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log_path)


def _latest(log: DataFrame) -> DataFrame:
    measures = [c for c in log.columns if c not in ("window_start", "window_end", "batch_id")]
    latest = F.max_by(F.struct(*measures, "batch_id"), F.col("batch_id")).alias("s")
    return log.groupBy("window_start", "window_end").agg(latest).select("window_start", "window_end", "s.*")


def _folders(spark: SparkSession, path: str, prefix: str, marker: str | None = None) -> dict[int, str]:
    """``<prefix><number>`` folders under a path (if it exists) by their number;
    with a marker, those that hold such a file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at(path)):
        return {}
    found = [st.getPath() for st in fs.listStatus(at(path)) if st.getPath().getName().startswith(prefix)]
    return {int(p.getName().removeprefix(prefix)): p.toString() for p in found if marker is None or fs.exists(at(p, marker))}


def _snapshot_path(log_path: str) -> str:
    return f"{log_path.rstrip('/')}-compact"


def _snapshots(spark: SparkSession, log_path: str) -> list[int]:
    """Last batch ids of the whole snapshots. Spark writes ``_SUCCESS`` last, in
    one step, and a snapshot is not written again: the newest one that has the
    file is what readers go by."""
    return sorted(_folders(spark, _snapshot_path(log_path), "upto=", "_SUCCESS"))


def _log_since_snapshot(spark: SparkSession, log_path: str) -> DataFrame:
    done = _snapshots(spark, log_path)
    if not done:
        return spark.read.parquet(log_path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    base = spark.read.parquet(f"{_snapshot_path(log_path)}/upto={done[-1]}")
    # The schema is given: folders that the snapshot covers may be gone by now.
    log = spark.read.schema(base.schema).parquet(log_path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return base.unionByName(log.where(F.col("batch_id") > done[-1]))  # older folders are pruned


def compact_log(spark: SparkSession, log_path: str) -> int | None:
    """Write the latest row per hour as a snapshot beside the log; readers then
    open only the snapshot and newer batches. Returns the last batch in it, or
    None for a log without batches.

    What the snapshot *before* this one covers is removed, with all snapshots
    older than that one: a reader that began before this call goes by the one
    before, and nothing that it reads is touched. With a compaction every n
    batches there are at most 2 n batch folders and two snapshots. A batch that
    runs again after it was folded in is ignored and goes with the next call."""
    done = _snapshots(spark, log_path)
    if not done and not _folders(spark, log_path, "batch_id="):
        return None
    rows = _log_since_snapshot(spark, log_path)
    upto = int(rows.agg(F.max("batch_id")).first()[0])
    if done and upto == done[-1]:
        return upto
    _latest(rows).write.mode("overwrite").parquet(f"{_snapshot_path(log_path)}/upto={upto}")
    if done:
        _remove_covered(spark, log_path, done[-1])
    return upto


def _remove_covered(spark: SparkSession, log_path: str, upto: int) -> None:
    old = [p for n, p in _folders(spark, log_path, "batch_id=").items() if n <= upto]
    old += [p for n, p in _folders(spark, _snapshot_path(log_path), "upto=").items() if n < upto]
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in old:
        at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at(path), True)


def latest_state(spark: SparkSession, log_path: str) -> DataFrame:
    """R6 reader: the latest row per hour (max batch id), one aggregate."""
    return _latest(_log_since_snapshot(spark, log_path)).drop("batch_id")


def state_counts(query: StreamingQuery) -> tuple[int, int]:
    """Rows (hours) in the state store after the last batch of a run, and how many
    its batches dropped behind the watermark (hours of a batch, not messages)."""
    ops = [op for p in query.recentProgress for op in p.stateOperators]
    return (ops[-1].numRowsTotal, sum(op.numRowsDroppedByWatermark for op in ops)) if ops else (0, 0)


PROGRESS = "query_id string, batch_id long, timestamp string, num_input_rows long, processed_rows_per_second double"


class ProgressLog(StreamingQueryListener):
    """A row for every progress event in ``path``, so the table is whole
    however many batches run. Rows are kept until there are ``every`` of them and
    then appended as one file; the rest goes when a query ends, or by ``flush``.
    Register it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (str(p.id), int(p.batchId), str(p.timestamp), int(p.numInputRows or 0), float(p.processedRowsPerSecond or 0.0))
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            if self._rows:
                self.spark.createDataFrame(self._rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            self._rows = []  # only what is written


def progress_rows(spark: SparkSession, path: str, query: StreamingQuery | None = None) -> DataFrame:
    """The logged progress (of one query), a row per batch."""
    rows = spark.read.schema(PROGRESS).parquet(path)
    return rows.where(F.col("query_id") == str(query.id)) if query is not None else rows
