"""Score a message stream into a Parquet sink.

source (Kafka or files) -> text (P6) -> ``from_json`` with the fixed
schema (P7) -> flatten (P8) -> good rows scored by the model (R2) -> Parquet
sink (S10). Rows that do not parse, hold a value of the wrong type or lack a
model input are dead letters (Q9). Both kinds go to one sink, parted by ``ok``,
so a message is parsed once. The sink keeps a log of the files of each committed
batch, and its readers, batch or stream, see only those: a batch that runs again
after a crash changes nothing (R3), nor does a file that a lost task left. The
label is carried under another name while the model runs, so a missing, NULL or
unseen label never stops scoring.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txpipe import schema as S
from txpipe.sources.messages import checked_messages, message_source

_CARRIED_LABEL = "_label_carried"


def score_rows(good: DataFrame, model: PipelineModel | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """R2: apply a fitted pipeline (or any DataFrame -> DataFrame scorer)."""
    carried = good.withColumnRenamed("TX_FRAUD", _CARRIED_LABEL) if "TX_FRAUD" in good.columns else good
    out = model.transform(carried) if hasattr(model, "transform") else model(carried)
    return out.withColumnRenamed(_CARRIED_LABEL, "TX_FRAUD") if _CARRIED_LABEL in out.columns else out


def with_fraud_probability(scored: DataFrame) -> DataFrame:
    """Everything the model adds stays (vectors, raw scores, probabilities);
    the fraud class's probability comes as a plain column besides."""
    if "probability" not in scored.columns:
        return scored
    from pyspark.ml.functions import vector_to_array

    return scored.withColumn("probability_fraud", vector_to_array(F.col("probability"))[1])


def scored_messages(messages: DataFrame, model) -> DataFrame:
    """Good messages with what the model adds, dead letters with their ``raw``
    text and the time they came; ``ok`` tells them apart. Model inputs of dead
    letters are 0 while the model runs and NULL after it."""
    checked = checked_messages(messages, required=("TRANSACTION_ID", "TX_DATETIME", *S.FEATURES))
    fields, ok = [f for f in checked.schema["m"].dataType.fields if f.name != "index"], F.col("ok")
    filled = [F.when(ok, F.col(f"m.{f.name}")).otherwise(F.lit(0).cast(f.dataType) if f.name in S.FEATURES else None).alias(f.name) for f in fields]
    out = with_fraud_probability(score_rows(checked.select(*filled, "ok", "raw"), model))
    rest = [F.when(ok, F.col(f"`{c}`")).alias(c) for c in out.columns if c not in ("ok", "raw")]
    return out.select(*rest, F.when(~ok, F.col("raw")).alias("raw"), F.when(~ok, F.current_timestamp()).alias("received_at"), "ok")


def start_scoring(
    spark: SparkSession,
    model,
    sink_path: str,
    checkpoint: str,
    source_fmt: str = "text",
    source_path: str | None = None,
    source_options: dict | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the scoring query into ``sink_path``; read it with
    :func:`scored_rows` and :func:`dead_letters`, or as a stream. ``available_now``
    processes what is there and stops (R8); otherwise a processing-time trigger
    runs continuously."""
    messages = message_source(spark, source_fmt, source_path, source_options, streaming=True)
    w = scored_messages(messages, model).writeStream.format("parquet").outputMode("append").partitionBy("ok")
    w = w.option("path", sink_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return (w.queryName(query_name) if query_name else w).start()


def scored_rows(spark: SparkSession, sink_path: str) -> DataFrame:
    """The scored messages of all committed batches."""
    return spark.read.parquet(sink_path).where(F.col("ok").cast("boolean")).drop("ok", "raw", "received_at")


def dead_letters(spark: SparkSession, sink_path: str) -> DataFrame:
    """Texts that could not be scored, and when they came."""
    return spark.read.parquet(sink_path).where(~F.col("ok").cast("boolean")).select("raw", "received_at")


def await_all(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Block until the queries end. With a limit, a query that has not
    ended by then is stopped and the call raises: its sink holds only a part."""
    for q in queries:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            for other in queries:
                other.stop()
            raise TimeoutError(f"stream {q.name or q.id} had not ended after {timeout_s} s; it was stopped and its sink is not complete")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def rule_scorer(threshold: float = 100.0) -> Callable[[DataFrame], DataFrame]:
    """A fixed scorer (amount above ``threshold``) for oracle-checkable streams."""

    def run(df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.when(F.col("TX_AMOUNT") > F.lit(threshold), 1.0).otherwise(0.0))

    return run
