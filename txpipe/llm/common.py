"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path (not yet made) below the shared folder that the cluster names.

    Only a local session without the setting gets a temporary folder."""
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not base:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="txpipe-llm-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and
    the files outlive any executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(col: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % modulus


def with_row_keys(documents: DataFrame, *columns: str) -> DataFrame:
    """Adds ``id_key, row_key``: two longs by which a row is found again in a
    later scan, however files are split then. Rows with equal doc_id and text
    share them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.xxhash64(F.col("doc_id").cast("long"), text)
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text, F.lit(1))).alias("id_key"), row.alias("row_key"), *columns)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column of an Arrow batch; NULL is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str) -> DataFrame:
    """``mapInArrow`` with a state per task: ``make()`` runs once in each task
    and returns the function that every batch goes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield from step(batch)

    return df.mapInArrow(run, schema)
