"""JSON messages: encode a table as a message stream, parse it back
(S8, S9, P6-P8, P14).

The source and sink formats are parameters: Kafka on a cluster, a folder of
text/JSON files here (the same job either way).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txpipe import schema as S

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def to_messages(df: DataFrame, since: str | None = None, index_col: str | None = "TRANSACTION_ID", slices: int | None = None) -> DataFrame:
    """Rows at or after ``since`` (P9), in time order (T2), as one
    JSON text column ``value``. Timestamps are written as text with
    microseconds (``to_json`` alone would cut them to milliseconds). With
    ``slices`` the time order is cut into that many partitions, whatever the
    number of rows; otherwise their number follows the size."""
    out = df
    if since is not None:
        out = out.where(F.col("TX_DATETIME") >= F.lit(since).cast("timestamp"))
    cols = []
    if index_col is not None and "index" not in out.columns:
        cols.append(F.col(index_col).alias("index"))
    for f in out.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(f.name, TS_TEXT).alias(f.name))
        else:
            cols.append(F.col(f.name))
    order = ["TX_DATETIME", "TRANSACTION_ID"]
    out = out.repartitionByRange(slices, *order).sortWithinPartitions(*order) if slices else out.orderBy(*order)
    return out.select(F.to_json(F.struct(*cols)).alias("value"))


def write_messages(messages: DataFrame, path: str, fmt: str = "text", options: dict | None = None, mode: str = "overwrite") -> None:
    """Write messages to a folder (``text``) or to Kafka (``fmt='kafka'``
    with ``kafka.bootstrap.servers`` and ``topic`` in ``options``), in the
    order they come in: the partitions of :func:`to_messages` are consecutive
    time slices, so file names sort in time order and no row moves after the
    sort. (The number of files is that of the sort's partitions.)"""
    w = messages.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w.save()
    else:
        w.mode(mode).save(path)


def message_source(spark: SparkSession, fmt: str = "text", path: str | None = None, options: dict | None = None, streaming: bool = True):
    """A stream (or batch) of message text in column ``value``.

    ``fmt='kafka'`` subscribes with the given options; ``text`` reads a
    folder of files. Kafka values are bytes, so they are cast to text (P6)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**(options or {}))
    df = reader.load(path) if path is not None else reader.load()
    return df.selectExpr("CAST(value AS STRING) AS value")


def checked_messages(messages: DataFrame, schema: T.StructType | None = None, required: tuple[str, ...] = ("TRANSACTION_ID", "TX_DATETIME")) -> DataFrame:
    """``raw``, ``m`` (the parsed struct, ``TX_DATETIME`` a timestamp) and
    ``ok``. A message is good if it parses, holds every required field, and no
    field that has a value in the text lost it to its type: a word where a
    number belongs, or a time that is none, makes it bad."""
    schema = schema or S.message_schema()
    parsed = messages.select(F.col("value").alias("raw"), F.from_json("value", schema).alias("m"), F.from_json("value", "map<string,string>").alias("said"))
    fields, ok = [], F.col("m").isNotNull() & F.col("said").isNotNull()
    for f in schema.fields:
        c = F.col(f"m.{f.name}")
        if f.name == "TX_DATETIME":
            c = c.try_cast("timestamp")
        ok = ok & (c.isNotNull() if f.name in required else (c.isNotNull() | F.col("said")[f.name].isNull()))
        fields.append(c.alias(f.name))
    return parsed.select("raw", F.struct(*fields).alias("m"), F.coalesce(ok, F.lit(False)).alias("ok"))


def good_messages(checked: DataFrame) -> DataFrame:
    """The good rows' fields as columns (``index`` dropped)."""
    return checked.where("ok").select(*[F.col(f"m.{f.name}") for f in checked.schema["m"].dataType.fields if f.name != "index"])


def bad_messages(checked: DataFrame) -> DataFrame:
    """Raw texts for the dead letter (Q9)."""
    return checked.where(~F.col("ok")).select("raw")


def parse_messages(messages: DataFrame, schema: T.StructType | None = None, required: tuple[str, ...] = ("TRANSACTION_ID", "TX_DATETIME")):
    """``(good, dead_letter)`` of :func:`checked_messages`."""
    checked = checked_messages(messages, schema, required)
    return good_messages(checked), bad_messages(checked)
