"""Daily transaction files and feature tables.

Daily data is one Parquet table partitioned by ``tx_date``: a date-range
read is partition pruning (``PartitionFilters`` in the plan). Folders of flat
``YYYY-MM-DD.parquet`` files are read as well; their days come from the file
names, and files outside a range are not opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.functions.columns import date_from_offset, replace_missing_marker, to_timestamp_col

PART = "tx_date"


def save_daily(
    df: DataFrame,
    path: str,
    start_date: str,
    partitions: int | None = None,
    datetime_as_text: bool = False,
    max_records_per_file: int = 5_000_000,
) -> None:
    """S3: one folder per day (``tx_date = start_date + TX_TIME_DAYS``), rows
    sorted by second of the day inside each file.

    Range partitioning on (date, seconds) splits a large day over several
    tasks and files instead of sending a whole day to one task.
    ``datetime_as_text`` stores ``TX_DATETIME`` as text as the reference's
    files do (microseconds kept)."""
    spark = df.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    out = df.withColumn(PART, date_from_offset("TX_TIME_DAYS", start_date))
    if datetime_as_text:
        out = out.withColumn("TX_DATETIME", F.date_format("TX_DATETIME", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    (
        out.repartitionByRange(n, PART, "TX_TIME_SECONDS")
        .sortWithinPartitions(PART, "TX_TIME_SECONDS")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(PART)
        .parquet(path)
    )


def load_dataset(
    spark: SparkSession,
    path: str,
    begin_date: str | None = None,
    end_date: str | None = None,
    replace_columns: list[str] | None = None,
    keep_partition_column: bool = False,
) -> DataFrame:
    """Days ``begin_date .. end_date`` (inclusive) of a daily table, or of
    a folder of flat ``YYYY-MM-DD.parquet`` files (a table without the
    partition column); ``TX_DATETIME`` cast to timestamp (P1) and ``-1``
    replaced by 0 (P2). An empty range gives an empty DataFrame (Q12). No sort:
    the next operator re-partitions anyway."""
    df = spark.read.parquet(path)
    if PART in df.columns:
        if begin_date is not None:
            df = df.where(F.col(PART) >= F.lit(begin_date).cast("date"))
        if end_date is not None:
            df = df.where(F.col(PART) <= F.lit(end_date).cast("date"))
    else:
        name = F.col("_metadata.file_name")
        keep_partition_column = True
        if begin_date is not None:
            df = df.where(name >= F.lit(f"{begin_date}.parquet"))
        if end_date is not None:
            df = df.where(name <= F.lit(f"{end_date}.parquet"))
    df = df.withColumn("TX_DATETIME", to_timestamp_col("TX_DATETIME"))
    if not keep_partition_column:
        df = df.drop(PART)
    return replace_missing_marker(df, replace_columns)


def read_file(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """One Parquet file or folder, optionally with a fixed schema."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def union_files(spark: SparkSession, paths: list[str], by_name: bool = True) -> DataFrame:
    """Many files (or patterns) as one DataFrame, in one read over all
    paths; ``by_name`` matches columns by name over differing schemas (missing
    ones NULL), otherwise the first file's schema holds for all."""
    if not paths:
        raise ValueError("no paths")
    return spark.read.option("mergeSchema", str(by_name).lower()).parquet(*paths)


def write_features(df: DataFrame, path: str, bloom_columns: tuple[str, ...] = ("CUSTOMER_ID", "TERMINAL_ID"), ndv: int = 1_000_000) -> None:
    """Overwrite a Parquet feature table with dictionary encoding,
    no page checksums and Bloom filters on the id columns (row-group
    skipping for point lookups by customer or terminal). Where a column chunk is
    dictionary-encoded throughout, Parquet leaves its filter out and readers skip
    by the dictionary."""
    w = (
        df.write.mode("overwrite")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.page.write-checksum.enabled", "false")
    )
    for c in bloom_columns:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(ndv))
    w.parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table, read distributed."""
    return spark.read.parquet(path)
