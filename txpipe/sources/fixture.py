"""Map the shared input tables onto the transaction data model.

``events`` plays the transactions, ``customer`` and ``supplier`` give the
customer and terminal profiles (coordinates derived by integer arithmetic,
as the tables carry none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.functions.columns import days_since, seconds_since, to_timestamp_col
from txpipe.session import pin_utc

# --- Fixed values of the table mapping (shared with the DuckDB oracle). ---
ORIGIN = "2024-01-01 00:00:00"
ORIGIN_DATE = "2024-01-01"
COORD_MODULUS = 10007
COORD_SCALE = 100.07
CUSTOMER_X_MULT = 7919
CUSTOMER_Y_MULT = 104729
TERMINAL_X_MULT = 15485863
TERMINAL_Y_MULT = 32452843
# --- end of fixed values ---


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Raw transactions (7 base columns) from the ``events`` table."""
    ts = to_timestamp_col("ts")
    return events.select(
        F.col("event_id").alias("TRANSACTION_ID"),
        ts.alias("TX_DATETIME"),
        F.col("user_id").alias("CUSTOMER_ID"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("TERMINAL_ID"),
        F.col("value").alias("TX_AMOUNT"),
        seconds_since(ts, ORIGIN).alias("TX_TIME_SECONDS"),
        days_since(ts, ORIGIN_DATE).alias("TX_TIME_DAYS"),
    )


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return transactions_from_events(table(spark, sf_dir, "events"))


def _coord(key: str, mult: int):
    return ((F.col(key) * F.lit(mult)) % F.lit(COORD_MODULUS)).cast("double") / F.lit(COORD_SCALE)


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``CUSTOMER_ID, x_customer_id, y_customer_id`` from ``customer``."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CUSTOMER_ID"),
        _coord("c_custkey", CUSTOMER_X_MULT).alias("x_customer_id"),
        _coord("c_custkey", CUSTOMER_Y_MULT).alias("y_customer_id"),
    )


def terminal_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``TERMINAL_ID, x_terminal_id, y_terminal_id`` from ``supplier``."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("TERMINAL_ID"),
        _coord("s_suppkey", TERMINAL_X_MULT).alias("x_terminal_id"),
        _coord("s_suppkey", TERMINAL_Y_MULT).alias("y_terminal_id"),
    )
