"""Queries for scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from txpipe.functions import columns as C
from txpipe.plans import oracle as O
from txpipe.plans.common import transactions
from txpipe.plans.registry import query
from txpipe.sources.fixture import ORIGIN, ORIGIN_DATE

PT = O.with_(O.TX)


@query(
    "p1_text_to_timestamp",
    PT + "SELECT TRANSACTION_ID, CAST(strftime(TX_DATETIME, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS TX_DATETIME FROM tx",
)
def p1(spark, sf):
    text = C.format_datetime("TX_DATETIME", "yyyy-MM-dd HH:mm:ss")
    return transactions(spark, sf).select("TRANSACTION_ID", C.to_timestamp_col(text).alias("TX_DATETIME"))


_P2_COLS = ["TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "TX_TIME_SECONDS", "TX_TIME_DAYS"]


# The tables hold no marker, so one row in seven gets it by a rule both sides share.
_MARKED = ["CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT"]


@query(
    "p2_replace_missing_marker",
    PT
    + "SELECT "
    + ", ".join(f"CASE WHEN {c} = -1 THEN 0 ELSE {c} END AS {c}" for c in _P2_COLS)
    + " FROM (SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN TRANSACTION_ID % 7 = {i} THEN -1 ELSE {c} END AS {c}" for i, c in enumerate(_MARKED))
    + ") FROM tx) marked",
)
def p2(spark, sf):
    tx = transactions(spark, sf).select(*_P2_COLS)
    rule = {c: F.when(F.col("TRANSACTION_ID") % 7 == i, F.lit(-1).cast(tx.schema[c].dataType)).otherwise(F.col(c)) for i, c in enumerate(_MARKED)}
    return C.replace_missing_marker(tx.withColumns(rule))


@query("p3_night_flag", PT + f"SELECT TRANSACTION_ID, {O.NIGHT} AS TX_DURING_NIGHT FROM tx")
def p3(spark, sf):
    return transactions(spark, sf).select("TRANSACTION_ID", C.night_flag().alias("TX_DURING_NIGHT"))


@query("p4_weekend_flag_aligned", PT + f"SELECT TRANSACTION_ID, {O.WEEKEND_ALIGNED} AS TX_DURING_WEEKEND FROM tx")
def p4a(spark, sf):
    return transactions(spark, sf).select("TRANSACTION_ID", C.weekend_flag(mode="aligned").alias("TX_DURING_WEEKEND"))


@query("p4_weekend_flag_calendar", PT + f"SELECT TRANSACTION_ID, {O.WEEKEND_CALENDAR} AS TX_DURING_WEEKEND FROM tx")
def p4c(spark, sf):
    return transactions(spark, sf).select("TRANSACTION_ID", C.weekend_flag(mode="calendar").alias("TX_DURING_WEEKEND"))


@query("p9_rows_since", PT + "SELECT TRANSACTION_ID FROM tx WHERE TX_DATETIME >= TIMESTAMP '2024-01-15 00:00:00'")
def p9(spark, sf):
    tx = transactions(spark, sf)
    return tx.where(F.col("TX_DATETIME") >= F.lit("2024-01-15 00:00:00").cast("timestamp")).select("TRANSACTION_ID")


@query(
    "p11_timestamp_from_offset",
    PT + "SELECT TRANSACTION_ID, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(TX_TIME_SECONDS) AS tx_second FROM tx",
)
def p11(spark, sf):
    return transactions(spark, sf).select("TRANSACTION_ID", C.timestamp_from_offset("TX_TIME_SECONDS", ORIGIN).alias("tx_second"))


@query(
    "p12_date_from_offset",
    PT + "SELECT DISTINCT TX_TIME_DAYS, CAST(DATE '2024-01-01' + CAST(TX_TIME_DAYS AS INTEGER) AS DATE) AS tx_date FROM tx",
)
def p12(spark, sf):
    return transactions(spark, sf).select("TX_TIME_DAYS", C.date_from_offset("TX_TIME_DAYS", ORIGIN_DATE).alias("tx_date")).distinct()


@query("p13_format_datetime", PT + "SELECT TRANSACTION_ID, strftime(TX_DATETIME, '%Y-%m-%d %H:%M:%S') AS tx_text FROM tx")
def p13(spark, sf):
    return transactions(spark, sf).select("TRANSACTION_ID", C.format_datetime("TX_DATETIME").alias("tx_text"))
