"""Queries for aggregates, sorts, top-k, ids, samples (A*, T*, P19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.functions.columns import date_from_offset
from txpipe.operators import stats as ST
from txpipe.operators.features import build_features
from txpipe.operators.ids import dense_id, place_in_group
from txpipe.plans import oracle as O
from txpipe.plans.common import labelled, scored, transactions
from txpipe.plans.registry import query
from txpipe.sources.fixture import ORIGIN_DATE

PL = O.labelled_prefix()
PT = O.with_(O.TX)
DAILY_SQL = (
    PL
    + """SELECT TX_TIME_DAYS, count(CUSTOMER_ID) AS nb_tx_per_day,
       CAST(sum(TX_FRAUD) AS BIGINT) AS nb_fraudulent_transactions_per_day,
       count(DISTINCT CASE WHEN TX_FRAUD = 1 THEN CUSTOMER_ID END) AS nb_frauded_cards_per_day,
       CAST(DATE '2024-01-01' + CAST(TX_TIME_DAYS AS INTEGER) AS DATE) AS tx_date
FROM lab GROUP BY TX_TIME_DAYS"""
)


@query("a1_tx_per_day", PT + "SELECT TX_TIME_DAYS, count(CUSTOMER_ID) AS nb_tx_per_day FROM tx GROUP BY 1")
def a1(spark, sf):
    return ST.tx_per_day(transactions(spark, sf))


@query(
    "a2_frauds_per_day",
    PL + "SELECT TX_TIME_DAYS, CAST(sum(TX_FRAUD) AS BIGINT) AS nb_fraudulent_transactions_per_day FROM lab GROUP BY 1",
)
def a2(spark, sf):
    return ST.frauds_per_day(labelled(spark, sf))


@query(
    "a3_frauded_cards_per_day",
    PL + "SELECT TX_TIME_DAYS, count(DISTINCT CUSTOMER_ID) AS nb_frauded_cards_per_day FROM lab WHERE TX_FRAUD = 1 GROUP BY 1",
)
def a3(spark, sf):
    return ST.frauded_cards_per_day(labelled(spark, sf))


@query("a5_daily_stats", DAILY_SQL)
def a5(spark, sf):
    return ST.daily_stats(labelled(spark, sf), start_date=ORIGIN_DATE)


@query("j5_daily_series_aligned", DAILY_SQL)
def j5(spark, sf):
    """The three daily series, each computed by itself, joined on day."""
    lab = labelled(spark, sf)
    series = ST.tx_per_day(lab).join(ST.frauds_per_day(lab), "TX_TIME_DAYS", "full").join(ST.frauded_cards_per_day(lab), "TX_TIME_DAYS", "full")
    return series.select(
        "TX_TIME_DAYS", "nb_tx_per_day", "nb_fraudulent_transactions_per_day",
        F.coalesce("nb_frauded_cards_per_day", F.lit(0)).alias("nb_frauded_cards_per_day"), date_from_offset("TX_TIME_DAYS", ORIGIN_DATE).alias("tx_date"),
    )


@query(
    "p19_scaled_daily_count",
    PT + "SELECT TX_TIME_DAYS, count(CUSTOMER_ID) / 50.0 AS nb_tx_per_day_scaled FROM tx GROUP BY 1",
)
def p19(spark, sf):
    return ST.scaled_daily(ST.tx_per_day(transactions(spark, sf)), 50.0)


@query("a4_max_amount_per_customer", PL + "SELECT CUSTOMER_ID, max(TX_AMOUNT) AS max_amount FROM lab GROUP BY 1")
def a4(spark, sf):
    return ST.max_amount_per_customer(labelled(spark, sf))


@query(
    "t4_top20_customers_by_max_amount",
    PL + "SELECT CUSTOMER_ID, max(TX_AMOUNT) AS max_amount FROM lab GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def t4(spark, sf):
    return ST.top_customers_by_max_amount(labelled(spark, sf), 20)


HOURLY_SQL = (
    PL
    + """SELECT date_trunc('hour', TX_DATETIME) AS window_start,
       date_trunc('hour', TX_DATETIME) + INTERVAL 1 HOUR AS window_end,
       round(count(CUSTOMER_ID) / 30.0, 2) AS nx_transactions,
       count(*) FILTER (WHERE TX_FRAUD = 1) AS nx_fraud_transactions,
       count(*) FILTER (WHERE TX_FRAUD = 1 AND prediction = 1) AS correct_fraud_predictions,
       count(*) FILTER (WHERE TX_FRAUD = 0 AND prediction = 1) AS false_positive_predictions
FROM lab GROUP BY 1, 2"""
)


@query("a6_hourly_batch", HOURLY_SQL)
def a6(spark, sf):
    """A6/A7/P17/P18/R4 batch form on rule-scored transactions."""
    return ST.hourly_counts(scored(spark, sf))


@query("t5_hourly_ordered_by_window_start", HOURLY_SQL + " ORDER BY window_start")
def t5(spark, sf):
    return ST.hourly_counts(scored(spark, sf)).orderBy("window_start")


@query(
    "a7_conditional_counts_per_day",
    PL
    + """SELECT TX_TIME_DAYS,
       count(CASE WHEN TX_FRAUD = 1 AND prediction = 1 THEN 1 END) AS correct_fraud_predictions,
       count(CASE WHEN TX_FRAUD = 0 AND prediction = 1 THEN 1 END) AS false_positive_predictions
FROM lab GROUP BY 1""",
)
def a7(spark, sf):
    fraud, pred = F.col("TX_FRAUD"), F.col("prediction")
    return scored(spark, sf).groupBy("TX_TIME_DAYS").agg(
        F.count(F.when((fraud == 1) & (pred == 1), 1)).alias("correct_fraud_predictions"),
        F.count(F.when((fraud == 0) & (pred == 1), 1)).alias("false_positive_predictions"),
    )


@query("a8_total_fraud", PL + "SELECT CAST(sum(TX_FRAUD) AS BIGINT) AS total_fraud FROM lab")
def a8(spark, sf):
    return ST.total_fraud(labelled(spark, sf))


@query("a9_max_day", O.with_(O.TX) + "SELECT max(TX_TIME_DAYS) AS max_day FROM tx")
def a9(spark, sf):
    return ST.max_day(transactions(spark, sf))


CORR_COLS = [
    "TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "TX_TIME_SECONDS", "TX_TIME_DAYS",
    "TX_FRAUD", "TX_FRAUD_SCENARIO", *S.FLAGS, *S.ROLLING_NAMES,
]


def _corr_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i:]]
    aggs = ", ".join(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c{i}" for i, (a, b) in enumerate(pairs))
    items = ", ".join(f"{{'col_a': '{a}', 'col_b': '{b}', 'v': c{i}}}" for i, (a, b) in enumerate(pairs))
    return (
        O.with_(O.TX, O.PICKS, O.LAB, O.features_cte())
        + f"""SELECT s.col_a AS col_a, s.col_b AS col_b,
       CASE WHEN isnan(s.v) THEN NULL ELSE round(s.v, 6) END AS corr
FROM (SELECT unnest([{items}]) AS s FROM (SELECT {aggs} FROM feat) w) u"""
    )


@query("a10_correlation_matrix", _corr_sql())
def a10(spark, sf):
    return ST.correlation_long(build_features(labelled(spark, sf)), CORR_COLS, 6)


@query(
    "a11_amount_histogram",
    PL
    + """, b AS (SELECT (SELECT min(TX_AMOUNT) FROM lab) AS lo, (SELECT max(TX_AMOUNT) FROM lab) AS hi)
SELECT bucket, lo + (hi - lo) * bucket / 50.0 AS lower, lo + (hi - lo) * (bucket + 1) / 50.0 AS upper, count(*) AS n
FROM (SELECT CAST(CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((TX_AMOUNT - lo) / (hi - lo) * 50.0), 49) END AS INTEGER) AS bucket, lo, hi
      FROM lab, b WHERE TX_AMOUNT IS NOT NULL) z
GROUP BY bucket, lo, hi""",
)
def a11(spark, sf):
    return ST.amount_histogram(labelled(spark, sf), 50)


@query(
    "a12_amount_sample",
    PL + "SELECT TRANSACTION_ID, TX_AMOUNT FROM lab ORDER BY (TRANSACTION_ID * 7919) % 1000003, TRANSACTION_ID LIMIT 500",
)
def a12(spark, sf):
    """A sample is the feature here; smaller than any of the tables."""
    return ST.hash_sample(labelled(spark, sf), 500).select("TRANSACTION_ID", "TX_AMOUNT")


@query("t1_sort_by_id", PT + "SELECT TRANSACTION_ID, TX_DATETIME FROM tx ORDER BY TRANSACTION_ID")
def t1(spark, sf):
    return transactions(spark, sf).orderBy("TRANSACTION_ID").select("TRANSACTION_ID", "TX_DATETIME")


@query("t2_sort_by_time", PT + "SELECT TRANSACTION_ID, TX_DATETIME FROM tx ORDER BY TX_DATETIME, TRANSACTION_ID")
def t2(spark, sf):
    return transactions(spark, sf).orderBy("TX_DATETIME", "TRANSACTION_ID").select("TRANSACTION_ID", "TX_DATETIME")


@query(
    "t3_sort_within_day",
    PT + "SELECT TX_TIME_DAYS, row_number() OVER (PARTITION BY TX_TIME_DAYS ORDER BY TX_TIME_SECONDS) AS place, TX_TIME_SECONDS FROM tx",
)
def t3(spark, sf):
    """Rows sorted inside their day; ``place`` is where a row came out, so
    the order itself is compared. A busy day spans several tasks."""
    df = transactions(spark, sf).select("TX_TIME_DAYS", "TX_TIME_SECONDS", "TRANSACTION_ID")
    return place_in_group(df, ["TX_TIME_DAYS"], ["TX_TIME_SECONDS", "TRANSACTION_ID"]).select("TX_TIME_DAYS", "place", "TX_TIME_SECONDS")


@query(
    "t6_dense_id_in_time_order",
    PT + "SELECT TRANSACTION_ID, row_number() OVER (ORDER BY TX_DATETIME, TRANSACTION_ID) - 1 AS dense_id FROM tx",
)
def t6(spark, sf):
    df = transactions(spark, sf).select("TRANSACTION_ID", "TX_DATETIME")
    return dense_id(df, ["TX_DATETIME", "TRANSACTION_ID"]).select("TRANSACTION_ID", "dense_id")
