"""Queries for fraud labelling (F1-F7) and its joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.operators import labels as L
from txpipe.plans import oracle as O
from txpipe.plans.common import labelled, transactions
from txpipe.plans.registry import query

P = O.with_(O.TX, O.PICKS)
PL = O.labelled_prefix()


@query("f1_scenario1_amount", O.with_(O.TX) + "SELECT TRANSACTION_ID, TX_AMOUNT FROM tx WHERE TX_AMOUNT > 220")
def f1(spark, sf):
    tx = transactions(spark, sf)
    return tx.where(F.col("TX_AMOUNT") > S.SCENARIO1_AMOUNT).select("TRANSACTION_ID", "TX_AMOUNT")


@query("f2_compromised_terminals", P + "SELECT start_day, entity_id FROM ct")
def f2_picks(spark, sf):
    return L.compromised_terminals(transactions(spark, sf))


@query("j2_terminal_window_semi", P + "SELECT TRANSACTION_ID FROM s2")
def j2(spark, sf):
    return L.terminal_hits(transactions(spark, sf))


@query("f4_compromised_customers", P + "SELECT start_day, entity_id FROM cc")
def f4(spark, sf):
    return L.compromised_customers(transactions(spark, sf))


@query("j3_customer_window_pairs", P + "SELECT TRANSACTION_ID, start_day FROM c3")
def j3(spark, sf):
    return L.customer_candidates(transactions(spark, sf))


@query(
    "j4_compromised_terminal_membership",
    P + "SELECT TRANSACTION_ID FROM tx WHERE TERMINAL_ID IN (SELECT entity_id FROM ct)",
)
def j4(spark, sf):
    tx = transactions(spark, sf)
    comp = L.compromised_terminals(tx).select(F.col("entity_id").alias("TERMINAL_ID")).distinct()
    return tx.join(comp, "TERMINAL_ID", "left_semi").select("TRANSACTION_ID")


@query("f5_sampled_candidates", P + "SELECT TRANSACTION_ID, start_day FROM c3pick")
def f5(spark, sf):
    from txpipe.operators.picks import smallest_share_per_group

    cand = L.customer_candidates(transactions(spark, sf))
    return smallest_share_per_group(cand, "start_day", "TRANSACTION_ID", S.SCENARIO3_SHARE_DIVISOR)


@query("f3_scenario3_times", P + "SELECT TRANSACTION_ID, times FROM p3")
def f3(spark, sf):
    return L.customer_picks(transactions(spark, sf))


@query("f6_fraud_label", PL + f"SELECT {O.LAB_COLS} FROM lab")
def f6(spark, sf):
    return labelled(spark, sf)


@query(
    "f7_new_fraud_counts",
    PL
    + """SELECT count(*) FILTER (WHERE hit1) AS new_scenario_1,
       count(*) FILTER (WHERE hit2 AND NOT hit1) AS new_scenario_2,
       count(*) FILTER (WHERE hit3 AND NOT (hit1 OR hit2)) AS new_scenario_3,
       CAST(sum(TX_FRAUD) AS BIGINT) AS total_fraud FROM lab""",
)
def f7(spark, sf):
    return L.new_fraud_counts(labelled(spark, sf, with_hits=True))
