"""Fraud labelling (F1-F7) with the joins it needs.

Scenario 1: amount above a threshold. Scenario 2: transactions at a
terminal compromised on day d, for days [d, d+28). Scenario 3: a third of
the transactions of customers compromised on day d, days [d, d+14), with the
amount multiplied by 5 once per day that picks it. Later scenarios win.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.operators.picks import (
    ROW_MODULUS,
    day_hash,
    picks_per_day,
    share_cutoffs,
    smallest_share_per_group,
)
from txpipe.session import stored

DAY = "TX_TIME_DAYS"


def compromises(tx: DataFrame, **per_day: int) -> dict[str, DataFrame]:
    """for each id column its ``(start_day, entity_id)`` rows -- that many
    entities per start day, chosen among the distinct ones seen in the
    transactions. One scan and one stored table for all columns, at most days x
    picks per day rows."""
    picks = stored(picks_per_day(tx, per_day, DAY), "picks")
    return {c: picks.where(F.col("kind") == c).select("start_day", "entity_id") for c in per_day}


def compromised_terminals(tx: DataFrame) -> DataFrame:
    return compromises(tx, TERMINAL_ID=S.SCENARIO2_PER_DAY)["TERMINAL_ID"]


def compromised_customers(tx: DataFrame) -> DataFrame:
    return compromises(tx, CUSTOMER_ID=S.SCENARIO3_PER_DAY)["CUSTOMER_ID"]


def in_window(tx: DataFrame, comp: DataFrame, entity_col: str, days: int, how: str) -> DataFrame:
    """Transactions whose entity is compromised and whose day lies
    in ``[start_day, start_day + days)``. ``left_semi`` keeps each
    transaction once (membership); ``inner`` keeps one row per start day.
    The compromise side is a stored table: broadcast if its bytes allow."""
    cond = (
        (tx[entity_col] == comp["entity_id"])
        & (tx[DAY] >= comp["start_day"])
        & (tx[DAY] < comp["start_day"] + F.lit(days))
    )
    return tx.join(comp, cond, how)


def terminal_hits(tx: DataFrame, comp_terminals: DataFrame | None = None) -> DataFrame:
    """F2 rows: transactions hit by scenario 2 (ids only)."""
    comp = comp_terminals if comp_terminals is not None else compromised_terminals(tx)
    return in_window(tx.select("TRANSACTION_ID", "TERMINAL_ID", DAY), comp, "TERMINAL_ID", S.SCENARIO2_DAYS, "left_semi").select(
        "TRANSACTION_ID"
    )


def customer_candidates(tx: DataFrame, comp_customers: DataFrame | None = None) -> DataFrame:
    """J3 rows ``(TRANSACTION_ID, start_day)``: one per transaction and
    compromise day (multiplicity kept)."""
    comp = comp_customers if comp_customers is not None else compromised_customers(tx)
    return in_window(tx.select("TRANSACTION_ID", "CUSTOMER_ID", DAY), comp, "CUSTOMER_ID", S.SCENARIO3_DAYS, "inner").select(
        "TRANSACTION_ID", "start_day"
    )


def customer_picks(tx: DataFrame, comp_customers: DataFrame | None = None) -> DataFrame:
    """``(TRANSACTION_ID, times)`` -- how many start days picked the
    transaction for scenario 3 (a third of each day's candidates)."""
    cand = customer_candidates(tx, comp_customers)
    chosen = smallest_share_per_group(cand, "start_day", "TRANSACTION_ID", S.SCENARIO3_SHARE_DIVISOR)
    return chosen.groupBy("TRANSACTION_ID").agg(F.count("*").alias("times"))


def label_frauds(
    tx: DataFrame,
    comp_terminals: DataFrame | None = None,
    comp_customers: DataFrame | None = None,
    with_hits: bool = False,
) -> DataFrame:
    """Add ``TX_FRAUD`` and ``TX_FRAUD_SCENARIO`` (3 > 2 > 1 > 0)
    and apply the scenario-3 amount factor ``5 ** times``.

    Plan: the transactions are read once for the result and not shuffled while
    the side tables are small. Those -- compromised terminals and customers per
    start day, and each day's scenario-3 cutoff -- are grouped into one array
    per entity (bounded by days x picks per day) and stored, so the planner
    knows their bytes and broadcasts them or, beyond the threshold, shuffles;
    higher-order functions then test every compromise of the row's terminal
    and customer. Three small writes come before the caller's own action;
    nothing stays cached.
    """
    given = {"TERMINAL_ID": comp_terminals, "CUSTOMER_ID": comp_customers}
    per_day = {"TERMINAL_ID": S.SCENARIO2_PER_DAY, "CUSTOMER_ID": S.SCENARIO3_PER_DAY}
    missing = {c: n for c, n in per_day.items() if given[c] is None}
    if missing:
        given |= compromises(tx, **missing)
    comp_terminals, comp_customers = given["TERMINAL_ID"], given["CUSTOMER_ID"]
    cand = customer_candidates(tx, comp_customers)
    cut = share_cutoffs(cand, "start_day", "TRANSACTION_ID", S.SCENARIO3_SHARE_DIVISOR)
    cust_side = (
        comp_customers.join(cut, "start_day")
        .groupBy(F.col("entity_id").alias("_cust"))
        .agg(F.collect_list(F.struct("start_day", "h_cut", "id_cut")).alias("_c3"))
    )
    term_side = comp_terminals.groupBy(F.col("entity_id").alias("_term")).agg(F.collect_list("start_day").alias("_c2"))
    cust_side = stored(cust_side, "customer-side")

    day, tid = F.col(DAY), F.col("TRANSACTION_ID")
    out = tx.join(term_side, tx["TERMINAL_ID"] == term_side["_term"], "left").join(
        cust_side, tx["CUSTOMER_ID"] == cust_side["_cust"], "left"
    )
    hit2 = F.exists(
        F.coalesce(F.col("_c2"), F.array().cast("array<bigint>")),
        lambda d: (day >= d) & (day < d + F.lit(S.SCENARIO2_DAYS)),
    )

    def picked(e):
        h = day_hash(tid, e["start_day"], ROW_MODULUS)
        in_days = (day >= e["start_day"]) & (day < e["start_day"] + F.lit(S.SCENARIO3_DAYS))
        return in_days & ((h < e["h_cut"]) | ((h == e["h_cut"]) & (tid <= e["id_cut"])))

    c3_type = "array<struct<start_day:bigint,h_cut:bigint,id_cut:bigint>>"
    times = F.size(F.filter(F.coalesce(F.col("_c3"), F.array().cast(c3_type)), picked))
    s1 = F.coalesce(F.col("TX_AMOUNT") > F.lit(S.SCENARIO1_AMOUNT), F.lit(False))
    s2 = hit2
    s3 = times > 0
    scenario = F.when(s3, 3).when(s2, 2).when(s1, 1).otherwise(0).cast("bigint")
    amount = F.when(
        s3, F.round(F.col("TX_AMOUNT") * F.pow(F.lit(float(S.SCENARIO3_AMOUNT_FACTOR)), times), 2)
    ).otherwise(F.col("TX_AMOUNT"))
    cols = [F.col(c) if c != "TX_AMOUNT" else amount.alias("TX_AMOUNT") for c in tx.columns]
    hits = [s1.alias("hit1"), s2.alias("hit2"), s3.alias("hit3")] if with_hits else []
    return out.select(
        *cols,
        F.when(scenario > 0, 1).otherwise(0).cast("bigint").alias("TX_FRAUD"),
        scenario.alias("TX_FRAUD_SCENARIO"),
        *hits,
    )


def new_fraud_counts(labelled_with_hits: DataFrame) -> DataFrame:
    """rows newly made fraud by each scenario step, in one aggregate."""
    h1, h2, h3 = F.col("hit1"), F.col("hit2"), F.col("hit3")
    return labelled_with_hits.agg(
        F.count_if(h1).alias("new_scenario_1"),
        F.count_if(h2 & ~h1).alias("new_scenario_2"),
        F.count_if(h3 & ~(h1 | h2)).alias("new_scenario_3"),
        F.sum("TX_FRAUD").cast("bigint").alias("total_fraud"),
    )
