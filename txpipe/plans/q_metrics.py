"""Queries for hard-label metrics and score tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from txpipe.functions.columns import wrong_prediction
from txpipe.operators.metrics import hard_metrics, rule_prediction, score_table
from txpipe.operators.labels import label_frauds
from txpipe.plans import oracle as O
from txpipe.plans.common import scored
from txpipe.plans.registry import query
from txpipe.sources.fixture import load_transactions

PL = O.labelled_prefix()


def _closed_form(conf: str) -> str:
    return f"""SELECT tp, fn, fp, tn,
       round((COALESCE(tp / NULLIF(tp + fn, 0), 0.0) + COALESCE(tn / NULLIF(tn + fp, 0), 0.0)) / 2.0, 6) AS roc_auc,
       round(CASE WHEN tp + fp = 0 THEN (tp + fn) / (tp + fn + fp + tn)
             ELSE COALESCE(tp / NULLIF(tp + fn, 0), 0.0) * (tp / (tp + fp))
                  + (1.0 - COALESCE(tp / NULLIF(tp + fn, 0), 0.0)) * ((tp / (tp + fp)) + (tp + fn) / (tp + fn + fp + tn)) / 2.0
             END, 6) AS pr_auc
FROM {conf}"""


CONF = """(SELECT count(*) FILTER (WHERE TX_FRAUD = 1 AND prediction = 1) AS tp,
        count(*) FILTER (WHERE TX_FRAUD = 1 AND prediction <> 1) AS fn,
        count(*) FILTER (WHERE TX_FRAUD <> 1 AND prediction = 1) AS fp,
        count(*) FILTER (WHERE TX_FRAUD <> 1 AND prediction <> 1) AS tn FROM lab) c"""


@query("m11_m12_hard_auc", PL + _closed_form(CONF))
def m11_m12(spark, sf):
    return hard_metrics(scored(spark, sf), "TX_FRAUD", "prediction")


@query("m11_auc_roc_hard", PL + f"SELECT roc_auc FROM ({_closed_form(CONF)}) m")
def m11(spark, sf):
    return hard_metrics(scored(spark, sf), "TX_FRAUD", "prediction").select("roc_auc")


@query("m12_auc_pr_hard", PL + f"SELECT pr_auc FROM ({_closed_form(CONF)}) m")
def m12(spark, sf):
    return hard_metrics(scored(spark, sf), "TX_FRAUD", "prediction").select("pr_auc")


RULES = (("AMOUNT_GT_100", 100.0), ("AMOUNT_GT_220", 220.0), ("AMOUNT_GT_50", 50.0))


def _score_sql() -> str:
    preds = " UNION ALL ".join(
        f"SELECT '{m}' AS model, TX_FRAUD, CASE WHEN raw_amount > {t} THEN 1.0 ELSE 0.0 END AS prediction FROM lab2"
        for m, t in RULES
    )
    conf = f"""(SELECT model, count(*) FILTER (WHERE TX_FRAUD = 1 AND prediction = 1) AS tp,
        count(*) FILTER (WHERE TX_FRAUD = 1 AND prediction <> 1) AS fn,
        count(*) FILTER (WHERE TX_FRAUD <> 1 AND prediction = 1) AS fp,
        count(*) FILTER (WHERE TX_FRAUD <> 1 AND prediction <> 1) AS tn FROM ({preds}) u GROUP BY model) c"""
    inner = _closed_form(conf).replace("SELECT tp, fn, fp, tn,", "SELECT model,")
    return (
        PL
        + f""", lab2 AS (SELECT l.TX_FRAUD, t.TX_AMOUNT AS raw_amount FROM lab l JOIN tx t ON l.TRANSACTION_ID = t.TRANSACTION_ID)
SELECT model, 'ROC_AUC' AS metric, roc_auc AS score FROM ({inner}) m
UNION ALL SELECT model, 'AUC_PR' AS metric, pr_auc AS score FROM ({inner}) m"""
    )


@query("m15_score_table_rules", _score_sql())
def m15(spark, sf):
    """Model x metric table; confusion counts of all models in one
    ``groupBy(model)`` over the stacked predictions."""
    lab = label_frauds(load_transactions(spark, sf).withColumn("raw_amount", F.col("TX_AMOUNT")))
    each = F.array(*[F.struct(F.lit(name).alias("model"), rule_prediction("raw_amount", t).alias("prediction")) for name, t in RULES])
    preds = lab.select("TX_FRAUD", F.explode(each).alias("p")).select("TX_FRAUD", "p.*")  # one pass over the labelled rows
    return score_table(hard_metrics(preds, "TX_FRAUD", "prediction", by=["model"]))


@query(
    "p10_wrong_predictions",
    PL + "SELECT TRANSACTION_ID, TX_FRAUD, prediction FROM lab WHERE TX_FRAUD <> CAST(prediction AS INTEGER)",
)
def p10(spark, sf):
    return scored(spark, sf).where(wrong_prediction()).select("TRANSACTION_ID", "TX_FRAUD", "prediction")
