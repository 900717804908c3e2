"""Hard-label metrics (M11, M12, M15) as one aggregate each.

With a 0/1 prediction used as the score, the ROC curve has one inner point,
so its area is (TPR + TNR) / 2; the PR curve is (0, P) -> (R, P) -> (1, pi),
area R*P + (1 - R)(P + pi) / 2, and pi when nothing is predicted positive.
These equal MLlib's BinaryClassificationEvaluator on such predictions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """TP, FN, FP, TN (bigint), optionally per group (e.g. per model)."""
    y = F.col(label) == 1
    p = F.col(prediction) == 1
    aggs = [
        F.count_if(y & p).alias("tp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def roc_auc_hard(tp: Column, fn: Column, fp: Column, tn: Column) -> Column:
    tpr = F.coalesce(_div(tp, tp + fn), F.lit(0.0))
    tnr = F.coalesce(_div(tn, tn + fp), F.lit(0.0))
    return (tpr + tnr) / F.lit(2.0)


def pr_auc_hard(tp: Column, fn: Column, fp: Column, tn: Column) -> Column:
    pi = _div(tp + fn, tp + fn + fp + tn)
    recall = F.coalesce(_div(tp, tp + fn), F.lit(0.0))
    precision = _div(tp, tp + fp)
    area = recall * precision + (F.lit(1.0) - recall) * (precision + pi) / F.lit(2.0)
    return F.when(tp + fp == 0, pi).otherwise(area)


def hard_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Confusion counts plus ``roc_auc`` and ``pr_auc`` (rounded to ``digits``)."""
    return with_areas(confusion(df, label, prediction, by), digits)


def with_areas(c: DataFrame, digits: int | None = 6) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` beside confusion counts."""
    tp, fn, fp, tn = (F.col(x) for x in ("tp", "fn", "fp", "tn"))
    roc, pr = roc_auc_hard(tp, fn, fp, tn), pr_auc_hard(tp, fn, fp, tn)
    if digits is not None:
        roc, pr = F.round(roc, digits), F.round(pr, digits)
    return c.select("*", roc.alias("roc_auc"), pr.alias("pr_auc"))


def score_table(metrics: DataFrame, model_col: str = "model") -> DataFrame:
    """Long ``(model, metric, score)`` from per-model metrics."""
    return metrics.select(
        model_col,
        F.explode(
            F.array(
                F.struct(F.lit("ROC_AUC").alias("metric"), F.col("roc_auc").alias("score")),
                F.struct(F.lit("AUC_PR").alias("metric"), F.col("pr_auc").alias("score")),
            )
        ).alias("m"),
    ).select(model_col, "m.metric", "m.score")


def rule_prediction(amount: str = "TX_AMOUNT", threshold: float = 100.0) -> Column:
    """A fixed scorer for oracle-checkable metrics: 1.0 above ``threshold``."""
    return F.when(F.col(amount) > F.lit(threshold), 1.0).otherwise(0.0)
