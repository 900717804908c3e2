import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from txpipe.operators.metrics import hard_metrics


def _rows(tp, fn, fp, tn):
    return [(1.0, 1.0)] * tp + [(1.0, 0.0)] * fn + [(0.0, 1.0)] * fp + [(0.0, 0.0)] * tn


@pytest.mark.parametrize("counts", [(3, 1, 2, 14), (0, 5, 0, 95), (5, 0, 0, 5), (2, 2, 2, 2), (0, 3, 4, 9)])
def test_closed_form_equals_evaluator(spark, counts):
    df = spark.createDataFrame(_rows(*counts), "label double, prediction double")
    m = hard_metrics(df, digits=None).collect()[0]
    for metric, col in (("areaUnderROC", "roc_auc"), ("areaUnderPR", "pr_auc")):
        ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="prediction", metricName=metric)
        assert m[col] == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_known_values(spark):
    df = spark.createDataFrame(_rows(3, 1, 2, 14), "label double, prediction double")
    m = hard_metrics(df).collect()[0]
    assert (m["roc_auc"], m["pr_auc"]) == (0.8125, 0.55)
    none = spark.createDataFrame(_rows(0, 4, 0, 16), "label double, prediction double")
    m = hard_metrics(none).collect()[0]
    assert (m["roc_auc"], m["pr_auc"]) == (0.5, 0.2)  # nothing predicted: 0.5 and the base rate


def test_fixture_values(spark):
    from txpipe.plans.registry import queries

    m = queries()["m11_m12_hard_auc"](spark, "/root/testdata/sf0.01").collect()[0]
    assert (m["roc_auc"], m["pr_auc"]) == (0.515739, 0.376765)
