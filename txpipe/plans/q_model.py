"""Queries for the MLlib part."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.operators import model as M
from txpipe.operators.features import build_features
from txpipe.operators.metrics import hard_metrics
from txpipe.plans import oracle as O
from txpipe.plans.common import labelled
from txpipe.plans.registry import query
from txpipe.session import stored, work_path

# Train/test cut on the shared tables' January 2024: a 7-day gap between
# the two ranges, as in the reference's cut.
TRAIN = ("2024-01-01", "2024-01-16")
TEST = ("2024-01-24", "2024-01-30")


def split(spark, sf):
    lab = labelled(spark, sf)
    return build_features(lab, begin_date=TRAIN[0], end_date=TRAIN[1]), build_features(lab, begin_date=TEST[0], end_date=TEST[1])


def _range_feat(name: str, lo: str, hi: str) -> str:
    src = f"(SELECT * FROM lab WHERE CAST(TX_DATETIME AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}')"
    return O.features_cte(source=src, name=name)


W14_SQL = (
    O.with_(O.TX, O.PICKS, O.LAB, _range_feat("ftrain", *TRAIN), _range_feat("ftest", *TEST))
    + f"SELECT 'train' AS split, {', '.join(S.FEATURE_TABLE)} FROM ftrain "
    + f"UNION ALL SELECT 'test' AS split, {', '.join(S.FEATURE_TABLE)} FROM ftest"
)


@query("w14_train_test_split", W14_SQL)
def w14(spark, sf):
    """Two date ranges, features computed per range (cold start, Q4)."""
    train, test = split(spark, sf)
    return train.select(F.lit("train").alias("split"), "*").unionByName(test.select(F.lit("test").alias("split"), "*"))


@query(
    "m1_assembled_features",
    O.with_(O.TX, O.PICKS, O.LAB, O.features_cte())
    + "SELECT TRANSACTION_ID, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS f{i:02d}" for i, c in enumerate(S.FEATURES))
    + " FROM feat",
)
def m1(spark, sf):
    feats = build_features(labelled(spark, sf))
    arr = vector_to_array(F.col(M.FEATURES_COL))
    out = M.assembler().transform(feats).select("TRANSACTION_ID", arr.alias("v"))
    return out.select("TRANSACTION_ID", *[F.col("v")[i].alias(f"f{i:02d}") for i in range(len(S.FEATURES))])


@query(
    "m2_label_index",
    O.labelled_prefix()
    + """, top AS (SELECT CAST(TX_FRAUD AS VARCHAR) AS l FROM lab GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT TRANSACTION_ID, CASE WHEN CAST(TX_FRAUD AS VARCHAR) = (SELECT l FROM top) THEN CAST(0.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS indexedLabel
FROM lab""",
)
def m2(spark, sf):
    lab = labelled(spark, sf)
    return M.label_indexer(lab).transform(lab).select("TRANSACTION_ID", M.LABEL_COL)


@query(
    "m3_index_to_string",
    O.labelled_prefix() + "SELECT TRANSACTION_ID, CASE WHEN prediction = 0 THEN '0' ELSE '1' END AS predictedLabel FROM lab",
)
def m3(spark, sf):
    from txpipe.plans.common import scored

    df = scored(spark, sf)
    return M.label_converter(M.label_indexer(df)).transform(df).select("TRANSACTION_ID", "predictedLabel")


# The grids in the order MLlib enumerates them, and which params name a point.
_POINTS = {
    "random_forest": [f"numTrees={n}" for n in (5, 10, 15, 20)],
    "logistic_regression": [f"elasticNetParam={e}, maxIter={m}, regParam={r}" for r in (0.01, 0.1) for e in (0.3, 0.8, 1.0) for m in (5, 10)],
    "gbt": [f"maxIter={m}" for m in (5, 10)],
    "svm": [f"maxIter={m}, regParam={r}" for m in (5, 10) for r in (0.01, 0.1)],
}


def _cv_sql(kind: str) -> str:
    rows = ", ".join(f"('{kind}', '{metric}', '{p}', true, true)" for metric in ("areaUnderROC", "areaUnderPR") for p in _POINTS[kind])
    return f"SELECT * FROM (VALUES {rows}) t(model, metric, params, in_unit_range, best_is_highest)"


def _train(spark, sf):
    """Training rows prepared, and the label indexer (fitted on the labels
    alone, before any window)."""
    lab = labelled(spark, sf)
    idx = M.label_indexer(lab.where(F.to_date("TX_DATETIME").between(*TRAIN)).select("TX_FRAUD"))
    return M.prepare(build_features(lab, begin_date=TRAIN[0], end_date=TRAIN[1]), idx), idx


def _test(spark, sf):
    return build_features(labelled(spark, sf), begin_date=TEST[0], end_date=TEST[1])


def _cv_table(spark, sf, kind: str):
    """One row per grid point and metric: its metric lies in [0, 1], and the
    refitted best model has the params of the highest one."""
    prepared, idx = _train(spark, sf)
    out = None
    for metric, tuned in M.tune_both(kind, prepared, idx).items():
        best = max(range(len(tuned.avgMetrics)), key=lambda i: tuned.avgMetrics[i])
        fitted = tuned.bestModel.stages[2]
        same = all(fitted.getOrDefault(p.name) == v for p, v in tuned.getEstimatorParamMaps()[best].items())
        part = M.avg_metrics(spark, kind, tuned).select("model", "metric", "params", F.col("avg_metric").between(0, 1).alias("in_unit_range"), F.lit(same).alias("best_is_highest"))
        out = part if out is None else out.unionByName(part)
    return out


@query("m5_random_forest_cv", _cv_sql("random_forest"))
def m5(spark, sf):
    """RF tuned for ROC and PR; a row per grid point."""
    return _cv_table(spark, sf, "random_forest")


@query("m6_logistic_regression_cv", _cv_sql("logistic_regression"))
def m6(spark, sf):
    return _cv_table(spark, sf, "logistic_regression")


@query("m7_gbt_cv", _cv_sql("gbt"))
def m7(spark, sf):
    return _cv_table(spark, sf, "gbt")


@query("m8_linear_svm_cv", _cv_sql("svm"))
def m8(spark, sf):
    return _cv_table(spark, sf, "svm")


_TEST_ROWS = O.labelled_prefix() + f"""SELECT {{cols}} FROM lab WHERE CAST(TX_DATETIME AS DATE) BETWEEN DATE '{TEST[0]}' AND DATE '{TEST[1]}'"""


@query("m4_m13_pipeline_batch_scoring", _TEST_ROWS.format(cols="TRANSACTION_ID, TX_FRAUD, true AS prediction_is_a_label, true AS label_text_follows, true AS probability_follows"))
def m13(spark, sf):
    """The tuned 4-stage pipeline scores the test range."""
    prepared, idx = _train(spark, sf)
    scored = M.score(M.tune("random_forest", prepared, idx), _test(spark, sf))
    p = vector_to_array(F.col("probability"))[1]
    return scored.select(
        "TRANSACTION_ID", "TX_FRAUD", F.col("prediction").isin(0.0, 1.0).alias("prediction_is_a_label"),
        (F.col("predictedLabel") == F.element_at(F.array(*map(F.lit, idx.labels)), F.col("prediction").cast("int") + 1)).alias("label_text_follows"),
        (p.between(0, 1) & ((p > 0.5) == (F.col("prediction") == 1))).alias("probability_follows"),
    )


_SHORT = {"random_forest": "RF", "logistic_regression": "LR", "gbt": "GBT", "svm": "SVM"}
_SCORES_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{m}', '{x}', true, true)" for m in _SHORT.values() for x in ("ROC_AUC", "AUC_PR")) + ") t(model, metric, in_unit_range, equals_closed_form)"


@query("m14_m15_model_scores", _SCORES_SQL)
def m14(spark, sf):
    """Each classifier's tuned model evaluated on the test range with
    its own evaluator; the score equals the closed form of the stored
    predictions' confusion counts."""
    prepared, idx = _train(spark, sf)
    test = stored(_test(spark, sf), "m14-test")
    rows = []
    for kind, short in _SHORT.items():
        for metric, tuned in M.tune_both(kind, prepared, idx).items():
            rows.append((short, *_evaluated(tuned, M.score(tuned, test), metric)))
    return spark.createDataFrame(rows, "model string, metric string, in_unit_range boolean, equals_closed_form boolean")


def _evaluated(tuned, scored, metric: str) -> tuple[str, bool, bool]:
    label, column = {"areaUnderROC": ("ROC_AUC", "roc_auc"), "areaUnderPR": ("AUC_PR", "pr_auc")}[metric]
    value, closed = M.evaluate(tuned, scored), hard_metrics(scored, M.LABEL_COL, "prediction", digits=None).first()[column]
    return label, 0 <= value <= 1, abs(value - closed) < 1e-9


@query("m16_saved_model_evaluates", "SELECT * FROM (VALUES ('ROC_AUC', true, true, true, true)) t(metric, in_unit_range, equals_closed_form, same_scores, same_grid)")
def m16(spark, sf):
    """A tuned model saved, loaded, scored and evaluated with the
    evaluator and grid metrics it was saved with."""
    prepared, idx = _train(spark, sf)
    tuned, path = M.tune("gbt", prepared, idx, folds=2), work_path(spark, "cv-model")
    M.save(tuned, path)
    again, test = M.load(path), stored(_test(spark, sf), "m16-test")
    a, b = M.score(tuned, test).select("TRANSACTION_ID", "prediction"), M.score(again, test)
    same = a.exceptAll(b.select("TRANSACTION_ID", "prediction")).isEmpty()
    grids = M.avg_metrics(spark, "gbt", tuned).collect() == M.avg_metrics(spark, "gbt", again).collect()
    return spark.createDataFrame([(*_evaluated(again, b, "areaUnderROC"), same, grids)], "metric string, in_unit_range boolean, equals_closed_form boolean, same_scores boolean, same_grid boolean")
