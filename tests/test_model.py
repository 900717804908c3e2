import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.operators import model as M
from txpipe.operators.features import build_features
from txpipe.session import work_path


@pytest.fixture(scope="module")
def feats(spark):
    from txpipe.operators.labels import label_frauds
    from txpipe.sources.fixture import load_transactions

    return build_features(label_frauds(load_transactions(spark, "/root/testdata/sf0.001"))).cache()


def test_schema_and_feature_list(feats):
    feats.printSchema()  # P20
    assert feats.columns == S.FEATURE_TABLE
    assert len(S.FEATURES) == 15 and all(c in feats.columns for c in S.FEATURES)
    types = dict(feats.dtypes)
    assert types["TX_DURING_NIGHT"] == "int" and types["CUSTOMER_ID_NB_TX_7DAY_WINDOW"] == "bigint"
    assert types["CUSTOMER_ID_MAX_AMOUNT_30DAY_WINDOW"] == "double"


def test_grid_sizes():
    sizes = {k: len(M.param_grid(k, M.classifier(k))) for k in ("random_forest", "logistic_regression", "gbt", "svm")}
    assert sizes == {"random_forest": 4, "logistic_regression": 12, "gbt": 2, "svm": 4}


def test_save_load_same_predictions(spark, feats):
    idx = M.label_indexer(feats)
    model = Pipeline(stages=M.pipeline("random_forest", idx).getStages()).fit(feats)
    base = work_path(spark, "t-model")
    path = M.save_versioned(model, base, "1")
    again = M.load(path)
    a = model.transform(feats).select("TRANSACTION_ID", "prediction", "predictedLabel")
    b = again.transform(feats).select("TRANSACTION_ID", "prediction", "predictedLabel")
    assert a.exceptAll(b).count() == 0 and a.count() == feats.count()


def test_cv_picks_best_saves_loads_and_evaluates(spark, feats):
    from txpipe.operators.metrics import hard_metrics

    idx = M.label_indexer(feats)
    prep = M.prepare(feats, idx)
    for t in (M.tune("gbt", prep, idx, folds=2, parallelism=2), M.tune_both("svm", prep, idx, folds=2)["areaUnderROC"]):
        best = max(range(len(t.avgMetrics)), key=lambda i: t.avgMetrics[i])
        for p, v in t.getEstimatorParamMaps()[best].items():
            assert t.bestModel.stages[2].getOrDefault(p.name) == v
        path = work_path(spark, "t-cv")
        M.save(t, path)
        again = M.load(path)
        assert again.avgMetrics == pytest.approx(t.avgMetrics) and len(again.getEstimatorParamMaps()) == len(t.avgMetrics)
        scored = M.score(again, feats)
        assert {"indexedFeatures", "rawPrediction", "prediction", "predictedLabel"} <= set(scored.columns)
        closed = hard_metrics(scored, M.LABEL_COL, "prediction", digits=None).first()["roc_auc"]
        assert M.evaluate(again, scored) == pytest.approx(closed, abs=1e-12) == M.evaluate(t, M.score(t, feats))
        assert M.avg_metrics(spark, "x", again).count() == len(t.avgMetrics)


def test_label_indexer_frequency_desc(feats):
    idx = M.label_indexer(feats)
    top = feats.groupBy("TX_FRAUD").count().orderBy(F.desc("count")).first()[0]
    assert idx.labels[0] == str(top)


def test_tune_both_matches_cross_validator(spark, feats):
    from pyspark.ml.tuning import CrossValidator

    idx = M.label_indexer(feats)
    prep = M.prepare(feats, idx)
    prep = prep.withColumn("fold", (F.monotonically_increasing_id() % 2).cast("int")).cache()
    both = M.tune_both("random_forest", prep, idx, folds=2, fold_col="fold")
    for metric in ("areaUnderROC", "areaUnderPR"):
        est = M.classifier("random_forest")
        cv = CrossValidator(estimator=est, estimatorParamMaps=M.param_grid("random_forest", est), evaluator=M.evaluator(metric),
                            numFolds=2, foldCol="fold", parallelism=4).fit(prep)
        assert both[metric].avgMetrics == pytest.approx(cv.avgMetrics, abs=1e-9)


def test_boosted_rounds_come_from_one_fit_a_fold(spark, feats, monkeypatch):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.tuning import CrossValidator

    idx = M.label_indexer(feats)
    prep = M.prepare(feats, idx)
    est, fits = M.classifier("gbt"), []
    expected = {m: CrossValidator(estimator=est, estimatorParamMaps=M.param_grid("gbt", est), evaluator=M.evaluator(m), numFolds=2, seed=M.SEED).fit(prep).avgMetrics for m in ("areaUnderROC",)}
    plain = GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: fits.append(self.getMaxIter()) or plain(self, df))
    both = M.tune_both("gbt", prep, idx, folds=2)
    refits = len({max(range(2), key=lambda i: t.avgMetrics[i]) for t in both.values()})
    assert fits[:2] == [10, 10] and len(fits) == 2 + refits
    for metric, avg in expected.items():
        assert both[metric].avgMetrics == pytest.approx(avg, abs=1e-9)


def test_tune_equals_cross_validator_on_random_folds(spark, feats):
    from pyspark.ml.tuning import CrossValidator

    idx = M.label_indexer(feats)
    prep = M.prepare(feats, idx)
    est = M.classifier("svm")
    cv = CrossValidator(estimator=est, estimatorParamMaps=M.param_grid("svm", est), evaluator=M.evaluator("areaUnderPR"), numFolds=2, seed=M.SEED).fit(prep)
    assert M.tune("svm", prep, idx, "areaUnderPR", folds=2).avgMetrics == pytest.approx(cv.avgMetrics, abs=1e-9)


def _linear_rows(spark, n=600, seed=5):
    """Own rows: a constant feature, a large one, two that tell the labels apart; three folds."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), np.full(n, 0.1), 1e4 + 50 * rng.normal(size=n), rng.integers(0, 2, n)], axis=1)
    y = (x[:, 0] + x[:, 3] + 0.7 * rng.normal(size=n) > 1).astype(float)
    rows = [(Vectors.dense(v), float(label), i % 3) for i, (v, label) in enumerate(zip(x.tolist(), y, strict=True))]
    return spark.createDataFrame(rows, [M.FEATURES_COL, M.LABEL_COL, "fold"])


@pytest.mark.parametrize("kind", ["logistic_regression", "svm"])
def test_linear_models_of_all_folds_share_passes(spark, kind, monkeypatch):
    from pyspark.ml.tuning import CrossValidator

    from txpipe.operators import linear

    df = _linear_rows(spark).repartition(3).cache()
    idx = M.label_indexer(df.withColumnRenamed(M.LABEL_COL, "TX_FRAUD"))
    est = M.classifier(kind)
    grid = M.param_grid(kind, est)
    expected = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=M.evaluator("areaUnderPR"), numFolds=3, foldCol="fold", parallelism=4).fit(df).avgMetrics
    # The same coefficients as MLlib's, not only the same predictions.
    kept = {}
    plain = linear.solutions
    monkeypatch.setattr(linear, "solutions", lambda kind, blocked, settings, scales: kept.setdefault("out", (settings, scales, plain(kind, blocked, settings, scales)))[2])
    fits, fit = [], type(est)._fit
    monkeypatch.setattr(type(est), "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    both = M.tune_both(kind, df, idx, folds=3, fold_col="fold")
    assert both["areaUnderPR"].avgMetrics == pytest.approx(expected, abs=1e-9)
    assert len(fits) <= 2  # the best point of each metric on all rows
    settings, scales, out = kept["out"]
    for i in (0, len(grid) - 1):
        p = est.copy(grid[i])
        share = p.getElasticNetParam() if kind == "logistic_regression" else 0.0
        k = next(k for k, s in enumerate(settings) if s[:3] == (1, share * p.getRegParam(), (1.0 - share) * p.getRegParam()))
        w, b = scales[1].plain(out[k][min(p.getMaxIter(), len(out[k]) - 1)])
        model = fit(p, df.where("fold <> 1"))
        assert [*w, b] == pytest.approx([*model.coefficients, model.intercept], rel=1e-7, abs=1e-9)


def test_linear_models_that_are_not_plain_go_to_mllib(spark):
    from txpipe.operators import linear

    est = M.classifier("logistic_regression")
    grid = M.param_grid("logistic_regression", est)
    found = lambda df, folds=3: linear.fold_counts("logistic_regression", est, grid, df, "fold", folds, M.FEATURES_COL, M.LABEL_COL)
    df = _linear_rows(spark)
    one_label = df.where(f"{M.LABEL_COL} = 0 OR fold = 2")
    assert {f for f, _ in found(one_label)} == {0, 1}  # without fold 2 there is one label
    assert {f for f, _ in found(df, 4)} == {0, 1, 2}  # fold 3 has no rows
    assert found(df.withColumn(M.LABEL_COL, F.col(M.LABEL_COL) * 2)) == {}
    assert found(df.withColumn(M.LABEL_COL, F.when(F.rand(1) > 0.01, F.col(M.LABEL_COL)))) == {}
    assert found(df.limit(0)) == {}
    counts = found(df.withColumn("fold", F.when(F.col("fold") < 2, F.col("fold"))), 2)
    assert sum(counts[0, 0]) == df.where("fold = 0").count() and len(counts) == 2 * len(grid)
