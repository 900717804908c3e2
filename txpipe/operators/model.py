"""MLlib classifiers, tuning and scoring.

The reference fits a 4-stage pipeline (assembler, label indexer, classifier,
label converter) inside 5-fold cross-validation. Assembler and fitted label
indexer do not depend on the folds, so here they run once, the assembled
rows are written to the shared folder, and cross-validation tunes the
classifier alone (``parallelism`` grid points at a time). The best classifier
is then put back between the same stages inside a ``CrossValidatorModel``,
which saves, loads, scores raw feature rows and evaluates like the reference's.
"""

from __future__ import annotations

from itertools import chain

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.operators import linear
from txpipe.session import stored

LABEL = "TX_FRAUD"
FEATURES_COL = "indexedFeatures"
LABEL_COL = "indexedLabel"
SEED = 42


def assembler(features: list[str] | None = None) -> VectorAssembler:
    """M1: the 15 features to one vector (invalid values raise, as in the
    reference; the stream drops bad rows before scoring)."""
    return VectorAssembler(inputCols=list(features or S.FEATURES), outputCol=FEATURES_COL)


def label_indexer(train: DataFrame, label: str = LABEL) -> StringIndexerModel:
    """M2: fitted on all training rows; frequencyDesc puts the common label at 0.0."""
    return StringIndexer(inputCol=label, outputCol=LABEL_COL).fit(train)


def label_converter(indexer: StringIndexerModel) -> IndexToString:
    """M3: prediction index back to the label text."""
    return IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=indexer.labels)


def classifier(kind: str):
    """M5-M8 with the reference's defaults (seeded where it has a seed)."""
    if kind == "random_forest":
        return RandomForestClassifier(labelCol=LABEL_COL, featuresCol=FEATURES_COL, seed=SEED)
    if kind == "logistic_regression":
        return LogisticRegression(labelCol=LABEL_COL, featuresCol=FEATURES_COL)
    if kind == "gbt":
        return GBTClassifier(labelCol=LABEL_COL, featuresCol=FEATURES_COL, seed=SEED)
    if kind == "svm":
        return LinearSVC(labelCol=LABEL_COL, featuresCol=FEATURES_COL)
    raise ValueError(kind)


def param_grid(kind: str, est) -> list:
    """M9: the reference's grids."""
    b = ParamGridBuilder()
    if kind == "random_forest":
        b = b.addGrid(est.numTrees, [5, 10, 15, 20])
    elif kind == "logistic_regression":
        b = b.addGrid(est.regParam, [0.01, 0.1]).addGrid(est.elasticNetParam, [0.3, 0.8, 1.0]).addGrid(est.maxIter, [5, 10])
    elif kind == "gbt":
        b = b.addGrid(est.maxIter, [5, 10])
    elif kind == "svm":
        b = b.addGrid(est.maxIter, [5, 10]).addGrid(est.regParam, [0.01, 0.1])
    return b.build()


def evaluator(metric: str = "areaUnderROC", hard: bool = True) -> BinaryClassificationEvaluator:
    """On the hard prediction (as the reference, Q5) or on the raw score."""
    return BinaryClassificationEvaluator(
        labelCol=LABEL_COL, rawPredictionCol="prediction" if hard else "rawPrediction", metricName=metric
    )


def pipeline(kind: str, indexer: StringIndexerModel, features: list[str] | None = None) -> Pipeline:
    """M4: assembler, fitted indexer, classifier, converter."""
    return Pipeline(stages=[assembler(features), indexer, classifier(kind), label_converter(indexer)])


def prepare(train: DataFrame, indexer: StringIndexerModel, features: list[str] | None = None) -> DataFrame:
    """Assemble + index once; stored for the many passes of cross-validation."""
    return stored(indexer.transform(assembler(features).transform(train)).select(FEATURES_COL, LABEL_COL), "prepared")


def _whole(kind: str, est, grid: list, indexer: StringIndexerModel, best, metrics: list[float], metric: str, hard: bool, folds: int, features) -> CrossValidatorModel:
    """The tuned classifier between the other stages, as the model that a
    cross-validation of the whole pipeline would have returned."""
    stages = [assembler(features), indexer, est, label_converter(indexer)]
    cv = CrossValidator(estimator=Pipeline(stages=stages), estimatorParamMaps=grid, evaluator=evaluator(metric, hard), numFolds=folds, seed=SEED)
    model = CrossValidatorModel(PipelineModel(stages=[*stages[:2], best, stages[3]]), list(metrics))
    for param in (cv.estimator, cv.estimatorParamMaps, cv.evaluator, cv.numFolds, cv.seed, cv.foldCol):
        model.set(model.getParam(param.name), cv.getOrDefault(param))
    return model


def tune(
    kind: str,
    prepared: DataFrame,
    indexer: StringIndexerModel,
    metric: str = "areaUnderROC",
    folds: int = 5,
    parallelism: int = 4,
    hard: bool = True,
    features: list[str] | None = None,
    fold_col: str | None = None,
) -> CrossValidatorModel:
    """K-fold CV over the grid; refit best on all rows; wrap in the
    4-stage pipeline. ``fold_col`` gives user folds (e.g. time blocks, Q13).
    Hard-label metrics on random folds come from :func:`tune_both`."""
    if hard and not fold_col:
        return tune_both(kind, prepared, indexer, folds, parallelism, features, metrics=(metric,))[metric]
    est = classifier(kind)
    grid = param_grid(kind, est)
    cv = CrossValidator(
        estimator=est,
        estimatorParamMaps=grid,
        evaluator=evaluator(metric, hard),
        numFolds=folds,
        parallelism=parallelism,
        seed=SEED,
        **({"foldCol": fold_col} if fold_col else {}),
    )
    cvm = cv.fit(prepared)
    return _whole(kind, est, grid, indexer, cvm.bestModel, cvm.avgMetrics, metric, hard, folds, features)


def _fitted_together(kind: str, grid: list) -> list[list[int]]:
    """Grid points that one fit serves: those of a boosted model that differ in
    ``maxIter`` alone, since fewer rounds are the first trees of more."""
    if kind != "gbt":
        return [[i] for i in range(len(grid))]
    groups: dict[frozenset, list[int]] = {}
    for i, pm in enumerate(grid):
        groups.setdefault(frozenset((p.name, v) for p, v in pm.items() if p.name != "maxIter"), []).append(i)
    return list(groups.values())


def _after_rounds(model, df: DataFrame, rounds: list[int]) -> DataFrame:
    """Each row once for every number of ``rounds``: label, that number, and the
    prediction of the boosted model's first so many trees."""
    margin, margins = F.lit(0.0), {}
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights), 1):
        df = tree.setFeaturesCol(FEATURES_COL).setPredictionCol(f"_tree{i}").transform(df)
        margin = margins[i] = margin + F.col(f"_tree{i}") * F.lit(weight)
    points = [F.struct(F.lit(n).alias("rounds"), F.when(margins[min(n, len(margins))] > 0, 1.0).otherwise(0.0).alias("prediction")) for n in rounds]
    return df.select(LABEL_COL, F.inline(F.array(*points)))


def tune_both(
    kind: str,
    prepared: DataFrame,
    indexer: StringIndexerModel,
    folds: int = 5,
    parallelism: int = 4,
    features: list[str] | None = None,
    fold_col: str | None = None,
    seed: int = SEED,
    metrics: tuple[str, ...] = ("areaUnderROC", "areaUnderPR"),
) -> dict[str, CrossValidatorModel]:
    """M10 for both hard-label metrics at once: the ROC and the PR runs of
    the reference fit the same models on the same folds, so each fold and
    grid point is fitted once (``parallelism`` at a time, of whatever fold)
    and scored once; one confusion-count aggregate gives both areas. Boosted
    models of fewer rounds are read off the longest one, and linear models share
    their passes over the rows (``linear.py``). The best point per
    metric is refitted on all rows. Returns
    ``{"areaUnderROC": ..., "areaUnderPR": ...}``."""
    from concurrent.futures import ThreadPoolExecutor

    from txpipe.operators.metrics import hard_metrics, with_areas

    est = classifier(kind)
    grid = param_grid(kind, est)
    if fold_col is None:
        data = prepared.withColumn("_fold", F.floor(F.rand(seed) * F.lit(folds)).cast("int"))
        fold_col = "_fold"
    else:
        data = prepared

    def fit_and_score(task):
        f, points = task
        # The folds are filters over one stored table; MLlib keeps its own copy while it fits.
        train, valid = data.where(F.col(fold_col) != f), data.where(F.col(fold_col) == f)
        if len(points) == 1:
            scored = est.copy(grid[points[0]]).fit(train).transform(valid)
            return f, [(points[0], hard_metrics(scored, LABEL_COL, "prediction", digits=None).first())]
        rounds = {i: grid[i][est.maxIter] for i in points}
        model = est.copy(grid[max(points, key=rounds.get)]).fit(train)
        found = {r["rounds"]: r for r in hard_metrics(_after_rounds(model, valid, list(rounds.values())), LABEL_COL, "prediction", ["rounds"], None).collect()}
        return f, [(i, found[n]) for i, n in rounds.items()]

    areas = {m: [[0.0] * folds for _ in grid] for m in metrics}
    counts = linear.fold_counts(kind, est, grid, data, fold_col, folds, FEATURES_COL, LABEL_COL) if kind in linear.KINDS else {}
    shared: dict[int, list] = {}
    if counts:
        rows = [(f, i, *c) for (f, i), c in counts.items()]
        for r in with_areas(prepared.sparkSession.createDataFrame(rows, "fold int, point int, tp long, fn long, fp long, tn long"), None).collect():
            shared.setdefault(r["fold"], []).append((r["point"], r))
    single = [(f, points) for f in range(folds) for points in _fitted_together(kind, grid) if (f, points[0]) not in counts]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for f, found in chain(shared.items(), pool.map(fit_and_score, single)):
            for i, m in found:
                for metric in metrics:
                    areas[metric][i][f] = m["roc_auc" if metric == "areaUnderROC" else "pr_auc"]
        averages = {metric: [sum(a / folds for a in point) for point in points] for metric, points in areas.items()}
        best = {metric: max(range(len(grid)), key=lambda i: avg[i]) for metric, avg in averages.items()}
        refits = dict(zip(set(best.values()), pool.map(lambda i: est.copy(grid[i]).fit(prepared), set(best.values()))))
    return {metric: _whole(kind, est, grid, indexer, refits[best[metric]], avg, metric, True, folds, features) for metric, avg in averages.items()}


def avg_metrics(spark, kind: str, tuned: CrossValidatorModel) -> DataFrame:
    """Mean CV metric per grid point (a table of grid-size rows)."""
    rows = []
    for pm, m in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics):
        params = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((kind, tuned.getEvaluator().getMetricName(), params, float(m)))
    return spark.createDataFrame(rows, "model string, metric string, params string, avg_metric double")


def score(model: CrossValidatorModel | PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring; adds indexedFeatures, indexedLabel (when the label
    is present), rawPrediction, probability (not for SVM), prediction,
    predictedLabel."""
    return model.transform(df)


def flatten_scores(scored: DataFrame, keep: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Vectors to rounded arrays, for storage and comparison."""
    cols = [F.col(c) for c in (keep or ["TRANSACTION_ID"])]
    cols.append(F.col("prediction"))
    if "probability" in scored.columns:
        cols.append(F.round(vector_to_array("probability")[1], digits).alias("probability_fraud"))
    cols.append(F.col("predictedLabel"))
    return scored.select(*cols)


def evaluate(tuned: CrossValidatorModel, scored: DataFrame) -> float:
    """The model's own evaluator on scored rows."""
    return float(tuned.getEvaluator().evaluate(scored))


def save(model: CrossValidatorModel | PipelineModel, path: str) -> None:
    """Write (overwrite) a model; read it with :func:`load`."""
    model.write().overwrite().save(path)


def save_versioned(model: CrossValidatorModel | PipelineModel, base: str, version: str | None = None) -> str:
    """Q15: write to a fresh ``base/v=<version>`` folder instead of
    overwriting in place (an overwrite can leave orphaned stages)."""
    import time

    path = f"{base.rstrip('/')}/v={version or time.strftime('%Y%m%dT%H%M%S')}"
    model.write().save(path)
    return path


def load(path: str) -> CrossValidatorModel | PipelineModel:
    """A saved model of either kind, told by its metadata."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    kind = spark.read.json(f"{path.rstrip('/')}/metadata").select("class").first()[0]
    return (CrossValidatorModel if "CrossValidatorModel" in kind else PipelineModel).load(path)
