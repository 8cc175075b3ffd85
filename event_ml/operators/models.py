"""Distributed training and evaluation of the four classifiers.

Fits are MLlib estimators (gradient rounds / split histograms run on the
executors); evaluation uses this library's exact metrics on the prediction
DataFrame, which stays distributed (no collect of predictions).
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.operators import metrics as m
from event_ml.operators import thresholds as th

# --- fixed values: estimator parameters of the four models -------------------
MODEL_PARAMS: dict[str, dict] = {
    "LogisticRegression": {"maxIter": 50, "family": "binomial", "regParam": 0.01},
    "RandomForest": {"numTrees": 20, "maxDepth": 8, "seed": 42, "subsamplingRate": 0.7},
    "GBT": {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "seed": 42},
    "SVM": {"maxIter": 50, "regParam": 0.01, "tol": 0.01},
}
# --- end of fixed values -----------------------------------------------------

_CLASSES = {
    "LogisticRegression": LogisticRegression,
    "RandomForest": RandomForestClassifier,
    "GBT": GBTClassifier,
    "SVM": LinearSVC,
}


def make_estimator(name: str, features_col: str = "features", label_col: str = "label", **overrides):
    params = dict(MODEL_PARAMS[name])
    params.update(overrides)
    return _CLASSES[name](featuresCol=features_col, labelCol=label_col, **params)


@contextlib.contextmanager
def cached(*dfs: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Persist inputs reused by several fits (materialised here, so a fit's
    timing covers training, not the cache build); always released
    afterwards."""
    held = [d.persist(StorageLevel.MEMORY_AND_DISK) for d in dfs]
    for d in held:
        d.count()
    try:
        yield tuple(held)
    finally:
        for d in held:
            d.unpersist()


def timed_fit(estimator, train: DataFrame):
    """(model, seconds) for one fit."""
    t0 = time.perf_counter()
    model = estimator.fit(train)
    return model, time.perf_counter() - t0


def score_column(pred: DataFrame) -> Column:
    """Positive-class score: probability[1], or rawPrediction[1] for models
    without probabilities (linear SVM)."""
    if "probability" in pred.columns:
        return vector_to_array("probability")[1]
    return vector_to_array("rawPrediction")[1]


def evaluate_predictions(pred: DataFrame, label_col: str = "label", digits: int = 4) -> DataFrame:
    """One row: exact AUC-ROC, AUC-PR, accuracy, weighted F1/precision/recall.

    The (label, score, prediction) projection is persisted once, so scoring
    runs a single time for all metrics; AUC-ROC and AUC-PR share one ranked
    per-score table.  The one-row result is materialised and the
    intermediates are released before returning."""
    spark = pred.sparkSession
    scored = pred.select(
        F.col(label_col).alias("label"), score_column(pred).alias("score"), "prediction"
    ).persist(StorageLevel.MEMORY_AND_DISK)
    ranked = m.ranked_scores(scored, "score", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        auc = m.auc_from_ranked(ranked).select("auc")
        aupr = m.auc_pr(ranked)
        cls = th.classification_metrics(th.confusion_counts(scored, "label", "prediction"), digits)
        out = auc.crossJoin(aupr).crossJoin(cls).select(
            F.round("auc", digits).alias("auc_roc"),
            F.round("auc_pr", digits).alias("auc_pr"),
            "accuracy",
            "f1",
            "weighted_precision",
            "weighted_recall",
        )
        row = out.first()
        return spark.createDataFrame([tuple(row)], out.schema)
    finally:
        ranked.unpersist()
        scored.unpersist()


def train_and_evaluate(
    name: str,
    train: DataFrame,
    val: DataFrame,
    features_col: str = "features",
    label_col: str = "label",
    **overrides,
) -> tuple[object, DataFrame]:
    """Fit one model on ``train``; one-row summary on ``val``: (model,
    val_auc, val_auc_pr, accuracy, f1, train_time_s, params)."""
    est = make_estimator(name, features_col, label_col, **overrides)
    model, secs = timed_fit(est, train)
    spark = train.sparkSession
    metrics = evaluate_predictions(model.transform(val), label_col).first()  # one small row
    params = {k: float(v) for k, v in {**MODEL_PARAMS[name], **overrides}.items() if isinstance(v, (int, float))}
    row = spark.createDataFrame(
        [(name, metrics["auc_roc"], metrics["auc_pr"], metrics["accuracy"], metrics["f1"], float(secs), params)],
        "model string, val_auc double, val_auc_pr double, accuracy double, f1 double, "
        "train_time_s double, params map<string,double>",
    )
    return model, row


def feature_importances(spark: SparkSession, model, feature_names: Sequence[str]) -> DataFrame:
    """(feature, importance) joined by ordinal position.  The importance
    vector has one entry per feature (size = number of features), so both
    sides of the join are tiny."""
    values = [float(v) for v in model.featureImportances.toArray()]
    imp = spark.createDataFrame([(values,)], "v array<double>").select(
        F.posexplode("v").alias("ordinal", "importance")
    )
    names = spark.createDataFrame(list(enumerate(feature_names)), "ordinal int, feature string")
    return imp.join(F.broadcast(names), "ordinal").select("feature", "importance", "ordinal")


def ranked_together(parts: Sequence[tuple[dict, DataFrame]], label_col: str = "label") -> DataFrame:
    """Exact AUC and class sizes of several scored tables, (names..., n_pos, n_neg, auc).

    ``parts`` pairs a table of predictions with the values that name it (the
    same names everywhere).  All scores are one long table with the names as
    group columns, so it is counted, ordered and summed once, however many
    models there are.
    """
    groups = list(parts[0][0])
    scored = [
        pred.select(*[F.lit(names[g]).alias(g) for g in groups], F.col(label_col).alias("label"), score_column(pred).alias("score"))
        for names, pred in parts
    ]
    return m.auc_exact(reduce(DataFrame.unionByName, scored), "score", "label", group_cols=groups)


def cross_validate_folds(
    df: DataFrame,
    name: str,
    grid: dict[str, Sequence[float]],
    fold_col: str = "fold",
    num_folds: int = 3,
    parallelism: int = 4,
    features_col: str = "features",
    label_col: str = "label",
) -> DataFrame:
    """k-fold CV over a grid of any parameters with a user fold column (hash folds:
    reproducible and partition-independent): (setting, params, fold, n_pos,
    n_neg, auc), a row for each setting and held-out fold.

    Fits are submitted ``parallelism`` at a time; the held-out scores of all of
    them are evaluated together.  A fold without rows has no row; one without a
    row of a class has a null AUC.
    """
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]
    jobs = [(i, fold) for i in range(len(settings)) for fold in range(num_folds)]

    def fitted(job: tuple[int, int]):
        i, fold = job
        return make_estimator(name, features_col, label_col, **settings[i]).fit(df.where(F.col(fold_col) != fold))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = list(pool.map(fitted, jobs))
    held = [({"setting": i, "fold": fold}, model.transform(df.where(F.col(fold_col) == fold))) for (i, fold), model in zip(jobs, models, strict=True)]
    aucs = ranked_together(held, label_col)
    rows = [(i, {k: float(v) for k, v in params.items()}) for i, params in enumerate(settings)]
    named = df.sparkSession.createDataFrame(rows, "setting int, params map<string,double>")
    # a row a setting
    return aucs.join(F.broadcast(named), "setting").select("setting", "params", "fold", "n_pos", "n_neg", "auc")


def cross_validate(df: DataFrame, name: str, grid: dict[str, Sequence[float]], **options) -> DataFrame:
    """(params, avg_auc): the mean of the folds' AUCs of ``cross_validate_folds``."""
    folds = cross_validate_folds(df, name, grid, **options)
    mean = folds.groupBy("setting").agg(F.first("params").alias("params"), F.avg("auc").alias("avg_auc"))
    return mean.select("params", "avg_auc")


def fit_all(
    train: DataFrame, val: DataFrame, models: dict[str, dict] | None = None
) -> tuple[dict[str, object], DataFrame]:
    """Fit several models, each on its own: (models that were fitted, status).

    ``models`` maps a name to parameter overrides.  A model that fails has the
    status ``failed`` with the error's text; the others are fitted all the same.
    """
    fitted, rows = {}, []
    for name, overrides in (models or {n: {} for n in MODEL_PARAMS}).items():
        try:
            fitted[name], row = train_and_evaluate(name, train, val, **overrides)
            rows.append((name, "ok", row.first()["val_auc"], None))
        except Exception as e:  # any estimator's own failure becomes its status
            rows.append((name, "failed", None, str(e)[:500]))
    return fitted, train.sparkSession.createDataFrame(rows, "model string, status string, val_auc double, error string")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(name: str, path: str):
    from pyspark.ml.classification import (
        GBTClassificationModel,
        LinearSVCModel,
        LogisticRegressionModel,
        RandomForestClassificationModel,
    )

    cls = {
        "LogisticRegression": LogisticRegressionModel,
        "RandomForest": RandomForestClassificationModel,
        "GBT": GBTClassificationModel,
        "SVM": LinearSVCModel,
    }[name]
    return cls.load(path)
