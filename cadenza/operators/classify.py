"""Supervised models: label encoding, three class-balanced tree ensembles,
evaluation and feature importances.

Label codes come from ``pyspark.ml``; the ensembles from
``cadenza.operators.trees``, because Spark's boosting is binary only and its
trees stop at depth 30.  Both boosting presets are softmax boosting on all classes
at once; the forest's trees grow until their leaves are pure.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.vocab import SEED
from cadenza.operators import metrics, trees


@dataclass(frozen=True)
class Preset:
    name: str
    kind: str                    # 'forest' | 'boost' | 'boost_newton'
    n_trees: int = 100           # trees, or rounds of one tree per class
    max_depth: int | None = 3    # None: until the leaves are pure
    step: float = 0.1


# The three model families compared by the experiment, with the reference
# libraries' documented defaults.
PRESETS = (
    Preset("RandomForest", "forest", n_trees=100, max_depth=None),
    # squared-error splits on the gradients, start at the class shares
    Preset("GradientBoosting", "boost", n_trees=100, max_depth=3, step=0.1),
    # second-order splits with l2 = 1 and a least hessian of 1 per child
    Preset("GBTDeep", "boost_newton", n_trees=100, max_depth=6, step=0.3),
)


def encode_labels(df: DataFrame, label: str, out: str = "label_idx"):
    """Alphabetical label -> index encoding (fit on ``df``); returns the
    encoded frame and the fitted indexer (``labels`` gives the inverse)."""
    idx = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc",
                        handleInvalid="error").fit(df)
    return idx.transform(df), idx


def decode_labels(df: DataFrame, indexer, col: str = "prediction", out: str = "pred_label"):
    return IndexToString(inputCol=col, outputCol=out, labels=indexer.labels).transform(df)


def fit_model(train: DataFrame, preset: Preset, features: str = "features",
              label: str = "label_idx", weight: str | None = "weight", seed: int = SEED,
              task_rows: int | None = None):
    """Fit one preset; the model's ``transform`` adds ``prediction`` (a label code)."""
    classes = int(train.agg(F.max(label)).first()[0]) + 1
    if preset.kind == "forest":
        width = len(train.select(trees.feature_array(train, features)).first()[0])
        rules = trees.Rules("gini", preset.max_depth, tries=max(1, math.isqrt(width)), seed=seed)
        return trees.fit_forest(train, features, label, weight, classes, preset.n_trees, rules,
                                task_rows=trees.TASK_ROWS if task_rows is None else task_rows)
    newton = preset.kind == "boost_newton"
    rules = (trees.Rules("newton", preset.max_depth, l2=1.0, least_hessian=1.0) if newton
             else trees.Rules("mse", preset.max_depth))
    return trees.fit_boosting(train, features, label, weight, classes, rules, preset.n_trees, preset.step,
                              prior=not newton, double_hessian=newton, average_gain=newton, task_rows=task_rows)


def importances(model, n_features: int) -> list[float]:
    """Feature importances, which sum to one."""
    out = [float(x) for x in model.featureImportances]
    return out + [0.0] * (n_features - len(out))


def evaluate(pred: DataFrame, truth: str, predicted: str) -> DataFrame:
    return metrics.accuracy_scores(pred, truth, predicted)


def compare_models(train: DataFrame, test: DataFrame, label: str, feature_names: Sequence[str],
                   presets: Sequence[Preset] = PRESETS, features: str = "features",
                   seed: int = SEED):
    """Fit every preset on ``train`` (weighted, balanced), score on ``test``.

    Returns (comparison DataFrame (model, accuracy, balanced_accuracy),
    {name: model}, indexer).  Labels are encoded on the training split.
    """
    from pyspark import StorageLevel
    enc_train, indexer = encode_labels(train, label)
    # every preset reads the rows a few times: keep the encoded frames
    # (recomputable from their short lineage) for the duration of the fits
    enc_train = enc_train.persist(StorageLevel.MEMORY_AND_DISK)
    enc_test = indexer.transform(test).persist(StorageLevel.MEMORY_AND_DISK)
    rows, models = [], {}
    try:
        for p in presets:
            m = fit_model(enc_train, p, features, "label_idx", "weight", seed)
            models[p.name] = m
            pred = decode_labels(m.transform(enc_test), indexer)
            s = evaluate(pred, label, "pred_label").first()
            rows.append((p.name, float(s["accuracy"]), float(s["balanced_accuracy"])))
    finally:
        enc_train.unpersist()
        enc_test.unpersist()
    spark = train.sparkSession
    comp = spark.createDataFrame(rows, "model string, accuracy double, balanced_accuracy double")
    return comp, models, indexer


def best_model_name(comparison: DataFrame) -> str:
    """Best by balanced accuracy; first in preset order on ties."""
    rows = comparison.collect()          # one row per model: bounded by the preset list
    best = max(rows, key=lambda r: r["balanced_accuracy"])
    return best["model"]


def importance_table(spark, model, feature_names: Sequence[str]) -> DataFrame:
    imp = importances(model, len(feature_names))
    return spark.createDataFrame(list(zip(feature_names, imp)), "feature string, importance double") \
                .orderBy(F.desc("importance"), F.asc("feature"))
