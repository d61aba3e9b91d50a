"""Classifiers (T1-T13) on Spark ML.

The four model types of the reference map to Spark ML estimators with the
same defaults: both boosting presets -> ``GBTClassifier`` (100 rounds, depth 6,
step 0.1, row and feature subsampling 0.8), the forest ->
``RandomForestClassifier`` (100 trees), the linear model ->
``LogisticRegression`` (L2, 1000 iterations, ``regParam = 1 / (C * n)``, so C=1 is
the same objective as the C-parametrised loss).  Tree building and every
prediction are distributed by Spark; nothing collects rows.  A tree fit passes over its
rows hundreds of times, so they are dealt over tasks first (:func:`spread`).
"""

from __future__ import annotations

import json
import logging
import math
import os
from dataclasses import dataclass, field
from typing import Any, Optional, Union

from pyspark.ml import Model
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saferow.operators import trees as TR
from saferow.operators.split import balanced_weight

MODEL_TYPES = ("xgboost", "lightgbm", "random_forest", "logistic_regression")
log = logging.getLogger(__name__)
BOOSTING = ("xgboost", "lightgbm")

# ---------------------------------------------------------------------------
# Fixed default parameters per model type (the reference's defaults, in its
# own parameter names): boosting n_estimators 100, max_depth 6,
# learning_rate 0.1, subsample 0.8, colsample_bytree 0.8; forest
# n_estimators 100, max_depth None, min_samples_split 2, min_samples_leaf 1;
# logistic max_iter 1000, C 1.0 (tolerance 1e-4, the library default).
# ---------------------------------------------------------------------------
DEFAULTS: dict[str, dict[str, Any]] = {
    "xgboost": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
                "colsample_bytree": 0.8},
    "lightgbm": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
                 "colsample_bytree": 0.8},
    "random_forest": {"n_estimators": 100, "max_depth": None, "min_samples_split": 2,
                      "min_samples_leaf": 1},
    "logistic_regression": {"max_iter": 1000, "C": 1.0, "tol": 1e-4},
}
MAX_TREE_DEPTH = 30  # Spark's limit for an unbounded depth
TREE_MEMORY_MB = 1024  # per-executor budget for split statistics (fewer passes per level)
#: Rows that a task of a fit gets: at least (a smaller table is one task's), and at most.
TASK_ROWS, MOST_TASK_ROWS = 12_500, 1_000_000
TASKS_PER_CORE = 2
#: Training rows from which on trees are grown over binned rows (:mod:`saferow.operators.trees`).
BINNED_ROWS = 25_000


def fit_tasks(n_rows: int, cores: int) -> int:
    """Tasks of a pass over ``n_rows`` training rows; as many as the cores or a multiple, if there are that many."""
    n = n_rows // TASK_ROWS
    if n > cores:
        n = cores * min(n // cores, TASKS_PER_CORE)
    return max(1, n, math.ceil(n_rows / MOST_TASK_ROWS))


def spread(df: DataFrame) -> DataFrame:
    """``df`` for the many passes of a tree fit: its rows dealt evenly over tasks.

    The number of tasks follows the rows; the files or coalesced shuffles that the table came from
    often give one or two, and then every pass of the fit has one or two cores.  Bagging draws by
    place in a task, so rows are put in order of a hash (equal rows are alike): the order in which
    shuffled rows arrive changes nothing.  A table for one task stays as it is."""
    return _dealt(df, df.count())


def _dealt(df: DataFrame, n_rows: int) -> DataFrame:
    n = fit_tasks(n_rows, df.sparkSession.sparkContext.defaultParallelism)
    return df if n == 1 else df.repartition(n).sortWithinPartitions(F.xxhash64(*df.columns))


def tree_depth(depth: Optional[int]) -> int:
    """Spark's trees reach ``MAX_TREE_DEPTH`` levels: an unbounded depth becomes that, more is an error."""
    if depth is None:
        log.info("unbounded tree depth: %d levels", MAX_TREE_DEPTH)
        return MAX_TREE_DEPTH
    if int(depth) > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {depth} is above {MAX_TREE_DEPTH}")
    return int(depth)


def spark_params(model_type: str, params: dict[str, Any], n_rows: Optional[float] = None) -> dict[str, Any]:
    """Translate the usual parameter names to Spark ML parameters (H1 mapping).

    ``n_rows``: the sum of the row weights.  ``gamma``, ``reg_alpha``, ``reg_lambda``,
    ``min_samples_split`` and ``solver`` have no counterpart in Spark's estimators
    (``minInfoGain`` is a normalised gain, not a loss reduction) and are not used.
    """
    p = {**DEFAULTS[model_type], **params}
    out: dict[str, Any] = {}
    if model_type in BOOSTING:
        out["maxIter"] = int(p["n_estimators"])
        out["maxDepth"] = tree_depth(p.get("max_depth"))
        out["stepSize"] = float(p["learning_rate"])
        out["subsamplingRate"] = float(p.get("subsample", 1.0))
        out["featureSubsetStrategy"] = str(float(p.get("colsample_bytree", 1.0)))
        if "min_child_samples" in p:
            out["minInstancesPerNode"] = int(p["min_child_samples"])
    elif model_type == "random_forest":
        out["numTrees"] = int(p["n_estimators"])
        out["maxDepth"] = tree_depth(p.get("max_depth"))
        out["minInstancesPerNode"] = int(p.get("min_samples_leaf", 1))
        mf = p.get("max_features")
        if mf in ("sqrt", "log2"):
            out["featureSubsetStrategy"] = mf
        elif mf is not None:
            out["featureSubsetStrategy"] = str(mf)
    elif model_type == "logistic_regression":
        out["maxIter"] = int(p["max_iter"])
        c = float(p.get("C", 1.0))
        out["regParam"] = 1.0 / (c * n_rows) if n_rows else 1.0 / c
        pen = p.get("penalty", "l2")
        mix = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.5}
        if pen not in mix:
            raise ValueError(f"unknown penalty {pen!r}; known: {list(mix)}")
        out["elasticNetParam"] = mix[pen]
        out["standardization"] = False
        out["tol"] = float(p.get("tol", 1e-4))
    else:
        raise ValueError(f"no classifier {model_type!r}; there are {', '.join(MODEL_TYPES)}")
    return out


def make_estimator(model_type: str, params: dict[str, Any] | None = None, seed: int = 42,
                   features: str = "features", label: str = "label", weight: Optional[str] = None,
                   validation: Optional[str] = None, n_rows: Optional[int] = None):
    """T1-T4 (and T6/T7 columns): an unfitted Spark ML classifier."""
    sp = spark_params(model_type, params or {}, n_rows)
    common = dict(featuresCol=features, labelCol=label)
    if weight:
        common["weightCol"] = weight
    # a larger split-statistics budget means fewer data passes per tree level;
    # checkpoints every 10 rounds (to spark.checkpoint.dir) cut the lineage of the
    # boosting residuals, so a lost executor does not replay every round
    trees = dict(maxMemoryInMB=TREE_MEMORY_MB, checkpointInterval=10)
    if model_type in BOOSTING:
        est = GBTClassifier(seed=seed, **common, **trees, **sp)
        if validation:
            est = est.setValidationIndicatorCol(validation)
        return est
    if model_type == "random_forest":
        # deep forests: cache each row's node id instead of re-walking the trees
        return RandomForestClassifier(seed=seed, cacheNodeIds=True, **common, **trees, **sp)
    return LogisticRegression(**common, **sp)


@dataclass
class TrainedModel:
    """A fitted classifier with its type, parameters and feature names."""

    model_type: str
    params: dict[str, Any]
    model: Union[Model, TR.StoredForest]
    feature_names: list[str] = field(default_factory=list)
    features: str = "features"
    label: str = "label"

    def predict(self, df: DataFrame, keep: Optional[list[str]] = None) -> DataFrame:
        """``prediction`` (0/1 int), ``prob_0``, ``prob_1`` per row."""
        out = self.model.transform(df)
        probs = vector_to_array(F.col("probability"))
        cols = [F.col(c) for c in (keep if keep is not None else df.columns)]
        return out.select(*cols, F.col("prediction").cast("int").alias("prediction"),
                          probs[0].alias("prob_0"), probs[1].alias("prob_1"))

    def feature_importance(self, top_n: int = 20) -> DataFrame:
        """Top-N (feature, importance): tree importances or |coefficient|."""
        from pyspark.sql import SparkSession

        if isinstance(self.model, LogisticRegressionModel):
            vals = [abs(v) for v in self.model.coefficients.toArray()]
        else:
            vals = list(self.model.featureImportances.toArray())
        names = self.feature_names or [f"feature_{i}" for i in range(len(vals))]
        spark = SparkSession.getActiveSession()
        # one value per feature column of the model: its size is the feature count
        df = spark.createDataFrame([(names[i], float(v)) for i, v in enumerate(vals)],
                                   "feature string, importance double")
        return df.orderBy(F.desc("importance"), F.asc("feature")).limit(top_n)

    def save(self, path: str) -> None:
        """Model with Spark ML's writer, type / parameters / names as JSON."""
        from pyspark.sql import SparkSession

        self.model.write().overwrite().save(os.path.join(path, "model"))
        meta = {"model_type": self.model_type, "params": self.params, "feature_names": self.feature_names,
                "features": self.features, "label": self.label}
        if isinstance(self.model, TR.StoredForest):
            meta["stored_forest"] = True
        SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "value string") \
            .coalesce(1).write.mode("overwrite").text(os.path.join(path, "metadata"))

    @staticmethod
    def load(path: str) -> "TrainedModel":
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(os.path.join(path, "metadata")).first()[0])
        cls = {"random_forest": RandomForestClassificationModel,
               "logistic_regression": LogisticRegressionModel}.get(meta["model_type"], GBTClassificationModel)
        if meta.pop("stored_forest", False):
            cls = TR.StoredForest
        return TrainedModel(model=cls.load(os.path.join(path, "model")), **meta)


def first_trees(model: GBTClassificationModel, k: int) -> GBTClassificationModel:
    """The boosted ensemble of the first ``k`` trees of ``model``: what a fit of ``k``
    rounds with the same seed gives, since later rounds change no earlier tree."""
    java, spark = model._java_obj, SparkSession.getActiveSession()  # noqa: SLF001
    trees, weights = java.trees(), java.treeWeights()
    k = min(int(k), len(trees))
    gateway = spark.sparkContext._gateway  # noqa: SLF001
    kept = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, k)
    scale = gateway.new_array(gateway.jvm.double, k)
    for i in range(k):
        kept[i], scale[i] = trees[i], weights[i]
    cut = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), kept, scale, java.numFeatures(), java.numClasses())
    settings = java.extractParamMap().toSeq()  # columns, thresholds and the other settings of the fit
    for i in range(settings.size()):
        cut.set(settings.apply(i))
    return GBTClassificationModel(cut)


def best_round(losses: list[float], patience: int) -> int:
    """Round-based early stopping: training stops once ``patience`` rounds pass
    without a new best validation loss; the model keeps rounds up to the best."""
    best_i, best = 0, float("inf")
    for i, loss in enumerate(losses):
        if loss < best:
            best_i, best = i, loss
        elif i - best_i >= patience:
            break
    return best_i


def _fit_trees(est, data: DataFrame, boosting: bool, features: str, label: str, weight: Optional[str],
               validation: Optional[str]) -> Union[Model, TR.StoredForest]:
    """The fit of a tree estimator: over binned rows from ``BINNED_ROWS`` of two classes on, else Spark's own."""
    n_rows, two = data.agg(F.count(F.lit(1)), F.bool_and(F.col(label).cast("double").isin(0.0, 1.0))).first()
    tasks = TR.growable(est, data, n_rows, boosting) if n_rows >= BINNED_ROWS and two and not validation else 0
    bins = TR.find_bins(est, data, boosting) if tasks else None
    if bins is None:
        return est.fit(_dealt(data, n_rows))
    fit = TR.fit_boosting if boosting else TR.fit_forest
    return fit(est, TR.tasks_for(data, tasks), tasks, bins, features, label, weight)


def train(df: DataFrame, model_type: str = "xgboost", params: dict[str, Any] | None = None,
          seed: int = 42, class_weight: Optional[str] = "balanced", sample_weight: Optional[str] = None,
          validation: Optional[str] = None, feature_names: Optional[list[str]] = None,
          features: str = "features", label: str = "label",
          early_stopping_rounds: Optional[int] = None) -> TrainedModel:
    """Fit one classifier.

    Balanced class weights apply to the forest and the linear model only (as in
    the reference); a per-row ``sample_weight`` multiplies them.  ``validation``
    names a boolean column of rows held out for early stopping (boosting only).
    With ``early_stopping_rounds`` the rule is the reference's: the validation
    loss of every round (``evaluateEachIteration``, one distributed pass) picks
    the best round before ``early_stopping_rounds`` rounds without improvement,
    and the one fitted ensemble is cut to its trees up to that round
    (:func:`first_trees`).  Without it, Spark's ``validationTol`` rule applies.
    """
    if early_stopping_rounds and validation and model_type in BOOSTING:
        full = train(df.where(~F.col(validation)), model_type, params, seed, class_weight, sample_weight, None,
                     feature_names, features, label)
        held = spread(df.where(F.col(validation)).select(features, label))
        losses = list(full.model.evaluateEachIteration(held))
        rounds = best_round(losses, early_stopping_rounds) + 1
        full.model = first_trees(full.model, rounds)
        full.params["n_estimators"] = rounds
        return full
    if model_type not in MODEL_TYPES:
        raise ValueError(f"no classifier {model_type!r}; there are {', '.join(MODEL_TYPES)}")
    data = df
    weight = sample_weight
    if class_weight == "balanced" and model_type in ("random_forest", "logistic_regression"):
        data = balanced_weight(data, label, out="_w", sample_weight=sample_weight)
        weight = "_w"
    n_rows = None
    if model_type == "logistic_regression":
        # C is per unit of weight: weight w with C equals weight 1 with w * C
        total = F.sum(F.col(weight).cast("double")) if weight else F.count(F.lit(1)).cast("double")
        n_rows = data.agg(total).first()[0]
    est = make_estimator(model_type, params, seed, features, label, weight,
                         validation if model_type in BOOSTING else None, n_rows)
    if model_type == "logistic_regression":
        model = est.fit(data)
    else:  # trees: a pass for every level
        data = data.select(*[c for c in (features, label, weight, validation) if c])
        model = _fit_trees(est, data, model_type in BOOSTING, features, label, weight,
                           validation if model_type in BOOSTING else None)
    return TrainedModel(model_type=model_type, params={**DEFAULTS[model_type], **(params or {})},
                        model=model, feature_names=list(feature_names or []), features=features, label=label)


def accuracy(pred: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy of a prediction table (one row)."""
    return pred.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))
