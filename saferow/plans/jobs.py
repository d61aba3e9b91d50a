"""Composite jobs (J1-J5): preprocess, train, evaluate, full run, reload.

Each stage is a lazy plan plus the few actions a fit needs; artifacts are
written with Spark ML writers and Parquet under an output folder (a shared
file system on a cluster).  The transformed training features are written
once and read back, so the many fits of a search read a materialised table
instead of recomputing the split and the feature plan each time (and lineage
stays short if an executor is lost).
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field
from typing import Any, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saferow.operators import features as FE
from saferow.operators import metrics as M
from saferow.operators import models as MD
from saferow.operators import search as H
from saferow.operators import split as S
from saferow.sources.files import is_complete, seal, write_lines
from saferow.spec import FOOD_SAFETY, TableSpec


@dataclass
class Prepared:
    features: FE.FittedFeatures
    train: DataFrame
    test: DataFrame
    val: Optional[DataFrame] = None
    counts: dict[str, int] = field(default_factory=dict)


def _materialise(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def preprocess(df: DataFrame, out_dir: str, spec: TableSpec = FOOD_SAFETY, test_size: float = 0.2,
               val_size: float = 0.1, scaling: str = "standard", seed: int = 42) -> Prepared:
    """Split, fit the features on train only, transform every split, save.

    The raw table is read once: the columns that the job uses are stored, and the split, the
    statistics, the dictionary and the transformation read that table."""
    key = spec.key or "sample_key"
    used = dict.fromkeys([key, spec.target, *spec.feature_columns])
    df = _materialise(df.select(*[F.col(f"`{c}`") for c in used if c in df.columns]), os.path.join(out_dir, "raw"))
    tagged = S.assign_split(df, key, spec.target, test_size, val_size, seed)
    train_raw = tagged.where(F.col("split") == "train").drop("split")
    fitted = FE.FeaturePrep(spec, scaling=scaling).fit(train_raw)
    fitted.save(os.path.join(out_dir, "preprocessor"))
    enc = FE.label_encode(F.col(spec.target), spec).cast("double")
    allx = fitted.transform(tagged).select(key, "split", spec.target, fitted.output_col, enc.alias("label"))
    allx = _materialise(allx, os.path.join(out_dir, "features"))
    parts = {s: allx.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    counts = {r["split"]: r["n"] for r in allx.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Prepared(features=fitted, train=parts["train"], test=parts["test"],
                    val=parts["val"] if val_size > 0 else None, counts=counts)


def train_job(prep: Prepared, out_dir: str, model_type: str = "xgboost", tune: bool = False,
              n_trials: int = 30, cv_folds: int = 5, metric: str = "f1", seed: int = 42,
              spec: TableSpec = FOOD_SAFETY, parallelism: Optional[int] = None,
              early_stopping_rounds: int = 10, space: Optional[dict[str, tuple]] = None) -> tuple[MD.TrainedModel, Optional[DataFrame]]:
    """Optional search (folds over the train split), refit, save.

    Early stopping on the validation split is used only when tuning is on (as
    in the reference run).  ``space`` replaces the model's search space."""
    params: dict[str, Any] = {}
    trials = None
    key = spec.key or "sample_key"
    if tune:
        folded = S.assign_folds(prep.train, key, spec.target, cv_folds, seed)
        folded = _materialise(folded, os.path.join(out_dir, "folds"))
        par = parallelism or folded.sparkSession.sparkContext.defaultParallelism
        trials, params, _ = H.tune(folded, model_type, n_trials, cv_folds, metric, seed, parallelism=par, space=space)
        trials.write.mode("overwrite").parquet(os.path.join(out_dir, "trials"))
    data, validation = prep.train, None
    if tune and prep.val is not None and model_type in MD.BOOSTING:
        data = prep.train.withColumn("_is_val", F.lit(False)).unionByName(
            prep.val.withColumn("_is_val", F.lit(True)))
        validation = "_is_val"
    model = MD.train(data, model_type, params, seed=seed, validation=validation,
                     feature_names=prep.features.feature_names(),
                     early_stopping_rounds=early_stopping_rounds if validation else None)
    model.save(os.path.join(out_dir, "model"))
    return model, trials


def evaluate_job(prep: Prepared, model: MD.TrainedModel, out_dir: str, top_n: int = 10,
                 spec: TableSpec = FOOD_SAFETY) -> dict[str, DataFrame]:
    """Metrics on the test split, top-N importance, report; all saved."""
    key = spec.key or "sample_key"
    pred = model.predict(prep.test, keep=[key, "label"])
    pred = pred.select(key, F.col("label").cast("int").alias("y"), F.col("prediction").alias("pred"),
                       F.col("prob_1").alias("p"))
    pred = _materialise(pred, os.path.join(out_dir, "predictions"))
    ev = M.evaluate(pred, "y", "pred", "p", class_names=spec.class_names)
    report = M.report_table(ev, spec.class_names)
    out = {"metrics": ev.metrics, "confusion": ev.confusion, "per_class": ev.per_class, "roc": ev.roc,
           "pr": ev.pr, "roc_auc": ev.roc_auc, "report": report,
           "importance": model.feature_importance(top_n)}
    for name, df in out.items():
        df.write.mode("overwrite").parquet(os.path.join(out_dir, "evaluation", name))
    write_lines(M.report_lines(report), os.path.join(out_dir, "evaluation", "report.txt"))
    return out


def full_run(df: DataFrame, out_dir: str, model_type: str = "xgboost", tune: bool = True, n_trials: int = 30,
             cv_folds: int = 5, spec: TableSpec = FOOD_SAFETY, seed: int = 42) -> DataFrame:
    """J1 -> J2 -> J3 and a one-row summary (durations, counts, settings, metrics)."""
    t0 = time.time()
    prep = preprocess(df, out_dir, spec, seed=seed)
    t1 = time.time()
    model, _ = train_job(prep, out_dir, model_type, tune, n_trials, cv_folds, seed=seed, spec=spec)
    t2 = time.time()
    ev = evaluate_job(prep, model, out_dir, spec=spec)
    m = ev["metrics"].first()
    auc = ev["roc_auc"].first()["roc_auc"]
    t3 = time.time()
    spark = df.sparkSession
    row = (model_type, bool(tune), int(prep.counts.get("train", 0)), int(prep.counts.get("val", 0)),
           int(prep.counts.get("test", 0)), float(m["accuracy"]), float(m["f1_score"]),
           float(auc) if auc is not None else None, t1 - t0, t2 - t1, t3 - t2, t3 - t0, out_dir)
    summary = spark.createDataFrame([row], "model_type string, tuned boolean, n_train long, n_val long, "
                                           "n_test long, accuracy double, f1_score double, roc_auc double, "
                                           "preprocess_sec double, train_sec double, evaluate_sec double, "
                                           "total_sec double, output_dir string")
    summary.write.mode("overwrite").parquet(os.path.join(out_dir, "summary"))
    seal(spark, out_dir)
    return summary


def load_run(spark: SparkSession, out_dir: str) -> tuple[FE.FittedFeatures, MD.TrainedModel, DataFrame]:
    """Reload the preprocessor, the model and the summary of a saved run; a run that was
    killed, or whose files are not those it left, is an error."""
    if not is_complete(spark, out_dir):
        raise FileNotFoundError(f"no complete run in {out_dir}")
    fitted = FE.FittedFeatures.load(os.path.join(out_dir, "preprocessor"))
    model = MD.TrainedModel.load(os.path.join(out_dir, "model"))
    summary = spark.read.parquet(os.path.join(out_dir, "summary"))
    return fitted, model, summary
