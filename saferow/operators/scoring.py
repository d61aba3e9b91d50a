"""Scoring and explanation.

Table scoring is one lazy plan: scan -> (row check) -> feature ``PipelineModel``
-> classifier -> label / probability projection -> (sink).  The reference's
chunk loop becomes Spark's own partitioning; chunk numbers are computed columns
from an exact global row index (:func:`saferow.operators.ranks.row_index`).
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saferow.functions import rules
from saferow.functions.exprs import numeric_columns
from saferow.operators.features import FittedFeatures
from saferow.operators.models import TrainedModel
from saferow.operators.quality import row_errors
from saferow.operators.ranks import row_index
from saferow.spec import FOOD_SAFETY, TableSpec


def validate_input(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> None:
    """Every feature column must be present (checked on the schema only)."""
    missing = [c for c in spec.feature_columns if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks these feature columns: {missing}")


def label_names(pred: Column, spec: TableSpec = FOOD_SAFETY) -> Column:
    """0/1 -> class name; anything else -> 'unknown'."""
    out: Column = F.lit("unknown")
    for name, idx in reversed(list(spec.label_map.items())):
        out = F.when(pred == F.lit(idx), F.lit(name)).otherwise(out)
    return out


def probability_columns(prob_safe: Column, prob_unsafe: Column) -> list[Column]:
    """prob_safe, prob_unsafe and confidence (the larger one)."""
    return [prob_safe.alias("prob_safe"), prob_unsafe.alias("prob_unsafe"),
            F.greatest(prob_safe, prob_unsafe).alias("confidence")]


def score(df: DataFrame, model: TrainedModel, features: Optional[FittedFeatures] = None,
          spec: TableSpec = FOOD_SAFETY, keep: Sequence[str] = (), return_proba: bool = True) -> DataFrame:
    """Score a table.

    The target column is ignored if present.  Without a fitted feature
    preparation, the numeric columns alone are assembled into the feature vector;
    trees then send missing cells (NaN) one way, while a linear model has no answer
    for such a row: its label is "unknown" and its probabilities are NULL.
    """
    validate_input(df, spec)
    data = df.drop(spec.target) if spec.target in df.columns else df
    if features is not None:
        feats = features.transform(data)
    else:
        num = [c for c in numeric_columns(data) if c != spec.key]
        feats = VectorAssembler(inputCols=num, outputCol=model.features, handleInvalid="keep").transform(data)
    out = model.model.transform(feats)
    probs = vector_to_array(F.col("probability"))
    known = ~F.isnan(probs[0])  # NaN only where a linear model met a missing cell
    label = F.when(known, F.col("prediction")).cast("int")
    cols = [F.col(c) for c in keep] + [label_names(label, spec).alias("prediction")]
    if return_proba:
        cols += probability_columns(F.when(known, probs[0]), F.when(known, probs[1]))
    return out.select(*cols)


def batch_ids(df: DataFrame, order_key: str, batch_size: int = 1000) -> DataFrame:
    """``sample_id`` (0-based position in ``order_key`` order) and ``batch_id``
    (``sample_id // batch_size + 1``), without a single-task window."""
    idx = row_index(df, [order_key], out="sample_id")
    return idx.withColumn("batch_id", (F.floor(F.col("sample_id") / F.lit(batch_size)) + 1).cast("long"))


def score_batch(df: DataFrame, model: TrainedModel, features: Optional[FittedFeatures], order_key: str,
                model_path: str = "", batch_size: int = 1000, output_path: Optional[str] = None,
                spec: TableSpec = FOOD_SAFETY, return_proba: bool = True) -> tuple[DataFrame, DataFrame]:
    """The batch job.

    Every row is scored (the feature preparation fills missing numbers and codes
    unseen categories as all zero), with its sample / batch ids, a timestamp and the
    model path, and optionally written as CSV.  The row check (V9, over the feature
    columns, never the target) only annotates: the second result holds the rows it
    objects to, with their ids and error codes.  Returns (scored, objections).
    """
    indexed = batch_ids(df, order_key, batch_size)  # ids first: one shuffle, no join back
    validate_input(indexed, spec)
    ids = [order_key, "sample_id", "batch_id"]
    bad = (indexed.select(*ids, row_errors(spec, spec.feature_columns).alias("errors"))
           .where(F.size("errors") > 0))
    scored = score(indexed, model, features, spec, keep=ids, return_proba=return_proba)
    out = (scored.withColumn("prediction_timestamp",
                             F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
           .withColumn("model_path", F.lit(model_path)))
    if output_path:
        out.write.mode("overwrite").option("header", True).option("escape", '"').csv(output_path)
    return out, bad


def explain(df: DataFrame, prediction: Column, confidence: Column, spec: TableSpec = FOOD_SAFETY,
            n_features: int = 5, keep: Sequence[str] = ()) -> DataFrame:
    """I8-I10 for every row: the first ``n_features`` risk-factor messages in rule
    order, their codes, and the ACCEPT / REJECT recommendation."""
    return df.select(*keep, prediction.alias("prediction"), confidence.alias("confidence"),
                     rules.first_n(rules.risk_factor_texts(spec), n_features).alias("risk_factors"),
                     rules.first_n(rules.risk_factor_codes(spec), n_features).alias("risk_codes"),
                     rules.recommendation(prediction).alias("recommendation"))
