"""The flagship query: samples -> clean (V10 + V11) -> label rule (R1) ->
confusion and point metrics against the stored label (E3/E4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saferow.functions import rules
from saferow.operators import metrics as M
from saferow.operators import quality as Q
from saferow.plans import fixtures as FX


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = Q.clean(FX.samples(spark, sf_dir), fill_missing="median")
    labelled = cleaned.select(
        (F.col("safety_status") == "unsafe").cast("int").alias("y"),
        rules.label_rule().cast("int").alias("pred"))
    return M.point_metrics(M.confusion(labelled, "y", "pred"))
