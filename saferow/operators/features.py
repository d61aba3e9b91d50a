"""Feature preparation (F1-F12, F15) as a Spark ML ``PipelineModel``.

Fitting runs one or two aggregates (means/medians, population deviations or
quartiles) and a ``StringIndexer`` fit; the fitted numeric and fill steps are
frozen into an ``SQLTransformer`` with literal constants, followed by
``StringIndexer`` -> ``OneHotEncoder`` -> ``VectorAssembler``.  Everything in
``transform`` is a native expression, and the whole model saves and loads with
Spark ML's own writers.

Semantics:
* numeric columns: mean imputation and population-std standard scaling
  (``standard``), median imputation and (x - median) / IQR robust scaling
  (``robust``), or mean imputation only (``none``); statistics of the scaler are
  those of the imputed column; a zero deviation or IQR scales by 1;
* categorical columns: missing -> ``"missing"``, one-hot over the sorted
  categories seen in fitting, unseen -> all zeros.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Optional, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saferow.functions.exprs import NUMERIC_TYPES
from saferow.spec import FOOD_SAFETY, TableSpec

MISSING = "missing"
NUM_PREFIX = "num__"
CAT_PREFIX = "cat__"


def infer_feature_columns(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """numeric and categorical columns by type, target and ``exclude`` dropped."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name == target or f.name in exclude:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


def _dlit(v: float) -> str:
    """A double constant for SQL text (plain decimals would parse as DECIMAL)."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def label_encode(c: Column, spec: TableSpec = FOOD_SAFETY) -> Column:
    """fixed label map (safe -> 0, unsafe -> 1); anything else -> NULL."""
    out = F.lit(None).cast("int")
    for name, idx in reversed(list(spec.label_map.items())):
        out = F.when(c == F.lit(name), F.lit(idx)).otherwise(out)
    return out


def label_decode(c: Column, spec: TableSpec = FOOD_SAFETY) -> Column:
    """the inverse map; unknown codes -> NULL."""
    out = F.lit(None).cast("string")
    for name, idx in reversed(list(spec.label_map.items())):
        out = F.when(c == F.lit(idx), F.lit(name)).otherwise(out)
    return out


@dataclass
class FittedFeatures:
    """The fitted state: constants, category lists and the Spark PipelineModel."""

    numeric: list[str]
    categorical: list[str]
    scaling: str
    fill: dict[str, Optional[float]]
    center: dict[str, float]
    scale: dict[str, float]
    categories: dict[str, list[str]]
    model: PipelineModel
    output_col: str = "features"
    target: str = "safety_status"
    extra: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """apply to any split; a target column is kept when present."""
        return self.model.transform(df)

    def numeric_frame(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The imputed / scaled numeric columns as plain columns (for checks)."""
        return df.select(*keep, *[numeric_expr(c, self.fill.get(c), self.center.get(c, 0.0),
                                               self.scale.get(c, 1.0)).alias(c) for c in self.numeric])

    def feature_names(self) -> list[str]:
        """numerics, then ``<column>_<category>`` in sorted category order."""
        names = list(self.numeric)
        for c in self.categorical:
            names += [f"{c}_{v}" for v in self.categories[c]]
        return names

    def save(self, path: str) -> None:
        """the PipelineModel with Spark ML's writer, the rest as JSON metadata."""
        self.model.write().overwrite().save(os.path.join(path, "model"))
        meta = {"numeric": self.numeric, "categorical": self.categorical, "scaling": self.scaling,
                "fill": self.fill, "center": self.center, "scale": self.scale,
                "categories": self.categories, "output_col": self.output_col, "target": self.target}
        _write_json(os.path.join(path, "metadata"), meta)

    @staticmethod
    def load(path: str) -> "FittedFeatures":
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        model = PipelineModel.load(os.path.join(path, "model"))
        meta = json.loads(spark.read.text(os.path.join(path, "metadata")).first()[0])
        return FittedFeatures(model=model, **meta)


def _write_json(path: str, meta: dict) -> None:
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def numeric_expr(c: str, fill: Optional[float], center: float, scale: float) -> Column:
    x = F.col(c).cast("double")
    if fill is not None:
        x = F.coalesce(x, F.lit(float(fill)))
    if center != 0.0 or scale != 1.0:
        x = (x - F.lit(float(center))) / F.lit(float(scale))
    return x


def _numeric_sql(c: str, fill: Optional[float], center: float, scale: float) -> str:
    x = f"CAST(`{c}` AS DOUBLE)"
    if fill is not None:
        x = f"coalesce({x}, {_dlit(fill)})"
    if center != 0.0 or scale != 1.0:
        x = f"(({x} - {_dlit(center)}) / {_dlit(scale)})"
    return x


def fit_numeric_stats(df: DataFrame, numeric: Sequence[str], scaling: str,
                      approx: bool = False) -> tuple[dict, dict, dict]:
    """Fill values, centres and scales; one aggregate (two for robust)."""
    fill: dict[str, Optional[float]] = {}
    center: dict[str, float] = {}
    scale: dict[str, float] = {}
    if not numeric:
        return fill, center, scale
    if scaling == "robust":
        from saferow.operators.quantiles import exact_medians, exact_quantiles

        if approx:
            med = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 100000).alias(c)
                           for c in numeric]).first()
            fill = {c: med[c] for c in numeric}
        else:
            fill = exact_medians(df, numeric)
        # quartiles of the imputed column (imputed cells sit at the median)
        imputed = df.select(*[(F.coalesce(F.col(c).cast("double"), F.lit(float(fill[c])))
                               if fill[c] is not None else F.col(c).cast("double")).alias(c) for c in numeric])
        if approx:
            row = imputed.agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], 100000).alias(c) for c in numeric]).first()
            qs = {c: row[c] for c in numeric}
        else:
            qs = exact_quantiles(imputed, numeric, [0.25, 0.5, 0.75])
        for c in numeric:
            q = qs[c]
            if q is None or q[0] is None:
                center[c], scale[c] = 0.0, 1.0
                continue
            iqr = q[2] - q[0]
            center[c] = float(q[1])
            scale[c] = float(iqr) if iqr != 0 else 1.0
        return fill, center, scale
    aggs = []
    for c in numeric:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.var_pop(x).alias(f"{c}__var"),
                 F.count(x).alias(f"{c}__n")]
    aggs.append(F.count(F.lit(1)).alias("__rows"))
    row = df.agg(*aggs).first()
    rows = row["__rows"]
    for c in numeric:
        mean = row[f"{c}__mean"]
        fill[c] = mean
        if scaling == "standard" and mean is not None:
            # population variance of the mean-imputed column
            var = (row[f"{c}__var"] or 0.0) * row[f"{c}__n"] / rows
            std = var ** 0.5
            center[c] = float(mean)
            scale[c] = std if std != 0 else 1.0
    return fill, center, scale


#: Categories of all columns together that may come to the driver as labels.
MAX_LABELS = 1_000_000


def _bounded_labels(df: DataFrame, categorical: Sequence[str]) -> None:
    """The indexer holds all labels on the driver: more than ``MAX_LABELS`` are refused."""
    if categorical:
        about = df.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
        if sum(about) > MAX_LABELS:
            raise ValueError(f"about {sum(about)} categories: code them with saferow.operators.dictionary")


class FeaturePrep:
    """The unfitted preparation; :meth:`fit` returns :class:`FittedFeatures`."""

    def __init__(self, spec: TableSpec = FOOD_SAFETY, scaling: str = "standard",
                 numeric: Optional[Sequence[str]] = None, categorical: Optional[Sequence[str]] = None,
                 output_col: str = "features", approx: bool = False):
        if scaling not in ("standard", "robust", "none"):
            raise ValueError(f"unknown scaling {scaling}")
        self.spec, self.scaling, self.output_col, self.approx = spec, scaling, output_col, approx
        self.numeric = list(numeric) if numeric is not None else list(spec.numeric_features)
        self.categorical = list(categorical) if categorical is not None else list(spec.categorical_features)

    def fit(self, df: DataFrame) -> FittedFeatures:
        numeric, categorical = self.numeric, self.categorical
        if not numeric and not categorical:
            numeric, categorical = infer_feature_columns(df, self.spec.target, [self.spec.key or ""])
        fill, center, scale = fit_numeric_stats(df, numeric, self.scaling, self.approx)
        sel = ["*"]
        sel += [f"{_numeric_sql(c, fill.get(c), center.get(c, 0.0), scale.get(c, 1.0))} AS `{NUM_PREFIX}{c}`"
                for c in numeric]
        sel += [f"coalesce(CAST(`{c}` AS STRING), '{MISSING}') AS `{CAT_PREFIX}{c}`" for c in categorical]
        _bounded_labels(df, categorical)
        stages = [SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")]
        idx_cols = [f"{CAT_PREFIX}{c}__idx" for c in categorical]
        ohe_cols = [f"{CAT_PREFIX}{c}__ohe" for c in categorical]
        if categorical:
            stages.append(StringIndexer(inputCols=[f"{CAT_PREFIX}{c}" for c in categorical], outputCols=idx_cols,
                                        stringOrderType="alphabetAsc", handleInvalid="keep"))
            # the indexer's unseen bucket is the last slot, which dropLast removes:
            # an unseen category encodes as all zeros
            stages.append(OneHotEncoder(inputCols=idx_cols, outputCols=ohe_cols, dropLast=True))
        stages.append(VectorAssembler(inputCols=[f"{NUM_PREFIX}{c}" for c in numeric] + ohe_cols,
                                      outputCol=self.output_col, handleInvalid="keep"))
        model = Pipeline(stages=stages).fit(df)
        categories = {}
        if categorical:
            indexer = model.stages[1]
            for c, labels in zip(categorical, indexer.labelsArray):
                categories[c] = list(labels)
        return FittedFeatures(numeric=list(numeric), categorical=list(categorical), scaling=self.scaling,
                              fill=fill, center=center, scale=scale, categories=categories, model=model,
                              output_col=self.output_col, target=self.spec.target)

    def fit_transform(self, df: DataFrame) -> tuple[FittedFeatures, DataFrame]:
        """Fit, then transform with the label encoded in ``label``."""
        fitted = self.fit(df)
        out = fitted.transform(df)
        if self.spec.target in df.columns:
            out = out.withColumn("label", label_encode(F.col(self.spec.target), self.spec).cast("double"))
        return fitted, out


def one_hot_counts(fitted: FittedFeatures, transformed: DataFrame) -> DataFrame:
    """F8 check: rows with a 1 in each one-hot slot, as (column_name, category, n_hot)."""
    from pyspark.ml.functions import vector_to_array

    parts = []
    for c in fitted.categorical:
        labels = F.array(*[F.lit(v) for v in fitted.categories[c]])
        arr = vector_to_array(F.col(f"{CAT_PREFIX}{c}__ohe"))
        parts.append(transformed.select(F.lit(c).alias("column_name"),
                                        F.posexplode(arr).alias("pos", "v"), labels.alias("labels"))
                     .where(F.col("v") == 1.0)
                     .select("column_name", F.element_at("labels", F.col("pos") + 1).alias("category")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("n_hot"))


def fit_stats_frame(df: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """the imputer statistics (mean or exact median) as a long table
    (column_name, fill_value); one row per column, built from the fitted scalars."""
    from saferow.operators.quality import fill_statistics

    stats = fill_statistics(df, list(cols), how)
    rows = [(c, round(stats[c], 6) if stats[c] is not None else None) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column_name string, fill_value double")


def names_frame(spark, names: Sequence[str]) -> DataFrame:
    """F12 as a table (position, feature_name); its size is the feature count."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "position int, feature_name string")
