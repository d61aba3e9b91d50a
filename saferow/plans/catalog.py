"""Registry of checked queries: each operator of the inventory as a Spark
DataFrame job over the driver's tables, with an equivalent DuckDB SQL text
where SQL can express it.

Column names match between both sides; derived doubles are rounded to six
places on both sides.
"""

from __future__ import annotations

from typing import Callable, Optional

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saferow.functions import rules
from saferow.functions.exprs import r6
from saferow.operators import dictionary as DI
from saferow.operators import metrics as M
from saferow.operators import quality as Q
from saferow.plans import fixtures as FX
from saferow.spec import FOOD_SAFETY as SPEC

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: Optional[str] = None, with_fixtures: bool = True):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = FX.oracle(sql) if with_fixtures else sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- SQL helpers
NUM = list(SPEC.numeric_features)
CAT_CHECKED = [c for c in SPEC.categorical_domains]
ALL_SAMPLE_COLS = ["sample_key"] + list(SPEC.feature_columns) + [SPEC.target]


def _num(v: float) -> str:
    """A double literal in both dialects (plain decimals are DECIMAL in both)."""
    s = repr(float(v))
    return s if "e" in s else s + "e0"


def sql_out_of_range(c: str) -> str:
    lo, hi = SPEC.numeric_ranges[c]
    cond = f"{c} < {_num(lo)}"
    if hi is not None:
        cond += f" OR {c} > {_num(hi)}"
    return f"coalesce({cond}, false)"


def sql_invalid(c: str) -> str:
    dom = ", ".join(f"'{v}'" for v in SPEC.categorical_domains[c])
    return f"({c} IS NOT NULL AND lower({c}) NOT IN ({dom}))"


def sql_nulled(c: str) -> str:
    if c in SPEC.numeric_ranges:
        return f"CASE WHEN {sql_out_of_range(c)} THEN NULL ELSE {c} END"
    return c


def samples_df(spark: SparkSession, sf: str) -> DataFrame:
    return FX.samples(spark, sf)


def scored_df(spark: SparkSession, sf: str) -> DataFrame:
    """scored + pred = (p >= 0.5), the model-free prediction the metric checks use."""
    return FX.scored(spark, sf).withColumn("pred", (F.col("p") >= 0.5).cast("int"))


SCORED_PRED = "scored_p AS (SELECT *, CAST(p >= 5e-1 AS INTEGER) AS pred FROM scored)"


# ================================================================ V: validation
@register("v2_range_flags", "SELECT sample_key, " + ", ".join(
    f"{sql_out_of_range(c)} AS {c}" for c in SPEC.numeric_ranges) + " FROM samples")
def v2_range_flags(spark, sf):
    return Q.range_flags(samples_df(spark, sf))


@register("v3_range_violations", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CAST({sql_out_of_range(c)} AS INTEGER)) AS BIGINT) AS violations "
    f"FROM samples" for c in SPEC.numeric_ranges))
def v3_range_violations(spark, sf):
    return Q.range_violations(samples_df(spark, sf))


@register("v4_invalid_categories", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM samples WHERE {sql_invalid(c)} "
    f"GROUP BY {c}" for c in CAT_CHECKED))
def v4_invalid_categories(spark, sf):
    return Q.invalid_categories(samples_df(spark, sf))


@register("v5_missing_values", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
    f"CASE WHEN count(*) = 0 THEN 0e0 ELSE (count(*) - count({c})) / count(*) END AS missing_ratio, "
    f"CASE WHEN count(*) = 0 THEN 0e0 ELSE (count(*) - count({c})) / count(*) END <= 5e-1 AS acceptable "
    f"FROM samples" for c in ALL_SAMPLE_COLS))
def v5_missing_values(spark, sf):
    return Q.missing_values(samples_df(spark, sf), SPEC.missing_threshold)


@register("v6_duplicate_rows", """
SELECT 'lineitem_rows' AS subset_name,
       CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem) d) AS BIGINT) AS duplicates
UNION ALL
SELECT 'lineitem_order_line', CAST((SELECT count(*) FROM lineitem)
       - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS BIGINT)
UNION ALL
SELECT 'samples_food_packaging', CAST((SELECT count(*) FROM samples)
       - (SELECT count(*) FROM (SELECT DISTINCT food_type, packaging_type FROM samples) d) AS BIGINT)
""")
def v6_duplicate_rows(spark, sf):
    li = FX.table(spark, sf, "lineitem")
    s = samples_df(spark, sf)
    parts = [
        Q.duplicate_count(li, compare=True).select(F.lit("lineitem_rows").alias("subset_name"), "duplicates"),
        Q.duplicate_count(li, ["l_orderkey", "l_linenumber"])
        .select(F.lit("lineitem_order_line").alias("subset_name"), "duplicates"),
        Q.duplicate_count(s, ["food_type", "packaging_type"])
        .select(F.lit("samples_food_packaging").alias("subset_name"), "duplicates"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("v7_duplicate_key", """
SELECT 'supplier_id' AS column_name,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT supplier_id FROM samples) d) AS BIGINT) AS duplicates
FROM samples""")
def v7_duplicate_key(spark, sf):
    return Q.duplicate_count(samples_df(spark, sf), ["supplier_id"]) \
        .select(F.lit("supplier_id").alias("column_name"), "duplicates")


def _v8_long_sql() -> str:
    parts = ["SELECT 'rows' AS check_name, '*' AS column_name, 'count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM samples"]
    for c in SPEC.numeric_ranges:
        parts.append(f"SELECT 'range_violations', '{c}', 'count', CAST(sum(CAST({sql_out_of_range(c)} AS INTEGER)) AS DOUBLE) FROM samples")
    for c in CAT_CHECKED:
        parts.append(f"SELECT 'invalid_categories', '{c}', 'count', CAST(sum(CAST({sql_invalid(c)} AS INTEGER)) AS DOUBLE) FROM samples")
    for c in ALL_SAMPLE_COLS:
        parts.append(f"SELECT 'missing', '{c}', 'count', CAST(count(*) - count({c}) AS DOUBLE) FROM samples")
        parts.append(f"SELECT 'missing', '{c}', 'ratio', CASE WHEN count(*) = 0 THEN 0e0 ELSE (count(*) - count({c})) / count(*) END FROM samples")
    parts.append("SELECT 'duplicates', '*', 'count', CAST((SELECT count(*) FROM samples) - (SELECT count(*) FROM (SELECT DISTINCT * FROM samples) d) AS DOUBLE)")
    for k in SPEC.duplicate_keys:
        parts.append(f"SELECT 'duplicates', '{k}', 'count', CAST((SELECT count(*) FROM samples) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM samples) d) AS DOUBLE)")
    return "\nUNION ALL ".join(parts)


@register("v8_validation_report", _v8_long_sql())
def v8_validation_report(spark, sf):
    return Q.validate_full(samples_df(spark, sf)).long


@register("v8_validation_verdict", """
SELECT true AS is_valid, true AS schema_valid,
  (SELECT sum(""" + " + ".join(f"CAST({sql_out_of_range(c)} AS INTEGER)" for c in SPEC.numeric_ranges) + """) FROM samples) = 0 AS range_valid,
  (SELECT sum(""" + " + ".join(f"CAST({sql_invalid(c)} AS INTEGER)" for c in CAT_CHECKED) + """) FROM samples) = 0 AS categorical_valid,
  (SELECT max(r) FROM (""" + " UNION ALL ".join(
    f"SELECT CASE WHEN count(*) = 0 THEN 0e0 ELSE (count(*) - count({c})) / count(*) END AS r FROM samples"
    for c in ALL_SAMPLE_COLS) + """) m) <= 5e-1 AS missing_acceptable,
  (SELECT count(*) FROM samples) AS n_samples, 12 AS n_features,
  CAST((SELECT count(*) FROM samples) - (SELECT count(*) FROM (SELECT DISTINCT * FROM samples) d) AS BIGINT) AS total_duplicates
""")
def v8_validation_verdict(spark, sf):
    return Q.validate_full(samples_df(spark, sf), strict=False).verdict


def _v9_cases() -> list[tuple[str, str]]:
    out = []
    for c in SPEC.required_columns:
        out.append((f"{c} IS NULL", f"{c}:missing"))
        if c in SPEC.numeric_ranges:
            lo, hi = SPEC.numeric_ranges[c]
            cond = f"{c} < {_num(lo)}" + (f" OR {c} > {_num(hi)}" if hi is not None else "")
            out.append((f"({cond})", f"{c}:range"))
        if c in SPEC.categorical_domains:
            dom = ", ".join(f"'{v}'" for v in SPEC.categorical_domains[c])
            out.append((f"{c} NOT IN ({dom})", f"{c}:domain"))
    return out


@register("v9_row_schema_errors", "SELECT sample_key, concat_ws(',', " + ", ".join(
    f"CASE WHEN {cond} THEN '{code}' END" for cond, code in _v9_cases()) + ") AS error_codes, CAST(" + " + ".join(
    f"(CASE WHEN {cond} THEN 1 ELSE 0 END)" for cond, _ in _v9_cases()) + " AS INTEGER) AS n_errors FROM samples")
def v9_row_schema_errors(spark, sf):
    checked = Q.with_row_errors(samples_df(spark, sf))
    return checked.select("sample_key", F.concat_ws(",", "errors").alias("error_codes"),
                          F.size("errors").cast("int").alias("n_errors"))


@register("v10_null_out_of_range", "SELECT " + ", ".join(
    (f"{sql_nulled(c)} AS {c}" if c in SPEC.numeric_ranges else c) for c in ALL_SAMPLE_COLS) + " FROM samples")
def v10_null_out_of_range(spark, sf):
    return Q.null_out_of_range(samples_df(spark, sf))


def _fill_sql(stat: str, rounded: bool) -> str:
    cols_c = ", ".join(["sample_key"] + [
        f"CAST({sql_nulled(c)} AS DOUBLE) AS {c}" for c in NUM] + list(SPEC.categorical_features) + [SPEC.target])
    stats = ", ".join(f"{stat}({c}) AS {c}" for c in NUM)
    wrap = (lambda e: f"round({e}, 6)") if rounded else (lambda e: e)
    sel = ", ".join(["c.sample_key"] + [f"{wrap(f'coalesce(c.{c}, m.{c})')} AS {c}" for c in NUM]
                    + [f"c.{c}" for c in SPEC.categorical_features] + [f"c.{SPEC.target}"])
    return f"WITH c AS (SELECT {cols_c} FROM samples), m AS (SELECT {stats} FROM c) SELECT {sel} FROM c, m"


@register("v11_fill_median", _fill_sql("median", False))
def v11_fill_median(spark, sf):
    return Q.clean(samples_df(spark, sf), fill_missing="median")


@register("v12_fill_mean", _fill_sql("avg", True))
def v12_fill_mean(spark, sf):
    out = Q.clean(samples_df(spark, sf), fill_missing="mean")
    return out.select(*[r6(F.col(c)).alias(c) if c in NUM else F.col(c) for c in out.columns])


@register("v13_drop_missing", "SELECT " + ", ".join(
    (f"{sql_nulled(c)} AS {c}" if c in SPEC.numeric_ranges else c) for c in ALL_SAMPLE_COLS)
    + " FROM samples WHERE " + " AND ".join(f"({sql_nulled(c)}) IS NOT NULL" for c in NUM))
def v13_drop_missing(spark, sf):
    return Q.clean(samples_df(spark, sf), fill_missing="drop")


@register("v14_no_outlier_no_fill", "SELECT * FROM samples")
def v14_no_outlier_no_fill(spark, sf):
    return Q.clean(samples_df(spark, sf), remove_outliers=False, fill_missing="none")


# ================================================================ R: rules
RULE_SQL = """(coalesce(total_plate_count > 1e6, false)
  OR coalesce(coliform_count > 1000e0, false)
  OR coalesce(temperature > 10e0 AND storage_time_days > 7, false)
  OR coalesce(water_activity > 85e-2 AND ph_level > 65e-1 AND storage_time_days > 14, false))"""
RISK_SQL = """(CASE WHEN total_plate_count > -1e0 THEN ln(1e0 + total_plate_count) END / 20e0
  + CASE WHEN coliform_count > -1e0 THEN ln(1e0 + coliform_count) END / 15e0
  + (temperature + 5e0) / 35e0 + storage_time_days / 730e0 + (water_activity - 3e-1) / 69e-2)"""


@register("r1_label_rule", f"SELECT sample_key, {RULE_SQL} AS rule_unsafe FROM samples")
def r1_label_rule(spark, sf):
    return samples_df(spark, sf).select("sample_key", rules.label_rule().alias("rule_unsafe"))


@register("r2_label_noise", f"SELECT sample_key, {RULE_SQL} <> (sample_key % 20 = 0) AS label_unsafe FROM samples")
def r2_label_noise(spark, sf):
    s = samples_df(spark, sf)
    return s.select("sample_key", rules.label_noise(rules.label_rule(), (F.col("sample_key") % 20) == 0)
                    .alias("label_unsafe"))


@register("r3_risk_score", f"SELECT sample_key, round({RISK_SQL}, 6) AS risk_score FROM samples")
def r3_risk_score(spark, sf):
    return samples_df(spark, sf).select("sample_key", r6(rules.risk_score()).alias("risk_score"))


@register("r4_ratio_correction", f"""
WITH r AS (SELECT sample_key, safety_status = 'unsafe' AS label, {RISK_SQL} AS risk FROM samples),
st AS (SELECT avg(CAST(label AS DOUBLE)) AS share, quantile_cont(risk, 7e-1) AS cut FROM r)
SELECT sample_key, CASE WHEN abs(share - 3e-1) > 5e-2 THEN coalesce(risk > cut, false) ELSE label END AS label_corrected
FROM r, st""")
def r4_ratio_correction(spark, sf):
    s = samples_df(spark, sf).select("sample_key", (F.col("safety_status") == "unsafe").alias("label"),
                                     rules.risk_score().alias("risk"))
    out = rules.ratio_correction(s, "label", "risk", ratio=0.3, tolerance=0.05)
    return out.select("sample_key", "label_corrected")


# ================================================================ E: evaluation
def _metrics_sql(pred_expr: str, y_expr: str = "y") -> str:
    return f"""
WITH {SCORED_PRED},
b AS (SELECT {y_expr} AS yy, {pred_expr} AS pp FROM scored_p),
cm AS (SELECT CAST(sum(CASE WHEN yy = 0 AND pp = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
              CAST(sum(CASE WHEN yy = 0 AND pp = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
              CAST(sum(CASE WHEN yy = 1 AND pp = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
              CAST(sum(CASE WHEN yy = 1 AND pp = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM b),
d AS (SELECT tn, fp, fn, tp, CAST(tn AS DOUBLE) AS tnd, CAST(fp AS DOUBLE) AS fpd, CAST(fn AS DOUBLE) AS fnd,
             CAST(tp AS DOUBLE) AS tpd, CAST(tn + fp + fn + tp AS DOUBLE) AS n FROM cm),
e AS (SELECT *, tnd + fpd AS t0, fnd + tpd AS t1, tnd + fnd AS p0, fpd + tpd AS p1 FROM d)
SELECT tn, fp, fn, tp,
  round(CASE WHEN n = 0 THEN 0e0 ELSE (tpd + tnd) / n END, 6) AS accuracy,
  round(CASE WHEN tpd + fpd = 0 THEN 0e0 ELSE tpd / (tpd + fpd) END, 6) AS precision,
  round(CASE WHEN tpd + fnd = 0 THEN 0e0 ELSE tpd / (tpd + fnd) END, 6) AS recall,
  round(CASE WHEN 2 * tpd + fpd + fnd = 0 THEN 0e0 ELSE 2 * tpd / (2 * tpd + fpd + fnd) END, 6) AS f1_score,
  round(CASE WHEN (n * n - (p0 * p0 + p1 * p1)) * (n * n - (t0 * t0 + t1 * t1)) = 0 THEN 0e0
        ELSE ((tpd + tnd) * n - (t0 * p0 + t1 * p1)) / sqrt((n * n - (t0 * t0 + t1 * t1)) * (n * n - (p0 * p0 + p1 * p1))) END, 6) AS matthews_corrcoef,
  round(1e0 - (fpd + fnd) / ((p0 * t1 + p1 * t0) / n), 6) AS cohen_kappa
FROM e"""


def _eval(spark, sf, threshold=0.5, strings=False):
    s = scored_df(spark, sf)
    if strings:
        s = s.select(F.col("safety_status").alias("y"),
                     F.when(F.col("p") >= 0.5, "unsafe").otherwise("safe").alias("pred"), "p")
    return M.evaluate(s, "y", "pred", "p", threshold=threshold, string_labels=strings)


@register("e1_string_labels", _metrics_sql(
    "CASE WHEN p >= 5e-1 THEN 1 ELSE 0 END", "CASE safety_status WHEN 'safe' THEN 0 WHEN 'unsafe' THEN 1 ELSE 0 END"))
def e1_string_labels(spark, sf):
    return _eval(spark, sf, strings=True).metrics


@register("e2_threshold_override", _metrics_sql("CAST(p >= 6e-1 AS INTEGER)"))
def e2_threshold_override(spark, sf):
    return _eval(spark, sf, threshold=0.6).metrics


@register("e3_confusion_matrix", f"SELECT tn, fp, fn, tp FROM ({_metrics_sql('pred')}) x")
def e3_confusion_matrix(spark, sf):
    return _eval(spark, sf).confusion


@register("e4_precision_recall_f1",
          f"SELECT accuracy, precision, recall, f1_score FROM ({_metrics_sql('pred')}) x")
def e4_precision_recall_f1(spark, sf):
    return _eval(spark, sf).metrics.select("accuracy", "precision", "recall", "f1_score")


@register("e5_matthews", f"SELECT matthews_corrcoef FROM ({_metrics_sql('pred')}) x")
def e5_matthews(spark, sf):
    return _eval(spark, sf).metrics.select("matthews_corrcoef")


@register("e6_cohen_kappa", f"SELECT cohen_kappa FROM ({_metrics_sql('pred')}) x")
def e6_cohen_kappa(spark, sf):
    return _eval(spark, sf).metrics.select("cohen_kappa")


PTS_SQL = """pts AS (SELECT p AS threshold, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
                  CAST(sum(CASE WHEN y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS neg
           FROM scored WHERE p IS NOT NULL GROUP BY p),
cum AS (SELECT threshold, pos, neg,
          CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tps,
          CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fps
        FROM pts),
tot AS (SELECT CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N FROM pts)"""

ROC_SQL = PTS_SQL + """,
nb AS (SELECT *, lag(fps) OVER w AS fps_prev, lead(fps) OVER w AS fps_next,
              lag(tps) OVER w AS tps_prev, lead(tps) OVER w AS tps_next
       FROM cum WINDOW w AS (ORDER BY threshold DESC)),
kept AS (SELECT threshold, fps, tps FROM nb
         WHERE fps_prev IS NULL OR fps_next IS NULL
            OR fps_next - 2 * fps + fps_prev <> 0 OR tps_next - 2 * tps + tps_prev <> 0
         UNION ALL SELECT CAST('inf' AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT)),
roc AS (SELECT threshold, fps, tps,
          round(CASE WHEN N <> 0 THEN fps / N END, 6) AS fpr,
          round(CASE WHEN P <> 0 THEN tps / P END, 6) AS tpr, P, N
        FROM kept, tot)"""


@register("e7_roc_auc", f"WITH {PTS_SQL} SELECT round(sum(neg * (tps - pos / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS roc_auc FROM cum")
def e7_roc_auc(spark, sf):
    return _eval(spark, sf).roc_auc


@register("e8_roc_curve", f"WITH {ROC_SQL} SELECT threshold, fps, tps, fpr, tpr FROM roc")
def e8_roc_curve(spark, sf):
    return _eval(spark, sf).roc


@register("e9_pr_curve", f"""WITH {PTS_SQL}
SELECT threshold, round(CASE WHEN tps + fps = 0 THEN 0e0 ELSE tps / (tps + fps) END, 6) AS precision,
       round(CASE WHEN P = 0 THEN 1e0 ELSE tps / P END, 6) AS recall FROM cum, tot
UNION ALL SELECT CAST(NULL AS DOUBLE), 1e0, 0e0""")
def e9_pr_curve(spark, sf):
    return _eval(spark, sf).pr


@register("e10_youden_threshold", f"""WITH {ROC_SQL}
SELECT threshold AS optimal_threshold, round(tpr - fpr, 6) AS youden_j FROM roc
ORDER BY tps * N - fps * P DESC, threshold DESC LIMIT 1""")
def e10_youden_threshold(spark, sf):
    return _eval(spark, sf).youden


@register("e11_per_class_report", f"""WITH m AS ({_metrics_sql('pred')}),
c AS (SELECT CAST(tn AS DOUBLE) tn, CAST(fp AS DOUBLE) fp, CAST(fn AS DOUBLE) fn, CAST(tp AS DOUBLE) tp FROM m),
k AS (SELECT *, CASE WHEN tn + fn = 0 THEN 0e0 ELSE tn / (tn + fn) END p0, CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn / (tn + fp) END r0,
        CASE WHEN 2 * tn + fn + fp = 0 THEN 0e0 ELSE 2 * tn / (2 * tn + fn + fp) END f0,
        CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END p1, CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END r1,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / (2 * tp + fp + fn) END f1,
        tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n FROM c)
SELECT 'safe' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM k
UNION ALL SELECT 'unsafe', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM k
UNION ALL SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), round(CASE WHEN n = 0 THEN 0e0 ELSE (tp + tn) / n END, 6), CAST(n AS BIGINT) FROM k
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6), round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM k""")
def e11_per_class_report(spark, sf):
    return _eval(spark, sf).per_class


SWEEP_SQL = f"""th AS (SELECT CAST(range AS INTEGER) AS k,
          CASE WHEN range = 99 THEN 99e-2 ELSE CAST(range AS DOUBLE) * {repr(M.SWEEP_STEP)} + 1e-2 END AS threshold
        FROM range(100)),
cnt AS (SELECT th.k, th.threshold,
          CAST(sum(CASE WHEN s.y = 1 AND s.p >= th.threshold THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
          CAST(sum(CASE WHEN s.y <> 1 AND s.p >= th.threshold THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
          CAST(sum(CASE WHEN s.y = 1 AND NOT (s.p >= th.threshold) THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
          CAST(sum(CASE WHEN s.y <> 1 AND NOT (s.p >= th.threshold) THEN 1 ELSE 0 END) AS DOUBLE) AS tn
        FROM th, scored s GROUP BY th.k, th.threshold),
sc AS (SELECT k, threshold,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
         CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END AS recall,
         (CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END) + (CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn / (tn + fp) END) - 1 AS youden
       FROM cnt),
lng AS (SELECT 'f1' AS metric, k, threshold, f1 AS score FROM sc
        UNION ALL SELECT 'precision', k, threshold, precision FROM sc
        UNION ALL SELECT 'recall', k, threshold, recall FROM sc
        UNION ALL SELECT 'youden', k, threshold, youden FROM sc)"""


@register("e12_optimal_threshold", f"""WITH {SWEEP_SQL},
rk AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY score DESC, k ASC) AS r FROM lng)
SELECT metric, round(threshold, 6) AS optimal_threshold, round(score, 6) AS best_score FROM rk WHERE r = 1""")
def e12_optimal_threshold(spark, sf):
    return M.optimal_threshold(scored_df(spark, sf), "y", "p", ("f1", "precision", "recall", "youden"))


E13_COLS = ALL_SAMPLE_COLS + ["y", "p", "pred"]


@register("e13_misclassified", f"""WITH {SCORED_PRED}
SELECT *, y AS true_label, pred AS predicted_label, p AS prediction_confidence,
       CASE WHEN pred = 1 THEN 'false_positive' ELSE 'false_negative' END AS error_type
FROM scored_p WHERE y <> pred""")
def e13_misclassified(spark, sf):
    return M.misclassified(scored_df(spark, sf), "y", "pred", "p")


@register("e15_top_errors", f"""WITH {SCORED_PRED}
SELECT *, y AS true_label, pred AS predicted_label, p AS prediction_confidence,
       CASE WHEN pred = 1 THEN 'false_positive' ELSE 'false_negative' END AS error_type
FROM scored_p WHERE y <> pred ORDER BY p ASC, sample_key ASC LIMIT 20""")
def e15_top_errors(spark, sf):
    return M.top_errors(scored_df(spark, sf), "sample_key", "y", "pred", "p", top_n=20)


@register("e16_error_summary", f"""WITH {SCORED_PRED}
SELECT count(*) AS total_samples, CAST(sum(CASE WHEN y <> pred THEN 1 ELSE 0 END) AS BIGINT) AS misclassified,
  round(CASE WHEN count(*) = 0 THEN 0e0 ELSE sum(CASE WHEN y <> pred THEN 1 ELSE 0 END) / count(*) END, 6) AS error_rate,
  CAST(sum(CASE WHEN y <> pred AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_positives,
  CAST(sum(CASE WHEN y <> pred AND pred <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives
FROM scored_p""")
def e16_error_summary(spark, sf):
    return M.error_summary(scored_df(spark, sf), "y", "pred")


E17_SQL = f"""WITH m AS ({_metrics_sql('pred')}),
{PTS_SQL},
nb AS (SELECT *, lag(fps) OVER w AS fps_prev, lead(fps) OVER w AS fps_next,
              lag(tps) OVER w AS tps_prev, lead(tps) OVER w AS tps_next
       FROM cum WINDOW w AS (ORDER BY threshold DESC)),
kept AS (SELECT threshold, fps, tps FROM nb
         WHERE fps_prev IS NULL OR fps_next IS NULL
            OR fps_next - 2 * fps + fps_prev <> 0 OR tps_next - 2 * tps + tps_prev <> 0
         UNION ALL SELECT CAST('inf' AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT)),
yd AS (SELECT threshold FROM kept, tot ORDER BY tps * N - fps * P DESC, threshold DESC LIMIT 1),
auc AS (SELECT round(sum(neg * (tps - pos / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS v FROM cum),
c AS (SELECT CAST(tn AS DOUBLE) tn, CAST(fp AS DOUBLE) fp, CAST(fn AS DOUBLE) fn, CAST(tp AS DOUBLE) tp FROM m)
SELECT 'overall' AS section, 'accuracy' AS name, accuracy AS value FROM m
UNION ALL SELECT 'overall', 'precision', precision FROM m
UNION ALL SELECT 'overall', 'recall', recall FROM m
UNION ALL SELECT 'overall', 'f1_score', f1_score FROM m
UNION ALL SELECT 'overall', 'matthews_corrcoef', matthews_corrcoef FROM m
UNION ALL SELECT 'overall', 'cohen_kappa', cohen_kappa FROM m
UNION ALL SELECT 'overall', 'roc_auc', v FROM auc
UNION ALL SELECT 'threshold', 'optimal_threshold', round(threshold, 6) FROM yd
UNION ALL SELECT 'confusion', 'tn', tn FROM c
UNION ALL SELECT 'confusion', 'fp', fp FROM c
UNION ALL SELECT 'confusion', 'fn', fn FROM c
UNION ALL SELECT 'confusion', 'tp', tp FROM c
UNION ALL SELECT 'per_class', 'safe_precision', round(CASE WHEN tn + fn = 0 THEN 0e0 ELSE tn / (tn + fn) END, 6) FROM c
UNION ALL SELECT 'per_class', 'unsafe_precision', round(CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END, 6) FROM c
UNION ALL SELECT 'per_class', 'safe_recall', round(CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn / (tn + fp) END, 6) FROM c
UNION ALL SELECT 'per_class', 'unsafe_recall', round(CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END, 6) FROM c
UNION ALL SELECT 'per_class', 'safe_f1_score', round(CASE WHEN 2 * tn + fn + fp = 0 THEN 0e0 ELSE 2 * tn / (2 * tn + fn + fp) END, 6) FROM c
UNION ALL SELECT 'per_class', 'unsafe_f1_score', round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) FROM c"""


@register("e17_report_table", E17_SQL)
def e17_report_table(spark, sf):
    return M.report_table(_eval(spark, sf))


# ================================================================ F: splits, folds, weights
from saferow.operators import split as S  # noqa: E402
from saferow.operators import features as FE  # noqa: E402


def _rank_sql(strat: str) -> str:
    part = f"PARTITION BY {strat}" if strat else ""
    return f"""h AS (SELECT *, md5('42:' || CAST(sample_key AS VARCHAR)) AS hh FROM samples),
r AS (SELECT *, row_number() OVER ({part} ORDER BY hh, sample_key) - 1 AS rk,
             count(*) OVER ({part}) AS n FROM h)"""


@register("f13_split_stratified", f"""WITH {_rank_sql('safety_status')}
SELECT sample_key, safety_status, CASE WHEN rk < round(n * 2e-1) THEN 'test' ELSE 'train' END AS split FROM r""")
def f13_split_stratified(spark, sf):
    s = samples_df(spark, sf).select("sample_key", "safety_status")
    return S.assign_split(s, "sample_key", "safety_status", test_size=0.2, seed=42)


@register("f13_split_plain", f"""WITH {_rank_sql('')}
SELECT sample_key, safety_status, CASE WHEN rk < round(n * 2e-1) THEN 'test' ELSE 'train' END AS split FROM r""")
def f13_split_plain(spark, sf):
    s = samples_df(spark, sf).select("sample_key", "safety_status")
    return S.assign_split(s, "sample_key", None, test_size=0.2, seed=42)


@register("f14_split_three_way", f"""WITH {_rank_sql('safety_status')},
q AS (SELECT *, round(n * 2e-1) AS nt FROM r)
SELECT sample_key, safety_status, CASE WHEN rk < nt THEN 'test'
  WHEN rk < nt + round((n - nt) * (1e-1 / (1e0 - 2e-1))) THEN 'val' ELSE 'train' END AS split FROM q""")
def f14_split_three_way(spark, sf):
    s = samples_df(spark, sf).select("sample_key", "safety_status")
    return S.assign_split(s, "sample_key", "safety_status", test_size=0.2, val_size=0.1, seed=42)


@register("t11_fold_assignment", f"""WITH {_rank_sql('safety_status')}
SELECT sample_key, safety_status, CAST(rk % 5 AS INTEGER) AS fold FROM r""")
def t11_fold_assignment(spark, sf):
    s = samples_df(spark, sf).select("sample_key", "safety_status")
    return S.assign_folds(s, "sample_key", "safety_status", k=5, seed=42)


@register("t5_class_weights", """WITH c AS (SELECT safety_status, count(*) AS nc FROM samples GROUP BY safety_status),
t AS (SELECT count(*) AS n, count(DISTINCT coalesce(safety_status, '')) AS k FROM samples)
SELECT s.sample_key, s.safety_status, round(CAST(t.n AS DOUBLE) / (t.k * c.nc), 6) AS weight
FROM samples s JOIN c ON s.safety_status IS NOT DISTINCT FROM c.safety_status, t""")
def t5_class_weights(spark, sf):
    s = samples_df(spark, sf).select("sample_key", "safety_status")
    out = S.balanced_weight(s, "safety_status")
    return out.select("sample_key", "safety_status", r6(F.col("weight")).alias("weight"))


# ================================================================ F: features
def _fit(spark, sf, scaling):
    s = samples_df(spark, sf)
    return s, FE.FeaturePrep(scaling=scaling).fit(s)


@register("f1_feature_selection", "SELECT sample_key, " + ", ".join(SPEC.feature_columns) + " FROM samples")
def f1_feature_selection(spark, sf):
    s = samples_df(spark, sf)
    num, cat = FE.infer_feature_columns(s, SPEC.target, exclude=[SPEC.key])
    return s.select(SPEC.key, *num, *cat)


@register("f2_mean_imputer_values", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CAST({c} AS DOUBLE)), 6) AS fill_value FROM samples" for c in NUM))
def f2_mean_imputer_values(spark, sf):
    return FE.fit_stats_frame(samples_df(spark, sf), list(SPEC.numeric_features), "mean")


@register("f3_median_imputer_values", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(median(CAST({c} AS DOUBLE)), 6) AS fill_value FROM samples" for c in NUM))
def f3_median_imputer_values(spark, sf):
    return FE.fit_stats_frame(samples_df(spark, sf), list(SPEC.numeric_features), "median")


@register("f4_categorical_fill", "SELECT sample_key, " + ", ".join(
    f"coalesce({c}, 'missing') AS {c}" for c in SPEC.categorical_features) + " FROM samples")
def f4_categorical_fill(spark, sf):
    s, fitted = _fit(spark, sf, "standard")
    out = fitted.transform(s)
    return out.select("sample_key", *[F.col(f"{FE.CAT_PREFIX}{c}").alias(c) for c in SPEC.categorical_features])


def _std_sql(where_fit: str = "", src: str = "samples", target_rows: str = "samples") -> str:
    stats = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, sqrt(var_pop(CAST({c} AS DOUBLE)) * count({c}) / count(*)) AS s_{c}"
        for c in NUM)
    sel = ", ".join(
        f"round((coalesce(CAST(x.{c} AS DOUBLE), st.m_{c}) - st.m_{c}) / CASE WHEN st.s_{c} = 0 THEN 1e0 ELSE st.s_{c} END, 6) AS {c}"
        for c in NUM)
    return f"WITH st AS (SELECT {stats} FROM {src} {where_fit}) SELECT x.sample_key, {sel} FROM {target_rows} x, st"


@register("f5_standard_scaling", _std_sql())
def f5_standard_scaling(spark, sf):
    s, fitted = _fit(spark, sf, "standard")
    out = fitted.transform(s)
    return out.select("sample_key", *[r6(F.col(f"{FE.NUM_PREFIX}{c}")).alias(c) for c in NUM])


def _robust_sql() -> str:
    meds = ", ".join(f"median(CAST({c} AS DOUBLE)) AS md_{c}" for c in NUM)
    filled = ", ".join(f"coalesce(CAST(s.{c} AS DOUBLE), md.md_{c}) AS {c}" for c in NUM)
    qs = ", ".join(f"quantile_cont({c}, 25e-2) AS q1_{c}, quantile_cont({c}, 5e-1) AS q2_{c}, "
                   f"quantile_cont({c}, 75e-2) AS q3_{c}" for c in NUM)
    sel = ", ".join(
        f"round(({c} - q2_{c}) / CASE WHEN q3_{c} - q1_{c} = 0 THEN 1e0 ELSE q3_{c} - q1_{c} END, 6) AS {c}"
        for c in NUM)
    return (f"WITH md AS (SELECT {meds} FROM samples), f AS (SELECT s.sample_key, {filled} FROM samples s, md), "
            f"q AS (SELECT {qs} FROM f) SELECT f.sample_key, {sel} FROM f, q")


@register("f6_robust_scaling", _robust_sql())
def f6_robust_scaling(spark, sf):
    s, fitted = _fit(spark, sf, "robust")
    out = fitted.transform(s)
    return out.select("sample_key", *[r6(F.col(f"{FE.NUM_PREFIX}{c}")).alias(c) for c in NUM])


@register("f7_no_scaling", "WITH st AS (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in NUM)
          + " FROM samples) SELECT x.sample_key, " + ", ".join(f"round(coalesce(CAST(x.{c} AS DOUBLE), st.m_{c}), 6) AS {c}" for c in NUM)
          + " FROM samples x, st")
def f7_no_scaling(spark, sf):
    s, fitted = _fit(spark, sf, "none")
    out = fitted.transform(s)
    return out.select("sample_key", *[r6(F.col(f"{FE.NUM_PREFIX}{c}")).alias(c) for c in NUM])


@register("f8_one_hot_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, coalesce({c}, 'missing') AS category, count(*) AS n_hot FROM samples "
    f"GROUP BY coalesce({c}, 'missing')" for c in SPEC.categorical_features))
def f8_one_hot_counts(spark, sf):
    s, fitted = _fit(spark, sf, "standard")
    return FE.one_hot_counts(fitted, fitted.transform(s))


@register("f8_dictionary_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, coalesce({c}, 'missing') AS category, count(*) AS n_hot FROM samples "
    f"GROUP BY coalesce({c}, 'missing')" for c in SPEC.categorical_features))
def f8_dictionary_counts(spark, sf):
    """F8 with the categories as a table that never comes to the driver."""
    s = samples_df(spark, sf)
    return DI.slot_counts(s, DI.fit_dictionary(s, SPEC.categorical_features))


@register("f8_dictionary_vectors", "SELECT sample_key, true AS same FROM samples")
def f8_dictionary_vectors(spark, sf):
    """F8: the sparse vectors coded through the table equal those of the fitted pipeline."""
    from pyspark.ml.functions import vector_to_array
    s, fitted = _fit(spark, sf, "standard")
    mine = DI.encode(s, DI.fit_dictionary(s, SPEC.categorical_features), fitted)
    other = fitted.transform(s).select("sample_key", vector_to_array("features").alias("other"))
    return mine.select("sample_key", vector_to_array("features").alias("v")).join(other, "sample_key") \
        .select("sample_key", F.forall(F.zip_with("v", "other", lambda a, b: F.abs(a - b) < 1e-12), lambda x: x).alias("same"))


@register("f9_fit_train_transform_test", f"""WITH {_rank_sql('safety_status')},
sp AS (SELECT * FROM r WHERE rk >= round(n * 2e-1)),
te AS (SELECT * FROM r WHERE rk < round(n * 2e-1)),
""" + _std_sql(src="sp", target_rows="te")[5:])
def f9_fit_train_transform_test(spark, sf):
    s = samples_df(spark, sf)
    parts = S.split_frames(s, "sample_key", "safety_status", test_size=0.2, seed=42, materialize=True)
    fitted = FE.FeaturePrep(scaling="standard").fit(parts["train"])
    out = fitted.transform(parts["test"])
    return out.select("sample_key", *[r6(F.col(f"{FE.NUM_PREFIX}{c}")).alias(c) for c in NUM])


@register("f10_label_encode", """SELECT sample_key, CASE safety_status WHEN 'safe' THEN 0 WHEN 'unsafe' THEN 1 END AS label
FROM samples""")
def f10_label_encode(spark, sf):
    s = samples_df(spark, sf)
    return s.select("sample_key", FE.label_encode(F.col("safety_status")).alias("label"))


@register("f11_inverse_label", """SELECT sample_key, CASE y WHEN 0 THEN 'safe' WHEN 1 THEN 'unsafe' END AS label_name
FROM scored""")
def f11_inverse_label(spark, sf):
    return scored_df(spark, sf).select("sample_key", FE.label_decode(F.col("y")).alias("label_name"))


def _names_sql() -> str:
    cats = " UNION ALL ".join(
        f"SELECT DISTINCT {i} AS ci, '{c}' AS c, coalesce({c}, 'missing') AS v FROM samples"
        for i, c in enumerate(SPEC.categorical_features))
    nums = " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS feature_name" for i, c in enumerate(NUM))
    return (f"WITH d AS ({cats}) {nums} UNION ALL SELECT CAST({len(NUM)} + row_number() OVER (ORDER BY ci, v) - 1 AS INTEGER), "
            f"c || '_' || v FROM d")


@register("f12_feature_names", _names_sql())
def f12_feature_names(spark, sf):
    s, fitted = _fit(spark, sf, "standard")
    names = fitted.feature_names()
    return FE.names_frame(s.sparkSession, names)


@register("f12_dictionary_names", _names_sql())
def f12_dictionary_names(spark, sf):
    """F12 as a table from the dictionary, at any number of categories."""
    d = DI.fit_dictionary(samples_df(spark, sf), SPEC.categorical_features)
    return DI.names_table(d, NUM)


# ================================================================ H: search results (events as trials)
from saferow.operators import search as H  # noqa: E402
from saferow.operators import scoring as I  # noqa: E402

TRIALS_SQL = "trials AS (SELECT event_id AS trial_number, CAST(value AS DOUBLE) AS score FROM events)"


def _trials(spark, sf):
    return H.trials_from_table(FX.table(spark, sf, "events"), "event_id", "value")


@register("h4_best_trial", f"""WITH {TRIALS_SQL}
SELECT trial_number, score, (SELECT count(*) FROM trials) AS n_trials FROM trials
ORDER BY score DESC, trial_number ASC LIMIT 1""", with_fixtures=False)
def h4_best_trial(spark, sf):
    return H.best_trial(_trials(spark, sf))


@register("h6_best_so_far", f"""WITH {TRIALS_SQL}
SELECT trial_number, score, max(score) OVER (ORDER BY trial_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_score
FROM trials""", with_fixtures=False)
def h6_best_so_far(spark, sf):
    return H.best_so_far(_trials(spark, sf))


@register("h7_score_histogram", f"""WITH {TRIALS_SQL},
st AS (SELECT min(score) AS lo, max(score) AS hi FROM trials),
e AS (SELECT CAST(range AS INTEGER) AS bin,
        CAST(range AS DOUBLE) * ((hi - lo) / 20e0) + lo AS bin_lo,
        CASE WHEN range + 1 >= 20 THEN hi ELSE CAST(range + 1 AS DOUBLE) * ((hi - lo) / 20e0) + lo END AS bin_hi
      FROM range(20), st)
SELECT bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi,
  (SELECT count(*) FROM trials t WHERE t.score >= e.bin_lo AND (t.score < e.bin_hi OR (e.bin = 19 AND t.score <= e.bin_hi))) AS n
FROM e""", with_fixtures=False)
def h7_score_histogram(spark, sf):
    return H.score_histogram(_trials(spark, sf), bins=20)


@register("h8_trials_save_load", f"WITH {TRIALS_SQL} SELECT trial_number, score FROM trials", with_fixtures=False)
def h8_trials_save_load(spark, sf):
    from saferow.session import scratch_path
    path = scratch_path(spark, "trials")
    _trials(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# ================================================================ I: scoring rules (model-free)
@register("i2_label_map", f"""WITH {SCORED_PRED}
SELECT sample_key, CASE pred WHEN 0 THEN 'safe' WHEN 1 THEN 'unsafe' ELSE 'unknown' END AS prediction FROM scored_p""")
def i2_label_map(spark, sf):
    s = scored_df(spark, sf)
    return s.select("sample_key", I.label_names(F.col("pred")).alias("prediction"))


@register("i3_probability_columns", """SELECT sample_key, round(1e0 - p, 6) AS prob_safe, round(p, 6) AS prob_unsafe,
  round(greatest(1e0 - p, p), 6) AS confidence FROM scored""")
def i3_probability_columns(spark, sf):
    s = scored_df(spark, sf)
    cols = I.probability_columns(F.lit(1.0) - F.col("p"), F.col("p"))
    return s.select("sample_key", *cols).select("sample_key", *[r6(F.col(c)).alias(c) for c in
                                                               ("prob_safe", "prob_unsafe", "confidence")])


@register("i6_batch_ids", """SELECT sample_key, row_number() OVER (ORDER BY sample_key) - 1 AS sample_id,
  CAST(floor((row_number() OVER (ORDER BY sample_key) - 1) / 1000) + 1 AS BIGINT) AS batch_id FROM samples""")
def i6_batch_ids(spark, sf):
    return I.batch_ids(samples_df(spark, sf).select("sample_key"), "sample_key", 1000)


@register("i7_quarantine_split", "SELECT CASE WHEN " + " OR ".join(f"({c})" for c, _ in _v9_cases())
          + " THEN 'quarantined' ELSE 'accepted' END AS status, count(*) AS n FROM samples GROUP BY 1")
def i7_quarantine_split(spark, sf):
    good, bad = Q.quarantine(samples_df(spark, sf))
    return good.select(F.lit("accepted").alias("status")).unionByName(bad.select(F.lit("quarantined").alias("status"))) \
        .groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _risk_cases() -> list[tuple[str, str]]:
    return [(f"{r.column} > {_num(r.threshold)}", r.code) for r in SPEC.risk_rules]


@register("i8_risk_factor_codes", "SELECT sample_key, concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} THEN '{code}' END" for c, code in _risk_cases()) + ") AS risk_codes, CAST(" + " + ".join(
    f"(CASE WHEN {c} THEN 1 ELSE 0 END)" for c, _ in _risk_cases()) + " AS INTEGER) AS n_factors FROM samples")
def i8_risk_factor_codes(spark, sf):
    s = samples_df(spark, sf)
    codes = rules.risk_factor_codes()
    return s.select("sample_key", F.concat_ws(",", codes).alias("risk_codes"), F.size(codes).cast("int").alias("n_factors"))


def _first5_sql() -> str:
    parts = [f"CASE WHEN {c} THEN '{code}' END" for c, code in _risk_cases()]
    arr = "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"
    return f"SELECT sample_key, array_to_string({arr}[1:5], ',') AS top_codes FROM samples"


@register("i9_top_risk_factors", _first5_sql())
def i9_top_risk_factors(spark, sf):
    s = samples_df(spark, sf)
    return s.select("sample_key", F.concat_ws(",", rules.first_n(rules.risk_factor_codes(), 5)).alias("top_codes"))


@register("i10_recommendation", f"""WITH {SCORED_PRED}
SELECT sample_key, CASE WHEN pred = 1 THEN 'REJECT - Unsafe for consumption' ELSE 'ACCEPT - Safe for consumption' END AS recommendation
FROM scored_p""")
def i10_recommendation(spark, sf):
    s = scored_df(spark, sf)
    return s.select("sample_key", rules.recommendation(I.label_names(F.col("pred"))).alias("recommendation"))


# ================================================================ S: sources and sinks
from saferow.sources import files as SRC  # noqa: E402
from saferow.sources import synth as SYN  # noqa: E402
from saferow.session import scratch_path  # noqa: E402

SAMPLES_SCHEMA = SPEC.spark_schema(with_key=True)


@register("s1_s6_csv_round_trip", "SELECT * FROM samples")
def s1_s6_csv_round_trip(spark, sf):
    path = scratch_path(spark, "samples") + ".csv"
    SRC.write_table(samples_df(spark, sf), path)
    return SRC.read_table(spark, path, schema=SAMPLES_SCHEMA)


@register("s2_s7_json_round_trip", "SELECT * FROM samples")
def s2_s7_json_round_trip(spark, sf):
    path = scratch_path(spark, "samples") + ".json"
    SRC.write_table(samples_df(spark, sf), path)
    return SRC.read_table(spark, path, schema=SAMPLES_SCHEMA).select(*ALL_SAMPLE_COLS)


_EVEN_HASH = "pmod(xxhash64(sample_key), 2) = 0"
#: Rows of one array file, about 100 MB: a larger table makes more files, not longer ones.
ARRAY_ROWS = 300_000


def _arrays(s, files: int, folder: str, compression: str = "none") -> None:
    """The rows of ``s`` as ``files`` files of one JSON array each, the array in one line.  A task
    writes its rows as they come, so no array is held as a whole."""
    def bracketed(batches):
        first = True
        for b in batches:
            if b.num_rows:
                lead = pa.array(["[" if first else ", "] + [", "] * (b.num_rows - 1), b.schema.types[0])
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(lead, b.column("value"), "")], ["value"])
                first = False
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])

    text = F.to_json(F.struct(*[F.col(c) for c in s.columns]), {"ignoreNullFields": "false"})
    s.select(text.alias("value")).repartition(files).mapInArrow(bracketed, "value string") \
        .write.option("lineSep", " ").option("compression", compression).text(folder)


def _as_arrays(spark, sf, folder: str, parts: int) -> None:
    """The samples as array files, at least ``parts`` of them, and those of every second
    hash of the key once more as compressed ones."""
    s = samples_df(spark, sf)
    files = max(parts, -(-s.count() // ARRAY_ROWS))
    _arrays(s, files, folder + "/plain")
    _arrays(s.where(_EVEN_HASH), -(-files // 2), folder + "/sub/zipped", "gzip")


@register("s2_json_array_files", "SELECT * FROM samples")
def s2_json_array_files(spark, sf):
    """Files that are one array in one line each, cut into byte ranges."""
    path = scratch_path(spark, "arrays")
    _as_arrays(spark, sf, path, 3)
    return SRC.read_table(spark, path + "/plain", "json", schema=SAMPLES_SCHEMA).select(*ALL_SAMPLE_COLS)


@register("s2_json_compressed_and_nested", """SELECT sample_key, count(*) AS n FROM (SELECT sample_key FROM samples
UNION ALL SELECT sample_key FROM samples) GROUP BY 1""")
def s2_json_compressed_and_nested(spark, sf):
    """One folder with plain array files, compressed array files in a sub-folder and
    compressed JSON Lines in another; the last two hold the samples once between them."""
    path = scratch_path(spark, "arrays")
    _as_arrays(spark, sf, path, 4)
    rest = samples_df(spark, sf).where(f"NOT ({_EVEN_HASH})")
    rest.write.option("compression", "gzip").json(path + "/more/lines")
    return SRC.read_table(spark, path, "json", schema=SAMPLES_SCHEMA).groupBy("sample_key").agg(F.count("*").alias("n"))


@register("s3_s8_parquet_round_trip", "SELECT * FROM samples")
def s3_s8_parquet_round_trip(spark, sf):
    path = scratch_path(spark, "samples") + ".parquet"
    SRC.write_table(samples_df(spark, sf), path)
    return SRC.read_table(spark, path)


@register("s3_parquet_scan", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice > 1e5",
          with_fixtures=False)
def s3_parquet_scan(spark, sf):
    df = SRC.read_table(spark, f"{sf}/orders.parquet")
    return df.where(F.col("o_totalprice") > 1e5).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@register("s5_multi_file_union", "SELECT " + ", ".join(
    (f"CASE WHEN sample_key % 2 = 0 THEN {c} END AS {c}" if c == "supplier_id" else c) for c in ALL_SAMPLE_COLS)
    + " FROM samples")
def s5_multi_file_union(spark, sf):
    """Even keys as Parquet, odd keys as CSV without ``supplier_id``, plus a
    path that does not exist (skipped with a warning); appended by column name."""
    s = samples_df(spark, sf)
    base = scratch_path(spark, "multi")
    a, b = base + "-even.parquet", base + "-odd.csv"
    SRC.write_table(s.where(F.col("sample_key") % 2 == 0), a)
    SRC.write_table(s.where(F.col("sample_key") % 2 == 1).drop("supplier_id"), b)
    out = SRC.read_many(spark, [a, base + "-absent.csv", b])
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SAMPLES_SCHEMA.fields])


def _damaged(spark, path: str) -> str:
    """A gzip file that breaks while it is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).create(file)
    stream.write(bytearray(b"\x1f\x8b\x08\x00" + b"damaged" * 9))
    stream.close()
    return path


@register("s5_load_outcomes", """SELECT 1 AS no, 'loaded' AS status, count(*) AS n_rows FROM samples WHERE sample_key % 2 = 0
UNION ALL SELECT 2, 'skipped', 0 UNION ALL SELECT 3, 'skipped', 0
UNION ALL SELECT 4, 'loaded', count(*) FROM samples WHERE sample_key % 2 = 1
UNION ALL SELECT 5, 'union', count(*) FROM samples""")
def s5_load_outcomes(spark, sf):
    """Outcome per path: Parquet, a CSV file that breaks while it is read, a path that does
    not exist, CSV; and the rows of the union of the rest."""
    s = samples_df(spark, sf)
    base = scratch_path(spark, "outcomes")
    SRC.write_table(s.where(F.col("sample_key") % 2 == 0), base + "-1.parquet")
    SRC.write_table(s.where(F.col("sample_key") % 2 == 1), base + "-4.csv")
    paths = [base + "-1.parquet", _damaged(spark, base + "-2.csv/part.csv.gz").rsplit("/", 1)[0], base + "-3.csv", base + "-4.csv"]
    frames, outcomes = SRC.load_each(spark, paths, schema=SAMPLES_SCHEMA)
    rows = outcomes.select(F.regexp_extract("path", r"-(\d)\.\w+$", 1).cast("int").alias("no"), "status", "n_rows")
    union = frames[0].unionByName(frames[1]).agg(F.count("*").alias("n_rows"))
    return rows.unionByName(union.select(F.lit(5).alias("no"), F.lit("union").alias("status"), "n_rows"))


@register("s10_half_written", "SELECT o_orderkey AS sample_key, false AS taken, true AS sealed FROM orders", with_fixtures=False)
def s10_half_written(spark, sf):
    """A folder that a killed write left (a part file, no manifest, a write under way) is
    not taken for the table: it is generated anew, and sealed."""
    path = scratch_path(spark, "half") + ".parquet"
    keys = FX.table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_key"))
    keys.limit(3).write.parquet(path + "/_temporary/0")
    keys.limit(3).coalesce(1).write.mode("append").parquet(path + "/lost")
    taken = SRC.is_complete(spark, path)
    out = SRC.load_or_generate(spark, path, seed=42, keys=keys)
    return out.select("sample_key", F.lit(taken).alias("taken"), F.lit(SRC.is_complete(spark, path)).alias("sealed"))


@register("s11_chunked_csv_scan", """SELECT sample_key, safety_status, row_number() OVER (ORDER BY sample_key) - 1 AS sample_id,
  CAST(floor((row_number() OVER (ORDER BY sample_key) - 1) / 1000) + 1 AS BIGINT) AS batch_id FROM samples""")
def s11_chunked_csv_scan(spark, sf):
    path = scratch_path(spark, "batch") + ".csv"
    SRC.write_table(samples_df(spark, sf), path)
    df = SRC.read_table(spark, path, schema=SAMPLES_SCHEMA)
    return I.batch_ids(df.select("sample_key", "safety_status"), "sample_key", 1000)


@register("s9_synthetic_from_orders")
def s9_synthetic_from_orders(spark, sf):
    keys = FX.table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_key"))
    return SYN.generate(spark, keys=keys, seed=42, contamination_ratio=0.3)


@register("s10_load_or_generate")
def s10_load_or_generate(spark, sf):
    path = scratch_path(spark, "generated") + ".parquet"
    keys = FX.table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_key"))
    first = SRC.load_or_generate(spark, path, seed=42, keys=keys)   # generates and persists
    del first
    return SRC.load_or_generate(spark, path, seed=42, keys=keys)    # loads the persisted table


@register("s12_report_text", f"""SELECT printf('%-10s %-22s %.4f', section, name, value) AS value
FROM ({E17_SQL}) r""")
def s12_report_text(spark, sf):
    path = scratch_path(spark, "report") + ".txt"
    SRC.write_lines(M.report_lines(M.report_table(_eval(spark, sf))), path)
    return spark.read.text(path)


# ================================================================ T / I / H / J: models (rows-only)
import json  # noqa: E402

from saferow.operators import models as MD  # noqa: E402
from saferow.plans import jobs as J  # noqa: E402

_CACHE: dict = {}


def _prepared(spark, sf):
    """Train/test features of the samples (split .2, seed 42), fitted on train;
    cached for the session so the model queries share one feature plan."""
    key = (id(spark), sf, "prep")
    if key not in _CACHE:
        s = samples_df(spark, sf)
        parts = S.split_frames(s, "sample_key", "safety_status", 0.2, 0.0, 42, materialize=True)
        fitted = FE.FeaturePrep(scaling="standard").fit(parts["train"])
        enc = FE.label_encode(F.col("safety_status")).cast("double").alias("label")
        tr = fitted.transform(parts["train"]).select("sample_key", "features", enc).cache()
        te = fitted.transform(parts["test"]).select("sample_key", "features", enc).cache()
        _CACHE[key] = (fitted, tr, te)
    return _CACHE[key]


def _model(spark, sf, model_type, params=None, **kw):
    fitted, tr, _ = _prepared(spark, sf)
    key = (id(spark), sf, model_type, json.dumps(MD.spark_params(model_type, params or {}), sort_keys=True),
           json.dumps(kw, sort_keys=True, default=str))
    if key not in _CACHE:
        _CACHE[key] = MD.train(tr, model_type, params, feature_names=fitted.feature_names(), **kw)
    return _CACHE[key]


def _test_predictions(spark, sf, model_type):
    _, _, te = _prepared(spark, sf)
    m = _model(spark, sf, model_type)
    out = m.predict(te, keep=["sample_key", "label"])
    return out.select("sample_key", F.col("label").cast("int").alias("y"), "prediction",
                      r6(F.col("prob_1")).alias("prob_1"))


@register("t1_boosting_xgboost_preset")
def t1_boosting_xgboost_preset(spark, sf):
    return _test_predictions(spark, sf, "xgboost")


@register("t2_boosting_lightgbm_preset")
def t2_boosting_lightgbm_preset(spark, sf):
    return _test_predictions(spark, sf, "lightgbm")


@register("t3_random_forest")
def t3_random_forest(spark, sf):
    return _test_predictions(spark, sf, "random_forest")


@register("t4_logistic_regression")
def t4_logistic_regression(spark, sf):
    return _test_predictions(spark, sf, "logistic_regression")


@register("t6_sample_weight")
def t6_sample_weight(spark, sf):
    """Logistic regression with a per-row weight (2 for unsafe-labelled rows of
    odd keys, else 1) multiplied into the balanced class weights."""
    fitted, tr, te = _prepared(spark, sf)
    w = tr.withColumn("sw", F.when((F.col("label") == 1) & (F.col("sample_key") % 2 == 1), 2.0).otherwise(1.0))
    m = MD.train(w, "logistic_regression", sample_weight="sw", feature_names=fitted.feature_names())
    return m.predict(te, keep=["sample_key"]).select("sample_key", "prediction", r6(F.col("prob_1")).alias("prob_1"))


@register("t7_early_stopping")
def t7_early_stopping(spark, sf):
    """Boosting with a held-out validation indicator (every 8th training key) and
    early stopping after 10 rounds without improvement; the kept rounds and the
    test predictions of the stopped model."""
    fitted, tr, te = _prepared(spark, sf)
    data = tr.withColumn("is_val", (F.col("sample_key") % 8) == 0)
    m = MD.train(data, "xgboost", validation="is_val", feature_names=fitted.feature_names(),
                 early_stopping_rounds=10)
    out = m.predict(te, keep=["sample_key"])
    return out.select("sample_key", "prediction", r6(F.col("prob_1")).alias("prob_1"),
                      F.lit(int(m.model.getNumTrees)).alias("num_trees"))


@register("t7_cut_equals_refit", f"""WITH {_rank_sql('safety_status')}
SELECT sample_key, true AS same, true AS fewer FROM r WHERE rk < round(n * 2e-1)""")
def t7_cut_equals_refit(spark, sf):
    """The ensemble that early stopping cuts (one fit) predicts what a second fit of that many
    rounds would; a large step makes it stop early."""
    fitted, tr, te = _prepared(spark, sf)
    data = tr.withColumn("is_val", (F.col("sample_key") % 8) == 0)
    params = {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.9}
    m = MD.train(data, "xgboost", params, validation="is_val", early_stopping_rounds=2)
    k = int(m.model.getNumTrees)
    again = MD.train(data.where("NOT is_val"), "xgboost", {**params, "n_estimators": k})
    other = again.predict(te, keep=["sample_key"]).select("sample_key", F.col("prob_1").alias("other"))
    return m.predict(te, keep=["sample_key"]).join(other, "sample_key") \
        .select("sample_key", (F.abs(F.col("prob_1") - F.col("other")) < 1e-12).alias("same"), F.lit(k < 12).alias("fewer"))


@register("t11_cross_validation_facts", """SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS fold, true AS better_than_chance,
       true AS mean_agrees""", with_fixtures=False)
def t11_cross_validation_facts(spark, sf):
    """Five scores of the linear model, each above the all-unsafe guess of its fold, and their mean."""
    fitted, tr, _ = _prepared(spark, sf)
    folded = S.assign_folds(tr.withColumn("safety_status", F.col("label")), "sample_key", "safety_status", 5, 42)
    per_fold, summary = H.cross_validate(folded, "logistic_regression", k=5, metric="roc_auc")
    mean = per_fold.agg(F.avg("score").alias("m")).crossJoin(summary.select("mean_score"))  # one row each
    return per_fold.crossJoin(mean).select("fold", (F.col("score") > 0.5).alias("better_than_chance"),
                                           (F.abs(F.col("m") - F.col("mean_score")) < 1e-12).alias("mean_agrees"))


@register("t8_predict_proba")
def t8_predict_proba(spark, sf):
    _, _, te = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    out = m.predict(te, keep=["sample_key"])
    return out.select("sample_key", "prediction", r6(F.col("prob_0")).alias("prob_0"), r6(F.col("prob_1")).alias("prob_1"))


@register("t9_split_accuracy", f"""WITH {_rank_sql('safety_status')},
q AS (SELECT *, round(n * 2e-1) AS nt FROM r),
sp AS (SELECT sample_key, CASE WHEN rk < nt THEN 'test' WHEN rk < nt + round((n - nt) * (1e-1 / (1e0 - 2e-1))) THEN 'val'
        ELSE 'train' END AS split FROM q),
{SCORED_PRED}
SELECT split, round(avg(CASE WHEN y = pred THEN 1e0 ELSE 0e0 END), 6) AS accuracy
FROM sp JOIN scored_p USING (sample_key) GROUP BY split""")
def t9_split_accuracy(spark, sf):
    """T9 on the rule score: accuracy of ``p >= 0.5`` per split."""
    s = scored_df(spark, sf)
    tagged = S.assign_split(s, "sample_key", "safety_status", 0.2, 0.1, 42)
    return tagged.groupBy("split").agg(r6(F.avg((F.col("y") == F.col("pred")).cast("double"))).alias("accuracy"))


@register("t10_model_evaluation")
def t10_model_evaluation(spark, sf):
    pred = _test_predictions(spark, sf, "logistic_regression")
    return M.evaluate(pred, "y", "prediction", "prob_1").metrics


@register("t11_cross_validation")
def t11_cross_validation(spark, sf):
    fitted, tr, _ = _prepared(spark, sf)
    folded = S.assign_folds(tr.withColumn("safety_status", F.col("label")), "sample_key", "safety_status", 5, 42)
    per_fold, summary = H.cross_validate(folded, "logistic_regression", k=5, metric="f1")
    return per_fold.select("fold", r6(F.col("score")).alias("score"))


@register("t12_feature_importance")
def t12_feature_importance(spark, sf):
    return _model(spark, sf, "xgboost").feature_importance(20)


@register("t13_model_save_load")
def t13_model_save_load(spark, sf):
    _, _, te = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    path = scratch_path(spark, "model")
    m.save(path)
    back = MD.TrainedModel.load(path)
    return back.predict(te, keep=["sample_key"]).select("sample_key", "prediction")


@register("h3_tune_logistic")
def h3_tune_logistic(spark, sf):
    """H2-H5: 10 random-search trials of the linear model, 5-fold CV on train."""
    fitted, tr, _ = _prepared(spark, sf)
    folded = S.assign_folds(tr.withColumn("safety_status", F.col("label")), "sample_key", "safety_status", 5, 42)
    trials, best, score = H.tune(folded, "logistic_regression", n_trials=10, k=5, metric="f1", parallelism=8)
    return trials.select("trial_number", F.col("params").cast("string").alias("params"), r6(F.col("score")).alias("score"))


@register("i2_score_table")
def i2_score_table(spark, sf):
    fitted, _, _ = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    return I.score(samples_df(spark, sf), m, fitted, keep=["sample_key"])


@register("i5_numeric_only_scoring")
def i5_numeric_only_scoring(spark, sf):
    """Scoring without a feature preparation: the numeric columns of the cleaned
    samples are the feature vector of a model trained the same way."""
    from pyspark.ml.feature import VectorAssembler
    s = Q.clean(samples_df(spark, sf), fill_missing="median")
    va = VectorAssembler(inputCols=NUM, outputCol="features")
    tr = va.transform(s).withColumn("label", FE.label_encode(F.col("safety_status")).cast("double"))
    m = MD.train(tr, "logistic_regression")
    return I.score(s, m, None, keep=["sample_key"])


@register("i6_score_batch")
def i6_score_batch(spark, sf):
    fitted, _, _ = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    out, bad = I.score_batch(samples_df(spark, sf), m, fitted, "sample_key", model_path="in-memory", batch_size=1000)
    return out.drop("prediction_timestamp")


@register("i6_score_batch_ids", """SELECT sample_key, row_number() OVER (ORDER BY sample_key) - 1 AS sample_id,
          (row_number() OVER (ORDER BY sample_key) - 1) // 1000 + 1 AS batch_id FROM samples""")
def i6_score_batch_ids(spark, sf):
    """The scored batch holds every row of an unlabelled table, with its ids."""
    fitted, _, _ = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    out, _ = I.score_batch(samples_df(spark, sf).drop(SPEC.target), m, fitted, "sample_key", batch_size=1000)
    return out.where("prediction IN ('safe', 'unsafe') AND abs(prob_safe + prob_unsafe - 1) < 1e-9") \
        .select("sample_key", "sample_id", "batch_id")


@register("i8_explain_predictions")
def i8_explain_predictions(spark, sf):
    fitted, _, _ = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    s = samples_df(spark, sf)
    scored = I.score(s, m, fitted, keep=[c for c in s.columns if c != SPEC.target])
    return I.explain(scored, F.col("prediction"), F.col("confidence"), keep=["sample_key"])


@register("j4_full_run_logistic")
def j4_full_run_logistic(spark, sf):
    """Preprocess, train (no search), evaluate, summary row."""
    out = scratch_path(spark, "run")
    summary = J.full_run(samples_df(spark, sf), out, model_type="logistic_regression", tune=False)
    return summary.drop("preprocess_sec", "train_sec", "evaluate_sec", "total_sec", "output_dir")


@register("j5_reload_run")
def j5_reload_run(spark, sf):
    """Run, reload the saved preprocessor and model, score the test split."""
    out = scratch_path(spark, "run")
    J.full_run(samples_df(spark, sf), out, model_type="logistic_regression", tune=False)
    fitted, model, summary = J.load_run(spark, out)
    return I.score(samples_df(spark, sf), model, fitted, keep=["sample_key"])


@register("i6_stream_score_chunks")
def i6_stream_score_chunks(spark, sf):
    """I6/I7 as a stream: the samples written as 4 CSV chunks, scored one chunk
    per micro-batch by the fitted features + linear model."""
    from saferow.streaming.scoring import read_scored, stream_score
    fitted, _, _ = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    src = scratch_path(spark, "stream-in")
    samples_df(spark, sf).repartition(4, "sample_key").write.option("header", True).csv(src)
    out = scratch_path(spark, "stream-out")
    q = stream_score(spark, src, SAMPLES_SCHEMA, m, fitted, out, files_per_batch=1)
    q.awaitTermination()
    return read_scored(spark, out).select("sample_key", "batch_id", "prediction", "risk_codes", "recommendation")


def _scored_chunks(spark, sf, broken: Optional[int] = None, headless: Optional[int] = None):
    """The samples in key order as 6 CSV chunks, streamed one a micro-batch; chunk ``broken`` is
    a damaged gzip file, chunk ``headless`` has other columns.  Gives the output folder."""
    from saferow.operators.ranks import row_index
    from saferow.streaming.scoring import finish, stream_score
    fitted, _, _ = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    numbered = row_index(samples_df(spark, sf), ["sample_key"], out="_at")
    total = numbered.count()
    src, out = scratch_path(spark, "chunks-in"), scratch_path(spark, "chunks-out")
    for k in range(6):  # one write each: the stream takes files by age
        part = numbered.where((F.col("_at") * 6 >= k * total) & (F.col("_at") * 6 < (k + 1) * total)).drop("_at")
        part = part.withColumnRenamed("ph_level", "acidity") if k + 1 == headless else part
        # gathered by a shuffle: the table is scanned by many tasks, one writes its chunk
        part.repartition(1).write.option("header", True).csv(f"{src}/chunk={k}")
        if k + 1 == broken:
            jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
            folder = jvm.org.apache.hadoop.fs.Path(f"{src}/chunk={k}")
            folder.getFileSystem(conf).delete(folder, True)
            _damaged(spark, f"{src}/chunk={k}/part-0.csv.gz")
    finish(spark, stream_score(spark, f"{src}/chunk=*", SAMPLES_SCHEMA, m, fitted, out, files_per_batch=1), out)
    return out


_CHUNKS = """c AS (SELECT *, CAST(floor(pos * 6 / n) AS BIGINT) + 1 AS chunk FROM
  (SELECT sample_key, row_number() OVER (ORDER BY sample_key) - 1 AS pos, count(*) OVER () AS n FROM samples) s)"""


@register("i6_stream_sample_ids", f"""WITH {_CHUNKS} SELECT sample_key, pos AS sample_id, chunk AS batch_id FROM c""")
def i6_stream_sample_ids(spark, sf):
    """Sample ids that run over the chunks of a stream equal those of the whole table."""
    from saferow.streaming.scoring import read_scored
    return read_scored(spark, _scored_chunks(spark, sf)).select("sample_key", "sample_id", F.col("batch_id").cast("long").alias("batch_id"))


@register("i7_skipped_chunks", f"""WITH {_CHUNKS}
SELECT batch_id, status, CAST(n_rows AS BIGINT) AS n_rows,
       CAST(coalesce(sum(n_rows) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
         AS first_sample_id, CASE WHEN status = 'scored' THEN n_rows ELSE 0 END AS scored_rows
FROM (SELECT chunk AS batch_id, CASE WHEN chunk IN (2, 5) THEN 'failed' ELSE 'scored' END AS status,
             CASE WHEN chunk IN (2, 5) THEN 0 ELSE count(*) END AS n_rows FROM c GROUP BY chunk) g""")
def i7_skipped_chunks(spark, sf):
    """The ledger of a stream in which chunk 2 cannot be read and chunk 5 lacks a column; the rest
    is scored and the two batch ids stay unused."""
    from saferow.streaming.scoring import read_ledger, read_scored
    out = _scored_chunks(spark, sf, broken=2, headless=5)
    rows = read_scored(spark, out).groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(F.count("*").alias("scored_rows"))
    return read_ledger(spark, out).join(rows, "batch_id", "left") \
        .select("batch_id", "status", "n_rows", "first_sample_id", F.coalesce("scored_rows", F.lit(0)).alias("scored_rows"))


@register("f15_features_save_load", _std_sql())
def f15_features_save_load(spark, sf):
    """the fitted preparation saved with Spark ML writers, loaded back and
    applied; its numeric outputs equal the standard-scaled columns."""
    s, fitted = _fit(spark, sf, "standard")
    path = scratch_path(spark, "prep")
    fitted.save(path)
    back = FE.FittedFeatures.load(path)
    out = back.transform(s)
    return out.select("sample_key", *[r6(F.col(f"{FE.NUM_PREFIX}{c}")).alias(c) for c in NUM])


@register("j1_preprocess_job", f"""WITH {_rank_sql('safety_status')},
q AS (SELECT *, round(n * 2e-1) AS nt FROM r),
sp AS (SELECT CASE WHEN rk < nt THEN 'test' WHEN rk < nt + round((n - nt) * (1e-1 / (1e0 - 2e-1))) THEN 'val'
        ELSE 'train' END AS split FROM q)
SELECT split, count(*) AS n FROM sp GROUP BY split""")
def j1_preprocess_job(spark, sf):
    """Split .2/.1, fit on train, transform and save every split; the saved
    feature table's split sizes."""
    out = scratch_path(spark, "prep-job")
    prep = J.preprocess(samples_df(spark, sf), out)
    feats = spark.read.parquet(out + "/features")
    del prep
    return feats.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("j3_evaluate_job")
def j3_evaluate_job(spark, sf):
    """Evaluate a trained model on the saved test split; the report table."""
    out = scratch_path(spark, "eval-job")
    prep = J.preprocess(samples_df(spark, sf), out)
    model = MD.train(prep.train, "logistic_regression", feature_names=prep.features.feature_names())
    ev = J.evaluate_job(prep, model, out)
    return ev["report"]


@register("j2_train_job_with_search")
def j2_train_job_with_search(spark, sf):
    """The preprocessed train split, 5-fold random search of the linear
    model (5 trials), refit with the best parameters, save; the trials table."""
    out = scratch_path(spark, "train-job")
    prep = J.preprocess(samples_df(spark, sf), out)
    model, trials = J.train_job(prep, out, "logistic_regression", tune=True, n_trials=5, cv_folds=5)
    del model
    return trials.select("trial_number", F.col("params").cast("string").alias("params"),
                         r6(F.col("score")).alias("score"))


# ================================================================ facts about models and jobs that SQL can state
#: The test rows of the split with their labels: what every model must answer for.
TEST_ROWS = f"""{_rank_sql('safety_status')},
q AS (SELECT *, round(n * 2e-1) AS nt FROM r),
test_rows AS (SELECT s.sample_key, CASE WHEN s.safety_status = 'unsafe' THEN 1 ELSE 0 END AS y
  FROM q JOIN samples s USING (sample_key) WHERE q.rk < q.nt)"""


def _register_prediction_facts(query: str, model_type: str) -> None:
    @register(f"{query}_prediction_facts", f"""WITH {TEST_ROWS}
SELECT sample_key, y, true AS sums_to_one, true AS agrees FROM test_rows""")
    def facts(spark, sf):
        """Each test row once, its probabilities sum to 1 and the larger one is the prediction."""
        _, _, te = _prepared(spark, sf)
        out = _model(spark, sf, model_type).predict(te, keep=["sample_key", "label"])
        larger = F.when(F.col("prob_0") == F.col("prob_1"), F.col("prediction")) \
            .otherwise((F.col("prob_1") > F.col("prob_0")).cast("int"))
        return out.select("sample_key", F.col("label").cast("int").alias("y"),
                          (F.abs(F.col("prob_0") + F.col("prob_1") - 1) < 1e-9).alias("sums_to_one"),
                          (F.col("prediction") == larger).alias("agrees"))


for _query, _type in (("t1", "xgboost"), ("t2", "lightgbm"), ("t3", "random_forest"), ("t4", "logistic_regression")):
    _register_prediction_facts(_query, _type)


def _same_answers(a, b):
    """Per row of ``a`` whether ``b`` gives the same prediction and probability."""
    b = b.select("sample_key", F.col("prediction").alias("other"), F.col("prob_1").alias("other_prob"))
    return a.join(b, "sample_key", "left").select(
        "sample_key", F.coalesce((F.abs(F.col("prob_1") - F.col("other_prob")) < 1e-4)
                                 & ((F.col("prediction") == F.col("other"))
                                    | (F.abs(F.col("prob_1") - 0.5) < 1e-4)), F.lit(False)).alias("same"))


@register("t6_weight_equivalence", f"WITH {TEST_ROWS} SELECT sample_key, true AS same FROM test_rows")
def t6_weight_equivalence(spark, sf):
    """Weight 5 on every row with C = .01 fits the same model as weight 1 with C = .05."""
    _, tr, te = _prepared(spark, sf)
    answers = []
    for w, c in ((5.0, 0.01), (1.0, 0.05)):
        m = MD.train(tr.withColumn("sw", F.lit(w)), "logistic_regression", {"C": c, "tol": 1e-9},
                     class_weight=None, sample_weight="sw")
        answers.append(m.predict(te, keep=["sample_key"]))
    return _same_answers(*answers)


@register("t13_reload_equals", f"WITH {TEST_ROWS} SELECT sample_key, true AS same FROM test_rows")
def t13_reload_equals(spark, sf):
    """A saved and reloaded model answers every test row as before."""
    _, _, te = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    path = scratch_path(spark, "model")
    m.save(path)
    return _same_answers(m.predict(te, keep=["sample_key"]), MD.TrainedModel.load(path).predict(te, keep=["sample_key"]))


@register("j4_split_counts", f"""WITH {_rank_sql('safety_status')},
q AS (SELECT *, round(n * 2e-1) AS nt FROM r),
sp AS (SELECT CASE WHEN rk < nt THEN 'test' WHEN rk < nt + round((n - nt) * (1e-1 / (1e0 - 2e-1))) THEN 'val'
        ELSE 'train' END AS split FROM q)
SELECT 'logistic_regression' AS model_type, false AS tuned, count(*) FILTER (split = 'train') AS n_train,
  count(*) FILTER (split = 'val') AS n_val, count(*) FILTER (split = 'test') AS n_test FROM sp""")
def j4_split_counts(spark, sf):
    """The summary of a full run names the model and the exact split sizes."""
    summary = J.full_run(samples_df(spark, sf), scratch_path(spark, "run"), model_type="logistic_regression", tune=False)
    return summary.select("model_type", "tuned", "n_train", "n_val", "n_test")


@register("i6_stream_equals_batch", "SELECT sample_key, true AS same FROM samples")
def i6_stream_equals_batch(spark, sf):
    """The stream and the batch job answer every sample alike."""
    fitted, _, _ = _prepared(spark, sf)
    m = _model(spark, sf, "logistic_regression")
    batch, _ = I.score_batch(samples_df(spark, sf), m, fitted, "sample_key")
    batch = batch.select("sample_key", F.col("prediction").alias("other"))
    return i6_stream_score_chunks(spark, sf).select("sample_key", "prediction").join(batch, "sample_key", "left") \
        .select("sample_key", F.coalesce(F.col("prediction") == F.col("other"), F.lit(False)).alias("same"))


@register("t10_evaluation_facts", f"""WITH {TEST_ROWS}
SELECT count(*) FILTER (y = 0) AS n_safe, count(*) FILTER (y = 1) AS n_unsafe, true AS accuracy_agrees,
       true AS recall_agrees, true AS auc_above_chance FROM test_rows""")
def t10_evaluation_facts(spark, sf):
    """The confusion matrix of the linear model holds every test row; accuracy and recall
    equal plain averages over the predictions."""
    pred = _test_predictions(spark, sf, "logistic_regression")
    ev = M.evaluate(pred, "y", "prediction", "prob_1")
    right = (F.col("y") == F.col("prediction")).cast("double")
    plain = pred.agg(F.avg(right).alias("accuracy_"), F.avg(F.when(F.col("y") == 1, right)).alias("recall_"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-5
    one = ev.metrics.crossJoin(plain).crossJoin(ev.roc_auc.select("roc_auc"))  # one row each
    return one.select((F.col("tn") + F.col("fp")).alias("n_safe"), (F.col("fn") + F.col("tp")).alias("n_unsafe"),
                      near("accuracy", "accuracy_").alias("accuracy_agrees"), near("recall", "recall_").alias("recall_agrees"),
                      (F.col("roc_auc") > 0.5).alias("auc_above_chance"))


def _train_names_sql() -> str:
    """Names of the features that the train rows give: numerics, then every category."""
    num = ", ".join(f"('{c}')" for c in NUM)
    cats = " UNION ALL ".join(f"SELECT DISTINCT '{c}_' || coalesce({c}, '{FE.MISSING}') AS feature FROM train_rows" for c in SPEC.categorical_features)
    return f"""WITH {_rank_sql('safety_status')},
train_rows AS (SELECT s.* FROM r JOIN samples s USING (sample_key) WHERE rk >= round(n * 2e-1)),
names AS (SELECT * FROM (VALUES {num}) t(feature) UNION ALL {cats})"""


@register("t12_importance_facts", f"""{_train_names_sql()}
SELECT feature, true AS legal, true AS sums_to_one, true AS ordered FROM names""")
def t12_importance_facts(spark, sf):
    """Tree importances name every feature once, are not negative and sum to 1; a shorter list
    is the head of the full one."""
    m = _model(spark, sf, "random_forest")
    full = m.feature_importance(len(m.feature_names))
    total = full.agg(F.sum("importance").alias("total"))
    head = [tuple(r) for r in m.feature_importance(5).collect()]  # a top-5 report
    same = head == [tuple(r) for r in full.limit(5).collect()]
    return full.crossJoin(total).select("feature", (F.col("importance") >= 0).alias("legal"),  # one row of totals
                                        (F.abs(F.col("total") - 1) < 1e-6).alias("sums_to_one"), F.lit(same).alias("ordered"))


@register("h3_trial_facts", """SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS trial_number, true AS in_space, true AS is_share,
       true AS equals_own_cv""", with_fixtures=False)
def h3_trial_facts(spark, sf):
    """H2-H5: six trials inside the search space; the best one's score is the mean of its own
    cross-validation."""
    fitted, tr, _ = _prepared(spark, sf)
    folded = S.assign_folds(tr.withColumn("safety_status", F.col("label")), "sample_key", "safety_status", 3, 42)
    trials, best, score = H.tune(folded, "logistic_regression", n_trials=6, k=3, metric="accuracy", parallelism=4)
    _, summary = H.cross_validate(folded, "logistic_regression", best, k=3, metric="accuracy")
    agrees = abs(summary.first()["mean_score"] - score) < 1e-9
    space = H.search_space("logistic_regression")
    c = F.col("params")["C"].cast("double")
    return trials.select("trial_number", (c.between(*space["C"]) & F.col("params")["penalty"].isin(*space["penalty"])).alias("in_space"),
                         F.col("score").between(0, 1).alias("is_share"),
                         (F.lit(agrees) & (F.col("score") <= score)).alias("equals_own_cv"))


@register("j2_tuned_boosting_facts", f"""WITH {_rank_sql('safety_status')},
q AS (SELECT *, round(n * 2e-1) AS nt FROM r)
SELECT sample_key, true AS same, true AS best_of_trials, true AS within_rounds FROM q
WHERE rk >= nt AND rk < nt + round((n - nt) * (1e-1 / (1e0 - 2e-1)))""")
def j2_tuned_boosting_facts(spark, sf):
    """A searched boosting run with early stopping on the validation split; the saved model answers
    every validation row like the one returned, its parameters are those of the best trial."""
    out = scratch_path(spark, "boosting-job")
    prep = J.preprocess(samples_df(spark, sf), out)
    space = {"n_estimators": (4, 8), "max_depth": (2, 3), "learning_rate": (0.1, 0.9)}
    model, trials = J.train_job(prep, out, "xgboost", tune=True, n_trials=2, cv_folds=2, space=space, early_stopping_rounds=2)
    top = trials.orderBy(F.desc("score"), "trial_number").first()["params"]
    best = all(str(model.params[k]) == v for k, v in top.items())
    rounds = 1 <= int(model.model.getNumTrees) <= int(top["n_estimators"])
    back = MD.TrainedModel.load(f"{out}/model")
    answers = _same_answers(model.predict(prep.val, keep=["sample_key"]), back.predict(prep.val, keep=["sample_key"]))
    return answers.withColumn("best_of_trials", F.lit(best)).withColumn("within_rounds", F.lit(rounds))


@register("j3_evaluation_facts", f"""WITH {TEST_ROWS}
SELECT y, count(*) AS support, true AS saved_whole FROM test_rows GROUP BY y""")
def j3_evaluation_facts(spark, sf):
    """The saved predictions hold each test row once, the saved report its classes."""
    out = scratch_path(spark, "eval-facts")
    prep = J.preprocess(samples_df(spark, sf), out)
    model = MD.train(prep.train, "logistic_regression", feature_names=prep.features.feature_names())
    J.evaluate_job(prep, model, out)
    support = spark.read.parquet(f"{out}/evaluation/per_class").where(F.col("label").isin(*SPEC.class_names)) \
        .select(FE.label_encode(F.col("label")).alias("y"), "support")
    rows = spark.read.parquet(f"{out}/predictions").groupBy("y").agg(F.count_distinct("sample_key").alias("n"))
    return support.join(rows, "y", "left").select("y", "support", F.coalesce(F.col("n") == F.col("support"), F.lit(False)).alias("saved_whole"))


@register("j5_reload_equals", f"WITH {TEST_ROWS} SELECT sample_key, true AS same FROM test_rows")
def j5_reload_equals(spark, sf):
    """The reloaded preparation and model answer every test row of the raw table as the run saved it."""
    out = scratch_path(spark, "reload-run")
    J.full_run(samples_df(spark, sf), out, model_type="logistic_regression", tune=False)
    fitted, model, _ = J.load_run(spark, out)
    again = I.score(samples_df(spark, sf), model, fitted, keep=["sample_key"]) \
        .select("sample_key", F.col("prob_unsafe").alias("other"))
    return spark.read.parquet(f"{out}/predictions").join(again, "sample_key", "left") \
        .select("sample_key", F.coalesce(F.abs(F.col("p") - F.col("other")) < 1e-9, F.lit(False)).alias("same"))


@register("i5_scoring_facts", f"""SELECT sample_key, {" AND ".join(f"{c} IS NOT NULL" for c in NUM)} AS answered FROM samples""")
def i5_scoring_facts(spark, sf):
    """Scoring by the numeric columns alone answers exactly the rows without a missing cell."""
    from pyspark.ml.feature import VectorAssembler
    filled = Q.clean(samples_df(spark, sf), fill_missing="median")
    train = VectorAssembler(inputCols=NUM, outputCol="features").transform(filled) \
        .withColumn("label", FE.label_encode(F.col("safety_status")).cast("double"))
    out = I.score(samples_df(spark, sf), MD.train(train, "logistic_regression"), None, keep=["sample_key"])
    legal = F.col("prediction").isin(*SPEC.class_names) & (F.abs(F.col("prob_safe") + F.col("prob_unsafe") - 1) < 1e-9)
    return out.select("sample_key", F.coalesce(legal, F.lit(False)).alias("answered"))


@register("s9_synthetic_facts", """SELECT o_orderkey AS sample_key, true AS in_range, true AS in_domain, true AS labelled
FROM orders""", with_fixtures=False)
def s9_synthetic_facts(spark, sf):
    """One generated sample per key; cells (counts scaled as outliers apart) and categories are legal."""
    s = s9_synthetic_from_orders(spark, sf)
    legal = [F.col(c).isNull() | ((F.col(c) >= lo) & ((F.col(c) <= hi) if hi is not None else F.lit(True)))
             for c, (lo, hi) in SPEC.numeric_ranges.items() if c not in ("total_plate_count", "coliform_count")]
    known = [F.lower(c).isin(*dom) for c, dom in SPEC.categorical_domains.items()]
    both = lambda conds: F.forall(F.array(*conds), lambda x: x)
    return s.select("sample_key", both(legal).alias("in_range"), both(known).alias("in_domain"),
                    F.col("safety_status").isin(*SPEC.class_names).alias("labelled"))
