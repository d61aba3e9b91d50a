"""Binary classification metrics as DataFrames.

Inputs are a table with a 0/1 label column, a 0/1 prediction column and
(optionally) a positive-class probability column.  Everything is computed by
aggregates:

* point metrics (E3-E6, E11, E16) from ONE four-count aggregate;
* curves and AUC (E7-E10) from the table of distinct scores, with global
  running sums by :func:`saferow.operators.ranks.prefix_agg` (range
  partitioned, never a single-task window over rows);
* the threshold sweep (E12) from a 101-bucket count table, never a rows x
  thresholds product.
"""

from __future__ import annotations

from functools import cached_property
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saferow.functions.exprs import r6, safe_div, zero_div
from saferow.operators.ranks import prefix_agg

INF = float("inf")


# ------------------------------------------------------------------ E1 / E2
def encode_labels(c: Column, class_names: Sequence[str] = ("safe", "unsafe")) -> Column:
    """Label -> its position in ``class_names``; unknown or missing -> 0."""
    m = F.create_map(*[x for i, n in enumerate(class_names) for x in (F.lit(n), F.lit(i))])
    return F.coalesce(m[c], F.lit(0)).cast("int")


def apply_threshold(pred: Column, proba: Optional[Column], threshold: float = 0.5) -> Column:
    """``proba >= threshold`` replaces the given prediction when t != 0.5."""
    if proba is not None and threshold != 0.5:
        return (proba >= F.lit(threshold)).cast("int")
    return pred.cast("int")


# ------------------------------------------------------------------ E3-E6
def _confusion_counts(y: Column, pred: Column) -> list[Column]:
    def cnt(cond: Column) -> Column:
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0)).cast("long")

    return [cnt((y == 0) & (pred == 0)).alias("tn"), cnt((y == 0) & (pred == 1)).alias("fp"),
            cnt((y == 1) & (pred == 0)).alias("fn"), cnt((y == 1) & (pred == 1)).alias("tp")]


def confusion(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """The 2x2 matrix as one row (tn, fp, fn, tp), also when a class is absent."""
    return df.agg(*_confusion_counts(F.col(y), F.col(pred)))


def _point_metric_cols() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    # Matthews correlation in covariance form; 0 when a marginal is degenerate
    t0, t1, p0, p1 = tn + fp, fn + tp, tn + fn, fp + tp
    cov_tp = (tp + tn) * n - (t0 * p0 + t1 * p1)
    cov_pp = n * n - (p0 * p0 + p1 * p1)
    cov_tt = n * n - (t0 * t0 + t1 * t1)
    mcc = F.when(cov_pp * cov_tt == 0, F.lit(0.0)).otherwise(cov_tp / F.sqrt(cov_tt * cov_pp))
    # Cohen's kappa: 1 - observed disagreement / expected disagreement
    expected_off = safe_div(p0 * t1 + p1 * t0, n)
    kappa = F.lit(1.0) - safe_div(fp + fn, expected_off)
    return {
        "accuracy": zero_div(tp + tn, n),
        "precision": zero_div(tp, tp + fp),
        "recall": zero_div(tp, tp + fn),
        "f1_score": zero_div(2 * tp, 2 * tp + fp + fn),
        "matthews_corrcoef": mcc,
        "cohen_kappa": kappa,
    }


def point_metrics(cm: DataFrame) -> DataFrame:
    """E4-E6 from a confusion row: accuracy, precision, recall, F1 of class 1
    (0 on zero division), Matthews correlation, Cohen's kappa."""
    cols = _point_metric_cols()
    return cm.select("tn", "fp", "fn", "tp", *[r6(v).alias(k) for k, v in cols.items()])


def classification_report(cm: DataFrame, class_names: Sequence[str] = ("safe", "unsafe")) -> DataFrame:
    """Per-class precision/recall/F1/support, then accuracy, macro and
    weighted averages (label, precision, recall, f1_score, support)."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    p0, r0, f0 = zero_div(tn, tn + fn), zero_div(tn, tn + fp), zero_div(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = zero_div(tp, tp + fp), zero_div(tp, tp + fn), zero_div(2 * tp, 2 * tp + fp + fn)
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    acc = zero_div(tp + tn, n)
    wavg = lambda a, b: zero_div(a * s0 + b * s1, n)
    rows = F.array(
        F.struct(F.lit(class_names[0]).alias("label"), p0.alias("precision"), r0.alias("recall"),
                 f0.alias("f1_score"), s0.alias("support")),
        F.struct(F.lit(class_names[1]).alias("label"), p1.alias("precision"), r1.alias("recall"),
                 f1.alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), wavg(p0, p1).alias("precision"),
                 wavg(r0, r1).alias("recall"), wavg(f0, f1).alias("f1_score"), n.alias("support")),
    )
    return (cm.select(F.inline(rows))
            .select("label", r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"),
                    r6(F.col("f1_score")).alias("f1_score"), F.col("support").cast("long").alias("support")))


# ------------------------------------------------------------------ E7-E10 curves
def score_counts(df: DataFrame, y: str = "y", proba: str = "p", pred: Optional[str] = None) -> DataFrame:
    """Rows per distinct score (NULL included) and class: threshold, pos, neg; with
    ``pred`` also the four confusion counts."""
    aggs = [F.sum((F.col(y) == 1).cast("long")).alias("pos"), F.sum((F.col(y) != 1).cast("long")).alias("neg")]
    if pred:
        aggs += _confusion_counts(F.col(y), F.col(pred))
    return df.groupBy(F.col(proba).alias("threshold")).agg(*aggs)


def running_points(counts: DataFrame, n_parts: int | None = None) -> DataFrame:
    """:func:`score_points` from the table of :func:`score_counts`."""
    pts = (counts.where(F.col("threshold").isNotNull()).select("threshold", "pos", "neg")
           .withColumn("one", F.lit(1).cast("long")))
    cum = prefix_agg(pts, ["threshold"], {"pos": "sum", "neg": "sum", "one": "sum"},
                     n_buckets=n_parts, descending=True)
    return cum.select("threshold", "pos", "neg", F.col("pos_cum").alias("tps"),
                      F.col("neg_cum").alias("fps"), (F.col("one_cum") - 1).alias("idx"))


def score_points(df: DataFrame, y: str = "y", proba: str = "p",
                 n_parts: int | None = None) -> DataFrame:
    """Distinct scores in descending order with cumulative counts.

    Columns: threshold, pos, neg, tps, fps (counts at or above the threshold),
    idx (0-based position).  The group-by pre-aggregates rows to distinct scores;
    the running sums are a range-partitioned prefix sum.
    """
    return running_points(score_counts(df, y, proba), n_parts)


def class_totals(df: DataFrame, y: str = "y", proba: str = "p",
                 points: Optional[DataFrame] = None) -> tuple[int, int]:
    """(P, N): positive and negative rows with a score; one aggregate, two scalars
    (from the distinct-score table when it is at hand)."""
    if points is not None:
        row = points.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("P"),
                         F.coalesce(F.sum("neg"), F.lit(0)).alias("N")).first()
    else:
        row = (df.where(F.col(proba).isNotNull())
               .agg(F.coalesce(F.sum((F.col(y) == 1).cast("long")), F.lit(0)).alias("P"),
                    F.coalesce(F.sum((F.col(y) != 1).cast("long")), F.lit(0)).alias("N")).first())
    return int(row["P"]), int(row["N"])


def materialised_points(df: DataFrame, y: str = "y", proba: str = "p") -> DataFrame:
    """The distinct-score table, computed once and cut from its lineage with a
    reliable checkpoint (to ``spark.checkpoint.dir``), so the curves, the AUC
    and the totals read it instead of re-aggregating the scored table."""
    from saferow.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return score_points(df, y, proba).checkpoint(eager=True)


def roc_auc(df: DataFrame, y: str = "y", proba: str = "p", points: Optional[DataFrame] = None) -> DataFrame:
    """ROC AUC with tied scores at half weight; NULL for a single class."""
    pts = points if points is not None else score_points(df, y, proba)
    area = F.sum(F.col("neg") * (F.col("tps") - F.col("pos") / 2.0))
    total = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return pts.agg(r6(safe_div(area, total)).alias("roc_auc"))


def roc_curve(df: DataFrame, y: str = "y", proba: str = "p", drop_intermediate: bool = True,
              points: Optional[DataFrame] = None) -> DataFrame:
    """ROC points at distinct scores, descending, with a first point at an
    infinite threshold; points collinear with both neighbours are dropped.

    Columns: threshold, fps, tps, fpr, tpr.  The neighbour test uses the integer
    second differences of the running counts (equi-joins on the point index).
    """
    pts = points if points is not None else materialised_points(df, y, proba)
    P, N = class_totals(df, y, proba, pts)
    if drop_intermediate:
        prev = pts.select((F.col("idx") + 1).alias("idx"), F.col("fps").alias("fps_prev"),
                          F.col("tps").alias("tps_prev"))
        nxt = pts.select((F.col("idx") - 1).alias("idx"), F.col("fps").alias("fps_next"),
                         F.col("tps").alias("tps_next"))
        nb = pts.join(prev, "idx", "left").join(nxt, "idx", "left")
        corner = ((F.col("fps_next") - 2 * F.col("fps") + F.col("fps_prev") != 0)
                  | (F.col("tps_next") - 2 * F.col("tps") + F.col("tps_prev") != 0))
        keep = F.col("fps_prev").isNull() | F.col("fps_next").isNull() | corner
        pts = nb.where(keep)
    spark = df.sparkSession
    first = spark.createDataFrame([(INF, 0, 0)], "threshold double, fps long, tps long")
    allp = pts.select("threshold", "fps", "tps").unionByName(first)
    return allp.select("threshold", "fps", "tps",
                       r6(safe_div(F.col("fps"), F.lit(N))).alias("fpr"),
                       r6(safe_div(F.col("tps"), F.lit(P))).alias("tpr"))


def pr_curve(df: DataFrame, y: str = "y", proba: str = "p", points: Optional[DataFrame] = None) -> DataFrame:
    """Precision / recall at each distinct score (ascending thresholds) plus the
    closing point precision 1, recall 0 with a NULL threshold.

    Columns: threshold, precision, recall.  Recall is 1 everywhere when there is
    no positive row.
    """
    pts = points if points is not None else materialised_points(df, y, proba)
    P, _ = class_totals(df, y, proba, pts)
    prec = zero_div(F.col("tps"), F.col("tps") + F.col("fps"))
    rec = F.lit(1.0) if P == 0 else safe_div(F.col("tps"), F.lit(P))
    out = pts.select(F.col("threshold"), r6(prec).alias("precision"), r6(rec).alias("recall"))
    close = df.sparkSession.createDataFrame([(None, 1.0, 0.0)],
                                            "threshold double, precision double, recall double")
    return out.unionByName(close)


def _wide(count: Column) -> Column:
    """A count whose products do not overflow a long."""
    return count.cast("decimal(18,0)")


def youden_threshold(df: DataFrame, y: str = "y", proba: str = "p",
                     points: Optional[DataFrame] = None) -> DataFrame:
    """The ROC threshold maximising tpr - fpr; the first (highest threshold)
    on ties.  Compared as integers tps*N - fps*P, so float ties cannot flip it."""
    pts = points if points is not None else materialised_points(df, y, proba)
    P, N = class_totals(df, y, proba, pts)
    roc = roc_curve(df, y, proba, points=pts)
    best = roc.agg(F.max(F.struct((_wide(F.col("tps")) * _wide(F.lit(N)) - _wide(F.col("fps")) * _wide(F.lit(P))).alias("jint"),
                                  F.col("threshold").alias("threshold"),
                                  (F.col("tpr") - F.col("fpr")).alias("j"))).alias("b"))
    return best.select(F.col("b.threshold").alias("optimal_threshold"), r6(F.col("b.j")).alias("youden_j"))


# ------------------------------------------------------------------ E12 sweep
SWEEP_N = 100
SWEEP_LO, SWEEP_HI = 0.01, 0.99
SWEEP_STEP = (SWEEP_HI - SWEEP_LO) / (SWEEP_N - 1)


def sweep_threshold(k: Column) -> Column:
    """Threshold k of 100 evenly spaced in [0.01, 0.99] (k*step + lo, last = hi)."""
    return F.when(k >= SWEEP_N - 1, F.lit(SWEEP_HI)).otherwise(k.cast("double") * F.lit(SWEEP_STEP)
                                                                + F.lit(SWEEP_LO))


def thresholds_passed(p: Column) -> Column:
    """Number of sweep thresholds t with t <= p (0..100), exact at the edges."""
    c = F.least(F.greatest(F.floor((p - F.lit(SWEEP_LO)) / F.lit(SWEEP_STEP)), F.lit(-1)),
                F.lit(SWEEP_N - 1)).cast("int")
    up = F.when((c + 1 <= SWEEP_N - 1) & (sweep_threshold(c + 1) <= p), 1).otherwise(0)
    down = F.when((c >= 0) & (sweep_threshold(c) > p), 1).otherwise(0)
    return F.coalesce(c + 1 + up - down, F.lit(0))


def threshold_sweep(df: DataFrame, y: str = "y", proba: str = "p") -> DataFrame:
    """E12 table: for each of the 100 thresholds the confusion counts and the
    f1, precision, recall and youden scores (k, threshold, tp, fp, fn, tn, ...).

    Rows are counted per number of thresholds passed (101 buckets); suffix sums
    over those buckets give every threshold's counts.
    """
    spark = df.sparkSession
    counts = (df.groupBy(thresholds_passed(F.col(proba)).alias("m"))
              .agg(F.sum((F.col(y) == 1).cast("long")).alias("pos"),
                   F.sum((F.col(y) != 1).cast("long")).alias("neg")))
    dense = (spark.range(SWEEP_N + 1).select(F.col("id").cast("int").alias("m"))
             .join(counts, "m", "left").fillna(0, ["pos", "neg"]))
    # 101 rows: a single-task window over a table of fixed size
    w = Window.orderBy(F.col("m").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(F.lit(0))
    suf = dense.select("m", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                       F.sum("pos").over(w_all).alias("P"), F.sum("neg").over(w_all).alias("N"))
    k = F.col("m") - 1
    t = suf.where(F.col("m") >= 1).select(
        k.alias("k"), sweep_threshold(k).alias("threshold"),
        "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"), (F.col("N") - F.col("fp")).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return t.select("k", "threshold", "tp", "fp", "fn", "tn",
                    zero_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    zero_div(tp, tp + fp).alias("precision"),
                    zero_div(tp, tp + fn).alias("recall"),
                    (zero_div(tp, tp + fn) + zero_div(tn, tn + fp) - 1).alias("youden"))


def optimal_threshold(df: DataFrame, y: str = "y", proba: str = "p",
                      metrics: Sequence[str] = ("f1",)) -> DataFrame:
    """The first threshold with the best score per metric (unknown -> f1).

    Columns: metric, optimal_threshold, best_score.
    """
    sweep = threshold_sweep(df, y, proba)
    known = {"f1", "precision", "recall", "youden"}
    pairs = ", ".join(f"'{m}', `{m if m in known else 'f1'}`" for m in metrics)
    # one sweep, unpivoted to (metric, score): the input is scanned once
    long = sweep.selectExpr("k", "threshold", f"stack({len(metrics)}, {pairs}) as (metric, score)")
    best = long.groupBy("metric").agg(
        F.max(F.struct(F.col("score").alias("s"), (-F.col("k")).alias("nk"), F.col("threshold").alias("t")))
        .alias("b"))
    return best.select("metric", r6(F.col("b.t")).alias("optimal_threshold"),
                       r6(F.col("b.s")).alias("best_score"))


# ------------------------------------------------------------------ E13-E16 errors
def misclassified(df: DataFrame, y: str = "y", pred: str = "pred", proba: Optional[str] = "p") -> DataFrame:
    """Rows whose prediction differs from the label, all columns kept,
    plus true_label, predicted_label, prediction_confidence and error_type
    (predicted 1 -> false_positive, else false_negative)."""
    out = df.where(F.col(y) != F.col(pred)).withColumn("true_label", F.col(y)) \
        .withColumn("predicted_label", F.col(pred))
    if proba:
        out = out.withColumn("prediction_confidence", F.col(proba))
    return out.withColumn("error_type", F.when(F.col(pred) == 1, F.lit("false_positive"))
                          .otherwise(F.lit("false_negative")))


def top_errors(df: DataFrame, key: str, y: str = "y", pred: str = "pred", proba: Optional[str] = "p",
               top_n: int = 20) -> DataFrame:
    """The ``top_n`` misclassified rows with the lowest positive-class
    probability (key breaks ties); by key when there is no probability.
    ``orderBy().limit()`` plans as a distributed TakeOrdered (top-k per task)."""
    errs = misclassified(df, y, pred, proba)
    order = [F.col("prediction_confidence").asc(), F.col(key).asc()] if proba else [F.col(key).asc()]
    return errs.orderBy(*order).limit(top_n)


def error_summary(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """total_samples, misclassified, error_rate, false_positives, false_negatives."""
    wrong = F.col(y) != F.col(pred)
    fp = F.sum((wrong & (F.col(pred) == 1)).cast("long"))
    fn = F.sum((wrong & (F.col(pred) != 1)).cast("long"))
    n = F.count(F.lit(1))
    mis = F.sum(wrong.cast("long"))
    return df.agg(n.alias("total_samples"), F.coalesce(mis, F.lit(0)).alias("misclassified"),
                  r6(zero_div(F.coalesce(mis, F.lit(0)), n)).alias("error_rate"),
                  F.coalesce(fp, F.lit(0)).alias("false_positives"),
                  F.coalesce(fn, F.lit(0)).alias("false_negatives"))


# ------------------------------------------------------------------ E17 report
class Evaluation:
    """Every metric table for one scored table, built on first use
    (curves need two scalar totals, so nothing runs until a table is asked for)."""

    def __init__(self, df: DataFrame, y: str, pred: str, proba: Optional[str],
                 class_names: Sequence[str]):
        self.df, self.y, self.pred, self.proba = df, y, pred, proba
        self.class_names = class_names

    @cached_property
    def counts(self) -> DataFrame:
        """The one scan of the scored table: counts per distinct score, checkpointed."""
        from saferow.session import checkpoint_dir

        checkpoint_dir(self.df.sparkSession)
        return score_counts(self.df, self.y, self.proba, self.pred).checkpoint(eager=True)

    @cached_property
    def confusion(self) -> DataFrame:
        if self.proba is None:
            return confusion(self.df, self.y, self.pred)
        return self.counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tn", "fp", "fn", "tp")])

    @cached_property
    def metrics(self) -> DataFrame:
        return point_metrics(self.confusion)

    @cached_property
    def per_class(self) -> DataFrame:
        return classification_report(self.confusion, self.class_names)

    @cached_property
    def points(self) -> Optional[DataFrame]:
        """The distinct scores with running counts, materialised once for all curves."""
        return running_points(self.counts).checkpoint(eager=True) if self.proba else None

    @cached_property
    def roc_auc(self) -> Optional[DataFrame]:
        return roc_auc(self.df, self.y, self.proba, points=self.points) if self.proba else None

    @cached_property
    def roc(self) -> Optional[DataFrame]:
        return roc_curve(self.df, self.y, self.proba, points=self.points) if self.proba else None

    @cached_property
    def pr(self) -> Optional[DataFrame]:
        return pr_curve(self.df, self.y, self.proba, points=self.points) if self.proba else None

    @cached_property
    def youden(self) -> Optional[DataFrame]:
        return youden_threshold(self.df, self.y, self.proba, points=self.points) if self.proba else None


def evaluate(df: DataFrame, y: str = "y", pred: str = "pred", proba: Optional[str] = "p",
             threshold: float = 0.5, class_names: Sequence[str] = ("safe", "unsafe"),
             string_labels: bool = False) -> Evaluation:
    """Label encoding, threshold override, then every metric table."""
    base = df
    if string_labels:
        base = base.withColumn(y, encode_labels(F.col(y), class_names)) \
            .withColumn(pred, encode_labels(F.col(pred), class_names))
    base = base.withColumn(pred, apply_threshold(F.col(pred), F.col(proba) if proba else None, threshold))
    return Evaluation(base, y, pred, proba, class_names)


def report_table(ev: Evaluation, class_names: Sequence[str] = ("safe", "unsafe")) -> DataFrame:
    """The report as a long table (section, name, value)."""
    m = ev.metrics
    overall = ["accuracy", "precision", "recall", "f1_score", "matthews_corrcoef", "cohen_kappa"]
    parts = [m.select(F.explode(F.array(*[F.struct(F.lit("overall").alias("section"), F.lit(k).alias("name"),
                                                   F.col(k).cast("double").alias("value"))
                                          for k in overall])).alias("r")).select("r.*")]
    if ev.roc_auc is not None:
        parts.append(ev.roc_auc.select(F.lit("overall").alias("section"), F.lit("roc_auc").alias("name"),
                                       F.col("roc_auc").alias("value")))
    if ev.youden is not None:
        parts.append(ev.youden.select(F.lit("threshold").alias("section"),
                                      F.lit("optimal_threshold").alias("name"),
                                      r6(F.col("optimal_threshold")).alias("value")))
    parts.append(ev.confusion.select(F.explode(F.array(*[
        F.struct(F.lit("confusion").alias("section"), F.lit(k).alias("name"),
                 F.col(k).cast("double").alias("value")) for k in ("tn", "fp", "fn", "tp")])).alias("r"))
        .select("r.*"))
    pc = ev.per_class.where(F.col("label").isin(*class_names))
    for k in ("precision", "recall", "f1_score"):
        parts.append(pc.select(F.lit("per_class").alias("section"),
                               F.concat(F.col("label"), F.lit(f"_{k}")).alias("name"),
                               F.col(k).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_lines(report: DataFrame) -> DataFrame:
    """E17 text: one formatted line per report entry (for ``write.text``)."""
    return report.select(F.format_string("%-10s %-22s %.4f", F.col("section"), F.col("name"),
                                         F.col("value")).alias("value"))
