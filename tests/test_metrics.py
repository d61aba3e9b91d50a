import math

import numpy as np
from pyspark.sql import functions as F

from saferow.operators import metrics as M


def brute_auc(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi != 1]
    s = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_separable_scores(spark):
    y = [1, 1, 0, 1, 0, 0, 0]
    p = [.95, .55, .45, .61, .05, .33, .28]
    df = spark.createDataFrame([(i, yi, pi, int(pi >= .5)) for i, (yi, pi) in enumerate(zip(y, p))],
                               "k int, y int, p double, pred int")
    ev = M.evaluate(df)
    assert ev.roc_auc.first()["roc_auc"] == 1.0
    m = ev.metrics.first()
    assert m["accuracy"] == 1.0 and m["f1_score"] == 1.0 and m["matthews_corrcoef"] == 1.0
    t = ev.youden.first()["optimal_threshold"]
    assert 0 < t < 1
    best = M.optimal_threshold(df, metrics=("f1",)).first()
    assert 0 < best["optimal_threshold"] < 1 and best["best_score"] == 1.0


def test_string_labels(spark):
    rows = [("safe", "safe", .2), ("unsafe", "unsafe", .8), ("safe", "unsafe", .9), ("unsafe", "safe", .4),
            ("other", "safe", .1)]
    df = spark.createDataFrame(rows, "y string, pred string, p double")
    cm = M.evaluate(df, string_labels=True).confusion.first()
    # unknown label maps to 0 (safe)
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (2, 1, 1, 1)


def test_fixture_values(scored):
    ev = M.evaluate(scored)
    cm = ev.confusion.first()
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (4948, 911, 4806, 4335)
    assert ev.roc_auc.first()["roc_auc"] == 0.738325
    assert ev.roc.count() == 613


def test_auc_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400).tolist()
    p = np.round(rng.random(400), 1).tolist()
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    assert math.isclose(M.roc_auc(df).first()["roc_auc"], round(brute_auc(y, p), 6), abs_tol=1e-6)


def test_auc_invariant_under_monotone_change(scored):
    a = M.roc_auc(scored).first()["roc_auc"]
    b = M.roc_auc(scored.withColumn("p", F.exp(F.col("p") * 3))).first()["roc_auc"]
    assert a == b


def test_single_class_auc_null(spark):
    df = spark.createDataFrame([(1, .3), (1, .6)], "y int, p double")
    assert M.roc_auc(df).first()["roc_auc"] is None


def test_all_scores_equal(spark):
    df = spark.createDataFrame([(0, .5), (1, .5), (1, .5)], "y int, p double")
    assert M.roc_auc(df).first()["roc_auc"] == 0.5
    pts = M.roc_curve(df).orderBy("fps").collect()
    assert [(r["fpr"], r["tpr"]) for r in pts] == [(0.0, 0.0), (1.0, 1.0)]


def test_sweep_matches_brute_force(scored):
    sweep = {r["k"]: r for r in M.threshold_sweep(scored).collect()}
    pdf = scored.select("y", "p").toPandas()
    ths = np.linspace(0.01, 0.99, 100)
    for k in (0, 17, 49, 50, 73, 99):
        pred = pdf.p >= ths[k]
        tp = int(((pdf.y == 1) & pred).sum())
        fp = int(((pdf.y == 0) & pred).sum())
        assert sweep[k]["tp"] == tp and sweep[k]["fp"] == fp
        assert sweep[k]["threshold"] == ths[k]


def test_thresholds_passed_edges(spark):
    ths = np.linspace(0.01, 0.99, 100)
    vals = [float(t) for t in ths] + [float(np.nextafter(t, 0)) for t in ths] + [0.0, 1.0, 0.5]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r[0] for r in df.select(M.thresholds_passed(F.col("p"))).collect()]
    want = [int((ths <= v).sum()) for v in vals]
    assert got == want


def test_per_class_report(scored):
    rep = {r["label"]: r for r in M.evaluate(scored).per_class.collect()}
    assert rep["safe"]["support"] == 5859 and rep["unsafe"]["support"] == 9141
    assert rep["accuracy"]["f1_score"] == round((4948 + 4335) / 15000, 6)


def test_errors(scored):
    top = M.top_errors(scored, "sample_key", top_n=20).collect()
    assert len(top) == 20
    ps = [r["prediction_confidence"] for r in top]
    assert ps == sorted(ps)
    summ = M.error_summary(scored).first()
    assert summ["misclassified"] == 911 + 4806 and summ["false_positives"] == 911


def test_no_errors_empty(spark):
    df = spark.createDataFrame([(1, 1, .9)], "y int, pred int, p double")
    assert M.misclassified(df).count() == 0


def test_youden_with_large_counts(spark):
    n = 5_000_000_000
    row = spark.range(1).select((M._wide(F.lit(n)) * M._wide(F.lit(n)) - M._wide(F.lit(10)) * M._wide(F.lit(n))).alias("j"))
    assert int(row.first()["j"]) == n * n - 10 * n
