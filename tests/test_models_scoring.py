from pyspark.sql import functions as F

from saferow.operators import features as FE
from saferow.operators import metrics as M
from saferow.operators import models as MD
from saferow.operators import search as HS
from saferow.operators import scoring as I
from saferow.operators import search as H
from saferow.operators import split as S
from saferow.plans import jobs as J
from saferow.session import scratch_path
from saferow.sources import synth


def _prepared(spark, n=600):
    df = synth.generate(spark, n=n, seed=1)
    f = FE.FeaturePrep().fit(df)
    x = f.transform(df).withColumn("label", FE.label_encode(F.col("safety_status")).cast("double")).cache()
    return df, f, x


def test_models_fit_predict(spark):
    df, f, x = _prepared(spark)
    for mt, params in (("xgboost", {"n_estimators": 5}), ("random_forest", {"n_estimators": 5, "max_depth": 5}),
                       ("logistic_regression", {})):
        m = MD.train(x, mt, params, feature_names=f.feature_names())
        pred = m.predict(x, keep=["sample_key", "label"])
        assert pred.count() == 600
        auc = M.roc_auc(pred.select(F.col("label").cast("int").alias("y"), F.col("prob_1").alias("p"))).first()[0]
        assert auc > 0.7
        imp = m.feature_importance(5).collect()
        assert len(imp) == 5 and imp[0]["importance"] >= imp[-1]["importance"]


def test_save_load_model(spark):
    _, f, x = _prepared(spark, 300)
    m = MD.train(x, "logistic_regression", feature_names=f.feature_names())
    path = scratch_path(spark, "m")
    m.save(path)
    back = MD.TrainedModel.load(path)
    a = m.predict(x, keep=["sample_key"]).orderBy("sample_key").collect()
    b = back.predict(x, keep=["sample_key"]).orderBy("sample_key").collect()
    assert a == b and back.feature_names == f.feature_names()


def test_cross_validate_and_tune(spark):
    _, _, x = _prepared(spark, 400)
    folded = S.assign_folds(x, "sample_key", "safety_status", 3, 42)
    per_fold, summary = H.cross_validate(folded, "logistic_regression", k=3)
    assert per_fold.count() == 3 and 0 <= summary.first()["mean_score"] <= 1
    trials, best, score = H.tune(folded, "logistic_regression", n_trials=3, k=3, parallelism=3)
    assert trials.count() == 3 and set(best) == {"C", "penalty"}


def test_candidates_typed_by_first_bound():
    c = H.draw_candidates("xgboost", 20, 1)
    assert all(isinstance(p["n_estimators"], int) and 50 <= p["n_estimators"] <= 500 for p in c)
    assert all("gamma" not in p for p in c)  # no counterpart in Spark's trees: not drawn
    assert all(0.01 <= p["learning_rate"] <= 0.3 for p in c)


def test_histogram_and_best(spark):
    t = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0.1, 0.5, 0.5, 0.9, 0.3])],
                              "trial_number int, score double")
    assert H.best_trial(t).first()["trial_number"] == 3
    import numpy as np
    h = {r["bin"]: r["n"] for r in H.score_histogram(t, 4).collect()}
    want, _ = np.histogram([0.1, 0.5, 0.5, 0.9, 0.3], bins=4)
    assert [h[i] for i in range(4)] == want.tolist()
    bsf = [r["best_score"] for r in H.best_so_far(t).orderBy("trial_number").collect()]
    assert bsf == [0.1, 0.5, 0.5, 0.9, 0.9]


def test_scoring_and_explain(spark):
    df, f, x = _prepared(spark, 300)
    m = MD.train(x, "logistic_regression")
    out = I.score(df, m, f, keep=["sample_key"])
    r = out.first()
    assert r["prediction"] in ("safe", "unsafe") and abs(r["prob_safe"] + r["prob_unsafe"] - 1) < 1e-9
    ex = I.explain(df.withColumn("temperature", F.lit(20.0)), F.lit("unsafe"), F.lit(0.9), n_features=2)
    row = ex.first()
    assert row["risk_codes"][0] == "high_temperature" and len(row["risk_factors"]) <= 2
    assert row["recommendation"].startswith("REJECT")


def test_score_batch_ids(spark):
    df, f, x = _prepared(spark, 300)
    m = MD.train(x, "logistic_regression")
    out, bad = I.score_batch(df, m, f, "sample_key", batch_size=100)
    rows = out.collect()
    assert len(rows) == 300 and 0 < bad.count() < 300
    assert max(r["batch_id"] for r in rows) <= 3 and all(r["model_path"] == "" for r in rows)


def test_missing_input_columns(spark):
    import pytest
    bad = spark.createDataFrame([(1.0,)], "temperature double")
    with pytest.raises(ValueError, match="lacks these feature columns"):
        I.validate_input(bad)


def test_full_run_and_reload(spark):
    df = synth.generate(spark, n=500, seed=3)
    out = scratch_path(spark, "run")
    summary = J.full_run(df, out, model_type="logistic_regression", tune=False).first()
    assert summary["n_train"] + summary["n_val"] + summary["n_test"] == 500
    fitted, model, s2 = J.load_run(spark, out)
    assert I.score(df, model, fitted).count() == 500


def test_best_round_patience():
    assert MD.best_round([5, 4, 3, 3.5, 3.6, 3.7, 2], 3) == 2
    assert MD.best_round([5, 4, 3, 2, 1], 3) == 4
    assert MD.best_round([1, 2, 3, 4], 2) == 0


def test_early_stopping_refit(spark):
    _, f, x = _prepared(spark, 400)
    data = x.withColumn("is_val", (F.col("sample_key") % 4) == 0)
    m = MD.train(data, "xgboost", {"n_estimators": 12}, validation="is_val", early_stopping_rounds=3)
    assert 1 <= m.model.getNumTrees <= 12


def test_score_batch_without_label_with_gaps_and_string_key(spark):
    df, f, x = _prepared(spark, 300)
    m = MD.train(x, "logistic_regression")
    last = F.substring("sample_key", -1, 1)
    odd = (df.drop("safety_status")
           .withColumn("sample_key", F.concat(F.lit("k"), F.lpad(F.col("sample_key").cast("string"), 5, "0")))
           .withColumn("temperature", F.when(last == "3", F.lit(None)).otherwise(F.col("temperature")))
           .withColumn("food_type", F.when(last == "4", F.lit("unseen")).otherwise(F.col("food_type"))))
    rows = I.score_batch(odd, m, f, "sample_key", batch_size=100)[0].orderBy("sample_key").collect()
    assert [r["sample_id"] for r in rows] == list(range(300))
    assert all(r["prediction"] in ("safe", "unsafe") and abs(r["prob_safe"] + r["prob_unsafe"] - 1) < 1e-9 for r in rows)


def test_weight_and_c_are_one_scale(spark):
    _, _, x = _prepared(spark, 400)
    a = MD.train(x.withColumn("w", F.lit(5.0)), "logistic_regression", {"C": 0.01}, class_weight=None, sample_weight="w")
    b = MD.train(x, "logistic_regression", {"C": 0.05}, class_weight=None)
    assert max(abs(p - q) for p, q in zip(a.model.coefficients, b.model.coefficients)) < 1e-3


def test_unknown_names_are_errors():
    import pytest

    from saferow.operators import search as S
    with pytest.raises(ValueError):
        MD.spark_params("logistic_regression", {"penalty": "l3"})
    with pytest.raises(ValueError):
        MD.spark_params("xgboost", {"max_depth": 31})
    with pytest.raises(ValueError):
        S.evaluator("f2")
    assert all("gamma" not in c and "reg_alpha" not in c for c in S.draw_candidates("xgboost", 5))


def _two_features(spark, n=400):
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(n).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("a"),
                               F.pmod(F.xxhash64("id", F.lit(1)), F.lit(89)).cast("double").alias("b"))
    noisy = (F.col("a") + F.col("b") / 3 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(60)) > 90).cast("double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.withColumn("label", noisy))


def test_early_stopping_cuts_the_one_fitted_ensemble(spark, monkeypatch):
    df = _two_features(spark).withColumn("held", F.col("id") % 4 == 0)
    params = {"n_estimators": 15, "max_depth": 4, "learning_rate": 0.9, "subsample": 0.7}
    fits = []
    plain = MD.make_estimator
    monkeypatch.setattr(MD, "make_estimator", lambda *a, **k: fits.append(a) or plain(*a, **k))
    m = MD.train(df, "xgboost", params, validation="held", early_stopping_rounds=2)
    k = m.model.getNumTrees
    assert len(fits) == 1 and 1 <= k < 15 and m.params["n_estimators"] == k
    again = MD.train(df.where("NOT held"), "xgboost", {**params, "n_estimators": k})
    probs = lambda x: [r["prob_1"] for r in x.predict(df).orderBy("id").collect()]
    assert probs(m) == probs(again)
    path = scratch_path(spark, "cut")
    m.save(path)
    assert probs(MD.TrainedModel.load(path)) == probs(m)


def test_folds_are_fitted_at_the_same_time_and_leave_no_cache(spark):
    import threading
    df = _two_features(spark).withColumn("fold", (F.col("id") % 3).cast("int"))
    seen, plain = set(), HS.make_estimator
    gate = threading.Barrier(3, timeout=60)

    def slow(*a, **k):
        seen.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        gate.wait()  # passes only if all three folds are under way together
        return plain(*a, **k)

    HS.make_estimator = slow
    try:
        per_fold, summary = HS.cross_validate(df, "logistic_regression", k=3, metric="accuracy")
    finally:
        HS.make_estimator = plain
    scores = [r["score"] for r in per_fold.orderBy("fold").collect()]
    assert seen == {"fold-0", "fold-1", "fold-2"} and len(scores) == 3 and min(scores) > 0.6
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty() or "fold" not in str(spark.sparkContext._jsc.getPersistentRDDs())
    one = plain("logistic_regression", None, n_rows=df.where("fold != 1").count()).fit(df.where("fold != 1"))
    assert abs(HS.evaluator("accuracy").evaluate(one.transform(df.where("fold = 1"))) - scores[1]) < 1e-9


def test_tree_fits_deal_one_partition_over_tasks(spark, monkeypatch):
    df = _two_features(spark).coalesce(1)
    n = df.count()
    monkeypatch.setattr(MD, "TASK_ROWS", n // 4)
    tasks, plain = [], MD.make_estimator

    class Watched:
        def __init__(self, est):
            self.est = est

        def fit(self, data):
            tasks.append(data.rdd.getNumPartitions())
            return self.est.fit(data)

    monkeypatch.setattr(MD, "make_estimator", lambda *a, **k: Watched(plain(*a, **k)))
    for model_type, params in (("random_forest", {"n_estimators": 2, "max_depth": 3}), ("xgboost", {"n_estimators": 2})):
        MD.train(df, model_type, params)
    assert tasks == [MD.fit_tasks(n, spark.sparkContext.defaultParallelism)] * 2 and tasks[0] >= min(4, spark.sparkContext.defaultParallelism)
    dealt = lambda: [[r["id"] for r in p] for p in MD.spread(df).rdd.glom().collect()]
    first = dealt()
    assert first == dealt() and sorted(sum(first, [])) == sorted(r["id"] for r in df.collect())
    assert max(map(len, first)) - min(map(len, first)) <= n // 10


def test_fit_tasks_follow_rows_and_cores():
    least, most = MD.TASK_ROWS, MD.MOST_TASK_ROWS
    assert [MD.fit_tasks(n, 8) for n in (0, least - 1, least, 3 * least, 9 * least, 16 * least, 500 * least)] == [1, 1, 1, 3, 8, 16, 16]
    assert MD.fit_tasks(100 * most, 8) == 100
