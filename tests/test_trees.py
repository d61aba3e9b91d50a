"""Tree fits over binned rows: the same trees as Spark's where nothing is drawn, few jobs, saved and read back."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from saferow.operators import models as MD
from saferow.operators import trees as TR
from saferow.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    """Two continuous features, a group of three one-hot ones, a constant; weights; noisy labels."""
    draw = lambda i, n: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n))
    df = spark.range(4000).select("id", (draw(1, 1009) / 7).alias("a"), (draw(2, 997) / 3).alias("b"),
                                  *[(draw(3, 3) == k).cast("double").alias(f"c{k}") for k in range(3)],
                                  F.lit(1.0).alias("d"), (1 + draw(4, 3)).cast("double").alias("w"))
    noisy = (F.col("a") + F.col("b") / 3 + 20 * F.col("c1") + draw(5, 60) > 170).cast("double")
    names = ["a", "b", "c0", "c1", "c2", "d"]
    return VectorAssembler(inputCols=names, outputCol="features").transform(df.withColumn("label", noisy)).cache()


def _probs(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select(vector_to_array("probability")[1]).collect()])


def _jobs(spark, work):
    """Jobs that ``work`` starts."""
    spark.sparkContext.setJobGroup(f"count-{id(work)}", "counted")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"count-{id(work)}"))


@pytest.mark.parametrize("weight", [None, "w"])
def test_one_tree_without_bagging_is_sparks(spark, rows, weight):
    est = RandomForestClassifier(numTrees=1, maxDepth=30, seed=7, bootstrap=False, featureSubsetStrategy="all", minInstancesPerNode=2)
    est = est.setWeightCol(weight) if weight else est
    bins = TR.find_bins(est, rows, False)
    assert [len(p) for p in bins.points] == [31, 31, 1, 1, 1, 0] and bins.per_node == 6
    mine = TR.fit_forest(est, TR.tasks_for(rows, 3), 3, bins, "features", "label", weight, bootstrap=False)
    theirs = est.fit(rows.coalesce(1))
    assert (np.abs(_probs(mine, rows) - _probs(theirs, rows)) > 1e-9).mean() < 0.01  # splits of equal gain may differ
    assert abs(mine.totalNumNodes / theirs.totalNumNodes - 1) < 0.02
    assert np.abs(mine.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.01


def test_forest_without_depth_limit_needs_few_jobs_and_reloads(spark, rows, monkeypatch):
    monkeypatch.setattr(MD, "BINNED_ROWS", 1000)
    params = {"n_estimators": 12}
    m, jobs = _jobs(spark, lambda: MD.train(rows, "random_forest", params, feature_names=["a", "b", "c0", "c1", "c2", "d"]))
    assert jobs <= 25  # not one for each level
    assert isinstance(m.model, TR.StoredForest) and m.model.getNumTrees == 12
    pred = m.predict(rows, keep=["id", "label"]).toPandas().sort_values("id")
    assert len(pred) == 4000 and (pred.prediction == pred.label).mean() > 0.9
    assert ((pred.prob_1 > 0.5) == (pred.prediction == 1)).all() and np.abs(pred.prob_0 + pred.prob_1 - 1).max() < 1e-9
    plain = RandomForestClassifier(numTrees=12, maxDepth=30, seed=42).fit(MD.balanced_weight(rows, "label", out="w2"))
    assert 0.8 < m.model.totalNumNodes / plain.totalNumNodes < 1.25
    total = m.feature_importance(6).agg(F.sum("importance")).first()[0]
    assert abs(total - 1) < 1e-9 and {r["feature"] for r in m.feature_importance(2).collect()} == {"a", "b"}
    again = MD.train(rows, "random_forest", params)
    assert (_probs(again.model, rows) == _probs(m.model, rows)).all()  # draws follow the seed
    path = scratch_path(spark, "forest-model")
    m.save(path)
    back = MD.TrainedModel.load(path)
    assert back.feature_names == m.feature_names and (_probs(back.model, rows) == _probs(m.model, rows)).all()


def test_bags_follow_the_rate():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, (3, 500)).astype(np.uint8), rng.integers(0, 2, 500).astype(np.uint8)
    bins = TR.Bins([np.arange(8.0)] * 3, 3)
    bag = rng.poisson(1.0, 500)
    tree, importance = TR._grow_tree(x, y, np.ones(500), bag, bins, 30, 1, [1, 0])  # noqa: SLF001
    votes = TR._votes(x, [TR._tree_bytes(tree)])  # noqa: SLF001
    assert importance.shape == (3,) and np.allclose(votes.sum(axis=1), 1)
    cells = {}
    for i in np.flatnonzero(bag):  # rows of one cell that no split can part share their class shares
        cells.setdefault(tuple(x[:, i]), []).append((y[i], bag[i]))
    for i in np.flatnonzero(bag):
        got, of = votes[i, 1], cells[tuple(x[:, i])]
        share = sum(b for c, b in of if c) / sum(b for _, b in of)
        assert (got > 0.5) == (share > 0.5)


@pytest.mark.parametrize("weight", [None, "w"])
def test_boosting_without_draws_is_sparks(spark, rows, weight):
    est = GBTClassifier(maxIter=6, maxDepth=4, stepSize=0.3, seed=7, subsamplingRate=1.0, featureSubsetStrategy="all",
                        minInstancesPerNode=5)
    est = est.setWeightCol(weight) if weight else est
    mine = TR.fit_boosting(est, TR.tasks_for(rows, 3), 3, TR.find_bins(est, rows, True), "features", "label", weight)
    theirs = est.fit(rows.coalesce(1))
    assert isinstance(mine, GBTClassificationModel) and mine.treeWeights == theirs.treeWeights and mine.uid == theirs.uid
    assert (np.abs(_probs(mine, rows) - _probs(theirs, rows)) > 1e-6).mean() < 0.01
    assert np.abs(mine.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.01
    assert np.allclose(mine.evaluateEachIteration(rows), theirs.evaluateEachIteration(rows), atol=1e-4)


def test_boosting_is_one_stage_and_follows_the_seed(spark, rows, monkeypatch):
    monkeypatch.setattr(MD, "BINNED_ROWS", 1000)
    params = {"n_estimators": 15, "max_depth": 4}
    m, jobs = _jobs(spark, lambda: MD.train(rows, "xgboost", params))
    assert jobs <= 30  # not one for each level of each round
    assert m.model.getNumTrees == 15 and (_probs(m.model, rows) == _probs(MD.train(rows, "xgboost", params).model, rows)).all()
    right = m.predict(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right > 0.85
    path = scratch_path(spark, "boosted-model")
    m.save(path)
    assert (_probs(MD.TrainedModel.load(path).model, rows) == _probs(m.model, rows)).all()
    held = rows.withColumn("held", F.col("id") % 4 == 0)
    cut = MD.train(held, "lightgbm", {**params, "learning_rate": 0.9}, validation="held", early_stopping_rounds=2)
    assert 1 <= cut.model.getNumTrees <= 15 and cut.params["n_estimators"] == cut.model.getNumTrees


def test_what_this_module_does_not_fit_stays_with_spark(spark, rows, monkeypatch):
    est = GBTClassifier(maxDepth=TR.DEEPEST_BOOSTED + 1)
    assert TR.growable(est, rows, 10_000, True) == 0 and TR.growable(GBTClassifier(), rows, 10_000, True) > 0
    monkeypatch.setattr(TR, "MOST_FOREST_ROWS", 100)
    assert TR.growable(RandomForestClassifier(), rows, 101, False) == 0
    from pyspark.ml.feature import VectorIndexer
    three = VectorAssembler(inputCols=["k"], outputCol="raw").transform(rows.select("id", "label", (F.col("id") % 3).cast("double").alias("k")))
    named = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(three).transform(three)
    assert TR.find_bins(RandomForestClassifier(), named, False) is None  # three categories in one feature


def test_an_exchange_adds_up_and_leaves_one_file_for_each_task(tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    tasks = [TR.Exchange(str(tmp_path / "x"), i, 3) for i in range(3)]

    def turns(i):
        return [tasks[i](np.array([[1.0, i], [t, 0.5]])).tolist() for t in range(20)]

    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(turns, range(3)))
    assert got == [[[[3.0, 3.0], [3.0 * t, 1.5]] for t in range(20)]] * 3
    assert len(list((tmp_path / "x").iterdir())) == 3
