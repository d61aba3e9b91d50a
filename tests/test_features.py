import math

import pytest
from pyspark.sql import functions as F

from saferow.operators import dictionary as DI
from saferow.operators import features as FE
from saferow.session import scratch_path


def test_standard_scaling_population_std(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a"), (10.0, None)], "x double, c string")
    f = FE.FeaturePrep(scaling="standard", numeric=["x"], categorical=["c"]).fit(df)
    mean = 4.0
    std = math.sqrt(sum((v - mean) ** 2 for v in [1, 2, 3, 10]) / 4)
    assert math.isclose(f.center["x"], mean) and math.isclose(f.scale["x"], std)
    assert f.categories["c"] == ["a", "b", "missing"]
    assert f.feature_names() == ["x", "c_a", "c_b", "c_missing"]


def test_imputed_std_uses_all_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (None,)], "x double")
    f = FE.FeaturePrep(scaling="standard", numeric=["x"], categorical=[]).fit(df)
    # imputed column 1, 3, 2, 2 -> population std sqrt(0.5)
    assert math.isclose(f.scale["x"], math.sqrt(0.5))


def test_robust_iqr_zero_scales_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,), (5.0,), (7.0,)], "x double")
    f = FE.FeaturePrep(scaling="robust", numeric=["x"], categorical=[]).fit(df)
    assert f.scale["x"] == 1.0 and f.center["x"] == 5.0


def test_unseen_category_all_zeros(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    f = FE.FeaturePrep(scaling="none", numeric=["x"], categorical=["c"]).fit(df)
    new = spark.createDataFrame([(1.0, "zzz")], "x double, c string")
    v = f.transform(new).select("features").first()[0].toArray().tolist()
    assert v == [1.0, 0.0, 0.0]


def test_label_maps(spark):
    df = spark.createDataFrame([("safe",), ("unsafe",), ("other",)], "s string")
    got = [r[0] for r in df.select(FE.label_encode(F.col("s"))).collect()]
    assert got == [0, 1, None]
    back = [r[0] for r in spark.createDataFrame([(0,), (1,), (5,)], "y int")
            .select(FE.label_decode(F.col("y"))).collect()]
    assert back == ["safe", "unsafe", None]


def test_save_load(spark, samples):
    f = FE.FeaturePrep().fit(samples)
    path = scratch_path(spark, "prep")
    f.save(path)
    g = FE.FittedFeatures.load(path)
    a = f.transform(samples).select("sample_key", "features").orderBy("sample_key").limit(50).collect()
    b = g.transform(samples).select("sample_key", "features").orderBy("sample_key").limit(50).collect()
    assert a == b and g.feature_names() == f.feature_names()


def test_infer_columns(samples):
    num, cat = FE.infer_feature_columns(samples, "safety_status", ["sample_key"])
    assert len(num) == 7 and cat == ["food_type", "packaging_type", "supplier_id"]


def test_dictionary_codes_like_the_pipeline(spark):
    rows = [(1.0, "b", "x"), (2.0, None, "x"), (None, "a", "y"), (4.0, "é", None)] + [(0.5, "a", "hot")] * 40
    df = spark.createDataFrame(rows, "x double, c string, d string")
    f = FE.FeaturePrep(numeric=["x"], categorical=["c", "d"]).fit(df)
    d = DI.fit_dictionary(df, ["c", "d"])
    assert d.sizes == {"c": 4, "d": 4} and d.n_slots == 8
    names = [r["feature_name"] for r in DI.names_table(d, ["x"]).orderBy("position").collect()]
    assert names == f.feature_names()
    new = df.unionByName(spark.createDataFrame([(9.0, "unseen", "y")], df.schema))
    dense = lambda out: sorted(tuple(r["features"].toArray().round(9)) for r in out.collect())
    assert dense(DI.encode(new, d, f)) == dense(f.transform(new))
    path = scratch_path(spark, "dictionary-copy")
    d.save(path)
    assert dense(DI.encode(new, DI.CategoryDictionary.load(spark, path, ["c", "d"]), f)) == dense(f.transform(new))
    assert {(r["column_name"], r["category"]): r["n_hot"] for r in DI.slot_counts(df, d).collect()}["d", "hot"] == 40


def test_many_categories_stay_off_the_driver(spark, monkeypatch):
    df = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id")).alias("c"), F.lit(1.0).alias("x"))
    monkeypatch.setattr(FE, "MAX_LABELS", 10_000)
    with pytest.raises(ValueError, match="categories"):
        FE.FeaturePrep(numeric=["x"], categorical=["c"]).fit(df)
    monkeypatch.undo()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = DI.fit_dictionary(df, ["c"])
        assert d.n_slots == 30_000
        f = FE.FeaturePrep(numeric=["x"], categorical=[]).fit(df)
        coded = DI.encode(df, d, f)
        assert "SortMergeJoin" in coded._jdf.queryExecution().executedPlan().toString()
        one = coded.where("c = 'k17'").first()["features"]
        slot = d.table.where("category = 'k17'").first()["slot"]
        assert one.size == 30_001 and one[int(slot) + 1] == 1.0 and one.numNonzeros() <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert DI.fit_dictionary(df.limit(0), ["c"]).n_slots == 0
