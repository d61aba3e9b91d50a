from pyspark.sql import functions as F

from saferow.operators import split as S


def counts(df):
    return {(r["safety_status"], r["split"]): r["n"]
            for r in df.groupBy("safety_status", "split").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_three_way_split_sizes(samples):
    c = counts(S.assign_split(samples, "sample_key", "safety_status", 0.2, 0.1, 42))
    assert c[("safe", "train")] == 4101 and c[("safe", "val")] == 586 and c[("safe", "test")] == 1172
    assert c[("unsafe", "train")] == 6399 and c[("unsafe", "val")] == 914 and c[("unsafe", "test")] == 1828


def test_split_partitions_keys(samples):
    parts = S.split_frames(samples, "sample_key", "safety_status", 0.2, 0.1, 42)
    total = sum(p.count() for p in parts.values())
    union = parts["train"].select("sample_key").union(parts["val"].select("sample_key")) \
        .union(parts["test"].select("sample_key")).distinct().count()
    assert total == union == 15000


def test_split_reproducible_and_seeded(samples):
    a = S.assign_split(samples, "sample_key", "safety_status", 0.2, 0, 42).where("split = 'test'")
    b = S.assign_split(samples, "sample_key", "safety_status", 0.2, 0, 42).where("split = 'test'")
    c = S.assign_split(samples, "sample_key", "safety_status", 0.2, 0, 7).where("split = 'test'")
    ka = {r[0] for r in a.select("sample_key").collect()}
    assert ka == {r[0] for r in b.select("sample_key").collect()}
    assert ka != {r[0] for r in c.select("sample_key").collect()}


def test_unstratified_exact_size(samples):
    out = S.assign_split(samples, "sample_key", None, 0.25, 0, 42)
    assert out.where("split = 'test'").count() == 3750


def test_split_equals_ranking_every_row(samples):
    from saferow.operators.ranks import bucketed_rank, hash_order_key

    ranked = bucketed_rank(samples.withColumn("h", hash_order_key("sample_key", 42)), ["safety_status"], "h",
                           ["sample_key"], digits=2)
    n_test = F.round(F.col("_group_n") * 0.2)
    n_val = F.round((F.col("_group_n") - n_test) * 0.125)
    want = F.when(F.col("_rank") < n_test, "test").when(F.col("_rank") < n_test + n_val, "val").otherwise("train")
    want = ranked.select("sample_key", want.alias("want"))
    for digits in (1, 4):
        got = S.assign_split(samples, "sample_key", "safety_status", 0.2, 0.1, 42, digits=digits)
        joined = got.join(want, "sample_key")
        assert joined.count() == 15000 and joined.where("split != want").count() == 0


def test_split_null_and_repeated_keys(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.lit("a")).alias("c"), "id")
    out = S.assign_split(df, "k", "c", 0.3, 0.2, 7)
    assert out.columns == ["k", "c", "id", "split"] and out.count() == 3000
    # rows of one key stay together; NULL keys are spread by the row's values
    assert out.where("k = -1").select("c", "split").distinct().count() == 2
    assert out.where("k is null").select("split").distinct().count() == 3
    assert out.where("c is null").count() == 600
    again = S.assign_split(df.repartition(5), "k", "c", 0.3, 0.2, 7)
    assert out.exceptAll(again).count() == 0


def test_split_moves_no_data_column(samples):
    plan = S.assign_split(samples, "sample_key", "safety_status", 0.2, 0.1, 42)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_split_of_an_empty_table(samples):
    assert S.assign_split(samples.limit(0), "sample_key", "safety_status", 0.2, 0.1, 42).count() == 0


def test_folds_balanced(samples):
    f = S.assign_folds(samples, "sample_key", "safety_status", 5, 42)
    c = f.groupBy("safety_status", "fold").count().collect()
    for cls in ("safe", "unsafe"):
        sizes = [r["count"] for r in c if r["safety_status"] == cls]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    w = {r["label"]: r["weight"] for r in S.balanced_weight(df, "label").distinct().collect()}
    assert abs(w[0] - 4 / 6) < 1e-12 and abs(w[1] - 2.0) < 1e-12
