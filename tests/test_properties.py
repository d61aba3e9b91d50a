"""Property tests: distributed operators equal their plain definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saferow.operators import metrics as M
from saferow.operators import split as S
from saferow.operators.ranks import prefix_agg

from test_metrics import brute_auc

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=60))
def test_auc_equals_pairwise_count(spark, rows):
    ys = [r[0] for r in rows]
    if len(set(ys)) < 2:
        return
    ps = [r[1] / 20 for r in rows]
    df = spark.createDataFrame(list(zip(ys, ps)), "y int, p double")
    assert abs(M.roc_auc(df).first()["roc_auc"] - round(brute_auc(ys, ps), 6)) < 1e-9


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=80), st.integers(1, 9))
def test_prefix_sum_equals_cumsum(spark, vals, buckets):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "t int, v long")
    got = [r["v_cum"] for r in prefix_agg(df, ["t"], {"v": "sum"}, n_buckets=buckets).orderBy("t").collect()]
    want, acc = [], 0
    for v in vals:
        acc += v
        want.append(acc)
    assert got == want


def test_split_invariant_to_partitioning(spark, samples):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = {r["sample_key"]: r["split"] for r in
             S.assign_split(samples.coalesce(1), "sample_key", "safety_status", 0.2, 0.1, 42).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        b = {r["sample_key"]: r["split"] for r in
             S.assign_split(samples.repartition(7), "sample_key", "safety_status", 0.2, 0.1, 42).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_class_shares_within_one_row(samples):
    tagged = S.assign_split(samples, "sample_key", "safety_status", 0.3, 0.0, 9)
    for r in tagged.groupBy("safety_status").agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "test").cast("long")).alias("t")).collect():
        assert abs(r["t"] - r["n"] * 0.3) <= 0.5 + 1e-9
