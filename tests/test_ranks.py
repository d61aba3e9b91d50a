from pyspark.sql import Window
from pyspark.sql import functions as F

from saferow.operators.ranks import bucketed_rank, hash_order_key, prefix_agg, ranged, row_index

from core_data import SF01


def test_row_index_equals_plain_rank(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    a = row_index(o, ["o_orderkey"], n_buckets=13)
    plain = o.select("o_orderkey", (F.row_number().over(Window.orderBy("o_orderkey")) - 1).alias("ref"))
    diff = a.join(plain, "o_orderkey").where(F.col("row_idx") != F.col("ref")).count()
    assert diff == 0 and a.count() == o.count()


def test_row_index_descending(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    a = row_index(o, ["o_orderkey"], descending=True)
    top = a.where("row_idx = 0").first()["o_orderkey"]
    assert top == o.agg(F.max("o_orderkey")).first()[0]


def test_prefix_sum_equals_window(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_totalprice")
    a = prefix_agg(o, ["o_orderkey"], {"o_totalprice": "sum"}, n_buckets=7)
    w = Window.orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    ref = o.select("o_orderkey", F.sum("o_totalprice").over(w).alias("ref"))
    bad = a.join(ref, "o_orderkey").where(F.abs(F.col("o_totalprice_cum") - F.col("ref")) > 1e-6 * F.col("ref"))
    assert bad.count() == 0


def test_prefix_max(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([3, 1, 4, 1, 5, 9, 2, 6])], "t int, s double")
    got = [r["s_cum"] for r in prefix_agg(df, ["t"], {"s": "max"}, n_buckets=3).orderBy("t").collect()]
    assert got == [3, 3, 4, 4, 5, 9, 9, 9]


def test_bucketed_rank_equals_plain(spark, samples):
    h = samples.select("sample_key", "safety_status").withColumn("h", hash_order_key("sample_key", 42))
    a = bucketed_rank(h, ["safety_status"], "h", ["sample_key"], digits=2)
    w = Window.partitionBy("safety_status").orderBy("h", "sample_key")
    ref = h.select("sample_key", (F.row_number().over(w) - 1).alias("ref"))
    assert a.join(ref, "sample_key").where(F.col("_rank") != F.col("ref")).count() == 0


def test_same_result_any_partitioning(spark, samples):
    h = samples.select("sample_key").withColumn("h", hash_order_key("sample_key", 7))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = {r["sample_key"]: r["row_idx"] for r in row_index(h, ["sample_key"]).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        b = {r["sample_key"]: r["row_idx"] for r in row_index(h.repartition(5), ["sample_key"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_row_index_over_several_columns_with_a_hot_key(spark):
    """A key that half of the rows hold is spread over many ranges; places stay right."""
    rows = [(7 if i % 2 else i % 5, None if i % 3 else f"k{i % 11}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "a int, b string, i int")
    got = row_index(df, ["a", "b"], n_buckets=16)
    plain = Window.orderBy("a", "b").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    checked = got.withColumn("upto", F.count(F.lit(1)).over(plain)) \
        .withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("a", "b")))
    assert checked.where((F.col("row_idx") >= F.col("upto")) | (F.col("row_idx") < F.col("upto") - F.col("same"))).isEmpty()
    assert sorted(r["row_idx"] for r in got.collect()) == list(range(4000))
    sizes = [r["n"] for r in ranged(df, ["a", "b"], n_buckets=16).groupBy("_bucket").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 4000 / 16


def test_row_index_of_nulls_texts_and_empty_tables(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "k string")
    assert sorted((r["row_idx"], r["k"]) for r in row_index(df, ["k"]).collect()) == [(0, None), (1, "a"), (2, "a"), (3, "b")]
    assert sorted((r["row_idx"], r["k"]) for r in row_index(df, ["k"], descending=True).collect()) \
        == [(0, "b"), (1, "a"), (2, "a"), (3, None)]
    assert row_index(df.limit(0), ["k"]).isEmpty()
