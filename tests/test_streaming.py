import pytest
from pyspark.sql import functions as F

from saferow.operators import features as FE
from saferow.operators import models as MD
from saferow.session import scratch_path
from saferow.sources import synth
from saferow.spec import FOOD_SAFETY
from saferow.streaming.scoring import failed_chunks, finish, read_ledger, read_scored, score_chunk, stream_score


def test_stream_scores_every_chunk(spark):
    df = synth.generate(spark, n=400, seed=5)
    f = FE.FeaturePrep().fit(df)
    x = f.transform(df).withColumn("label", FE.label_encode(F.col("safety_status")).cast("double"))
    m = MD.train(x, "logistic_regression")
    src = scratch_path(spark, "sin")
    df.repartition(3).write.option("header", True).csv(src)
    out = scratch_path(spark, "sout")
    q = stream_score(spark, src, FOOD_SAFETY.spark_schema(with_key=True), m, f, out)
    q.awaitTermination()
    scored = read_scored(spark, out)
    assert scored.count() == 400
    assert 0 < spark.read.parquet(out + "_quarantine").count() < 400
    assert scored.select("batch_id").distinct().count() == 3
    assert scored.select("sample_key").distinct().count() == scored.count()


@pytest.fixture(scope="module")
def fitted(spark):
    df = synth.generate(spark, n=400, seed=5).cache()
    f = FE.FeaturePrep().fit(df)
    x = f.transform(df).withColumn("label", FE.label_encode(F.col("safety_status")).cast("double"))
    return df, f, MD.train(x, "logistic_regression")


def test_a_replayed_chunk_gives_the_same_ids(spark, fitted):
    df, f, m = fitted
    out = scratch_path(spark, "replay")
    key = F.col("sample_key")
    chunks = [df.where(key < 100), df.where((key >= 100) & (key < 250)), df.where(key >= 250)]
    for n, chunk in enumerate(chunks, 1):
        score_chunk(chunk, n, m, f, out)
    ids = lambda: sorted(tuple(r) for r in read_scored(spark, out).select("batch_id", "sample_key", "sample_id").collect())
    first = ids()
    order = [r["sample_key"] for r in df.select("sample_key").orderBy("sample_key").collect()]
    assert [(k, i) for _, k, i in sorted(first, key=lambda r: r[2])] == list(zip(order, range(400)))
    score_chunk(chunks[1].repartition(7), 2, m, f, out)  # replayed after chunk 3, its rows in another order
    assert ids() == first
    assert [r["next_sample_id"] for r in read_ledger(spark, out).orderBy("batch_id").collect()][-1] == 400


def test_bad_chunks_are_skipped_and_all_bad_is_an_error(spark, fitted, tmp_path):
    df, f, m = fitted
    (tmp_path / "a").mkdir()
    rows = df.toPandas()
    rows[:100].to_csv(tmp_path / "a" / "1.csv", index=False)
    (tmp_path / "a" / "2.csv.gz").write_bytes(b"\x1f\x8b\x08\x00" + b"damaged" * 9)
    rows[100:].to_csv(tmp_path / "a" / "3.csv", index=False)
    import os
    for k, name in enumerate(("1.csv", "2.csv.gz", "3.csv")):
        os.utime(tmp_path / "a" / name, (1000 + k, 1000 + k))
    out = scratch_path(spark, "skip")
    schema = FOOD_SAFETY.spark_schema(with_key=True)
    ledger = finish(spark, stream_score(spark, str(tmp_path / "a"), schema, m, f, out), out)
    got = [tuple(r) for r in ledger.orderBy("batch_id").select("batch_id", "status", "first_sample_id", "n_rows").collect()]
    assert got == [(1, "scored", 0, 100), (2, "failed", 100, 0), (3, "scored", 100, 300)]
    dead = failed_chunks(spark, out).first()
    assert dead["files"][0].endswith("2.csv.gz") and dead["error"]
    assert sorted(r[0] for r in read_scored(spark, out).select("batch_id").distinct().collect()) == [1, 3]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "1.csv").write_text("wrong,header\n1,2\n")
    none = scratch_path(spark, "none")
    with pytest.raises(RuntimeError, match="no chunk was scored"):
        finish(spark, stream_score(spark, str(tmp_path / "b"), schema, m, f, none), none)
