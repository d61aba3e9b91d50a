import math

from pyspark.sql import functions as F

from saferow.functions.exprs import nan_to_null
from saferow.operators import quality as Q

from core_data import SF01


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_valid_schema_passes(valid_rows):
    assert Q.schema_is_valid(valid_rows)
    assert Q.schema_check(valid_rows).count() == 0


def test_missing_columns_fail(spark):
    df = spark.createDataFrame([(4.0, 6.5), (5.0, 7.0)], "temperature double, ph_level double")
    assert not Q.schema_is_valid(df)
    missing = {r["column_name"] for r in Q.schema_check(df).where("kind = 'missing'").collect()}
    assert "safety_status" in missing and "temperature" not in missing


def test_out_of_range_found(spark):
    df = spark.createDataFrame([(3.0, 6.2), (212.0, 5.5), (-90.0, 7.7)], "temperature double, ph_level double")
    v = as_dict(Q.range_violations(df), "column_name", "violations")
    assert v == {"temperature": 2, "ph_level": 0}
    flags = Q.range_flags(df).collect()
    assert [r["temperature"] for r in flags] == [False, True, True]


def test_fixture_counts(samples):
    v = as_dict(Q.range_violations(samples), "column_name", "violations")
    assert v["temperature"] == 283 and v["coliform_count"] == 1413
    assert sum(v.values()) == 283 + 1413
    inv = {(r["column_name"], r["value"]): r["n"] for r in Q.invalid_categories(samples).collect()}
    assert inv == {("food_type", "plastic"): 1875, ("packaging_type", "crate"): 2996}
    miss = as_dict(Q.missing_values(samples), "column_name", "missing_count")
    assert miss["temperature"] == 484 and miss["food_type"] == 1875 and miss["supplier_id"] == 0
    assert Q.duplicate_count(samples, ["supplier_id"]).first()["duplicates"] == 14980


def test_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, None), (2, "b")], "k int, v string")
    assert Q.duplicate_count(df).first()["duplicates"] == 2
    assert Q.duplicate_count(df, ["k"]).first()["duplicates"] == 2


def test_empty_table_missing_ratio_zero(spark):
    df = spark.createDataFrame([], "temperature double, food_type string")
    m = Q.missing_values(df).collect()
    assert all(r["missing_ratio"] == 0.0 and r["acceptable"] for r in m)


def test_nan_is_missing_not_violation(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (200.0,)], "temperature double"))
    assert as_dict(Q.range_violations(df), "column_name", "violations") == {"temperature": 1}
    assert as_dict(Q.missing_values(df), "column_name", "missing_count") == {"temperature": 1}


def test_report_and_verdict(samples):
    rep = Q.validate_full(samples, strict=False)
    v = rep.verdict.first()
    assert v["is_valid"] and not v["range_valid"] and not v["categorical_valid"]
    assert v["n_samples"] == 15000 and v["total_duplicates"] == 0
    strict = Q.validate_full(samples, strict=True).verdict.first()
    assert not strict["is_valid"]


def test_row_schema_errors(spark, valid_rows):
    good, bad = Q.quarantine(valid_rows)
    assert good.count() == 3 and bad.count() == 0
    df = valid_rows.withColumn("food_type", F.lit("MEAT")).withColumn("temperature", F.lit(None).cast("double"))
    errs = Q.with_row_errors(df).first()["errors"]
    assert "food_type:domain" in errs and "temperature:missing" in errs


def test_clean_median_after_nulling(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (500.0,), (None,)], "temperature double")
    out = [r["temperature"] for r in Q.clean(df, fill_missing="median").collect()]
    # 500 is out of range -> NULL; median of 1..4 interpolates to 2.5
    assert out == [1.0, 2.0, 3.0, 4.0, 2.5, 2.5]
    mean = [r["temperature"] for r in Q.clean(df, fill_missing="mean").collect()]
    assert math.isclose(mean[-1], 2.5)
    assert Q.clean(df, fill_missing="drop").count() == 4
    assert Q.clean(df, remove_outliers=False, fill_missing="none").where("temperature = 500").count() == 1


def test_all_null_column_is_left_alone(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "temperature double, ph_level double")
    out = Q.clean(df).collect()
    assert [r["temperature"] for r in out] == [None, None]


def test_digests_keep_null_places_apart(spark):
    rows = [(1, None, 0.0), (None, 1, 0.0), (1, None, -0.0), (None, None, float("nan")), (None, None, float("nan")),
            (None, None, None), (1, 1, 0.0)]
    df = spark.createDataFrame(rows, "a int, b int, c double")
    for compare in (False, True):
        assert Q.duplicate_count(df, compare=compare).first()[0] == 2
    assert Q.duplicate_count(df.limit(0)).first()[0] == 0


def test_report_counts_from_one_scan(spark, samples):
    df = samples.unionByName(samples.limit(50))
    counts = Q.counted_checks(df).first()
    assert counts["rows"] == df.count()
    assert counts["duplicates__*"] == 50 == Q.duplicate_count(df, compare=True).first()[0]
    assert counts["duplicates__supplier_id"] == Q.duplicate_count(df, ["supplier_id"]).first()[0]
    for check, table, value in (("range_violations", Q.range_violations(df), "violations"),
                                ("invalid_categories", Q.invalid_category_counts(df), "invalid"),
                                ("missing", Q.missing_values(df), "missing_count")):
        for c, n in as_dict(table, "column_name", value).items():
            assert counts[f"{check}__{c}"] == n
    scan = spark.read.parquet(f"{SF01}/lineitem.parquet")
    plan = Q.validate_full(scan).long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_report_of_an_empty_table_and_odd_names(spark, valid_rows):
    empty = {(r["check_name"], r["column_name"], r["metric"]): r["value"] for r in Q.validate_full(valid_rows.limit(0)).long.collect()}
    assert set(empty.values()) == {0.0}
    odd = valid_rows.withColumn("a.b c", F.lit(None).cast("string"))
    got = Q.validate_full(odd, missing_threshold=0.5)
    assert got.long.where("check_name = 'missing' AND column_name LIKE 'a.b%' AND value > 0").count() == 2
    v = got.verdict.first()
    assert v["is_valid"] and not v["missing_acceptable"] and v["n_samples"] == 3 and v["total_duplicates"] == 0
