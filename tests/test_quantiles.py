import math

import numpy as np
import pytest

from saferow.operators.quantiles import exact_quantiles


def test_distributed_path_equals_numpy(spark):
    rng = np.random.default_rng(11)
    vals = np.round(rng.lognormal(3, 1, 5000), 3).tolist() + [None] * 17
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.7, 0.75, 1.0]
    got_big = exact_quantiles(df, ["x"], probs, max_in_memory_distinct=0)["x"]
    got_small = exact_quantiles(df, ["x"], probs)["x"]
    want = np.percentile([v for v in vals if v is not None], [p * 100 for p in probs])
    assert np.allclose(got_big, want, rtol=1e-12, atol=1e-12)
    assert np.allclose(got_small, want, rtol=1e-12, atol=1e-12)


def test_duplicates_and_even_count(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 2.0, 3.0, 4.0]], "x double")
    assert exact_quantiles(df, ["x"], [0.5], max_in_memory_distinct=0)["x"] == [2.0]
    df2 = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0]], "x double")
    assert exact_quantiles(df2, ["x"], [0.5], max_in_memory_distinct=0)["x"] == [2.5]


def test_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5], max_in_memory_distinct=0)["x"] == [None]


PROBS = [0.0, 0.25, 0.5, 0.7, 0.75, 1.0]


def one_column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("keep", [0, 7, 200_000])
def test_equals_numpy_however_far_narrowed(spark, keep):
    rng = np.random.default_rng(11)
    a = np.round(rng.lognormal(3, 1, 3000), 3).tolist() + [None] * 17
    b = rng.integers(0, 9, 3017).astype(float).tolist()
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = exact_quantiles(df, ["a", "b"], PROBS, max_in_memory_distinct=keep)
    for name, vals in (("a", a), ("b", b)):
        want = np.percentile([v for v in vals if v is not None], [p * 100 for p in PROBS])
        assert np.allclose(got[name], want, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("keep", [0, 200_000])
def test_ties_infinities_and_nan(spark, keep):
    inf = math.inf
    assert exact_quantiles(one_column(spark, [1.0, 2.0, 2.0, 2.0, 3.0, 4.0]), ["x"], [0.5], keep)["x"] == [2.0]
    assert exact_quantiles(one_column(spark, [1.0, 2.0, 3.0, 4.0]), ["x"], [0.5], keep)["x"] == [2.5]
    got = exact_quantiles(one_column(spark, [1.0, 2.0, inf, inf, inf, math.nan]), ["x"], [0.25, 0.75], keep)["x"]
    assert got == [2.0, inf]
    assert exact_quantiles(one_column(spark, [-inf, -inf, 5.0]), ["x"], [0.0, 0.5, 1.0], keep)["x"] == [-inf, -inf, 5.0]
