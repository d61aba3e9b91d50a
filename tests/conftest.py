import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from core_data import SF01  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from saferow.session import build_session, checkpoint_dir

    s = build_session("local[*]", shuffle_partitions=8, app_name="saferow-tests")
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def samples(spark):
    from saferow.plans import fixtures as FX

    return FX.samples(spark, SF01).cache()


@pytest.fixture(scope="session")
def scored(spark):
    from pyspark.sql import functions as F

    from saferow.plans import fixtures as FX

    return FX.scored(spark, SF01).withColumn("pred", (F.col("p") >= 0.5).cast("int")).cache()


@pytest.fixture()
def valid_rows(spark):
    """Three records that pass every check."""
    from saferow.spec import FOOD_SAFETY

    rows = [(2.5, 6.1, 71.5, 850.0, 4.0, 3, 0.91, "meat", "vacuum", "S-17", "safe"),
            (7.25, 5.9, 66.0, 40.0, 0.0, 21, 0.79, "dairy", "refrigerated", "S-04", "safe"),
            (11.0, 7.3, 58.5, 91000.0, 310.0, 12, 0.96, "produce", "ambient", "S-88", "unsafe")]
    return spark.createDataFrame(rows, FOOD_SAFETY.spark_schema())
