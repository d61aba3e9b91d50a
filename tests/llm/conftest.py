import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from llm_data import SCHEMA  # noqa: E402

@pytest.fixture()
def frame(spark):
    """docs from (doc_id, text[, source]) with extra columns whose names operators use inside."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", 0, 1.0, 1, True) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture()
def labels(spark):
    return spark.createDataFrame([(2, 1, 0), (7, 1, 0), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
