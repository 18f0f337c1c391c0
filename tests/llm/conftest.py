import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, kept string, n_words string, `key.id` long, sequence_id string"


@pytest.fixture(scope="session")
def table(spark):
    """(id, text) rows to a frame whose other columns have names that results use as well."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", None, 1, None) for i, t in rows], SCHEMA)
    return make
