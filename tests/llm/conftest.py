import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def docs_of(spark):
    """Documents table of (id, text) pairs, with clashing and extra columns."""

    def make(rows, parts=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, id string, node long, rank int"
        return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), "x", 7, 1) for i, t in rows], schema).repartition(parts)

    return make
