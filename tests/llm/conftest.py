from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows():
    """Collect a DataFrame as plain tuples of the named columns."""
    def collect(df, *cols):
        return [tuple(r[c] for c in cols) for r in df.collect()]

    return collect


@pytest.fixture(scope="session")
def docs(spark):
    """documents from (doc_id, text[, source]) with clashing extra columns."""
    def make(items):
        items = [(i[0], i[1], "en", i[2] if len(i) > 2 else "src0", None, "x", 1, True) for i in items]
        return spark.createDataFrame(items, "doc_id long, text string, lang string, source string, n_chars long, "
                                            "keep_id string, score int, kept boolean")

    return make


@pytest.fixture(scope="session")
def labels(spark):
    def make(items):
        return spark.createDataFrame(items, "doc_id long, quality int, toxic int")

    return make
