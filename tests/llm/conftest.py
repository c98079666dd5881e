from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from texts, or from (doc_id, text) pairs."""

    def make(rows):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(rows)]
        return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in pairs], SCHEMA)

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
