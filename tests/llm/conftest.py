from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents with the given (doc_id, text) rows; more columns on request."""

    def make(rows, source="src0", lang="en"):
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make
