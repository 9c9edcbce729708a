from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs_of(spark):
    """Documents from a list of texts, ids from 0, or of (id, text) pairs."""

    def make(texts, extra: str = ""):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "src", None if t is None else len(t)) + (("x",) if extra else ()) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA + (f", {extra} string" if extra else ""))

    return make
