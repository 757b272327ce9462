from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture()
def documents(spark):
    """Builds a table of documents from (id, text) or (id, text, source) rows, with columns of clashing names."""

    def build(*rows):
        full = [(r[0], "en", r[2] if len(r) > 2 else "src1", r[1], None, "x", 5) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, lang string, source string, text string, n_words string, key string, part int"
        )

    return build
