import os
import sys

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

import pytest  # noqa: E402

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Frame of documents from (doc_id, text) or (doc_id, text, source)."""
    def make(*rows):
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCUMENTS)
    return make
