from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs; ``extra`` adds columns with names the operators use inside."""

    def make(rows, extra: bool = False):
        frame = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCUMENTS)
        if extra:
            for name in ("score", "_score", "class", "_class", "item", "bin", "deme", "kept", "_text", "h", "word"):
                frame = frame.selectExpr("*", f"'mine' as `{name}`")
        return frame

    return make
