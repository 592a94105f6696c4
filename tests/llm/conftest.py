from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table, with columns whose names clash with the operators' own, from (doc_id, text)."""

    def build(rows):
        table = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], DOCS)
        for name in ("score", "code", "digest", "hash", "words", "_joined_id", "keep_id", "salt", "content"):
            table = table.selectExpr("*", f"'x' AS {name}")
        return table

    return build


def rows_of(df, *columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
