import pytest
from pyspark.sql import Row


@pytest.fixture
def documents(spark):
    """Builds a documents table with a clashing extra column from (doc_id, text, lang, source) rows."""

    def build(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, size string, kept array<int>, _row string"
        full = [(d, t, l, s, len(t) if t is not None else None, "x", [1], "y") for d, t, l, s in rows]
        return spark.createDataFrame([Row(*r) for r in full], schema)

    return build
