import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make(spark):
    """documents from (doc_id, text) or (doc_id, text, lang) rows, with clashing extra columns if asked."""

    def build(rows, *extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit("x") for c in extra})

    return build
