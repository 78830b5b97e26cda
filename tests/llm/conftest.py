import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs or (doc_id, text, lang, source) rows."""

    def make(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, value in extra.items():
            df = df.selectExpr("*", f"{value} AS `{name}`")
        return df

    return make
