import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash with internal names."""

    def build(*rows, **extra):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, value in extra.items():
            df = df.selectExpr("*", f"{value} AS {name}")
        return df

    return build
