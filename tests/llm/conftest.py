import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts, or from (doc_id, text) pairs."""

    def make(texts, **extra):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name, value in extra.items():
            df = df.selectExpr("*", f"{value} AS `{name}`")
        return df

    return make
