import pytest

EXTRA = ["lang", "score", "rank", "fp", "node", "kind"]


@pytest.fixture
def table(spark):
    """Rows of (doc_id, text) as a documents table with columns whose names
    clash with those the operators use inside."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            for c in EXTRA:
                df = df.selectExpr("*", f"cast(null as string) as {c}")
        return df
    return make
