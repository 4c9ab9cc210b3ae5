import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, source[, lang]]) rows, with columns whose names clash
    with names the operators use inside."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)), "x", 7, 1.5) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, lang string, node string, size int, kept double")

    return build
