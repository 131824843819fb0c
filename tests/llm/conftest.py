import pytest

#: Columns whose names operators use inside, to be ignored when a table brings them.
CLASHING = "id long, row long, node long, label string, key long, score double, kept boolean, n long, w string"


@pytest.fixture
def documents(spark):
    """Documents with two ids and a text each, and columns with clashing names."""
    def make(texts, ids=None):
        ids = ids if ids is not None else range(len(texts))
        rows = [(i, t, 7, 8, 9, "x", 1, 0.5, None, 3, None) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}")
    return make
