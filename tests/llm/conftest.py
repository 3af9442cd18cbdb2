import pytest

from tests.llm.brute import edge_rows


@pytest.fixture(scope="session")
def edge(spark):
    """Null, empty and long texts, ties, repeated rows, null and equal ids, and columns named like inner ones."""
    rows = [(*row, "kept", 1, 2.0, "x", 7, 8) for row in edge_rows()]
    columns = "doc_id long, text string, kept string, row int, home double, fp string, key int, n_words int"
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)
