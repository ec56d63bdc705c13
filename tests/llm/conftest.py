import os

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def odd_docs(spark):
    """Nulls in any column, empty and blank texts, a very long one, repeated rows, columns whose names clash."""
    long = "Lorem ipsum. " * 20_000 + "\n" + "a line that is long enough to count, and is repeated here" + "\n"
    line = "A Line that is long enough to count, and is repeated here"
    rows = [(1, "", "x", 1.0), (2, None, None, None), (None, f"null id\n{line}", "x", 2.0), (3, "   \n\t", "x", 1.0), (4, long, "x", 1.0), (5, "same text here", "x", 1.0), (5, "same text here", "x", 1.0), (5, "another text of that id", "y", 1.0)]
    rows += [(k, f"number {k} of them\n  {line.upper()} \nend", "z", 0.5) for k in range(10, 16)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_lines string, score double")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def big_dir():
    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
