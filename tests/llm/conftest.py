from datetime import datetime

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, slot string, lead long, fp string, root int, size string, row string, key string, _id long, held_out string, component_id string, label int"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns with clashing names."""
    own = ("s", 1, "f", 2, "z", "r", "k", 3, "h", "c", 4)
    rows = [
        (1, "one two three four five six", "en", "a", 9, *own),
        (1, "one two three four five six", "en", "a", 9, *own),
        (1, "another text under the same id", "en", "a", None, *own),
        (2, None, None, None, None, *[None] * 11),
        (3, "", "en", "b", 0, *own),
        (None, "a text without an id it has seven words", "de", None, 1, *own),
        (None, None, "en", "a", 1, *own),
        (4, " \t\n", "fr", "b", 1, *own),
        (5, LONG, "en", "a", 1, *own),
        (6, LONG + " end", "en", "b", 1, *own),
        (7, "12345 !!! ???", "en", "b", 1, *own),
        (8, "naïve Ünïcode \U0001f600 text İstanbul ﬁne", "de", "", 1, *own),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame([(1, 1, 0, 5), (1, 0, 1, 5), (5, None, None, None), (None, 1, 1, 1), (3, 0, 0, 1), (99, 1, 1, 1)], "doc_id long, quality int, toxic int, text int")


@pytest.fixture(scope="session")
def sf(tmp_path_factory):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def noon():
    return datetime(2024, 6, 1, 12)
