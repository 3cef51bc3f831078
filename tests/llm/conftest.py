import os

import pytest

SF = "/root/testdata/sf0.001"
EDGE = [
    # doc_id, text: null, empty, spaces, ties, repeated rows, a long text, marks only
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "Same Text here"),
    (5, "same text HERE"),
    (5, "same text HERE"),
    (6, "!!! 123 ..."),
    (7, "É à ü ß — straße " * 40),
    (8, "x" * 300_000),
    (None, "a row without an id"),
]


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TALLY_TEST_SF", SF)


@pytest.fixture(scope="session")
def shipped(spark):
    from tally.session import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def edge_docs(shipped):
    """Awkward rows with further columns named like columns that the operators make."""
    rows = [(i, t, "en" if t else None, f"s{(i or 0) % 3}" if i != 4 else None, 0, -1, "n", 5, 6) for i, t in EDGE]
    return shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int, name string, size int, taken int")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
