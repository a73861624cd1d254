import os

import pytest

from loadloom.llm import common

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers(spark):
    common.importable(spark)


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL


@pytest.fixture
def docs(spark):
    """Frame of (doc_id, text) with further columns, some with names the operators use."""

    def make(rows):
        rows = [(i, t, "en", "s", 1, 2) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id int, h1 int")

    return make


#: Awkward inputs: nulls, blanks, ties, repeated rows, no letters, very long words and texts.
ODD = [
    (None, None), (None, "a b c d e"), (1, None), (2, ""), (3, " \t\n\x0b "), (4, "\n\n\n"), (5, "one"),
    (6, "one two three\none two three\nA LINE OF SOME LENGTH"), (7, "  a line of some length\t\nother"),
    (8, "x" * 50_000), (9, "w " * 30_000), (10, "é ü ñ 你好 😀 ‏ İ"), (11, "12345 !!! $$$ ***"),
    (12, "same text twice"), (12, "same text twice"), (13, "same id, first text"), (13, "same id, second text"),
    (2**63 - 1, "last"), (-5, "first"),
]
