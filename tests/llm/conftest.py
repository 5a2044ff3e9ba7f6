import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs_frame(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows, and an extra column."""

    def make(rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string"
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "clash") for r in rows], schema)

    return make


ODD = [
    (1, None, None, None), (2, "", "en", "a"), (None, "word " * 60, "en", "a"), (3, "x " * 30_000, None, "b"),
    (4, "same text here", "en", "a"), (4, "same text here", "en", "a"), (5, "same text here", "de", None), (6, "\n\n \t", "en", "a"), (7, "é▁ 日本 😀", "fr", "b"),
]


@pytest.fixture(scope="session")
def odd(docs_frame):
    return docs_frame(ODD)


@pytest.fixture(scope="session")
def empty(docs_frame):
    return docs_frame([])


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
