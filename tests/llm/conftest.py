import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, blanks, a very long text, repeated rows, copies and clashing column names."""
    words = [f"w{i % 701}x{i * i % 97}" for i in range(6000)]
    long = " ".join(words)
    shared = " ".join(words[100:160])
    rows = [(7, None, "en"), (3, "", "en"), (5, "  \t\n ", None), (9, long, "en"), (1, shared + " begins here", "de"),
            (4, "and then " + shared + "\n" + shared, "de"), (4, "and then " + shared + "\n" + shared, "de"),
            (None, shared, "fr"), (2, "é" * 40 + " ab " + "é" * 40, "fr"), (6, "é" * 40 + " ab " + "é" * 40, "fr"),
            (8, "one", "en"), (10, "One two", "en"), (11, "one\x0btwo", "en"), (12, long + " end", "en")]
    return spark.createDataFrame([(d, t, s, 0, "r", b"x") for d, t, s in rows],
                                 "doc_id long, text string, lang string, n int, run string, key binary")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
