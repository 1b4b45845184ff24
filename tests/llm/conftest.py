import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from kestrel.llm.tables import make_importable  # noqa: E402

TABLES = "documents embeddings conversations labels"


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    make_importable(spark)


@pytest.fixture(scope="session")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture
def odd(spark):
    """Rows with nulls, empty and long texts, ties, repeats and extra columns whose names clash with results."""
    long = " ".join(f"word{i % 97}" for i in range(60_000))
    rows = [(1, "plain words in a row of ten words or so here", "a", 1), (1, "plain words in a row of ten words or so here", "a", 1),
            (2, None, "a", 2), (3, "", None, 3), (None, "a text without an id but with several words", None, None),
            (4, long, "b", 4), (5, " \n\t  ", "b", 5), (6, "one", "b", 6), (7, "é😀 ünïcode 漢字 text\x00 here", "c", 7),
            (2, "the same id with another text of a few words", "c", 8)]
    return spark.createDataFrame([(*r, 9, "x", 0.5, 0, True) for r in rows],
                                 "doc_id long, text string, source string, n_chars long, n_tokens int, spans string, "
                                 "score double, copies int, kept boolean")


@pytest.fixture
def empty(odd):
    return odd.where("false")
