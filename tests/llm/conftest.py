import os

import pytest

from privlink.llm.common import prepare

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers(spark):
    """Python workers import the package, batches are as in production."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", REPO)
    prepare(spark)


@pytest.fixture
def tiny_batches(spark):
    """Arrow batches of a few rows: what spans batches is put to the test."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    prepare(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def docs_of(spark):
    """A documents-like frame of (doc_id, text) with columns that clash with operators' own names."""

    def make(rows):
        extra = "ids array<int>, fp string, shard string, id string, n string, score string, key string"
        return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), None, "fp", "shard", "id", "n", "score", None) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {extra}")

    return make


#: Rows that every operator must take: nulls, blanks, repeated rows, equal ids, odd characters.
ODD = [(1, None), (2, ""), (None, "no id"), (3, "same row"), (3, "same row"), (4, "equal id, one text"), (4, "equal id, other text"), (5, " \t\r\n\x0b "), (6, "é日本😀\u0000  x"), (7, "..."), (None, None)]
