import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 3000}x" for i in range(30_000))

#: Nulls, empty and blank texts, ties, a repeated row, a repeated id, a very long text.
ODD = [(1, "one two three four five six seven eight nine ten", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "de", "b"),
       (5, "one two three four five six seven eight nine ten", "en", "a"), (5, "one two three four five six seven eight nine ten", "en", "a"),
       (6, "Grüße an é 字 one", None, "b"), (None, "no id here but words", "fr", "c"), (7, LONG, "en", "c"), (8, "x", "en", "a"), (9, "first", "en", "a"), (9, "second text", "en", "a")]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source), with extra columns of names that operators might use themselves."""
    def docs(rows, extra=True):
        df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], COLUMNS)
        if extra:
            for name in ("row", "line", "words", "key", "h", "bucket", "tokens", "topic", "p", "u", "fp", "root", "n", "uid", "id", "mark", "kind", "x", "score", "kept"):
                df = df.withColumn(name, F.lit(f"extra {name}"))
        return df
    return docs


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([])
