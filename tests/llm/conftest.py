import os

import duckdb
import pytest

from tests.conftest import SF_SMALL

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(60_000))
CLASHES = ("size", "score", "shard", "slot", "id", "node", "n", "th", "root", "spans", "evidence", "target", "taken", "n_tokens", "offset", "length", "kept", "key")


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def docs_of(spark, rows):
    """Documents (doc_id, text, source) with further columns of clashing names."""
    data = [(i, t, None, s, None, *["x"] * len(CLASHES)) for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(data, schema)


MESSY = [
    (None, "a row without an id but with some words in it", "s1"),
    (None, None, None),
    (1, None, "s1"),
    (2, "", "s2"),
    (3, " \t\n\x0b\x0c\r ", None),
    (4, "one two", "s1"),
    (5, "One TWO", "s1"),
    (6, "tie tie tie tie tie tie", "s2"),
    (7, "tie tie tie tie tie tie", "s2"),
    (7, "tie tie tie tie tie tie", "s2"),
    (8, LONG, "s3"),
    (9, LONG, "s3"),
    (10, "é ü ß x 日本 語 text", "ünï"),
]


@pytest.fixture(scope="session")
def messy(spark):
    return docs_of(spark, MESSY)


@pytest.fixture(scope="session")
def empty(spark):
    return docs_of(spark, [])
