"""Every registered query against its independent DuckDB SQL (sf0.001):
same columns, same row count, same values (order-insensitive)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from strata.plans import ORACLE, QUERIES

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 96
    assert set(E.queries()) >= set(QUERIES) and set(E.oracle_sql()) >= set(ORACLE)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    rel = con.sql(ORACLE[key])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: TYPES.get(t, t) for c, t in sdf.dtypes} == duck_types
    sp = sdf.toPandas()
    dk = rel.df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert _rows(sp) == _rows(dk)
