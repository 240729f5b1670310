"""Every query against its SQL in DuckDB, on whole tables."""

import datetime
import math

import duckdb
import numpy as np
import pytest

import epiframe.service_queries  # noqa: F401  registers its queries
from epiframe.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(map(plain, v))
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = duck.execute(ORACLES[name])
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, got.fetchall())
