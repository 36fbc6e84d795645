"""Every survey query against its SQL at the smallest size."""

from __future__ import annotations

import math

import duckdb
import pytest

from skyloom.plans import survey, values  # noqa: F401
from skyloom.plans.registry import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, sf_dir, name):
    mine = QUERIES[name](spark, sf_dir)
    theirs = duck.sql(SQL[name])
    columns = sorted(mine.columns)
    assert sorted(theirs.columns) == columns
    at = [theirs.columns.index(c) for c in columns]
    a = sorted((tuple(plain(r[c]) for c in columns) for r in mine.collect()), key=repr)
    b = sorted((tuple(plain(r[i]) for i in at) for r in theirs.fetchall()), key=repr)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() >= 0
