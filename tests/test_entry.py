"""Driver contract and registered queries on the smallest benchmark tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_mod
from eventmart.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["venue_city", "venue_state", "venue_country"]


def test_every_query_has_an_oracle():
    """All queries of this library; the optional training-data queries have their own tests."""
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    return "∅" if v is None else (repr(float(v)) if isinstance(v, float) else str(v))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    cols = df.columns
    got = sorted("|".join(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    res = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = sorted("|".join(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want
