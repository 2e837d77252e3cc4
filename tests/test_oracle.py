"""Every registered query against its DuckDB SQL, on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

from tephra import oracle
from tephra.plans import queries as registry
from tools.oracle_check import duck, frame_digest

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(oracle.all_sql()) == set(registry.all_queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQL[name]).df()
    n1, c1, h1, r1 = frame_digest(got)
    n2, c2, h2, r2 = frame_digest(want)
    assert c1 == c2
    assert n1 == n2
    assert h1 == h2, (sorted(set(r1) - set(r2))[:3], sorted(set(r2) - set(r1))[:3])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "fire_intensity_category" in df.columns
