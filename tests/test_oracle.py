"""Every registered query against its DuckDB oracle (sf0.001 and sf0.01)."""

import pytest

import __spark_entry__ as entry
from shardwise import registry
from tests.oracle_check import digest
from tests.conftest import SF001, SF01

ORACLE = registry.ORACLE
NAMES = sorted(registry.QUERIES)


def _check(spark, sf, name):
    from tests.duck import connect

    df = registry.QUERIES[name](spark, sf)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) > 0
        return
    cur = connect(sf).execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(cols, rows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_sf001(spark, name):
    _check(spark, SF001, name)


@pytest.mark.parametrize("name", [n for n in NAMES if n in ORACLE])
def test_query_matches_oracle_sf01(spark, name):
    _check(spark, SF01, name)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "__topic__", "logs", "value_sum"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(ORACLE)
