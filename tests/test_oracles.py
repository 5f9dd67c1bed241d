"""Every registered query equals its SQL oracle (sf0.001 here; sf0.01 via run_oracles.py)."""
from __future__ import annotations

import pytest
from oracle_compare import compare, duck_connection

import __spark_entry__ as E
from closequarters.plans.catalog import queries as core_queries
from closequarters.plans.oracle import oracle_sql as core_oracles

SF = "/root/testdata/sf0.001"
KEYS = sorted(core_queries())


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(core_queries()) == set(core_oracles())
    assert set(E.oracle_sql()) <= set(E.queries()) >= set(core_queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("list", "string"), ("rank", "bigint"), ("mmsi_a", "bigint"), ("mmsi_b", "bigint"), ("name_a", "string"),
        ("name_b", "string"), ("ship_type_a", "string"), ("ship_type_b", "string"), ("timestamp_utc", "string"),
        ("lat_a", "double"), ("lon_a", "double"), ("lat_b", "double"), ("lon_b", "double"),
        ("distance_m", "double"), ("window_minutes", "bigint")]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert df.count() >= 0
        return
    problems, _ = compare(df, con, sql)
    assert not problems, problems
