"""Every registered query against DuckDB (PUNCTUAL_SF_DIR chooses the data folder)."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry

SF_DIR = os.environ.get("PUNCTUAL_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[:3] == ["Year", "Reporting_Airline", "Airline_Name"]
    assert rows.count() > 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_lookup_keys_are_unique_and_complete(spark, sf):
    """What the derived fact relies on: primary keys, and no line without its lookups."""
    from punctual.plans.demo import flights, table

    folder = f"/root/testdata/{sf}"
    for name, key in {
        "orders": "o_orderkey",
        "customer": "c_custkey",
        "supplier": "s_suppkey",
        "part": "p_partkey",
        "nation": "n_nationkey",
        "region": "r_regionkey",
    }.items():
        rows = table(spark, folder, name)
        assert rows.groupBy(key).count().where("count > 1").isEmpty(), (sf, name)
    lines = table(spark, folder, "lineitem").count()
    fact = flights(spark, folder, "Origin", "OriginState", "Dest", "DestState", "Reporting_Airline")
    assert fact.count() == lines
    assert fact.where("Origin IS NULL OR Dest IS NULL OR Reporting_Airline IS NULL OR DestState IS NULL").isEmpty()
