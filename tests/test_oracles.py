"""Every registered query against its SQL on DuckDB, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference
from oracles import ORACLES
from spendlens.plans.registry import TABLES

QUERIES = {name: query for name, query in entry_module.queries().items() if name in TABLES}


@pytest.fixture(scope="module")
def duck(data_dir):
    con = connect(data_dir)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) == set(TABLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, data_dir, name):
    assert difference(QUERIES[name](spark, data_dir), duck, ORACLES[name]) is None


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["period", "bucket"]
