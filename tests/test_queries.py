"""Every query against its SQL twin, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spec
from check import TABLES, compare
from workload import oracle
from workload import queries as catalog

DATA = "/root/testdata/sf0.001"
SLOW = {"train_classify", "classify"}  # check.py runs these; test_plans has a smaller forest

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SLOW))
def test_query(spark, con, name):
    good, text = compare(spark, con, DATA, name, spec.queries()[name], spec.oracle_sql()[name])
    assert good, text


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(spec.queries())


def test_entry_selects_names(spark):
    rows = spec.entry(spark).collect()
    assert len(rows) == 5 and {r.usage for r in rows} == {"train"}
