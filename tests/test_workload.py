"""Every registered query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = os.environ.get("WORKLOAD_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(arrow):
    names = sorted(arrow.column_names)
    types = [str(arrow.schema.field(n).type).replace("large_string", "string") for n in names]
    values = sorted(zip(*[arrow.column(n).to_pylist() for n in names]), key=repr)
    return names, types, values


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = canonical(entry_module.queries()[name](spark, SF).toArrow())
    want = canonical(duck.sql(entry_module.oracle_sql()[name]).to_arrow_table())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[2] == want[2]


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_each_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
