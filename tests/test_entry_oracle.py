"""The driver contract: entry() smoke, and every registered query against its
DuckDB oracle on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from scripts.oracle_check import frame_hash
from statmart.plans.suite import ORACLE, QUERIES, TABLES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["jaar", "l_orderkey", "l_linenumber", "part_name", "part_type",
                          "supplier_name", "quantity"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())


# Spark type → DuckDB type of the same values.
TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    declared = {r[0]: r[1] for r in duck.sql(f"DESCRIBE ({E.oracle_sql()[key]})").fetchall()}
    for f in df.schema.fields:
        assert TYPE_NAMES.get(f.dataType.simpleString()) == declared[f.name], f.name
    got = df.toPandas()
    want = duck.sql(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)
