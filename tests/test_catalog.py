"""Every query against its SQL equivalent, on the smallest test tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from footfall.plans.catalog import QUERIES
from footfall.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(clean, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE[name])
    assert {c: TYPES.get(t) for c, t in df.dtypes} == {
        c: str(t) for c, t in zip(expected.columns, expected.types)}
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == comparable(
        expected.columns, expected.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_contract_lists_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
