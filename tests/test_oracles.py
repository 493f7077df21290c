"""Every query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from runnel.plans import oracles, source_oracles, source_queries
from runnel.plans import queries as bound

TABLES = Path("/root/testdata/sf0.001")


def queries():
    return bound.registered() | source_queries.registered()


def oracle_sql():
    return oracles.oracle_sql() | source_oracles.oracle_sql()


pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def table(arrow, columns):
    def text(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(map(text, row)) for row in zip(*[arrow.column(c).to_pylist() for c in columns]))


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    got = queries()[name](spark, str(TABLES)).toArrow()
    want = duck.sql(oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    assert [got.schema.field(c).type for c in columns] == [want.schema.field(c).type for c in columns]
    assert table(got, columns) == table(want, columns)


def test_entry(spark):
    assert entry(spark).count() == 4
