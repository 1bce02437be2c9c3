"""Every registered query against its SQL, over the whole smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from docsheaf.plans.oracles import ORACLES
from docsheaf.plans.registry import QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(rows):
    rounded = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]
    return sorted(rounded, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, str(SF))
    relation = duck.sql(driver.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    expected = relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert normal(map(tuple, df.select(*columns).collect())) == normal(expected)
