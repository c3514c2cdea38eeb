"""Every registered query against its comparison SQL, on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple("~" if row[i] is None else repr(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, other, name):
    result = driver.queries()[name](spark, SF)
    found = rows(result.columns, [tuple(r) for r in result.collect()])
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    cursor = other.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert found == rows(names, cursor.fetchall())


def test_entry(spark):
    flagship = driver.entry(spark)
    assert flagship.columns == ["state_name", "year", "total_claims_paid", "total_premium", "total_exposure", "loss_ratio"]
    assert flagship.count() > 0
