"""Every registered query against its SQL counterpart."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == int(value) else float(value)
    return round(value, 9) if isinstance(value, float) else value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    rows = result.collect()
    assert rows
    if name in ORACLES:
        expected = duck.execute(ORACLES[name])
        names = [c[0] for c in expected.description]
        assert sorted(names) == sorted(result.columns)
        assert table(result.columns, rows) == table(names, expected.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["lang", "records", "chars"]


def test_all_have_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())
