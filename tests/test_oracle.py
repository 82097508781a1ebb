"""Every registered query against DuckDB on the same parquet files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from vecloom.catalog.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir)
    wanted = duck.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    rows = found.select(*[f"`{c.replace('`', '``')}`" for c in columns]).collect()

    def ordered(values):
        return sorted((tuple(r) for r in values), key=repr)

    assert ordered(rows) == ordered(wanted.fetchall())


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["doc_id", "text", "score"]
    assert result.count() == 5
