"""Every registered query against its SQL oracle on the smallest driver tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = Path(os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001"))

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(driver.QUERIES) == set(driver.ORACLES)
    assert set(driver.QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query_matches_oracle(spark, database, name):
    frame = driver.queries()[name](spark, str(FOLDER))
    columns = sorted(frame.columns)
    answer = database.execute(driver.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = sorted((tuple(r[i] for i in order) for r in answer.fetchall()), key=repr)
    actual = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    assert actual == expected


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 3 and all(r["rows"] == r.expected_rows for r in rows)
