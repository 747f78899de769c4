"""Every registered query beside its SQL on the smallest tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check_oracles import TABLES, compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, database, name):
    frame = queries()[name](spark, FOLDER)
    sql = oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert compare(frame, database.sql(sql)) is None


def test_entry(spark):
    assert len(entry(spark).columns) == 5
