"""Every registered query against its SQL counterpart on the smallest tables."""

import math
import os

import duckdb
import pytest

from ratewell.catalog import QUERIES, run

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def shown(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value)


def ordered(rows, columns):
    places = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(shown(row[i]) for i in places) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(name, spark, duck):
    query = QUERIES[name]
    answer = run(name, spark, FOLDER)
    result = duck.execute(query.sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(answer.columns)
    expected = ordered(result.fetchall(), columns)
    found = ordered([tuple(r) for r in answer.collect()], answer.columns)
    assert len(found) == len(expected)
    assert found == expected
