"""Every registered query against its SQL on the given tables."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# The text operators and their pipeline have tests of their own.
TEXT = re.compile(r"op\d+_|pipeline$")
QUERIES, SQL = ({k: v for k, v in named.items() if not TEXT.match(k)} for named in (contract.queries(), contract.oracle_sql()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


# Types by which both engines name the same thing.
SAME = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(df.columns) == sorted(names)
    expected = cursor.fetchall()
    assert expected
    assert _sorted([tuple(r) for r in df.collect()], df.columns) == _sorted(expected, names)
    assert {n: SAME.get(t, t) for n, t in types.items()} == dict(df.dtypes)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() == 10
