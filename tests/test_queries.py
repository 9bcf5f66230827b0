"""Every registered query against its SQL counterpart, on whole tables."""

import datetime as dt
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from newsloom.session import SETTINGS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY: set[str] = set()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 9)
    return str(value) if isinstance(value, (dt.date, dt.datetime)) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


#: The queries of this package; those for training data have their own tests.
OWN = sorted(name for name, query in registered.queries().items() if query.__module__ == registered.__name__)


def test_all_queries_have_sql():
    assert set(OWN) - set(registered.oracle_sql()) == ROWS_ONLY
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.fixture(scope="module")
def plain_session(spark):
    """A user's own session: none of the settings of the package's."""
    made = spark.newSession()
    for key in SETTINGS:
        made.conf.unset(key)
    return made


@pytest.mark.parametrize("name", OWN)
def test_query(plain_session, tables, name):
    df = registered.queries()[name](plain_session, SF_DIR)
    rows = df.collect()
    if name in ROWS_ONLY:
        assert rows
        return
    result = tables.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, rows) == table(columns, result.fetchall())


def test_entry(spark):
    assert registered.entry(spark).limit(1).count() == 1
