import datetime
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.rules import Rules
from ledgerloom.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rules():
    return Rules()


@pytest.fixture
def table(spark):
    """Make a table from a DDL schema and rows; text turns into dates and decimals."""

    def convert(value, kind: str):
        if value is None:
            return None
        if kind == "date":
            return datetime.date.fromisoformat(value)
        if kind.startswith("decimal"):
            return Decimal(str(value))
        return value

    def make(ddl: str, rows):
        kinds = [part.strip().split(" ", 1)[1] for part in ddl.split(";")]
        names = [part.strip().split(" ", 1)[0] for part in ddl.split(";")]
        data = [tuple(convert(v, k) for v, k in zip(row, kinds, strict=True)) for row in rows]
        schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
        return spark.createDataFrame(data, schema)

    return make


def values(df, *columns):
    """Rows as tuples, decimals as float and dates as text, in the order of an id."""

    def plain(v):
        if isinstance(v, Decimal):
            return float(v)
        if isinstance(v, datetime.date):
            return v.isoformat()
        return v

    return [tuple(plain(v) for v in row) for row in df.select(*columns).collect()]


def column(df, name, by="id"):
    return [row[0] for row in values(df.orderBy(by), name)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
