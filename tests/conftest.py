"""One small Spark session for all tests, and a maker of typed little tables."""

from __future__ import annotations

import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhouse.schemas import STAGING  # noqa: E402
from tallyhouse.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = open_session(
        "tallyhouse-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _value(kind, value):
    if value is None or not isinstance(value, (str, int, float)):
        return value
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    if isinstance(kind, T.TimestampNTZType):
        return datetime.fromisoformat(value)
    return value


@pytest.fixture(scope="session")
def staged(spark):
    """``staged(orders=[{...}], ...)``: all nine staging tables, empty unless rows are given.

    Columns a row leaves out are NULL.
    """

    def build(**rows):
        tables = {}
        for name, contract in STAGING.items():
            fields = [T.StructField(f.name, f.dataType, True) for f in contract.schema]
            schema = T.StructType(fields)
            given = rows.pop(name.removeprefix("raw_"), [])
            data = [tuple(_value(f.dataType, row.get(f.name)) for f in schema) for row in given]
            for row in given:
                assert set(row) <= set(schema.names), row
            tables[name] = spark.createDataFrame(data, schema)
        assert not rows, rows
        return tables

    return build


@pytest.fixture(scope="session")
def found():
    """``found(df, "key", "value")``: two columns of a result as a dict."""

    def build(df, key, value):
        return {row[key]: row[value] for row in df.collect()}

    return build
