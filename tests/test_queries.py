"""Every registered query gives what its SQL gives, and runs as a plan we want."""

from __future__ import annotations

import math
import re
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from tallyhouse.plans.oracle import oracle_queries
from tallyhouse.plans.queries import all_queries

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()
QUERIES, EXPECTED = all_queries(), oracle_queries()


@pytest.fixture(scope="module")
def sample():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{SMALL}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def test_every_query_has_its_expectation():
    assert set(QUERIES) == set(EXPECTED)
    assert len(QUERIES) > 75
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(EXPECTED) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sample, name):
    df = QUERIES[name](spark, SMALL)
    result = sample.execute(EXPECTED[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(
        tuple(_plain(row[names.index(c)]) for c in df.columns) for row in result.fetchall()
    )
    assert sorted(tuple(_plain(v) for v in row) for row in df.collect()) == expected

    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize(
    "name",
    "monthly_orders top_categories monthly_orders_last12 state_sales dataset_profile".split(),
)
def test_order_of_rows(spark, name):
    """Collected rows come in the stated order."""
    rows = QUERIES[name](spark, SMALL).collect()
    order = {
        "monthly_orders": lambda r: r.order_month,
        "monthly_orders_last12": lambda r: r.order_month,
        "top_categories": lambda r: (r.revenue, r.category),
        "state_sales": lambda r: (-r.orders, r.customer_state),
        "dataset_profile": lambda r: (-r.rows, r.dataset),
    }[name]
    assert rows == sorted(rows, key=order)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["order_month", "orders", "revenue"]
    assert df.count() > 0


def _explained(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()


def test_existence_is_a_semi_or_anti_join(spark):
    assert _explained(spark, "fact_order_item").count("LeftSemi") >= 3
    assert "LeftSemi" in _explained(spark, "fact_review")
    relations = _explained(spark, "check_relationships")
    assert "LeftAnti" in relations and "LeftOuter" not in relations


def test_scans_read_only_the_columns_they_need(spark):
    plan = _explained(spark, "order_status_mix")
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert schemas == {"struct<o_orderkey:bigint,o_orderstatus:string>"}


def test_lean_warehouse_never_reads_amounts(spark):
    plan = _explained(spark, "late_rate_trend")
    assert "lineitem" not in plan


def test_checks_of_one_table_share_a_scan(spark):
    plan = QUERIES["check_business_rules"](spark, SMALL)._jdf.queryExecution()
    scans = re.findall(r"FileScan parquet", plan.executedPlan().toString())
    assert len(scans) == 4
