"""Stored tables let a reader of one key skip most of what they hold."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyhouse.schemas import STAGING, WAREHOUSE
from tallyhouse.sources.snapshots import SnapshotStore
from tallyhouse.sources.warehouse_store import LOOKUPS, put_table, read_table, stored_order

KEYS, COPIES = 30_000, 2


def rows_scanned(df):
    """Rows that the scan hands on after skipping row groups and pages, and the rows of the result."""
    plan = df._jdf.queryExecution().executedPlan()
    total = df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().apply(0).metrics().get("numOutputRows").get().value(), total


@pytest.fixture(scope="module")
def stored(spark, staged, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layout"))
    rows = spark.range(0, KEYS * COPIES, 1, 3)
    key = F.md5((F.col("id") % KEYS).cast("string"))
    items = rows.select(
        key.alias("order_id"),
        (F.col("id") / KEYS).cast("int").alias("order_item_id"),
        F.md5(F.col("id").cast("string")).alias("product_id"),
        F.lit("s").alias("seller_id"),
        F.lit("2018-01-01").cast("timestamp_ntz").alias("shipping_limit_date"),
        F.lit(20180101).alias("shipping_limit_date_key"),
        *[F.lit(1).cast("decimal(12,2)").alias(c) for c in ("price", "freight_value", "line_total_value")],
        F.lit(1).cast("decimal(10,4)").alias("freight_rate"),
    )
    draft = SnapshotStore(spark, root).begin()
    spark.conf.set("parquet.page.row.count.limit", "500")
    put_table(draft, "fact_order_item", items)
    spark.conf.unset("parquet.page.row.count.limit")
    draft.commit()
    return root


def test_one_order_reads_few_rows(spark, stored):
    wanted = spark.range(1).select(F.md5(F.lit("77")).alias("k")).first().k
    found = read_table(spark, "fact_order_item", stored).where(F.col("order_id") == wanted)
    scanned, rows = rows_scanned(found)
    assert rows == COPIES
    assert scanned < KEYS * COPIES / 10


def test_bloom_filters_skip_what_no_minimum_can(spark, stored):
    """Products are in no order, and an absent one lies between their least and greatest."""
    table = read_table(spark, "fact_order_item", stored)
    scanned, rows = rows_scanned(table.where(F.col("product_id") == "8" + "0" * 31))
    assert (scanned, rows) == (0, 0)


def test_rows_are_sorted_inside_files_and_none_is_lost(spark, stored):
    path = SnapshotStore(spark, stored).path("fact_order_item")
    files = [str(p) for p in Path(path).glob("*.parquet")]
    assert len(files) == 3
    total = 0
    for file in files:
        keys = pq.read_table(file, columns=["order_id"])["order_id"].to_pylist()
        assert keys == sorted(keys)
        total += len(keys)
    assert total == KEYS * COPIES


def test_lookups_name_columns_of_the_contracts():
    for name, columns in LOOKUPS.items():
        assert set(columns) <= set((STAGING | WAREHOUSE)[name].columns), name
    assert stored_order("raw_orders") == () and stored_order("fact_order") == ("order_id",)
    assert stored_order("dim_date") == ()
