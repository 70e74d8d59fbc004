"""One key holds a large share of all rows: Spark splits it, or it is small before the shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.facts import fact_order, fact_order_item, known_orders
from tallyhouse.operators.ranking import first_per_key

ROWS = 200_000


@pytest.fixture
def large_cluster_rules(spark):
    """Thresholds scaled down, so that this little data is treated as a cluster's would be."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def _third(expression):
    """A key that is 7 in a third of all rows."""
    return F.when(F.col("id") % 3 == 0, 7).otherwise(expression)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_of_a_hot_order_and_product_are_split(spark, staged, large_cluster_rules):
    rows = spark.range(0, ROWS, 1, 8)
    items = rows.select(
        _third(F.col("id") % 5000).cast("string").alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        _third(F.col("id") % 900).cast("string").alias("product_id"),
        (F.col("id") % 700).cast("string").alias("seller_id"),
        F.lit("2018-01-01").cast("timestamp_ntz").alias("shipping_limit_date"),
        F.rand(1).cast("decimal(12,2)").alias("price"),
        F.rand(2).cast("decimal(12,2)").alias("freight_value"),
    )
    keys = spark.range(0, 5000, 1, 8).select(F.col("id").cast("string").alias("key"))
    orders = keys.select(F.col("key").alias("order_id"), F.col("key").alias("customer_id"))
    known = known_orders(orders, keys.select(F.col("key").alias("customer_id")))
    facts = fact_order_item(
        items,
        known,
        keys.select(F.col("key").alias("product_id")),
        keys.select(F.col("key").alias("seller_id")),
    )
    plan = _final_plan(facts)
    assert "SortMergeJoin(skew=true)" in plan
    assert facts.count() == ROWS


def test_orders_of_a_hot_customer_are_split(spark, staged, large_cluster_rules):
    rows = spark.range(0, ROWS, 1, 8)
    empty = staged()
    moment = F.lit("2018-01-01").cast("timestamp_ntz")
    orders = rows.select(
        F.col("id").cast("string").alias("order_id"),
        _third(F.col("id") % 4000).cast("string").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        moment.alias("order_purchase_timestamp"),
        moment.alias("order_approved_at"),
        moment.alias("order_delivered_carrier_date"),
        moment.alias("order_delivered_customer_date"),
        moment.alias("order_estimated_delivery_date"),
    )
    customers = spark.range(0, 4000, 1, 8).select(
        F.col("id").cast("string").alias("customer_id"),
        F.col("id").cast("string").alias("customer_unique_id"),
    )
    facts = fact_order(orders, customers, empty["raw_order_payments"])
    plan = _final_plan(facts.select("order_id", "customer_unique_id", "payment_value"))
    assert "SortMergeJoin(skew=true)" in plan
    assert facts.count() == ROWS


def test_copies_of_one_key_shrink_before_the_shuffle(spark):
    rows = spark.range(0, ROWS, 1, 8).select(
        _third(F.col("id")).alias("key"), F.col("id").alias("rank"), F.lit("x").alias("rest")
    )
    kept = first_per_key(rows, ["key"], ["rank"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "partial_min" in plan[shuffle:]
    assert kept.where("key = 7").first()["rank"] == 0
