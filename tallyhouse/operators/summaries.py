"""Amounts per order, brought to order grain before anything joins to orders.

Both sums combine on the map side, so an order with very many rows costs no task more than others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.schemas import TOTAL


def payment_summary(payments: DataFrame) -> DataFrame:
    """Paid amount per order."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").cast(TOTAL).alias("payment_value")
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    """Paid amount and number of payments per order."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").cast(TOTAL).alias("payment_value"),
        F.count("*").alias("payment_count"),
    )


def item_summary(items: DataFrame) -> DataFrame:
    """Merchandise, freight, number of items and number of sellers per order."""
    return items.groupBy("order_id").agg(
        F.sum("price").cast(TOTAL).alias("merchandise_value"),
        F.sum("freight_value").cast(TOTAL).alias("freight_value"),
        F.count("*").alias("item_count"),
        F.count_distinct("seller_id").alias("seller_count"),
    )
