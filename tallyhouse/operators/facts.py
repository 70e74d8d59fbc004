"""The three facts of the star schema.

Existence conditions are semi joins on unique keys: they keep the grain of the fact and need only
the key of the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import blank_to_null, date_key, says_something, started_days
from tallyhouse.operators.summaries import item_summary, payment_totals
from tallyhouse.schemas import COUNT, MONEY, RATE, TOTAL

# Scores up to / from which a review counts as negative / positive.
NEGATIVE_UP_TO = 2
POSITIVE_FROM = 4


def known_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Keys of the orders that ``fact_order`` holds, without computing the fact."""
    return orders.join(customers, "customer_id", "left_semi").select("order_id")


def order_lifecycle(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The part of ``fact_order`` that needs no amounts: keys, dates, durations, late flag.

    Orders whose customer is unknown are left out. ``late_delivery_flag`` is NULL while an order
    is undelivered.
    """
    placed = F.col("order_purchase_timestamp")
    approved = F.col("order_approved_at")
    handed_over = F.col("order_delivered_carrier_date")
    delivered = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    people = customers.select("customer_id", "customer_unique_id")
    return orders.join(people, "customer_id").select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "order_status",
        placed,
        approved,
        handed_over,
        delivered,
        promised,
        date_key(placed).alias("purchase_date_key"),
        date_key(approved).alias("approved_date_key"),
        date_key(handed_over).alias("delivered_carrier_date_key"),
        date_key(delivered).alias("delivered_customer_date_key"),
        date_key(promised).alias("estimated_delivery_date_key"),
        started_days(placed, approved).alias("approval_days"),
        started_days(approved, handed_over).alias("carrier_handling_days"),
        started_days(placed, delivered).alias("delivery_days"),
        started_days(placed, promised).alias("estimated_delivery_days"),
        (delivered > promised).alias("late_delivery_flag"),
    )


def fact_order(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame | None = None,
    items: DataFrame | None = None,
) -> DataFrame:
    """One row per order of a known customer, with its amounts (0 where it has none).

    A left join stays in a plan even when its columns are not used. So a query that needs only
    payments, or only items, leaves the other one out and gets the fact without those columns.
    """
    fact = order_lifecycle(orders, customers)
    lifecycle = fact.columns
    amounts: dict[str, object] = {}
    if payments is not None:
        fact = fact.join(payment_totals(payments), "order_id", "left")
        amounts |= {"payment_value": TOTAL, "payment_count": COUNT}
    if items is not None:
        fact = fact.join(item_summary(items), "order_id", "left")
        amounts |= {"merchandise_value": TOTAL, "freight_value": TOTAL}
        amounts |= {"item_count": COUNT, "seller_count": COUNT}
    filled = [F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c) for c, t in amounts.items()]
    at = lifecycle.index("approval_days")
    return fact.select(*lifecycle[:at], *filled, *lifecycle[at:])


def fact_order_item(
    items: DataFrame, orders: DataFrame | None, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    """One row per item whose order, product and seller are known.

    ``orders`` may be None for readers that join the result to known orders themselves.

    ``orders``, ``products`` and ``sellers`` may be any tables holding the key: ``fact_order`` as
    stored, or ``known_orders``. The small sides come first, so fewer items reach the big one.
    A total or rate too large for its column is NULL, which the checks of the fact report.
    """
    price, freight = F.col("price"), F.col("freight_value")
    offered = items.join(sellers.select("seller_id"), "seller_id", "left_semi").join(
        products.select("product_id"), "product_id", "left_semi"
    )
    return (
        (offered.join(orders.select("order_id"), "order_id", "left_semi") if orders is not None else offered)
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            date_key(F.col("shipping_limit_date")).alias("shipping_limit_date_key"),
            price,
            freight,
            (price + freight).try_cast(MONEY).alias("line_total_value"),
            F.try_divide(freight, price).try_cast(RATE).alias("freight_rate"),
        )
    )


def fact_review(reviews: DataFrame, orders: DataFrame | None) -> DataFrame:
    """One row per review that has a creation date and a known order.

    ``orders`` may be None for readers that join the result to known orders themselves. A message of spaces only is kept as it is but does not count as a comment.
    """
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    score = F.col("review_score")
    dated = reviews.where(created.isNotNull())
    return (
        (dated.join(orders.select("order_id"), "order_id", "left_semi") if orders is not None else dated)
        .select(
            "review_id",
            "order_id",
            score,
            blank_to_null(F.col("review_comment_title")).alias("review_comment_title"),
            blank_to_null(F.col("review_comment_message")).alias("review_comment_message"),
            created,
            answered,
            date_key(created).alias("review_creation_date_key"),
            started_days(created, answered).alias("review_response_days"),
            says_something(F.col("review_comment_message")).alias("has_review_comment"),
            (score <= NEGATIVE_UP_TO).alias("is_negative_review"),
            (score >= POSITIVE_FROM).alias("is_positive_review"),
        )
    )
