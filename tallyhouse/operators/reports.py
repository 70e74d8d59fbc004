"""Exploration reports on the staging tables.

Rules shared by all of them: groups with a NULL key are left out, a sum without values is 0, and
every report joins only the tables it reads. Customers, payments (summed) and items (summed) have
one row per key, so a left join to them never changes the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import blank_to_null, floored_days, mean, month_label, ratio
from tallyhouse.operators.distributions import frequencies
from tallyhouse.operators.summaries import item_summary, payment_summary

Tables = Mapping[str, DataFrame]

# How many rows the top lists show.
TOP_STATES, TOP_CITIES, TOP_CATEGORIES, TOP_SELLERS, LAST_MONTHS = 15, 20, 15, 20, 12


def with_delivery(orders: DataFrame) -> DataFrame:
    """Orders with whole delivery days, promised days, and the late mark.

    Days are rounded down. An undelivered order is not late (False), unlike in ``fact_order``.
    """
    placed = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    return orders.withColumns(
        {
            "delivery_days": floored_days(placed, delivered),
            "estimated_delivery_days": floored_days(placed, promised),
            "late_delivery": F.coalesce(delivered > promised, F.lit(False)),
        }
    )


def orders_enriched(raw: Tables) -> DataFrame:
    """All orders with customer, amounts and delivery columns."""
    orders = (
        raw["raw_orders"]
        .join(raw["raw_customers"], "customer_id", "left")
        .join(payment_summary(raw["raw_order_payments"]), "order_id", "left")
        .join(item_summary(raw["raw_order_items"]), "order_id", "left")
    )
    return with_delivery(orders)


def category(english: str, original: str) -> Column:
    """English category name, else the original one, else ``unknown``; blank counts as missing."""
    names = [blank_to_null(F.col(english)), blank_to_null(F.col(original))]
    return F.coalesce(*names, F.lit("unknown")).alias("category")


def items_products(raw: Tables) -> DataFrame:
    """All items with product, translation, seller and category columns.

    Products take their translation before they meet the items, so items are joined twice only.
    """
    products = _translated(raw["raw_products"], raw)
    return (
        raw["raw_order_items"]
        .join(products, "product_id", "left")
        .join(raw["raw_sellers"], "seller_id", "left")
        .withColumn("category", category("product_category_name_english", "product_category_name"))
    )


def kpis(raw: Tables) -> DataFrame:
    """Eleven figures in one row; each table is scanned with the columns its figures need."""
    orders, payments = raw["raw_orders"], raw["raw_order_payments"]
    by_order = payment_summary(payments.dropna(subset=["order_id"]))
    delivered = with_delivery(orders.dropna(subset=["order_delivered_customer_date"]))
    figures = {
        "unique_orders": _distinct(orders, "order_id"),
        "unique_customers": _distinct(raw["raw_customers"], "customer_unique_id"),
        "unique_sellers": _distinct(raw["raw_sellers"], "seller_id"),
        "unique_products": _distinct(raw["raw_products"], "product_id"),
        "payment_value": payments.agg(_sum("payment_value")),
        "merchandise_value": raw["raw_order_items"].agg(_sum("price")),
        "freight_value": raw["raw_order_items"].agg(_sum("freight_value")),
        "avg_payment_per_order": by_order.agg(mean(F.col("payment_value"))),
        "avg_review_score": raw["raw_order_reviews"].agg(mean(F.col("review_score"))),
        # Days are small integers, so their median holds few values in memory.
        "median_delivery_days": delivered.agg(F.median("delivery_days")),
        "late_delivery_rate": delivered.agg(mean(F.col("late_delivery").cast("int"))),
    }
    one = orders.sparkSession.range(1)
    return one.select(*[figure.scalar().alias(name) for name, figure in figures.items()])


def monthly_orders(raw: Tables) -> DataFrame:
    """Distinct orders and paid amount per purchase month, in month order."""
    paid = _paid(raw["raw_orders"].dropna(subset=["order_purchase_timestamp"]), raw)
    return (
        paid.groupBy(month_label(F.col("order_purchase_timestamp")).alias("order_month"))
        .agg(F.count_distinct("order_id").alias("orders"), _sum("payment_value", "revenue"))
        .orderBy("order_month")
    )


def last_months(by_month: DataFrame, months: int = LAST_MONTHS) -> DataFrame:
    """The latest rows of a table by month, in month order."""
    return by_month.orderBy(F.desc("order_month")).limit(months).orderBy("order_month")


def top(report: DataFrame, measure: str, key: Sequence[str], rows: int) -> DataFrame:
    """The first rows by a measure; equal measures are ordered by key."""
    return report.orderBy(F.desc_nulls_last(measure), *key).limit(rows)


def order_status_mix(orders: DataFrame) -> DataFrame:
    """Share and number of orders per status."""
    mix = frequencies(orders, "order_status", "orders", share=True)
    return mix.orderBy(F.desc("orders"), "order_status")


def state_sales(raw: Tables) -> DataFrame:
    """Orders, paid amount and customers per customer state."""
    people = raw["raw_customers"].select("customer_id", "customer_unique_id", "customer_state")
    # Customers first: the distinct orders below then use the partitioning of the payment join.
    located = _paid(raw["raw_orders"].join(people, "customer_id"), raw)
    return (
        located.dropna(subset=["customer_state"])
        .groupBy("customer_state")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            _sum("payment_value", "revenue"),
            F.count_distinct("customer_unique_id").alias("customers"),
        )
        .orderBy(F.desc("orders"), "customer_state")
    )


def city_sales(raw: Tables) -> DataFrame:
    """Orders and paid amount per customer state and city."""
    place = ["customer_state", "customer_city"]
    people = raw["raw_customers"].select("customer_id", *place)
    located = _paid(raw["raw_orders"].join(people, "customer_id"), raw)
    return (
        located.dropna(subset=place)
        .groupBy(*place)
        .agg(F.count_distinct("order_id").alias("orders"), _sum("payment_value", "revenue"))
        .orderBy(F.desc("orders"), *place)
    )


def category_sales(raw: Tables) -> DataFrame:
    """Items, revenue, freight and sellers per product category."""
    sold = _sold_by_product_and_seller(raw)
    return (
        _with_category(sold, raw)
        .groupBy("category")
        .agg(*_sold_totals(), F.count_distinct("seller_id").alias("sellers"))
        .orderBy(F.desc("revenue"), "category")
    )


def ascending(report: DataFrame, measure: str, key: Sequence[str]) -> DataFrame:
    """A (short) report from its smallest to its largest measure."""
    return report.orderBy(F.asc(measure), *key)


def seller_sales(raw: Tables) -> DataFrame:
    """Items, revenue, freight and categories per seller of known place."""
    place = ["seller_state", "seller_city"]
    sellers = raw["raw_sellers"].select("seller_id", *place).dropna()
    sold = _sold_by_product_and_seller(raw).join(sellers, "seller_id")
    return (
        _with_category(sold, raw)
        .groupBy("seller_id", *place)
        .agg(*_sold_totals(), F.count_distinct("category").alias("categories"))
        .orderBy(F.desc("revenue"), "seller_id")
    )


def payment_mix(payments: DataFrame) -> DataFrame:
    """Transactions, amount, mean amount and mean instalments per payment type."""
    return (
        payments.dropna(subset=["payment_type"])
        .groupBy("payment_type")
        .agg(
            F.count("order_id").alias("transactions"),
            _sum("payment_value"),
            mean(F.col("payment_value")).alias("avg_payment"),
            mean(F.col("payment_installments")).alias("avg_installments"),
        )
        .orderBy(F.desc("payment_value"), "payment_type")
    )


def items_per_order_histogram(items: DataFrame) -> DataFrame:
    """Number of orders per number of items."""
    sizes = items.groupBy("order_id").agg(F.count("order_item_id").alias("item_count"))
    return (
        sizes.dropna(subset=["order_id"])
        .groupBy("item_count")
        .agg(F.count("*").alias("orders"))
        .orderBy("item_count")
    )


def late_by_state(raw: Tables) -> DataFrame:
    """Delivered orders, late share and median days per customer state.

    Orders are counted once per state, order, days and lateness; both the distinct orders and the
    days' counts, from which share and median come, are read from that one shuffle.
    """
    delivered = with_delivery(raw["raw_orders"].dropna(subset=["order_delivered_customer_date"]))
    located = delivered.join(
        raw["raw_customers"].select("customer_id", "customer_state"), "customer_id"
    ).dropna(subset=["customer_state"])
    counted = located.groupBy("customer_state", "order_id", "delivery_days", "late_delivery").agg(
        F.count("*").alias("n")
    )
    # Both halves use all columns, so they share the plan, and its result, up to here.
    sizes = counted.groupBy("customer_state", "order_id").agg(F.sum("n").alias("rows"))
    sizes = sizes.where("rows > 0").groupBy("customer_state")
    sizes = sizes.agg(F.count("order_id").alias("orders"))
    spread = (
        counted.groupBy("customer_state", "delivery_days", "late_delivery")
        .agg(F.sum("n").alias("n"))
        .groupBy("customer_state")
        .agg(
            ratio(F.sum(F.when(F.col("late_delivery"), F.col("n")).otherwise(0)), F.sum("n")).alias(
                "late_delivery_rate"
            ),
            F.percentile("delivery_days", 0.5, F.col("n")).alias("median_delivery_days"),
        )
    )
    return sizes.join(spread, "customer_state").orderBy(
        F.desc("late_delivery_rate"), "customer_state"
    )


def review_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score, in score order."""
    return frequencies(reviews, "review_score", "reviews").orderBy("review_score")


def review_summary(raw: Tables) -> DataFrame:
    """Reviews, mean delivery days, late share and mean paid amount per score.

    Undelivered orders count as not late here. Reviews are counted per order and score before they
    meet the orders, so an order with very many reviews is one row per score, and the means weigh
    that row with its number of reviews.
    """
    scored = (
        raw["raw_order_reviews"]
        .dropna(subset=["review_score"])
        .groupBy("order_id", "review_score")
        .agg(F.count("review_id").alias("reviews"), F.count("*").alias("weight"))
    )
    orders = _paid(with_delivery(raw["raw_orders"]), raw)
    joined = scored.join(
        orders.select("order_id", "delivery_days", "late_delivery", "payment_value"),
        "order_id",
        "left",
    )
    weight = F.col("weight")

    def weighted(value: Column) -> Column:
        return ratio(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))

    return (
        joined.groupBy("review_score")
        .agg(
            F.sum("reviews").alias("reviews"),
            weighted(F.col("delivery_days")).alias("avg_delivery_days"),
            weighted(F.col("late_delivery").cast("int")).alias("late_delivery_rate"),
            weighted(F.col("payment_value")).alias("avg_payment_value"),
        )
        .orderBy("review_score")
    )


def _paid(orders: DataFrame, raw: Tables) -> DataFrame:
    return orders.join(payment_summary(raw["raw_order_payments"]), "order_id", "left")


def _sold_by_product_and_seller(raw: Tables) -> DataFrame:
    """Items added up per product and seller: far fewer rows than items, and no hot product."""
    return (
        raw["raw_order_items"]
        .groupBy("product_id", "seller_id")
        .agg(
            F.count("order_item_id").alias("order_items"),
            F.sum("price").alias("price"),
            F.sum("freight_value").alias("freight_value"),
        )
    )


def _with_category(sold: DataFrame, raw: Tables) -> DataFrame:
    products = _translated(raw["raw_products"].select("product_id", "product_category_name"), raw)
    named = products.select(
        "product_id", category("product_category_name_english", "product_category_name")
    )
    # A product that is not in the table has no category either.
    return sold.join(named, "product_id", "left").fillna("unknown", ["category"])


def _translated(products: DataFrame, raw: Tables) -> DataFrame:
    translation = raw["raw_product_category_translation"]
    return products.join(translation, "product_category_name", "left")


def _sold_totals() -> list[Column]:
    return [
        F.sum("order_items").alias("order_items"),
        _sum("price", "revenue"),
        _sum("freight_value", "freight"),
    ]


def _sum(column: str, name: str | None = None) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(38,2)").alias(name or column)


def _distinct(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column))
