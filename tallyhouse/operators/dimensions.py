"""The four dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import blank_to_null, date_key
from tallyhouse.schemas import VOLUME

UNKNOWN = "unknown"

# Fixed value: the two weekend days, counting Sunday as 1.
WEEKEND = (1, 7)

# The date-times of an order that put their day into the calendar.
ORDER_MOMENTS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def dim_date(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per day that occurs in the data; not a gapless calendar.

    Orders are scanned once for their five dates. Each task first reduces its rows to distinct
    days, so only a few thousand days per task are shuffled.
    """
    days = (
        orders.select(F.explode(F.array(*[F.to_date(c) for c in ORDER_MOMENTS])).alias("full_date"))
        .union(items.select(F.to_date("shipping_limit_date")))
        .union(reviews.select(F.to_date("review_creation_date")))
        .where(F.col("full_date").isNotNull())
        .distinct()
    )
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_number"),
        F.day(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(*WEEKEND).alias("is_weekend"),
    )


def dim_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per person: first record, location of the latest record, order statistics.

    A record without an order has no purchase time and sorts before every record with one; ties go
    to the smaller identifier for "first" and to the larger for "latest". Comparing structs does
    both (NULL is smallest), which combine in each task before their shuffle (as sort aggregates, since structs
    have no fixed width). Orders are brought to one row per record before the join for the same reason.
    """
    placed = F.col("order_purchase_timestamp")
    per_record = orders.groupBy("customer_id").agg(
        F.min(placed).alias("first_order"),
        F.max(placed).alias("last_order"),
        F.count(placed).alias("orders"),
        F.max(placed.isNull()).alias("has_undated"),
    )
    records = customers.join(per_record, "customer_id", "left").withColumn(
        "earliest", F.when(~F.col("has_undated"), F.col("first_order"))
    )
    people = records.groupBy("customer_unique_id").agg(
        F.min(F.struct("earliest", "customer_id")).alias("head"),
        F.max(
            F.struct(
                "last_order",
                "customer_id",
                "customer_city",
                "customer_state",
                "customer_zip_code_prefix",
            )
        ).alias("latest"),
        F.min("first_order").alias("first_order_date"),
        F.max("last_order").alias("last_order_date"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
    )
    return people.select(
        "customer_unique_id",
        F.col("head.customer_id").alias("first_customer_id"),
        "latest.customer_city",
        "latest.customer_state",
        "latest.customer_zip_code_prefix",
        "first_order_date",
        "last_order_date",
        "total_orders",
    )


def dim_product(
    products: DataFrame, translation: DataFrame, collation: str | None = None
) -> DataFrame:
    """One row per product, with its English category and volume.

    A missing or blank category, or a missing translation, becomes ``unknown``; no product is
    dropped. Category names match byte for byte unless ``collation`` names a looser rule, for
    example ``UNICODE_CI_AI`` to ignore case and accents.
    """
    name = translation["product_category_name"]
    named = F.collate(name, collation) if collation else name
    # One translation per name as the rule sees it: the first spelling, then the first word.
    first = translation.groupBy(named.alias("__name")).agg(
        F.min(F.struct(name.alias("spelling"), "product_category_name_english")).alias("first")
    )
    one = first.select("__name", "first.product_category_name_english")
    ours = products["product_category_name"]
    ours = F.collate(ours, collation) if collation else ours
    joined = products.join(one, ours == F.col("__name"), "left")

    def known(column) -> F.Column:
        return F.coalesce(blank_to_null(column), F.lit(UNKNOWN))

    edges = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return joined.select(
        "product_id",
        known(products["product_category_name"]).alias("product_category_name"),
        known(F.col("product_category_name_english")).alias("product_category_name_english"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        edges.try_cast(VOLUME).alias("product_volume_cm3"),
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    """One row per seller."""
    return sellers.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix")
