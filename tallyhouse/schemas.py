"""Table contracts: columns, types, nullability and key of every staging and warehouse table.

Identifiers are declared as strings, which is what the CSV files hold. The operators never
rely on that: the sample tables use ``bigint`` identifiers and go through the same code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.IntegerType()
MOMENT = T.TimestampNTZType()
DAY = T.DateType()
FLAG = T.BooleanType()
MONEY = T.DecimalType(12, 2)
# Totals of one order and counts of one key are wider than single amounts and plain integers, so
# that one key may own any share of all rows.
TOTAL = T.DecimalType(22, 2)
COUNT = T.LongType()
SIZE = T.DecimalType(12, 2)
COUNTED = T.DecimalType(8, 2)
VOLUME = T.DecimalType(18, 2)
COORDINATE = T.DecimalType(10, 7)
DAYS = T.DecimalType(10, 2)
RATE = T.DecimalType(10, 4)


@dataclass(frozen=True)
class Contract:
    """What a table must look like; ``key`` is empty when the table has no key."""

    name: str
    key: tuple[str, ...]
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        """Columns that must never be NULL."""
        return [field.name for field in self.schema if not field.nullable]

    @property
    def moments(self) -> list[str]:
        """Date-time columns."""
        return [field.name for field in self.schema if field.dataType == MOMENT]


REQUIRED, NULLABLE = False, True


def _contract(name: str, key: str, *columns: tuple[str, T.DataType, bool]) -> Contract:
    fields = [T.StructField(*column) for column in columns]
    return Contract(name, tuple(key.split()), T.StructType(fields))


# Column names, types, nullability and keys are the public interface of the data.

STAGING: dict[str, Contract] = {
    c.name: c
    for c in (
        _contract(
            "raw_customers",
            "customer_id",
            ("customer_id", TEXT, REQUIRED),
            ("customer_unique_id", TEXT, REQUIRED),
            ("customer_zip_code_prefix", WHOLE, REQUIRED),
            ("customer_city", TEXT, REQUIRED),
            ("customer_state", TEXT, REQUIRED),
        ),
        _contract(
            "raw_geolocation",
            "",
            ("geolocation_zip_code_prefix", WHOLE, REQUIRED),
            ("geolocation_lat", COORDINATE, REQUIRED),
            ("geolocation_lng", COORDINATE, REQUIRED),
            ("geolocation_city", TEXT, REQUIRED),
            ("geolocation_state", TEXT, REQUIRED),
        ),
        _contract(
            "raw_orders",
            "order_id",
            ("order_id", TEXT, REQUIRED),
            ("customer_id", TEXT, REQUIRED),
            ("order_status", TEXT, REQUIRED),
            ("order_purchase_timestamp", MOMENT, REQUIRED),
            ("order_approved_at", MOMENT, NULLABLE),
            ("order_delivered_carrier_date", MOMENT, NULLABLE),
            ("order_delivered_customer_date", MOMENT, NULLABLE),
            ("order_estimated_delivery_date", MOMENT, REQUIRED),
        ),
        _contract(
            "raw_order_items",
            "order_id order_item_id",
            ("order_id", TEXT, REQUIRED),
            ("order_item_id", WHOLE, REQUIRED),
            ("product_id", TEXT, REQUIRED),
            ("seller_id", TEXT, REQUIRED),
            ("shipping_limit_date", MOMENT, REQUIRED),
            ("price", MONEY, REQUIRED),
            ("freight_value", MONEY, REQUIRED),
        ),
        _contract(
            "raw_order_payments",
            "order_id payment_sequential",
            ("order_id", TEXT, REQUIRED),
            ("payment_sequential", WHOLE, REQUIRED),
            ("payment_type", TEXT, REQUIRED),
            ("payment_installments", WHOLE, REQUIRED),
            ("payment_value", MONEY, REQUIRED),
        ),
        _contract(
            "raw_order_reviews",
            "review_id",
            ("review_id", TEXT, REQUIRED),
            ("order_id", TEXT, REQUIRED),
            ("review_score", WHOLE, REQUIRED),
            ("review_comment_title", TEXT, NULLABLE),
            ("review_comment_message", TEXT, NULLABLE),
            ("review_creation_date", MOMENT, NULLABLE),
            ("review_answer_timestamp", MOMENT, NULLABLE),
        ),
        _contract(
            "raw_products",
            "product_id",
            ("product_id", TEXT, REQUIRED),
            ("product_category_name", TEXT, NULLABLE),
            ("product_name_lenght", COUNTED, NULLABLE),
            ("product_description_lenght", COUNTED, NULLABLE),
            ("product_photos_qty", COUNTED, NULLABLE),
            ("product_weight_g", SIZE, NULLABLE),
            ("product_length_cm", SIZE, NULLABLE),
            ("product_height_cm", SIZE, NULLABLE),
            ("product_width_cm", SIZE, NULLABLE),
        ),
        _contract(
            "raw_sellers",
            "seller_id",
            ("seller_id", TEXT, REQUIRED),
            ("seller_zip_code_prefix", WHOLE, REQUIRED),
            ("seller_city", TEXT, REQUIRED),
            ("seller_state", TEXT, REQUIRED),
        ),
        _contract(
            "raw_product_category_translation",
            "product_category_name",
            ("product_category_name", TEXT, REQUIRED),
            ("product_category_name_english", TEXT, REQUIRED),
        ),
    )
}

WAREHOUSE: dict[str, Contract] = {
    c.name: c
    for c in (
        _contract(
            "dim_date",
            "date_key",
            ("date_key", WHOLE, REQUIRED),
            ("full_date", DAY, REQUIRED),
            ("year_number", WHOLE, REQUIRED),
            ("quarter_number", WHOLE, REQUIRED),
            ("month_number", WHOLE, REQUIRED),
            ("month_name", TEXT, REQUIRED),
            ("week_number", WHOLE, REQUIRED),
            ("day_of_month", WHOLE, REQUIRED),
            ("day_of_week", WHOLE, REQUIRED),
            ("day_name", TEXT, REQUIRED),
            ("is_weekend", FLAG, REQUIRED),
        ),
        _contract(
            "dim_customer",
            "customer_unique_id",
            ("customer_unique_id", TEXT, REQUIRED),
            ("first_customer_id", TEXT, REQUIRED),
            ("customer_city", TEXT, REQUIRED),
            ("customer_state", TEXT, REQUIRED),
            ("customer_zip_code_prefix", WHOLE, REQUIRED),
            ("first_order_date", MOMENT, NULLABLE),
            ("last_order_date", MOMENT, NULLABLE),
            ("total_orders", COUNT, REQUIRED),
        ),
        _contract(
            "dim_product",
            "product_id",
            ("product_id", TEXT, REQUIRED),
            ("product_category_name", TEXT, REQUIRED),
            ("product_category_name_english", TEXT, REQUIRED),
            ("product_name_length", COUNTED, NULLABLE),
            ("product_description_length", COUNTED, NULLABLE),
            ("product_photos_qty", COUNTED, NULLABLE),
            ("product_weight_g", SIZE, NULLABLE),
            ("product_volume_cm3", VOLUME, NULLABLE),
        ),
        _contract(
            "dim_seller",
            "seller_id",
            ("seller_id", TEXT, REQUIRED),
            ("seller_city", TEXT, REQUIRED),
            ("seller_state", TEXT, REQUIRED),
            ("seller_zip_code_prefix", WHOLE, REQUIRED),
        ),
        _contract(
            "fact_order",
            "order_id",
            ("order_id", TEXT, REQUIRED),
            ("customer_id", TEXT, REQUIRED),
            ("customer_unique_id", TEXT, REQUIRED),
            ("order_status", TEXT, REQUIRED),
            ("order_purchase_timestamp", MOMENT, REQUIRED),
            ("order_approved_at", MOMENT, NULLABLE),
            ("order_delivered_carrier_date", MOMENT, NULLABLE),
            ("order_delivered_customer_date", MOMENT, NULLABLE),
            ("order_estimated_delivery_date", MOMENT, REQUIRED),
            ("purchase_date_key", WHOLE, REQUIRED),
            ("approved_date_key", WHOLE, NULLABLE),
            ("delivered_carrier_date_key", WHOLE, NULLABLE),
            ("delivered_customer_date_key", WHOLE, NULLABLE),
            ("estimated_delivery_date_key", WHOLE, REQUIRED),
            ("payment_value", TOTAL, REQUIRED),
            ("payment_count", COUNT, REQUIRED),
            ("merchandise_value", TOTAL, REQUIRED),
            ("freight_value", TOTAL, REQUIRED),
            ("item_count", COUNT, REQUIRED),
            ("seller_count", COUNT, REQUIRED),
            ("approval_days", DAYS, NULLABLE),
            ("carrier_handling_days", DAYS, NULLABLE),
            ("delivery_days", DAYS, NULLABLE),
            ("estimated_delivery_days", DAYS, NULLABLE),
            ("late_delivery_flag", FLAG, NULLABLE),
        ),
        _contract(
            "fact_order_item",
            "order_id order_item_id",
            ("order_id", TEXT, REQUIRED),
            ("order_item_id", WHOLE, REQUIRED),
            ("product_id", TEXT, REQUIRED),
            ("seller_id", TEXT, REQUIRED),
            ("shipping_limit_date", MOMENT, REQUIRED),
            ("shipping_limit_date_key", WHOLE, REQUIRED),
            ("price", MONEY, REQUIRED),
            ("freight_value", MONEY, REQUIRED),
            ("line_total_value", MONEY, REQUIRED),
            ("freight_rate", RATE, NULLABLE),
        ),
        _contract(
            "fact_review",
            "review_id",
            ("review_id", TEXT, REQUIRED),
            ("order_id", TEXT, REQUIRED),
            ("review_score", WHOLE, REQUIRED),
            ("review_comment_title", TEXT, NULLABLE),
            ("review_comment_message", TEXT, NULLABLE),
            ("review_creation_date", MOMENT, REQUIRED),
            ("review_answer_timestamp", MOMENT, NULLABLE),
            ("review_creation_date_key", WHOLE, REQUIRED),
            ("review_response_days", DAYS, NULLABLE),
            ("has_review_comment", FLAG, REQUIRED),
            ("is_negative_review", FLAG, REQUIRED),
            ("is_positive_review", FLAG, REQUIRED),
        ),
    )
}
