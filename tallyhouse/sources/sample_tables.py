"""The nine staging tables made from the sample Parquet tables.

Every table is a plain projection of whole sample tables (plus the 25-row nation lookup), so a
query's plan shows the shuffles of its own operators and no others. Defects the checks look for
(unknown references, blanks, zero and negative amounts, odd dates, repeated keys) are put in by
changing values; no row is left out. Identifiers stay ``bigint``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.schemas import COORDINATE, COUNTED, MONEY, SIZE
from tallyhouse.tables import LazyTables


# The columns the staging tables read, as stored; declared so that no file is opened to plan.
_STORED = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "props string",
    "embeddings": "embedding array<float>, label int",
}


def load_sample(spark: SparkSession, directory: str) -> LazyTables:
    """Staging tables by name, lazily read from ``directory``."""

    def stored(name: str) -> DataFrame:
        return spark.read.schema(_STORED[name]).parquet(f"{directory}/{name}.parquet")

    return LazyTables(
        {
            "raw_customers": lambda: _customers(stored("customer"), stored("nation")),
            "raw_geolocation": lambda: _geolocation(stored("embeddings")),
            "raw_orders": lambda: _orders(stored("orders")),
            "raw_order_items": lambda: _items(stored("lineitem")),
            "raw_order_payments": lambda: _payments(stored("lineitem")),
            "raw_order_reviews": lambda: _reviews(stored("events")),
            "raw_products": lambda: _products(stored("part")),
            "raw_sellers": lambda: _sellers(stored("supplier"), stored("nation")),
            "raw_product_category_translation": lambda: _translation(stored("part")),
        }
    )


def _after(moment: Column, minutes: Column) -> Column:
    return moment + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def _unknown_when(key: Column, condition: Column) -> Column:
    """Point some references at an identifier that exists nowhere."""
    return F.when(condition, -1 - key).otherwise(key)


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    # Three customer records share one person, so "latest location" has something to choose.
    key = F.col("c_custkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        key.alias("customer_id"),
        (key - key % 3).alias("customer_unique_id"),
        (key % 100).cast("int").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), (key % 37).cast("string")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _orders(orders: DataFrame) -> DataFrame:
    order, customer, placed = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    state = F.col("o_orderstatus")
    approval = (order % 72 - 2) * 60 + order % 60
    handover = (order % 72 + customer % 120) * 60 + order % 60
    arrival = handover + ((order * 7) % 500) * 60
    early = -90 - order % 600
    return orders.select(
        order.alias("order_id"),
        # Some buyers are unknown, and the customers they would be never order.
        _unknown_when(customer, customer % 50 == 7).alias("customer_id"),
        F.when(order % 50 == 0, "canceled")
        .when(order % 97 == 0, "unavailable")
        .when(state == "F", "delivered")
        .when(state == "P", "shipped")
        .otherwise("created")
        .alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        F.when(order % 61 != 0, _after(placed, approval)).alias("order_approved_at"),
        F.when(state.isin("F", "P"), _after(placed, handover)).alias(
            "order_delivered_carrier_date"
        ),
        F.when((state == "F") & (order % 211 == 5), _after(placed, early))
        .when(state == "F", _after(placed, arrival))
        .alias("order_delivered_customer_date"),
        _after(placed, (14 + order % 10) * 1440).alias("order_estimated_delivery_date"),
    )


def _items(lines: DataFrame) -> DataFrame:
    # Line numbers repeat within some orders; they stay, so the grain check has a live case.
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    price = F.col("l_extendedprice")
    return lines.select(
        _unknown_when(order, order % 331 == 1).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _unknown_when(part, part % 200 == 199).alias("product_id"),
        _unknown_when(supplier, supplier % 10 == 9).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.when(part % 500 == 0, F.lit(0.0))
        .when(part % 977 == 3, -price)
        .otherwise(price)
        .cast(MONEY)
        .alias("price"),
        F.col("l_quantity").cast(MONEY).alias("freight_value"),
    )


def _payments(lines: DataFrame) -> DataFrame:
    order, flag, price = F.col("l_orderkey"), F.col("l_returnflag"), F.col("l_extendedprice")
    return lines.select(
        _unknown_when(order, order % 337 == 1).alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(flag == "A", "credit_card")
        .when(flag == "N", "boleto")
        .otherwise("voucher")
        .alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        F.when(F.col("l_partkey") % 997 == 5, -price)
        .otherwise(price)
        .cast(MONEY)
        .alias("payment_value"),
    )


def _reviews(events: DataFrame) -> DataFrame:
    key, moment = F.col("event_id"), F.col("ts")
    return events.select(
        # Some review identifiers come twice.
        F.when(key % 30 == 1, key - 1).otherwise(key).alias("review_id"),
        _unknown_when(key - key % 2, key % 97 == 3).alias("order_id"),
        F.when(key % 211 == 0, 0)
        .otherwise(1 + (F.col("user_id") + key) % 5)
        .cast("int")
        .alias("review_score"),
        F.when(key % 10 == 0, F.col("event_type"))
        .when(key % 10 == 1, "")
        .alias("review_comment_title"),
        F.when(key % 4 == 0, "")
        .when(key % 4 == 1, "  ")
        .when(key % 4 == 2, F.col("props"))
        .alias("review_comment_message"),
        F.when(key % 25 != 0, moment).alias("review_creation_date"),
        F.when(key % 7 != 0, _after(moment, (key % 200) * 60)).alias("review_answer_timestamp"),
    )


def _products(part: DataFrame) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        key.alias("product_id"),
        F.when(key % 50 == 0, None)
        .when(key % 50 == 1, "")
        .when(key % 50 == 2, "unlisted")
        .otherwise(F.lower("p_type"))
        .alias("product_category_name"),
        F.length("p_name").cast(COUNTED).alias("product_name_lenght"),
        (F.length("p_name") * 7).cast(COUNTED).alias("product_description_lenght"),
        (size % 6).cast(COUNTED).alias("product_photos_qty"),
        F.col("p_retailprice").cast(SIZE).alias("product_weight_g"),
        F.when(key % 40 != 0, size.cast(SIZE)).alias("product_length_cm"),
        (size + 1).cast(SIZE).alias("product_height_cm"),
        (size + 2).cast(SIZE).alias("product_width_cm"),
    )


def _sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        key.alias("seller_id"),
        (key % 100).cast("int").alias("seller_zip_code_prefix"),
        F.concat(F.lit("city_"), (key % 37).cast("string")).alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def _translation(part: DataFrame) -> DataFrame:
    # One category has a blank translation, one product category ("unlisted") has none.
    kinds = part.select("p_type").distinct()
    name = F.lower("p_type")
    return kinds.select(
        name.alias("product_category_name"),
        F.when(F.col("p_type") == "ECONOMY", "")
        .otherwise(F.concat(F.lit("en_"), name))
        .alias("product_category_name_english"),
    )


def _geolocation(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(
        F.col("label").alias("geolocation_zip_code_prefix"),
        F.element_at("embedding", 1).cast(COORDINATE).alias("geolocation_lat"),
        F.element_at("embedding", 2).cast(COORDINATE).alias("geolocation_lng"),
        F.concat(F.lit("city_"), F.col("label").cast("string")).alias("geolocation_city"),
        F.lit("XX").alias("geolocation_state"),
    )
