"""Coordinates per zip prefix and distances between sellers and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import distance_km
from tallyhouse.operators.distributions import exact_quantiles

COORDINATE_DECIMALS = 7


def geo_by_zip(geolocation: DataFrame) -> DataFrame:
    """Median latitude and longitude per zip prefix.

    A prefix may have any number of observations; both medians are exact and taken without
    gathering a prefix in one task. Each observation becomes one row per axis, so both axes share
    the same passes.
    """
    axis = geolocation.where(F.col("geolocation_zip_code_prefix").isNotNull()).unpivot(
        "geolocation_zip_code_prefix", ["geolocation_lat", "geolocation_lng"], "axis", "degrees"
    )
    medians = exact_quantiles(
        axis,
        "degrees",
        {"median": 0.5},
        keys=["geolocation_zip_code_prefix", "axis"],
        scale=COORDINATE_DECIMALS,
    )

    def of(name: str):
        return F.max(F.when(F.col("axis") == name, F.col("median")))

    return medians.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        of("geolocation_lat").alias("latitude"), of("geolocation_lng").alias("longitude")
    )


def _place(geo: DataFrame, side: str) -> DataFrame:
    return geo.select(
        F.col("zip_code_prefix").alias(f"{side}_zip_code_prefix"),
        F.col("latitude").alias(f"{side}_latitude"),
        F.col("longitude").alias(f"{side}_longitude"),
    )


def customer_geo(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """Customer records with the coordinates of their zip prefix, where known.

    The places have one row per prefix, so Spark broadcasts them when it measures them as small.
    """
    return customers.join(_place(geo, "customer"), "customer_zip_code_prefix", "left")


def seller_geo(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Sellers with the coordinates of their zip prefix, where known."""
    return sellers.join(_place(geo, "seller"), "seller_zip_code_prefix", "left")


def seller_customer_distance(
    items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame, geo: DataFrame
) -> DataFrame:
    """Kilometres between seller and customer of every item; NULL where a place is unknown.

    Coordinates are attached to sellers and customers, which are far fewer than items, and travel
    to the items along the keys they are joined on anyway; items never meet on a zip prefix.
    """
    buyer = ["customer_zip_code_prefix", "customer_latitude", "customer_longitude"]
    vendor = ["seller_zip_code_prefix", "seller_latitude", "seller_longitude"]
    buyers = orders.select("order_id", "customer_id").join(
        customer_geo(customers, geo).select("customer_id", *buyer), "customer_id"
    )
    return (
        items.select("order_id", "order_item_id", "product_id", "seller_id")
        .join(seller_geo(sellers, geo).select("seller_id", *vendor), "seller_id", "left")
        .join(buyers.drop("customer_id"), "order_id", "left")
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "seller_zip_code_prefix",
            "customer_zip_code_prefix",
            distance_km(*[F.col(c) for c in (*vendor[1:], *buyer[1:])]).alias("distance_km"),
        )
    )
