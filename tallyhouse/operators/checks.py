"""Data-quality checks. Each returns one row per check: its name and how much failed.

Conditions on one table are counted in one pass over it. Keys are counted per task before they
are shuffled, so neither a hot key nor a large child table makes a join large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import is_blank
from tallyhouse.schemas import STAGING, WAREHOUSE, Contract

Tables = Mapping[str, DataFrame]

ROWS = "failed_rows"
GROUPS = "failed_groups"


def together(parts: Sequence[DataFrame]) -> DataFrame:
    """The rows of all parts."""
    return reduce(DataFrame.unionByName, parts)


def count_conditions(
    df: DataFrame, conditions: Mapping[str, Column | Sequence[Column]]
) -> DataFrame:
    """Rows meeting each named condition, from a single aggregate over the table.

    Several conditions under one name are counted one by one and added up.
    """
    totals = {}
    for name, found in conditions.items():
        each = [F.count_if(c) for c in ([found] if isinstance(found, Column) else found)]
        totals[name] = reduce(Column.__add__, each)
    return _one_row_per_check(df, totals)


def _one_row_per_check(df: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    one_row = df.agg(*[total.alias(f"c{i}") for i, total in enumerate(totals.values())])
    named = [F.struct(F.lit(n).alias("n"), F.col(f"c{i}").alias("c")) for i, n in enumerate(totals)]
    return one_row.select(F.inline(F.array(*named)).alias("check_name", ROWS))


def count_repeated(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """How many key values occur more than once."""
    sizes = df.groupBy(*key).agg(F.count("*").alias("size"))
    return sizes.agg(F.count_if(F.col("size") > 1).alias(GROUPS)).select(
        F.lit(name).alias("check_name"), GROUPS
    )


def count_unmatched(
    child: DataFrame, parent: DataFrame, key: str, name: str, null_is_missing: bool = True
) -> DataFrame:
    """Child rows whose key is not in the parent. A NULL key counts unless told otherwise."""
    if not null_is_missing:
        child = child.where(F.col(key).isNotNull())
    per_key = child.groupBy(key).agg(F.count("*").alias("rows"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(ROWS)).select(
        F.lit(name).alias("check_name"), ROWS
    )


def row_counts(tables: Tables, names: Sequence[str]) -> DataFrame:
    """``table_name, row_count`` of the named tables."""
    return together(
        [
            tables[n].agg(F.count("*").alias("row_count")).select(
                F.lit(n).alias("table_name"), "row_count"
            )
            for n in names
        ]
    )


# Table names and check names in the following groups are part of the interface.

RAW_COUNT_TABLES = (
    "raw_customers",
    "raw_geolocation",
    "raw_orders",
    "raw_order_items",
    "raw_order_payments",
    "raw_order_reviews",
    "raw_products",
    "raw_sellers",
    "raw_product_category_translation",
)

WAREHOUSE_COUNT_TABLES = (
    "dim_date",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "fact_order",
    "fact_order_item",
    "fact_review",
)

REQUIRED_KEYS = (
    ("raw_customers", "customer_id"),
    ("raw_orders", "order_id"),
    ("raw_order_items", "order_id"),
    ("raw_order_items", "product_id"),
    ("raw_order_items", "seller_id"),
    ("raw_order_payments", "order_id"),
    ("raw_order_reviews", "review_id"),
    ("raw_products", "product_id"),
    ("raw_sellers", "seller_id"),
)

UNIQUE_KEYS = {
    "duplicate raw customer_id": "raw_customers",
    "duplicate raw order_id": "raw_orders",
    "duplicate raw order item grain": "raw_order_items",
    "duplicate raw payment grain": "raw_order_payments",
    "duplicate raw review_id": "raw_order_reviews",
    "duplicate raw product_id": "raw_products",
    "duplicate raw seller_id": "raw_sellers",
}

REFERENCES = {
    "orders missing customer": ("raw_orders", "raw_customers", "customer_id"),
    "order items missing order": ("raw_order_items", "raw_orders", "order_id"),
    "payments missing order": ("raw_order_payments", "raw_orders", "order_id"),
    "reviews missing order": ("raw_order_reviews", "raw_orders", "order_id"),
    "order items missing product": ("raw_order_items", "raw_products", "product_id"),
    "order items missing seller": ("raw_order_items", "raw_sellers", "seller_id"),
}

LOWEST_SCORE, HIGHEST_SCORE = 1, 5


def required_keys(raw: Tables) -> DataFrame:
    """Rows whose key is NULL or blank."""
    per_table: dict[str, dict[str, Column]] = {}
    for table, column in REQUIRED_KEYS:
        failing = per_table.setdefault(table, {})
        failing[f"{table}.{column} nulls"] = is_blank(F.col(column))
    return together([count_conditions(raw[t], failing) for t, failing in per_table.items()])


def duplicate_grain(raw: Tables) -> DataFrame:
    """Keys that identify more than one row (``failed_groups``)."""
    return together(
        [count_repeated(raw[t], STAGING[t].key, name) for name, t in UNIQUE_KEYS.items()]
    )


def relationships(raw: Tables) -> DataFrame:
    """Rows that refer to a row which does not exist."""
    return together(
        [
            count_unmatched(raw[child], raw[parent], key, name)
            for name, (child, parent, key) in REFERENCES.items()
        ]
    )


def business_rules(raw: Tables) -> DataFrame:
    """Values outside their range and dates in the wrong order; NULL never fails."""
    placed = F.col("order_purchase_timestamp")
    return together(
        [
            count_conditions(
                raw["raw_order_items"],
                {
                    "negative item price": F.col("price") < 0,
                    "negative freight value": F.col("freight_value") < 0,
                },
            ),
            count_conditions(
                raw["raw_order_payments"],
                {"negative payment value": F.col("payment_value") < 0},
            ),
            count_conditions(
                raw["raw_order_reviews"],
                {
                    "invalid review score": ~F.col("review_score").between(
                        LOWEST_SCORE, HIGHEST_SCORE
                    )
                },
            ),
            count_conditions(
                raw["raw_orders"],
                {
                    "delivered before purchase": F.col("order_delivered_customer_date") < placed,
                    "approved before purchase": F.col("order_approved_at") < placed,
                },
            ),
        ]
    )


def datetime_hygiene(reviews: DataFrame) -> DataFrame:
    """Zero and missing review dates.

    On the text layer of a file the zero date-time is visible; a typed table cannot hold it, so
    there it counts as missing.
    """
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")

    def zero(moment: Column) -> Column:
        return moment.cast("string") == "0000-00-00 00:00:00"

    return count_conditions(
        reviews,
        {
            "zero review creation date": zero(created),
            "zero review answer timestamp": zero(answered),
            "missing review creation date": is_blank(created),
            "missing review answer timestamp": is_blank(answered),
        },
    )


def raw_constraints(raw: Tables) -> DataFrame:
    """What the staging contracts declare beyond the groups above.

    Required columns without NULL, a non-negative number of instalments, and unique names in the
    translation table.
    """
    parts = []
    for name, contract in STAGING.items():
        failing = _nulls(contract)
        if name == "raw_order_payments":
            failing["raw_order_payments.payment_installments negative"] = (
                F.col("payment_installments") < 0
            )
        parts.append(count_conditions(raw[name], failing))
    translation = "raw_product_category_translation"
    parts.append(
        count_repeated(
            raw[translation], STAGING[translation].key, f"{translation} key repeated"
        ).withColumnRenamed(GROUPS, ROWS)
    )
    return together(parts)


def warehouse_keys(warehouse: Tables) -> DataFrame:
    """Primary keys of the warehouse tables and the calendar's unique day (``failed_groups``)."""
    parts = [
        count_repeated(warehouse[name], contract.key, f"{name} key repeated")
        for name, contract in WAREHOUSE.items()
    ]
    parts.append(
        count_repeated(warehouse["dim_date"], ["full_date"], "dim_date.full_date repeated")
    )
    return together(parts)


NON_NEGATIVE = {
    "dim_customer": ("total_orders",),
    "fact_order": (
        "payment_value",
        "merchandise_value",
        "freight_value",
        "item_count",
        "seller_count",
    ),
    "fact_order_item": ("price", "freight_value", "line_total_value"),
}


def warehouse_rules(warehouse: Tables) -> DataFrame:
    """Required columns without NULL and values inside their range, one pass per table."""
    parts = []
    for name, contract in WAREHOUSE.items():
        failing = _nulls(contract)
        for column in NON_NEGATIVE.get(name, ()):
            failing[f"{name}.{column} negative"] = F.col(column) < 0
        if name == "fact_review":
            failing["fact_review.review_score out of range"] = ~F.col("review_score").between(
                LOWEST_SCORE, HIGHEST_SCORE
            )
        parts.append(count_conditions(warehouse[name], failing))
    return together(parts)


WAREHOUSE_REFERENCES = (
    ("fact_order", "customer_unique_id", "dim_customer"),
    ("fact_order_item", "order_id", "fact_order"),
    ("fact_order_item", "product_id", "dim_product"),
    ("fact_order_item", "seller_id", "dim_seller"),
    ("fact_review", "order_id", "fact_order"),
)

CALENDAR_REFERENCES = {
    "fact_order": (
        "purchase_date_key",
        "approved_date_key",
        "delivered_carrier_date_key",
        "delivered_customer_date_key",
        "estimated_delivery_date_key",
    ),
    "fact_order_item": ("shipping_limit_date_key",),
    "fact_review": ("review_creation_date_key",),
}


def warehouse_references(warehouse: Tables) -> DataFrame:
    """Foreign keys of the facts; a NULL foreign key is allowed.

    One scan per fact for all of its keys: they are counted by check and value in each task before
    they meet the known values, which are read once per parent table.
    """
    references = [
        *((child, key, parent, key) for child, key, parent in WAREHOUSE_REFERENCES),
        *((c, key, "dim_date", "date_key") for c, keys in CALENDAR_REFERENCES.items() for key in keys),
    ]
    names = [f"{child}.{key} unknown" for child, key, _, _ in references]
    used, known = [], []
    for fact in dict.fromkeys(child for child, _, _, _ in references):
        pairs = [
            _target(f"{child}.{key} unknown", parent, key)
            for child, key, parent, _ in references
            if child == fact
        ]
        used.append(warehouse[fact].select(F.inline(F.array(*pairs))))
    for parent, key in dict.fromkeys((parent, key) for _, _, parent, key in references):
        value = F.col(key).cast("string").alias("value")
        known.append(warehouse[parent].select(F.lit(parent).alias("parent"), value))
    counted = (
        together(used)
        .where(F.col("value").isNotNull())
        .groupBy("check_name", "parent", "value")
        .agg(F.count("*").alias("rows"))
    )
    lost = counted.join(together(known), ["parent", "value"], "left_anti")
    sums = {
        n: F.coalesce(F.sum(F.when(F.col("check_name") == n, F.col("rows"))), F.lit(0))
        for n in names
    }
    return _one_row_per_check(lost, sums)


def _target(name: str, parent: str, key: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(parent).alias("parent"),
        F.col(key).cast("string").alias("value"),
    )


def _nulls(contract: Contract) -> dict[str, Column]:
    return {f"{contract.name}.{c} missing": F.col(c).isNull() for c in contract.required}
