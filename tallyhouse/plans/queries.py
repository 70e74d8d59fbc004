"""Every ready query by name: ``(spark, directory of sample tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import (
    board,
    checks,
    distributions,
    gate,
    geography,
    metrics,
    profile,
    reports,
)
from tallyhouse.operators.ranking import customer_order_ranks
from tallyhouse.operators.summaries import item_summary, payment_summary
from tallyhouse.plans.months import month_board
from tallyhouse.plans.quarantine import judge, rejections, rules_from
from tallyhouse.plans.warehouse import (
    dedupe,
    dedupe_reviews,
    lazy_warehouse,
    surplus_keys,
    warehouse_row_counts,
)
from tallyhouse.sources.sample_tables import load_sample

Tables = Mapping[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

# Figures worked out in floating point are shown with this many decimals.
DECIMALS = 6

# The selection behind the "dashboard_filtered" queries.
SELECTION = metrics.Filters(
    date_from=date(1996, 1, 1),
    date_to=date(2000, 6, 30),
    customer_states=("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13"),
    product_categories=("en_small", "en_promo", "en_large"),
    seller_states=("NATION_0", "NATION_4", "NATION_7", "NATION_15", "NATION_16", "NATION_20"),
    order_statuses=("delivered", "shipped"),
)


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """The same rows with floating-point columns rounded."""
    return df.select(
        *[
            F.round(f.name, decimals).alias(f.name) if f.dataType == T.DoubleType() else f.name
            for f in df.schema
        ]
    )


def _paid_per_order(raw: Tables) -> DataFrame:
    return payment_summary(raw["raw_order_payments"]).dropna(subset=["order_id"])


def _delivery_days(raw: Tables) -> DataFrame:
    return reports.with_delivery(raw["raw_orders"]).select("delivery_days")


def _describe_payments(raw: Tables) -> DataFrame:
    # The deviation adds up squares in floating point, where fewer decimals are certain.
    return rounded(distributions.describe(_paid_per_order(raw), "payment_value"), 4)


def _describe_delivery(raw: Tables) -> DataFrame:
    return distributions.describe(_delivery_days(raw), "delivery_days", few_values=True)


def _places(raw: Tables) -> DataFrame:
    return geography.geo_by_zip(raw["raw_geolocation"])


def _distance(raw: Tables) -> DataFrame:
    found = geography.seller_customer_distance(
        raw["raw_order_items"],
        raw["raw_orders"],
        raw["raw_customers"],
        raw["raw_sellers"],
        _places(raw),
    )
    return rounded(found, 3)


def _top_categories(raw: Tables) -> DataFrame:
    best = reports.top(
        reports.category_sales(raw), "revenue", ["category"], reports.TOP_CATEGORIES
    )
    return reports.ascending(best, "revenue", ["category"])


def _rejected(raw: Tables) -> DataFrame:
    return rejections(judge(raw, gate.WARNING), rules_from(gate.WARNING))


def _preview(table: str, key: str) -> Callable[[Tables], DataFrame]:
    return lambda raw: profile.preview(raw[table], key.split())


# Queries on the staging tables.
ON_STAGING: dict[str, Callable[[Tables], DataFrame]] = {
    # data quality
    "raw_row_counts": lambda raw: checks.row_counts(raw, checks.RAW_COUNT_TABLES),
    "check_required_keys": checks.required_keys,
    "check_duplicate_grain": checks.duplicate_grain,
    "check_relationships": checks.relationships,
    "check_business_rules": checks.business_rules,
    "check_datetime_hygiene": lambda raw: checks.datetime_hygiene(raw["raw_order_reviews"]),
    "check_raw_constraints": checks.raw_constraints,
    "quality_gate": lambda raw: gate.quality_gate(gate.rule_failures(raw)),
    "dedupe_reviews": lambda raw: dedupe_reviews(raw["raw_order_reviews"]),
    "dedupe_customers": lambda raw: dedupe(raw["raw_customers"], "raw_customers"),
    "dedupe_orders": lambda raw: dedupe(raw["raw_orders"], "raw_orders"),
    "dedupe_order_items": lambda raw: dedupe(raw["raw_order_items"], "raw_order_items"),
    "surplus_keys": surplus_keys,
    "rejected_rows": _rejected,
    # profile
    "dataset_profile": lambda raw: rounded(profile.dataset_profile(raw)),
    "missing_summary": lambda raw: rounded(profile.missing_summary(raw)),
    "dtype_summary": profile.dtype_summary,
    "preview_orders": _preview("raw_orders", "order_id"),
    # building blocks
    "payment_summary": lambda raw: payment_summary(raw["raw_order_payments"]),
    "item_summary": lambda raw: item_summary(raw["raw_order_items"]),
    "customer_order_ranks": lambda raw: customer_order_ranks(
        raw["raw_customers"], raw["raw_orders"]
    ),
    # reports
    "orders_enriched": reports.orders_enriched,
    "items_products": reports.items_products,
    "kpis": lambda raw: rounded(reports.kpis(raw)),
    "monthly_orders": reports.monthly_orders,
    "monthly_orders_last12": lambda raw: reports.last_months(reports.monthly_orders(raw)),
    "order_status_mix": lambda raw: rounded(reports.order_status_mix(raw["raw_orders"])),
    "state_sales": reports.state_sales,
    "top_states": lambda raw: reports.top(
        reports.state_sales(raw), "orders", ["customer_state"], reports.TOP_STATES
    ),
    "city_sales": reports.city_sales,
    "top_cities": lambda raw: reports.top(
        reports.city_sales(raw), "orders", ["customer_state", "customer_city"], reports.TOP_CITIES
    ),
    "category_sales": reports.category_sales,
    "top_categories": _top_categories,
    "seller_sales": reports.seller_sales,
    "top_sellers": lambda raw: reports.top(
        reports.seller_sales(raw), "revenue", ["seller_id"], reports.TOP_SELLERS
    ),
    "payment_mix": lambda raw: rounded(reports.payment_mix(raw["raw_order_payments"])),
    "order_payment_describe": _describe_payments,
    "payment_histogram": lambda raw: rounded(
        distributions.histogram(_paid_per_order(raw), "payment_value")
    ),
    "items_per_order_histogram": lambda raw: reports.items_per_order_histogram(
        raw["raw_order_items"]
    ),
    "delivery_summary": lambda raw: rounded(_describe_delivery(raw), 4),
    "delivery_histogram": lambda raw: rounded(
        distributions.histogram(_delivery_days(raw), "delivery_days")
    ),
    "late_by_state": lambda raw: rounded(reports.late_by_state(raw)),
    "top_late_states": lambda raw: reports.top(
        rounded(reports.late_by_state(raw)),
        "late_delivery_rate",
        ["customer_state"],
        reports.TOP_STATES,
    ),
    "review_distribution": lambda raw: reports.review_distribution(raw["raw_order_reviews"]),
    "review_summary": lambda raw: rounded(reports.review_summary(raw)),
    # geography
    "geo_by_zip": lambda raw: rounded(_places(raw), 8),
    "customer_geo": lambda raw: rounded(
        geography.customer_geo(raw["raw_customers"], _places(raw)), 8
    ),
    "seller_geo": lambda raw: rounded(geography.seller_geo(raw["raw_sellers"], _places(raw)), 8),
    "seller_customer_distance": _distance,
}

# Queries on the warehouse by the amounts of ``fact_order`` they read; others are not worked out.
ON_WAREHOUSE: dict[str, Callable[[Tables], DataFrame]] = {
    "dim_date": lambda wh: wh["dim_date"],
    "dim_customer": lambda wh: wh["dim_customer"],
    "dim_product": lambda wh: wh["dim_product"],
    "dim_seller": lambda wh: wh["dim_seller"],
    "fact_order": lambda wh: wh["fact_order"],
    "fact_order_item": lambda wh: wh["fact_order_item"],
    "fact_review": lambda wh: wh["fact_review"],
    "check_warehouse_rules": checks.warehouse_rules,
    "revenue_valid_orders": lambda wh: metrics.revenue_orders(wh["fact_order"]).select(
        "order_id",
        "order_status",
        "payment_value",
        metrics.revenue(metrics.ITEM).alias("item_value"),
    ),
}

ON_PAYMENTS: dict[str, Callable[[Tables], DataFrame]] = {
    "total_revenue_payment": metrics.total_revenue,
    "total_revenue_all_orders": lambda wh: metrics.total_revenue(
        wh, metrics.Rules(exclude_no_revenue=False)
    ),
    "average_order_value": lambda wh: rounded(metrics.average_order_value(wh)),
    "average_order_value_per_order": lambda wh: rounded(
        metrics.average_order_value_per_order(wh)
    ),
    "monthly_revenue": metrics.monthly_revenue,
    "revenue_growth_monthly": lambda wh: rounded(metrics.revenue_growth_monthly(wh)),
    "kpi_cards": lambda wh: rounded(metrics.kpi_cards(wh)),
    "month_board": lambda wh: month_board(board.person_months(wh["fact_order"])),
}

ON_ITEMS: dict[str, Callable[[Tables], DataFrame]] = {
    "total_revenue_item": lambda wh: metrics.total_revenue(wh, metrics.Rules(metrics.ITEM)),
    "items_per_order": lambda wh: rounded(metrics.items_per_order(wh)),
    "monthly_revenue_item": lambda wh: metrics.monthly_revenue(wh, metrics.Rules(metrics.ITEM)),
}

WITHOUT_AMOUNTS: dict[str, Callable[[Tables], DataFrame]] = {
    "warehouse_row_counts": warehouse_row_counts,
    "check_warehouse_keys": checks.warehouse_keys,
    "check_warehouse_fks": checks.warehouse_references,
    "total_orders": metrics.total_orders,
    "total_customers": metrics.total_customers,
    "repeat_purchase_rate": lambda wh: rounded(metrics.repeat_purchase_rate(wh)),
    "avg_delivery_time": lambda wh: rounded(metrics.average_delivery_time(wh)),
    "late_delivery_rate": lambda wh: rounded(metrics.late_delivery_rate(wh)),
    "avg_review_score": lambda wh: rounded(metrics.average_review_score(wh)),
    "customer_growth_monthly": metrics.customer_growth_monthly,
    "delivery_time_trend": lambda wh: rounded(metrics.delivery_time_trend(wh)),
    "late_rate_trend": lambda wh: rounded(metrics.late_rate_trend(wh)),
    "review_score_distribution": metrics.review_score_distribution,
}

# Dashboard feeds under a selection, with and without payments.
FEEDS_ON_PAYMENTS: dict[str, Callable[[Tables], DataFrame]] = {
    "dashboard_filtered_revenue": metrics.monthly_revenue,
    "dashboard_filtered_growth": lambda wh: rounded(metrics.revenue_growth_monthly(wh)),
}

FEEDS: dict[str, Callable[[Tables], DataFrame]] = {
    "dashboard_filtered_customers": metrics.customer_growth_monthly,
    "dashboard_filtered_delivery": lambda wh: rounded(metrics.delivery_time_trend(wh)),
    "dashboard_filtered_late": lambda wh: rounded(metrics.late_rate_trend(wh)),
    "dashboard_filtered_reviews": metrics.review_score_distribution,
}


# The same selection from one pass over its orders.
BOARDS: dict[str, Callable[[Tables], DataFrame]] = {
    "dashboard_filtered": lambda wh: rounded(board.cards(board.board(wh, SELECTION, history=False))),
    "dashboard_filtered_board": lambda wh: board.board(wh, SELECTION),
}


def _on_staging(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, directory: build(load_sample(spark, directory))


def _on_warehouse(
    build: Callable[[Tables], DataFrame],
    payments: bool = False,
    items: bool = False,
    filters: metrics.Filters | None = None,
    known: bool = True,
) -> Query:
    def query(spark: SparkSession, directory: str) -> DataFrame:
        raw = load_sample(spark, directory)
        return build(metrics.select(lazy_warehouse(raw, payments, items, known), filters))

    return query


def all_queries() -> dict[str, Query]:
    """Queries by name."""
    found = {name: _on_staging(build) for name, build in ON_STAGING.items()}
    for name, build in ON_WAREHOUSE.items():
        found[name] = _on_warehouse(build, payments=True, items=True)
    for name, build in ON_PAYMENTS.items():
        found[name] = _on_warehouse(build, payments=True)
    for name, build in ON_ITEMS.items():
        found[name] = _on_warehouse(build, items=True)
    for name, build in WITHOUT_AMOUNTS.items():
        found[name] = _on_warehouse(build)
    for name, build in FEEDS_ON_PAYMENTS.items():
        found[name] = _on_warehouse(build, payments=True, filters=SELECTION)
    for name, build in FEEDS.items():
        found[name] = _on_warehouse(build, filters=SELECTION)
    for name, build in BOARDS.items():
        found[name] = _on_warehouse(build, payments=True, known=False)
    return found
