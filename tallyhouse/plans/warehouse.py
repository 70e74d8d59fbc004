"""Build the star schema: lazily, or as stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import checks, gate
from tallyhouse.operators.dimensions import dim_customer, dim_date, dim_product, dim_seller
from tallyhouse.operators.facts import (
    fact_order,
    fact_order_item,
    fact_review,
    known_orders,
)
from tallyhouse.operators.geography import geo_by_zip
from tallyhouse.operators.ranking import first_per_key, surplus_copies
from tallyhouse.schemas import STAGING
from tallyhouse.sources.csv_files import (
    PLACE,
    locate,
    read_text,
    unreadable_values,
    with_losses,
    with_places,
    zero_moments,
)
from tallyhouse.sources.snapshots import Draft, SnapshotStore
from tallyhouse.sources.warehouse_store import put_report, put_table, write_geography
from tallyhouse.tables import LazyTables

Tables = Mapping[str, DataFrame]

STAGING_REPORT, WAREHOUSE_REPORT = "staging_report", "warehouse_report"
REJECTED, REJECTED_REPORT = "rejected", "rejected_report"

# Which copy of a repeated key stays: the earliest by these columns, NULLs last.
FIRST_BY: dict[str, list[str]] = {
    "raw_orders": ["order_purchase_timestamp", "order_approved_at"],
    "raw_order_items": ["shipping_limit_date"],
    "raw_order_reviews": ["review_creation_date", "review_answer_timestamp"],
}


def dedupe(df: DataFrame, table: str) -> DataFrame:
    """One row per primary key of a staging table, as a load with that key would keep: the first one
    delivered where the rows know their places, or else the earliest by ``FIRST_BY``."""
    key = list(STAGING[table].key)
    if set(PLACE) <= set(df.columns):
        return first_per_key(df, key, list(PLACE)).drop(*PLACE)
    return first_per_key(df, key, FIRST_BY.get(table, []))


def dedupe_reviews(reviews: DataFrame) -> DataFrame:
    """One row per review identifier: the earliest created, then the earliest answered."""
    return dedupe(reviews, "raw_order_reviews")


def dedupe_all(raw: Tables) -> dict[str, DataFrame]:
    """All staging tables, the keyed ones with one row per key."""
    return {name: dedupe(df, name) if STAGING[name].key else df for name, df in raw.items()}


def surplus_keys(raw: Tables) -> DataFrame:
    """``check_name, failed_rows``: copies that de-duplication leaves out, per keyed table."""
    return checks.together(
        [
            surplus_copies(df, list(STAGING[name].key)).select(
                F.lit(f"{name} copies of a key").alias("check_name"),
                F.col("copies").alias("failed_rows"),
            )
            for name, df in raw.items()
            if STAGING[name].key
        ]
    )


def lazy_warehouse(
    raw: Tables, payments: bool = True, items: bool = True, known: bool = True
) -> LazyTables:
    """The seven tables as plans over the staging tables; nothing runs until one is used.

    Without ``payments`` or ``items``, ``fact_order`` leaves out those amounts and the work behind
    them: the right form for counting orders, checking keys, delivery metrics, and revenue on one
    basis. Without ``known``, items and reviews are not held against the known orders: the right form
    for readers that join them to ``fact_order`` anyway, as ``operators.board`` does.
    """

    def orders_and_customers() -> tuple[DataFrame, DataFrame]:
        return raw["raw_orders"], raw["raw_customers"]

    def orders_to_meet() -> DataFrame | None:
        return known_orders(*orders_and_customers()) if known else None

    def orders_with_amounts() -> DataFrame:
        return fact_order(
            *orders_and_customers(),
            raw["raw_order_payments"] if payments else None,
            raw["raw_order_items"] if items else None,
        )

    return LazyTables(
        {
            "dim_date": lambda: dim_date(
                raw["raw_orders"], raw["raw_order_items"], raw["raw_order_reviews"]
            ),
            "dim_customer": lambda: dim_customer(raw["raw_customers"], raw["raw_orders"]),
            "dim_product": lambda: dim_product(
                raw["raw_products"], raw["raw_product_category_translation"]
            ),
            "dim_seller": lambda: dim_seller(raw["raw_sellers"]),
            "fact_order": orders_with_amounts,
            "fact_order_item": lambda: fact_order_item(
                raw["raw_order_items"],
                orders_to_meet(),
                raw["raw_products"],
                raw["raw_sellers"],
            ),
            "fact_review": lambda: fact_review(raw["raw_order_reviews"], orders_to_meet()),
        }
    )


def stage_files(
    spark: SparkSession, directory: str, root: str, patterns: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Load the nine files, hold them against the quality rules, and store them as Parquet.

    The files are parsed once: rows read, values that cannot be read and zero dates are counted while
    the typed rows are written. All checks then run on the stored tables, and their counts are kept
    with the set as ``staging_report``. Rules of severity Error stop the run before the set is
    committed, so readers keep the one before.
    """
    paths = locate(spark, directory, dict(patterns or {}))
    texts = {table: read_text(spark, table, path) for table, path in paths.items()}
    draft = SnapshotStore(spark, root).begin()
    raw, lost = {}, {}
    for table, text in texts.items():
        typed, counts = with_losses(with_places(text), table)
        raw[table] = put_table(draft, table, typed, counts)
        lost |= {name: draft.observed[table][name] for name in counts}
    gate.enforce(gate.quality_gate(gate.rule_failures(raw, lost=lost)))
    read = {f"{table} rows written": draft.observed[table]["rows"] for table in raw}
    seen = [counted(spark, lost), counted(spark, read), validate(raw)]
    put_report(draft, STAGING_REPORT, checks.together(seen))
    forget_rejected(draft)
    draft.commit()
    return raw


def forget_rejected(draft: Draft) -> None:
    """Rows that an earlier load kept apart are no part of a set that is staged anew."""
    for name in STAGING:
        draft.tables.pop(f"{REJECTED}_{name}", None)
    draft.tables.pop(REJECTED_REPORT, None)


def counted(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "check_name string, failed_rows long")


def validate(raw: Tables, texts: Tables | None = None) -> DataFrame:
    """``check_name, failed_rows`` of every check on the staging tables, and row counts.

    With ``texts``, the text layer of the files, zero dates and values that cannot be read are
    counted too; a typed table cannot hold them.
    """
    parts = [
        checks.required_keys(raw),
        checks.duplicate_grain(raw),
        checks.relationships(raw),
        checks.business_rules(raw),
        checks.datetime_hygiene(raw["raw_order_reviews"]),
        checks.row_counts(raw, checks.RAW_COUNT_TABLES),
        surplus_keys(raw),
    ]
    for name, text in (texts or {}).items():
        if STAGING[name].moments:
            parts.append(zero_moments(text, name))
        parts.append(unreadable_values(text, name))
    return checks.together([_two_columns(part) for part in parts])


def _two_columns(found: DataFrame) -> DataFrame:
    name, count = found.columns[:2]
    return found.select(
        F.col(name).cast("string").alias("check_name"), F.col(count).cast("long").alias("failed_rows")
    )


def keyed_once(raw: Tables, draft: Draft) -> dict[str, DataFrame]:
    """All staging tables, the keyed ones with one row per key.

    Keys are counted first, all tables in one job. Only tables with copies of a key are de-duplicated,
    and stored, once: the plans of dimensions and facts read the result instead of repeating it.
    """
    found = {row.check_name: row.failed_rows for row in surplus_keys(raw).collect()}  # a row a table
    out = {name: df.drop(*PLACE) for name, df in raw.items()}
    for name, df in raw.items():
        if found.get(f"{name} copies of a key"):
            path = draft.write(f"keyed_{name}", dedupe(df, name), listed=False)
            out[name] = df.sparkSession.read.schema(out[name].schema).parquet(path)
    return out


def refresh_warehouse(
    spark: SparkSession, raw: Tables, root: str, one_row_per_key: bool = True
) -> dict[str, DataFrame]:
    """Replace the stored warehouse, all tables at once. Later tables read the earlier ones.

    Every refresh writes new folders and is committed last, so readers see the set before until all
    tables are there, and a failure half-way changes nothing. DataFrames read before stay readable
    until ``SnapshotStore.expire`` removes what they point at. Running it again gives the same tables.

    ``one_row_per_key`` leaves one row per primary key in all keyed tables, as a load with primary
    keys would; ``surplus_keys`` tells how many rows that leaves out. With ``raw`` from
    ``read_delivered`` the first row delivered stays, as in a load line by line. Rows written per table are kept
    with the set as ``warehouse_report``.
    """
    draft = SnapshotStore(spark, root).begin()
    if one_row_per_key:
        raw = keyed_once(raw, draft)
    plans = lazy_warehouse(raw)
    stored = {
        name: put_table(draft, name, plans[name])
        for name in ("dim_date", "dim_customer", "dim_product", "dim_seller", "fact_order")
    }
    stored["fact_order_item"] = put_table(
        draft,
        "fact_order_item",
        fact_order_item(
            raw["raw_order_items"],
            stored["fact_order"],
            stored["dim_product"],
            stored["dim_seller"],
        ),
    )
    stored["fact_review"] = put_table(
        draft, "fact_review", fact_review(raw["raw_order_reviews"], stored["fact_order"])
    )
    rows = [(name, draft.observed[name]["rows"]) for name in stored]
    report = spark.createDataFrame(rows, "table_name string, row_count long")
    put_report(draft, WAREHOUSE_REPORT, report)
    draft.commit()
    return stored


def refresh_geography(spark: SparkSession, raw: Tables, root: str) -> DataFrame:
    """Store the median place of every zip prefix; stored, it is small enough to broadcast."""
    return write_geography(spark, geo_by_zip(raw["raw_geolocation"]), root)


def warehouse_row_counts(warehouse: Tables) -> DataFrame:
    """``table_name, row_count`` of the seven tables."""
    return checks.row_counts(warehouse, checks.WAREHOUSE_COUNT_TABLES)
