"""Keep staging and warehouse tables as Parquet: full refresh in, column-pruned scans out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import month_label
from tallyhouse.schemas import STAGING, WAREHOUSE, Contract
from tallyhouse.sources.csv_files import PLACE, PLACE_SCHEMA
from tallyhouse.sources.snapshots import Draft, SnapshotStore

# Date filters prune whole months of orders.
MONTH_OF = {"fact_order": "order_purchase_timestamp"}
MONTH_COLUMN = "stored_month"
# Put together from lines in partitions of uneven size, so evened out before they are stored; others
# stay as partitioned.
SPREAD = frozenset({"raw_order_reviews"})
# Columns of many values that rows are looked up by: keys, and the declared indexes on
# identifiers. Columns of few values need nothing: Parquet prunes by their dictionaries.
LOOKUPS: dict[str, tuple[str, ...]] = {
    "raw_customers": ("customer_id", "customer_unique_id"),
    "raw_orders": ("order_id", "customer_id"),
    "raw_order_items": ("order_id", "product_id", "seller_id"),
    "raw_order_payments": ("order_id",),
    "raw_order_reviews": ("review_id", "order_id"),
    "raw_products": ("product_id",),
    "raw_sellers": ("seller_id",),
    "dim_customer": ("customer_unique_id", "first_customer_id"),
    "dim_product": ("product_id",),
    "dim_seller": ("seller_id",),
    "fact_order": ("order_id", "customer_unique_id"),
    "fact_order_item": ("order_id", "product_id", "seller_id"),
    "fact_review": ("review_id", "order_id"),
}


def lookup_options(name: str) -> dict[str, str]:
    """Writer options that add a Bloom filter, as large as its values need, per look-up column."""
    found = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKUPS.get(name, ())}
    return found and found | {"parquet.bloom.filter.adaptive.enabled": "true"}


def stored_order(name: str) -> tuple[str, ...]:
    """Columns that warehouse tables are sorted by inside a file, so that few pages hold one key.

    Staging tables are read whole and stay in the order of delivery.
    """
    return LOOKUPS.get(name, ())[:1] if name in WAREHOUSE else ()


def _stored_schema(contract: Contract) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in contract.schema])


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns and types of the contract; raises where a column is absent or cannot be widened.

    NULLs in required columns are the checks' business, not a reason to stop here.
    """
    return df.to(_stored_schema(contract))


def write_table(df: DataFrame, name: str, root: str) -> None:
    """Replace table ``name`` under ``root``; running it again gives the same table."""
    out = conform(df, (STAGING | WAREHOUSE)[name])
    if name in MONTH_OF:
        # Rebalancing lets Spark split a month that is too large and merge those that are small.
        out = out.withColumn(MONTH_COLUMN, month_label(F.col(MONTH_OF[name])))
        out = out.hint("rebalance", MONTH_COLUMN)
        out.write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(f"{root}/{name}")
    else:
        out = out.hint("rebalance") if name in SPREAD else out
        out.write.mode("overwrite").parquet(f"{root}/{name}")


def put_table(
    draft: Draft, name: str, df: DataFrame, counts: Mapping[str, Column] | None = None
) -> DataFrame:
    """Write table ``name`` into a set that is being made, and return it as stored.

    ``counts`` are aggregates over ``df`` as given, whatever columns it has beside the contract's.
    """
    contract = (STAGING | WAREHOUSE)[name]
    month = MONTH_COLUMN if name in MONTH_OF else None
    if month:
        df = df.withColumn(month, month_label(F.col(MONTH_OF[name])))
    fields = {f.name: f.dataType for f in contract.schema}
    kept = conform(df, contract).columns  # raises where a column is absent
    kept += [c for c in PLACE if c in df.columns]
    df = df.withColumns({c: F.col(c).cast(kind) for c, kind in fields.items()})
    df = df.hint("rebalance") if name in SPREAD else df
    path = draft.write(
        name,
        df,
        month,
        counts,
        (*kept, *([month] if month else [])),
        sort=stored_order(name),
        options=lookup_options(name),
    )
    return _read(draft.store.spark, name, path)


def _read(spark: SparkSession, name: str, path: str) -> DataFrame:
    schema = _stored_schema((STAGING | WAREHOUSE)[name])
    if name in MONTH_OF:
        schema = schema.add(MONTH_COLUMN, T.StringType())
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Table ``name`` of the newest committed set below ``root``, or as written by ``write_table``.

    The month column stays, for pruning.
    """
    return _read(spark, name, SnapshotStore(spark, root).path(name) or f"{root}/{name}")


def read_delivered(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The staging tables of the newest set, each row with where it stood in the files."""
    store = SnapshotStore(spark, root).current()
    places = T.StructType.fromDDL(PLACE_SCHEMA)
    return {
        name: spark.read.schema(T.StructType([*_stored_schema(contract), *places])).parquet(
            f"{root.rstrip('/')}/{store[name]}"
        )
        for name, contract in STAGING.items()
    }


def put_report(draft: Draft, name: str, rows: DataFrame) -> None:
    """Keep the figures of a run with the tables they are about."""
    draft.write(name, rows.coalesce(1))


def read_report(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The figures of the newest committed run."""
    return spark.read.parquet(SnapshotStore(spark, root).path(name))


def write_geography(spark: SparkSession, geo: DataFrame, root: str) -> DataFrame:
    """Replace the table of places and return it as stored."""
    draft = SnapshotStore(spark, root).begin()
    path = draft.write("geo_by_zip", geo)
    draft.commit()
    return spark.read.schema(geo.schema).parquet(path)
