"""Dashboard figures kept by month: a refresh works out again only the months that changed.

Orders add up to one row per person and month (*visits*), stored in a folder per month, and to one row
per month (*sums*). A refresh takes a fingerprint of every month from one scan of the orders and compares
it with the one stored; where it differs, that month's visits are written anew and take the place of
the old ones in the set. All other months keep their files. The sums are few rows and are written each
time. What spans months, such as who bought first when, is worked out from the visits, never from orders.

Fingerprints add up 64-bit hashes of the columns that figures come from; a change goes unseen with a
probability of about 2^-64 a month.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions import month_label
from tallyhouse.operators import board, metrics
from tallyhouse.operators.metrics import Rules
from tallyhouse.sources.snapshots import Draft, SnapshotStore
from tallyhouse.sources.warehouse_store import MONTH_COLUMN

SUMS, PRINTS, VISITS = "month_sums", "month_prints", "visits_"
FOLDER = "folder_month"
UNDATED = "undated"  # stands for the month of orders without a purchase time
SUMMED = ("revenue", "paid_orders", "orders", "delivery_days", "delivered", "late", "judged")
READ = (
    "order_id",
    "customer_unique_id",
    "order_status",
    "order_purchase_timestamp",
    "payment_value",
    "payment_count",
    "merchandise_value",
    "freight_value",
    "item_count",
    "delivery_days",
    "late_delivery_flag",
)


def _label(month: Column) -> Column:
    return F.coalesce(month, F.lit(UNDATED))


def fingerprints(fact_order: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``order_month, orders, print, rules``: what a month's figures depend on, one row per month."""
    month = _label(month_label(F.col("order_purchase_timestamp")))
    hashed = F.xxhash64(*READ).cast("decimal(20,0)")
    return fact_order.groupBy(month.alias("order_month")).agg(
        F.count("*").alias("orders"),
        F.sum(hashed).cast("string").alias("print"),
        F.lit(repr(rules)).alias("rules"),
    )


def _prints(df: DataFrame) -> dict[str, tuple]:
    return {row.order_month: tuple(row) for row in df.collect()}  # a row a month


def _of_months(fact_order: DataFrame, months: Iterable[str]) -> DataFrame:
    """The orders of some months; stored by month, only their folders are read."""
    months = list(months)
    found = _label(month_label(F.col("order_purchase_timestamp"))).isin(*months)
    if MONTH_COLUMN in fact_order.columns:
        stored = F.col(MONTH_COLUMN).isin(*months)
        if UNDATED in months:
            stored = stored | F.col(MONTH_COLUMN).isNull()
        found = stored & found
    return fact_order.where(found)


def sums_of(visits: DataFrame) -> DataFrame:
    """One row per month from visits: what adds up over people."""
    sums = visits.groupBy("order_month").agg(*[F.sum(x).alias(x) for x in SUMMED])
    return sums.withColumn("revenue", metrics.money(F.col("revenue")))


def refresh_months(
    spark: SparkSession, fact_order: DataFrame, root: str, rules: Rules = Rules()
) -> list[str]:
    """Bring the stored months in line with ``fact_order``; the months that were worked out.

    Everything is committed at once: readers see the months before until all are there, and a failure
    changes nothing. A month without orders any more goes.
    """
    store = SnapshotStore(spark, root)
    draft = store.begin()
    printed = fingerprints(fact_order, rules)
    now = _prints(printed)
    old = draft.tables.get(PRINTS)
    schema = printed.schema
    before = _prints(spark.read.schema(schema).parquet(f"{store.root}/{old}")) if old else {}
    touched = sorted(m for m in now.keys() | before.keys() if now.get(m) != before.get(m))
    if old and not touched:
        return []
    sums = _write_visits(draft, fact_order, [m for m in touched if m in now], rules)
    for month in touched:
        if month not in now:
            draft.tables.pop(f"{VISITS}{month}", None)
    if old:
        kept = spark.read.parquet(f"{store.root}/{draft.tables[SUMS]}")
        sums = sums.unionByName(kept.where(~F.col("order_month").isin(*touched)))
    draft.write(SUMS, sums.coalesce(1))
    rows = spark.createDataFrame(list(now.values()), schema)
    draft.write(PRINTS, rows.coalesce(1))
    draft.commit()
    return touched


def _write_visits(draft: Draft, fact_order: DataFrame, months: list[str], rules: Rules) -> DataFrame:
    """Store the visits of ``months``, enter each month into the set, and return their sums."""
    visits = board.person_months(_of_months(fact_order, months), rules)
    visits = visits.withColumn("order_month", _label(F.col("order_month")))
    visits = visits.withColumn(FOLDER, F.col("order_month"))
    path = draft.write("visits", visits, FOLDER, listed=False)
    for month in months:
        draft.tables[f"{VISITS}{month}"] = f"{draft.folder}/visits/{FOLDER}={month}"
    if not months:
        return sums_of(visits)
    return sums_of(visits.sparkSession.read.schema(visits.schema).parquet(path))


def read_sums(spark: SparkSession, root: str) -> DataFrame:
    """One row per month: revenue, orders and deliveries; the feeds about them read nothing else."""
    return _dated(spark.read.parquet(SnapshotStore(spark, root).path(SUMS)))


def read_visits(spark: SparkSession, root: str) -> DataFrame:
    """One row per person and month."""
    store = SnapshotStore(spark, root)
    paths = [f"{store.root}/{p}" for name, p in sorted(store.current().items()) if name.startswith(VISITS)]
    if not paths:
        raise FileNotFoundError(f"no months are stored below {root}")
    return _dated(spark.read.parquet(*paths))


def _dated(df: DataFrame) -> DataFrame:
    month = F.when(F.col("order_month") != UNDATED, F.col("order_month"))
    return df.withColumn("order_month", month)


def month_board(visits: DataFrame) -> DataFrame:
    """The board of all orders, without scores, from visits: people are compared by month, and no person
    has more rows than there are months."""
    person = Window.partitionBy("customer_unique_id")
    first = F.col("visit") == 1
    known = visits.withColumns(
        {
            "debut": F.min("opening").over(person),
            "person_orders": F.sum("orders").over(person),
            "visit": F.row_number().over(person.orderBy("order_month")),
        }
    )
    months = known.groupBy("order_month").agg(
        *[F.sum(x).alias(x) for x in SUMMED],
        F.count_if(first).alias("customers"),
        F.count_if(first & (F.col("person_orders") >= 2)).alias("repeaters"),
        F.count("*").alias("buyers"),
        F.count_if(F.col("opening") == F.col("debut")).alias("new_customers"),
        F.count_if(F.col("closing") > F.col("debut")).alias("repeat_customers"),
    )
    return months.withColumn("revenue", metrics.money(F.col("revenue")))
