"""Row numbers and "first row" choices that do not put one key's rows into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import date_key
from tallyhouse.functions.ordering import coarse_key

BEFORE_ALL_HOURS = -1


def customer_order_ranks(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer record with its orders, ranked per person from first and from latest.

    Order is purchase time, then record identifier; records without an order come first. A person
    may own a large share of all rows, so a person's rows are split into slices: the hour of
    purchase or, without an order, a prefix of the identifier. Each slice is numbered on its own
    and starts where the slices before it end; a person has at most one slice per hour of history
    and per prefix. Counting from the latest is the mirror image, so one sort serves both ranks.

    Records with orders come from an inner join with the orders on its left, where Spark can split
    a record that has very many of them; the others come from an anti join.
    """
    placed, record = F.col("order_purchase_timestamp"), F.col("customer_id")
    undated = placed.isNull()
    prefix = coarse_key(customers, "customer_id")
    people = customers.select("customer_id", "customer_unique_id")
    active = orders.select("customer_id").distinct()
    visits = (
        orders.select("customer_id", placed)
        .join(people, "customer_id")
        .unionByName(people.join(active, "customer_id", "left_anti"), allowMissingColumns=True)
    )
    rows = visits.select(
        "customer_unique_id",
        record,
        placed,
        F.coalesce(
            date_key(placed).cast("bigint") * 100 + F.hour(placed), F.lit(BEFORE_ALL_HOURS)
        ).alias("hour"),
        F.coalesce(F.when(undated, prefix.cast("string")), F.lit("")).alias("prefix"),
        F.when(undated, prefix).alias("prefix_order"),
    )
    slice_key = ["customer_unique_id", "hour", "prefix"]
    person = Window.partitionBy("customer_unique_id")
    earlier = person.orderBy("hour", "prefix_order").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*slice_key, "prefix_order")
        .agg(F.count("*").alias("size"))
        .select(
            *slice_key,
            F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"),
            F.sum("size").over(person).alias("total"),
        )
    )
    in_slice = Window.partitionBy(*slice_key).orderBy(placed.asc_nulls_first(), record.asc())
    first = F.col("start") + F.row_number().over(in_slice)
    return rows.join(starts, slice_key).select(
        "customer_unique_id",
        "customer_id",
        placed,
        first.alias("first_order_rank"),
        (F.col("total") + 1 - first).alias("latest_order_rank"),
    )


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` with NULLs last, then by the other columns.

    Which of several equal keys a load keeps must not depend on how files are split, hence the
    stated order. Keys are counted first, which shuffles keys only and combines copies in each
    task; rows whose key is alone pass as they are, and the minimum is taken among the rest (a
    sort aggregate, which also combines in each task before its shuffle).
    """
    repeated = _repeated_keys(df, key)
    same = reduce(Column.__and__, [df[c].eqNullSafe(repeated[f"__{c}"]) for c in key])
    alone = df.join(repeated, same, "left_anti")
    copies = df.join(repeated, same, "left_semi")
    rest = [c for c in df.columns if c not in key and c not in order]
    ranked = [part for c in order for part in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]
    kept = copies.groupBy(*key).agg(F.min(F.struct(*ranked, *rest)).alias("kept"))
    chosen = kept.select(*[F.col(c) if c in key else F.col(f"kept.{c}") for c in df.columns])
    return alone.unionByName(chosen)


def surplus_copies(df: DataFrame, key: list[str]) -> DataFrame:
    """One row with ``copies``: how many rows ``first_per_key`` leaves out."""
    counted = df.groupBy(*key).agg(F.count("*").alias("n"))
    return counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"))


def _repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    counted = df.groupBy(*key).agg(F.count("*").alias("__n")).where("__n > 1")
    return counted.select(*[F.col(c).alias(f"__{c}") for c in key])
