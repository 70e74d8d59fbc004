"""All dashboard feeds of a selection from one pass over its orders.

The selected orders are planned once. Reviews come to them as counts per score and order, so each
order stays one row, and everything is added up per person and month; no person has more rows there
than there are months. That small table knows, beside amounts and deliveries, who bought first in which
month and who came back, so it shrinks to one row per month, the *board*, and every feed and card
is a projection or a sum of the board. Store the board of a selection, and no feed reads an order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import month_label, ratio
from tallyhouse.operators import metrics
from tallyhouse.operators.metrics import VALID_SCORES, Filters, Rules

Tables = Mapping[str, DataFrame]

SCORES = {score: f"score_{score}" for score in range(VALID_SCORES[0], VALID_SCORES[1] + 1)}
SUMS = (
    "revenue",
    "paid_orders",
    "orders",
    "delivery_days",
    "delivered",
    "late",
    "judged",
    *SCORES.values(),
)


def person_months(orders: DataFrame, rules: Rules = Rules(), counts: tuple[str, ...] = ()) -> DataFrame:
    """One row per person and purchase month: sums, and the first and last order of the month."""
    placed = F.col("order_purchase_timestamp")
    return orders.groupBy("customer_unique_id", month_label(placed).alias("order_month")).agg(
        *metrics.amounts(rules),
        *metrics.deliveries(),
        *[F.sum(name).alias(name) for name in counts],
        F.min(placed).alias("opening"),
        F.max(placed).alias("closing"),
    )


def board(
    warehouse: Tables,
    filters: Filters | None = None,
    rules: Rules = Rules(),
    history: bool = True,
    reviews: bool = True,
) -> DataFrame:
    """One row per purchase month of the selected orders, with what all feeds need.

    ``customers`` and ``repeaters`` count a person in the first month of the selection that they
    bought in, so that their sums count people. Without ``history``, the customers' first orders ever
    are not looked up and ``buyers``, ``new_customers`` and ``repeat_customers`` are left out; without
    ``reviews``, so are the scores.
    """
    rows = metrics.filtered_orders(warehouse, filters or Filters())
    scores = SCORES if reviews else {}
    if reviews:
        valid = metrics.valid_reviews(warehouse["fact_review"])
        counts = [F.count_if(F.col("review_score") == k).alias(name) for k, name in SCORES.items()]
        rows = rows.join(valid.groupBy("order_id").agg(*counts), "order_id", "left")
    visits = person_months(rows, rules, tuple(scores.values()))
    person = Window.partitionBy("customer_unique_id")
    visits = visits.withColumn("person_orders", F.sum("orders").over(person)).withColumn(
        "visit", F.row_number().over(person.orderBy("order_month"))
    )
    people = [
        F.count_if(F.col("visit") == 1).alias("customers"),
        F.count_if((F.col("visit") == 1) & (F.col("person_orders") >= 2)).alias("repeaters"),
    ]
    if history:
        firsts = warehouse["dim_customer"].select(
            "customer_unique_id", F.col("first_order_date").alias("debut"), F.lit(True).alias("known")
        )
        visits = visits.join(firsts, "customer_unique_id", "left")
        people += [
            F.count_if(F.col("known")).alias("buyers"),
            F.count_if(F.col("opening") == F.col("debut")).alias("new_customers"),
            F.count_if(F.col("closing") > F.col("debut")).alias("repeat_customers"),
        ]
    sums = [name for name in SUMS if name not in SCORES.values() or name in scores.values()]
    months = visits.groupBy("order_month").agg(*[F.sum(x).alias(x) for x in sums], *people)
    counts = {name: F.coalesce(name, F.lit(0)) for name in scores.values()}
    return months.withColumns({"revenue": metrics.money(F.col("revenue"))} | counts)


def revenue(months: DataFrame) -> DataFrame:
    """Orders and revenue per month."""
    return months.select("order_month", "orders", "revenue").orderBy("order_month")


def growth(months: DataFrame) -> DataFrame:
    """Revenue per month against the month before."""
    return metrics.with_growth(months.select("order_month", "revenue")).orderBy("order_month")


def customers(months: DataFrame) -> DataFrame:
    """Buyers, new and repeat buyers, and new ones so far, per month."""
    so_far = (
        Window.partitionBy()
        .orderBy("order_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        months.where("buyers > 0")
        .select("order_month", "buyers", "new_customers", "repeat_customers")
        .withColumn("cumulative_customers", F.sum("new_customers").over(so_far))
        .orderBy("order_month")
    )


def delivery(months: DataFrame) -> DataFrame:
    """Mean delivery days of delivered orders per month."""
    days = ratio(F.col("delivery_days"), F.col("delivered")).alias("average_delivery_days")
    found = months.where("delivered > 0")
    return found.select("order_month", F.col("delivered").alias("delivered_orders"), days).orderBy("order_month")


def late(months: DataFrame) -> DataFrame:
    """Late orders in percent of delivered ones per month."""
    rate = (ratio(F.col("late"), F.col("judged")) * 100).alias("late_delivery_rate")
    found = months.where("judged > 0")
    return found.select("order_month", F.col("judged").alias("delivered_orders"), rate).orderBy("order_month")


def scores(months: DataFrame) -> DataFrame:
    """Valid reviews per score."""
    counts = months.agg(*[F.sum(name).alias(name) for name in SCORES.values()])
    pairs = [F.struct(F.lit(k).alias("review_score"), F.col(name).alias("reviews")) for k, name in SCORES.items()]
    return counts.select(F.inline(F.array(*pairs))).where("reviews > 0").orderBy("review_score")


def cards(months: DataFrame) -> DataFrame:
    """All core metrics of the selection in one row; growth is that of the latest month."""
    reviews = sum((F.sum(name) for name in list(SCORES.values())[1:]), F.sum(SCORES[1]))
    points = sum((k * F.sum(name) for k, name in list(SCORES.items())[1:]), F.sum(SCORES[1]))
    count = {x: F.coalesce(F.sum(x), F.lit(0)) for x in ("orders", "customers", "repeaters")}
    return metrics.with_growth(months).agg(
        metrics.money(F.sum("revenue")).alias("total_revenue"),
        F.max_by("growth_pct", "order_month").alias("revenue_growth_pct"),
        count["orders"].alias("orders"),
        ratio(F.sum("revenue"), F.sum("paid_orders")).alias("average_order_value"),
        ratio(F.sum("delivery_days"), F.sum("delivered")).alias("average_delivery_days"),
        (ratio(F.sum("late"), F.sum("judged")) * 100).alias("late_delivery_rate"),
        count["customers"].alias("customers"),
        (ratio(count["repeaters"], count["customers"]) * 100).alias("repeat_purchase_rate"),
        ratio(points, reviews).alias("average_review_score"),
    )


FEEDS = {
    "cards": cards,
    "revenue": revenue,
    "growth": growth,
    "customers": customers,
    "delivery": delivery,
    "late": late,
    "reviews": scores,
}


def store_board(months: DataFrame, path: str) -> DataFrame:
    """Keep a selection's board as one small file and return it: feeds of it read nothing else."""
    months.coalesce(1).write.mode("overwrite").parquet(path)
    return months.sparkSession.read.schema(months.schema).parquet(path)
