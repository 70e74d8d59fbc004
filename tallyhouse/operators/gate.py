"""Quality gate: which findings stop a run and which are only reported."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import is_blank
from tallyhouse.operators import checks
from tallyhouse.operators.checks import Tables
from tallyhouse.schemas import STAGING
from tallyhouse.sources.csv_files import unreadable_moments, unreadable_values

ERROR, WARNING, INFO = "Error", "Warning", "Info"

# The quality rules and their severities.
SEVERITIES: dict[str, str] = {
    "Required files exist": ERROR,
    "Required columns exist": ERROR,
    "Primary keys are non-null": ERROR,
    "Order IDs are unique in orders": ERROR,
    "Customer IDs join from orders to customers": ERROR,
    "Order items join to orders": WARNING,
    "Payments join to orders": WARNING,
    "Reviews join to orders": WARNING,
    "Product IDs join from items to products": WARNING,
    "Seller IDs join from items to sellers": WARNING,
    "Dates parse successfully": ERROR,
    "Delivered date is after purchase date": WARNING,
    "Negative prices or freight values": ERROR,
    "Missing review comments": INFO,
    "Missing product categories": WARNING,
}
# Beside them: a number that cannot be read becomes NULL and would be missing from every sum.
NUMBERS_READ = "Numbers parse successfully"
SEVERITIES[NUMBERS_READ] = ERROR

RULE_OF_REFERENCE = {
    "orders missing customer": "Customer IDs join from orders to customers",
    "order items missing order": "Order items join to orders",
    "payments missing order": "Payments join to orders",
    "reviews missing order": "Reviews join to orders",
    "order items missing product": "Product IDs join from items to products",
    "order items missing seller": "Seller IDs join from items to sellers",
}


class QualityGateError(ValueError):
    """At least one rule of severity Error has failures."""


def rule_failures(
    raw: Tables, texts: Tables | None = None, lost: Mapping[str, int] | None = None
) -> DataFrame:
    """``rule, failed`` for the rules that tables can show.

    Files and columns are tested when a load starts (it raises). Dates and numbers that do not parse can only
    be seen in ``texts``, the text layer of the files, or come as counts per check in ``lost``, taken
    while the files were read; without either those rules are not reported.
    """
    by_table = row_rules()
    parts = [checks.count_conditions(raw[name], failing) for name, failing in by_table.items()]
    parts.append(
        checks.count_repeated(
            raw["raw_orders"], ["order_id"], "Order IDs are unique in orders"
        ).withColumnRenamed(checks.GROUPS, checks.ROWS)
    )
    parts.append(_renamed(checks.relationships(raw), RULE_OF_REFERENCE))
    if lost:
        moments = {f"unreadable {name}.{c}" for name, x in STAGING.items() for c in x.moments}
        rows = [
            ("Dates parse successfully" if check in moments else NUMBERS_READ, n)
            for check, n in lost.items()
            if check.startswith("unreadable ")
        ]
        session = raw["raw_orders"].sparkSession
        parts.append(session.createDataFrame(rows, f"check_name string, {checks.ROWS} long"))
    for name, text in (texts or {}).items():
        if STAGING[name].moments:
            failures = unreadable_moments(text, name)
            parts.append(failures.withColumn("check_name", F.lit("Dates parse successfully")))
        moments = [f"unreadable {name}.{c}" for c in STAGING[name].moments]
        numbers = unreadable_values(text, name).where(~F.col("check_name").isin(moments))
        parts.append(numbers.withColumn("check_name", F.lit(NUMBERS_READ)))
    return (
        checks.together(parts)
        .groupBy(F.col("check_name").alias("rule"))
        .agg(F.sum(checks.ROWS).alias("failed"))
    )


def quality_gate(
    failures: DataFrame, severities: Mapping[str, str] = SEVERITIES
) -> DataFrame:
    """``rule, severity, failed, outcome``: passed, reported, or blocked (Error with failures)."""
    lookup = F.create_map(*[F.lit(part) for pair in severities.items() for part in pair])
    severity = lookup[F.col("rule")]
    return failures.select(
        "rule",
        severity.alias("severity"),
        "failed",
        F.when(F.col("failed") == 0, "passed")
        .when(severity == ERROR, "blocked")
        .otherwise("reported")
        .alias("outcome"),
    )


def enforce(gate: DataFrame) -> None:
    """Raise ``QualityGateError`` naming every rule that blocks the run."""
    blocked = gate.where(F.col("outcome") == "blocked").select("rule", "failed").collect()
    if blocked:
        found = "; ".join(f"{row.rule}: {row.failed}" for row in sorted(blocked))
        raise QualityGateError(found)


def row_rules() -> dict[str, dict[str, list[Column]]]:
    """Rules that single rows can break, by table, so that each table is read once for all."""
    rules: dict[str, dict[str, list[Column]]] = {
        name: {
            "Primary keys are non-null": [
                reduce(Column.__or__, [is_blank(F.col(c)) for c in contract.key])
            ]
        }
        for name, contract in STAGING.items()
        if contract.key
    }
    negative = "Negative prices or freight values"
    rules["raw_order_items"][negative] = [F.col("price") < 0, F.col("freight_value") < 0]
    rules["raw_order_payments"][negative] = [F.col("payment_value") < 0]
    rules["raw_orders"]["Delivered date is after purchase date"] = [
        F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    ]
    rules["raw_order_reviews"]["Missing review comments"] = [
        is_blank(F.col("review_comment_title")) | is_blank(F.col("review_comment_message"))
    ]
    rules["raw_products"]["Missing product categories"] = [is_blank(F.col("product_category_name"))]
    return rules


def _renamed(found: DataFrame, rule_of: Mapping[str, str]) -> DataFrame:
    lookup = F.create_map(*[F.lit(part) for pair in rule_of.items() for part in pair])
    renamed = found.withColumn("check_name", lookup[F.col("check_name")])
    return renamed.where(F.col("check_name").isNotNull())
