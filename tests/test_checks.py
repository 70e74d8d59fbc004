"""Checks find what is wrong and count it right."""

from __future__ import annotations

import pytest

from tallyhouse.operators import checks, gate, profile
from tallyhouse.plans.warehouse import lazy_warehouse


@pytest.fixture(scope="module")
def broken(staged):
    return staged(
        customers=[dict(customer_id="c1"), dict(customer_id="c1"), dict(customer_id="")],
        orders=[
            dict(order_id="o1", customer_id="c1", order_purchase_timestamp="2018-01-02 00:00:00",
                 order_delivered_customer_date="2018-01-01 00:00:00",
                 order_approved_at="2018-01-02 00:00:00"),
            dict(order_id="o1", customer_id=None, order_purchase_timestamp="2018-01-02 00:00:00",
                 order_approved_at="2018-01-01 23:59:59"),
            dict(order_id=None, customer_id="gone"),
        ],
        order_items=[
            dict(order_id="o1", order_item_id=1, product_id="p1", seller_id="s1", price=-1,
                 freight_value=0),
            dict(order_id="o1", order_item_id=1, product_id="p9", seller_id="s1", price=1,
                 freight_value=-2),
            dict(order_id="o9", order_item_id=1, product_id="", seller_id=None, price=0),
            dict(order_id="o9", order_item_id=2, product_id="p9", seller_id="s9"),
        ],
        order_payments=[
            dict(order_id="o9", payment_sequential=1, payment_installments=-1, payment_value=-5),
            dict(order_id="o9", payment_sequential=1, payment_installments=0, payment_value=0),
        ],
        order_reviews=[
            dict(review_id="r1", order_id="o9", review_score=0, review_comment_title="t",
                 review_comment_message="m"),
            dict(review_id="r2", order_id=None, review_score=6),
            dict(review_id="r3", order_id="o1", review_score=None),
            dict(review_id="r4", order_id="o1", review_score=5),
        ],
        products=[dict(product_id="p1"), dict(product_id="p2", product_category_name="x")],
        sellers=[dict(seller_id="s1")],
        product_category_translation=[
            dict(product_category_name="x", product_category_name_english="y"),
            dict(product_category_name="x", product_category_name_english="z"),
        ],
    )


def test_required_keys(broken, found):
    failed = found(checks.required_keys(broken), "check_name", "failed_rows")
    assert {k: v for k, v in failed.items() if v} == {
        "raw_customers.customer_id nulls": 1,
        "raw_orders.order_id nulls": 1,
        "raw_order_items.product_id nulls": 1,
        "raw_order_items.seller_id nulls": 1,
    }
    assert len(failed) == 9


def test_duplicate_grain_counts_keys_not_rows(broken, found):
    assert found(checks.duplicate_grain(broken), "check_name", "failed_groups") == {
        "duplicate raw customer_id": 1,
        "duplicate raw order_id": 1,
        "duplicate raw order item grain": 1,
        "duplicate raw payment grain": 1,
        "duplicate raw review_id": 0,
        "duplicate raw product_id": 0,
        "duplicate raw seller_id": 0,
    }


def test_relationships_count_null_references(broken, found):
    assert found(checks.relationships(broken), "check_name", "failed_rows") == {
        "orders missing customer": 2,
        "order items missing order": 2,
        "payments missing order": 2,
        "reviews missing order": 2,
        "order items missing product": 3,
        "order items missing seller": 2,
    }


def test_business_rules_never_fail_on_null(broken, found):
    assert found(checks.business_rules(broken), "check_name", "failed_rows") == {
        "negative item price": 1,
        "negative freight value": 1,
        "negative payment value": 1,
        "invalid review score": 2,
        "delivered before purchase": 1,
        "approved before purchase": 1,
    }


def test_datetime_hygiene(broken, found):
    reviews = broken["raw_order_reviews"]
    failed = found(checks.datetime_hygiene(reviews), "check_name", "failed_rows")
    assert list(failed.values()) == [0, 0, 4, 4]


def test_declared_constraints(broken, found):
    failed = found(checks.raw_constraints(broken), "check_name", "failed_rows")
    assert failed["raw_order_payments.payment_installments negative"] == 1
    assert failed["raw_product_category_translation key repeated"] == 1
    assert failed["raw_orders.order_purchase_timestamp missing"] == 1
    assert "raw_orders.order_approved_at missing" not in failed


def test_warehouse_checks(broken, found):
    warehouse = lazy_warehouse(broken)
    keys = found(checks.warehouse_keys(warehouse), "check_name", "failed_groups")
    assert keys["fact_order key repeated"] == 1 and keys["dim_date key repeated"] == 0
    rules = found(checks.warehouse_rules(warehouse), "check_name", "failed_rows")
    assert rules["fact_order_item.price negative"] == 1
    assert rules["fact_order.customer_unique_id missing"] == 2
    assert "fact_order.delivery_days missing" not in rules


def test_foreign_keys(spark, broken, found):
    warehouse = dict(lazy_warehouse(broken))
    fine = found(checks.warehouse_references(warehouse), "check_name", "failed_rows")
    assert len(fine) == 12 and set(fine.values()) == {0}
    warehouse["dim_date"] = warehouse["dim_date"].where("date_key <> 20180101")
    warehouse["dim_seller"] = warehouse["dim_seller"].limit(0)
    failed = found(checks.warehouse_references(warehouse), "check_name", "failed_rows")
    assert {k: v for k, v in failed.items() if v} == {
        "fact_order.delivered_customer_date_key unknown": 2,
        "fact_order_item.seller_id unknown": 1,
    }


def test_gate(broken, staged, found):
    table = gate.quality_gate(gate.rule_failures(broken))
    outcome = found(table, "rule", "outcome")
    assert outcome["Order IDs are unique in orders"] == "blocked"
    assert outcome["Order items join to orders"] == "reported"
    assert outcome["Missing review comments"] == "reported"
    assert found(table, "rule", "failed")["Negative prices or freight values"] == 3
    assert found(table, "rule", "failed")["Missing product categories"] == 1
    with pytest.raises(gate.QualityGateError, match="Primary keys are non-null: 2"):
        gate.enforce(table)
    clean = gate.quality_gate(gate.rule_failures(staged()))
    assert set(found(clean, "rule", "outcome").values()) == {"passed"}
    gate.enforce(clean)
    softer = gate.quality_gate(
        gate.rule_failures(broken), dict.fromkeys(gate.SEVERITIES, gate.WARNING)
    )
    gate.enforce(softer)


def test_profile(spark, found):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "k int, v string")
    empty = spark.createDataFrame([], "k int")
    row = profile.dataset_profile({"t": df, "none": empty}).collect()
    assert tuple(row[0]) == ("t", 4, 2, 2, 3, 0.375)
    assert tuple(row[1]) == ("none", 0, 1, 0, 0, None)
    gaps = [tuple(r) for r in profile.missing_summary({"t": df}).collect()]
    assert gaps == [("t", "v", 3, 0.75)]
    types = [tuple(r) for r in profile.dtype_summary({"t": df}).collect()]
    assert types == [("t", "k", "int", 0), ("t", "v", "string", 3)]
    assert [r.k for r in profile.preview(df, ["k"], 2).collect()] == [1, 1]
