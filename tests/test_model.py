"""Dimensions, facts and metrics on hand-made edge cases."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.operators import dimensions, facts, metrics, reports
from tallyhouse.plans.warehouse import dedupe_reviews, lazy_warehouse


@pytest.fixture(scope="module")
def shop(staged):
    placed, promised = "order_purchase_timestamp", "order_estimated_delivery_date"
    arrived = "order_delivered_customer_date"
    return staged(
        customers=[
            dict(customer_id="c1", customer_unique_id="u1", customer_city="a", customer_state="SP"),
            dict(customer_id="c2", customer_unique_id="u1", customer_city="b", customer_state="RJ"),
            dict(customer_id="c0", customer_unique_id="u1", customer_city="z", customer_state="MG"),
            dict(customer_id="c3", customer_unique_id="u2", customer_city="c", customer_state="SP"),
            dict(customer_id="c4", customer_unique_id="u3", customer_city="d", customer_state="BA"),
        ],
        orders=[
            {
                "order_id": "o1", "customer_id": "c1", "order_status": "delivered",
                placed: "2018-01-31 10:00:00", "order_approved_at": "2018-01-31 07:00:01",
                "order_delivered_carrier_date": "2018-02-01 12:59:59",
                arrived: "2018-02-03 12:00:00", promised: "2018-02-02 00:00:00",
            },
            {
                "order_id": "o2", "customer_id": "c2", "order_status": "canceled",
                placed: "2018-02-15 00:00:00", promised: "2018-03-01 00:00:00",
            },
            {
                "order_id": "o3", "customer_id": "c3", "order_status": "delivered",
                placed: "2018-02-20 12:00:00", arrived: "2018-02-20 07:00:00",
                promised: "2018-03-01 00:00:00",
            },
            {
                "order_id": "o4", "customer_id": "nobody", "order_status": "delivered",
                placed: "2018-03-01 00:00:00", promised: "2018-03-09 00:00:00",
            },
        ],
        order_items=[
            dict(order_id="o1", order_item_id=1, product_id="p1", seller_id="s1",
                 shipping_limit_date="2018-02-02 00:00:00", price=8, freight_value=1),
            dict(order_id="o1", order_item_id=2, product_id="p2", seller_id="s2",
                 shipping_limit_date="2018-02-02 00:00:00", price=0, freight_value=5),
            dict(order_id="o3", order_item_id=1, product_id="p3", seller_id="s1",
                 shipping_limit_date="2018-12-31 00:00:00", price=3, freight_value=2),
            dict(order_id="o3", order_item_id=2, product_id="lost", seller_id="s1",
                 shipping_limit_date="2018-12-31 00:00:00", price=4, freight_value=2),
            dict(order_id="o3", order_item_id=3, product_id="p1", seller_id="lost",
                 shipping_limit_date="2018-12-31 00:00:00", price=4, freight_value=2),
            dict(order_id="o4", order_item_id=1, product_id="p1", seller_id="s1",
                 shipping_limit_date="2018-12-31 00:00:00", price=4, freight_value=2),
        ],
        order_payments=[
            dict(order_id="o1", payment_sequential=1, payment_value=10),
            dict(order_id="o1", payment_sequential=2, payment_value=4),
            dict(order_id="o2", payment_sequential=1, payment_value=100),
            dict(order_id="o3", payment_sequential=1, payment_value=7),
        ],
        order_reviews=[
            dict(review_id="r1", order_id="o1", review_score=2, review_comment_title="",
                 review_comment_message="  ", review_creation_date="2018-02-04 00:00:00",
                 review_answer_timestamp="2018-02-03 21:00:01"),
            dict(review_id="r2", order_id="o1", review_score=3, review_comment_message="fine",
                 review_creation_date="2018-02-04 00:00:00"),
            dict(review_id="r3", order_id="o3", review_score=5),
            dict(review_id="r4", order_id="o4", review_score=4,
                 review_creation_date="2018-02-04 00:00:00"),
            dict(review_id="r5", order_id="o3", review_score=9,
                 review_creation_date="2018-02-05 00:00:00"),
        ],
        products=[
            dict(product_id="p1", product_category_name="moveis", product_name_lenght=4,
                 product_length_cm=2, product_height_cm=3, product_width_cm=1.5),
            dict(product_id="p2", product_category_name="", product_length_cm=2,
                 product_height_cm=3),
            dict(product_id="p3", product_category_name="jardim"),
            dict(product_id="p4"),
        ],
        sellers=[
            dict(seller_id="s1", seller_state="SP", seller_city="a"),
            dict(seller_id="s2", seller_state="RJ", seller_city="b"),
        ],
        product_category_translation=[
            dict(product_category_name="moveis", product_category_name_english="furniture"),
            dict(product_category_name="Jardím", product_category_name_english="garden"),
        ],
    )


@pytest.fixture(scope="module")
def warehouse(shop):
    return lazy_warehouse(shop)


def _by(df, key):
    return {row[key]: row for row in df.collect()}


def test_calendar_holds_each_day_once(warehouse):
    days = _by(warehouse["dim_date"], "date_key")
    assert 20180204 in days and 20180205 in days
    newest = days[20181231]
    assert newest.full_date == date(2018, 12, 31)
    assert (newest.week_number, newest.month_name, newest.day_name) == (1, "December", "Monday")
    assert (newest.quarter_number, newest.day_of_week, newest.is_weekend) == (4, 2, False)
    assert days[20180203].is_weekend and days[20180204].is_weekend
    assert warehouse["dim_date"].count() == len(days)


def test_person_takes_first_record_and_latest_place(warehouse):
    people = _by(warehouse["dim_customer"], "customer_unique_id")
    # A record without an order sorts before all others, so it is the first one.
    assert people["u1"].first_customer_id == "c0"
    assert (people["u1"].customer_city, people["u1"].customer_state) == ("b", "RJ")
    assert people["u1"].total_orders == 2
    assert people["u1"].first_order_date == datetime(2018, 1, 31, 10)
    assert people["u1"].last_order_date == datetime(2018, 2, 15)
    assert (people["u3"].total_orders, people["u3"].first_order_date) == (0, None)
    assert people["u3"].customer_city == "d"


def test_products_keep_unknown_categories(warehouse, shop):
    products = _by(warehouse["dim_product"], "product_id")
    assert products["p1"].product_category_name_english == "furniture"
    assert products["p1"].product_volume_cm3 == Decimal("9.00")
    assert products["p1"].product_name_length == Decimal("4.00")
    for name in ("p2", "p4"):
        assert products[name].product_category_name == "unknown"
        assert products[name].product_category_name_english == "unknown"
        assert products[name].product_volume_cm3 is None
    assert products["p3"].product_category_name == "jardim"
    assert products["p3"].product_category_name_english == "unknown"
    loose = dimensions.dim_product(
        shop["raw_products"], shop["raw_product_category_translation"], "UNICODE_CI_AI"
    )
    assert _by(loose, "product_id")["p3"].product_category_name_english == "garden"


def test_orders(warehouse):
    orders = _by(warehouse["fact_order"], "order_id")
    assert set(orders) == {"o1", "o2", "o3"}
    first = orders["o1"]
    assert first.payment_value == Decimal("14.00") and first.merchandise_value == Decimal("8.00")
    assert (first.item_count, first.seller_count, first.late_delivery_flag) == (2, 2, True)
    # Two hours 59 minutes before the purchase: two completed hours, toward zero.
    assert first.approval_days == Decimal("-0.08")
    assert first.carrier_handling_days == Decimal("1.21")
    assert first.delivery_days == Decimal("3.08")
    assert first.purchase_date_key == 20180131 and first.delivered_customer_date_key == 20180203
    open_order = orders["o2"]
    assert open_order.late_delivery_flag is None and open_order.delivery_days is None
    assert open_order.approved_date_key is None and open_order.item_count == 0
    assert open_order.merchandise_value == Decimal("0.00")
    assert orders["o3"].delivery_days == Decimal("-0.21")


def test_items_need_order_product_and_seller(warehouse):
    items = {(r.order_id, r.order_item_id): r for r in warehouse["fact_order_item"].collect()}
    assert set(items) == {("o1", 1), ("o1", 2), ("o3", 1)}
    assert items["o1", 1].line_total_value == Decimal("9.00")
    assert items["o1", 1].freight_rate == Decimal("0.1250")
    assert items["o1", 2].freight_rate is None
    assert items["o3", 1].freight_rate == Decimal("0.6667")


def test_reviews(warehouse):
    reviews = _by(warehouse["fact_review"], "review_id")
    assert set(reviews) == {"r1", "r2", "r5"}
    first = reviews["r1"]
    assert first.review_comment_title is None and first.review_comment_message == "  "
    assert not first.has_review_comment and first.is_negative_review
    assert first.review_response_days == Decimal("-0.08")
    assert reviews["r2"].has_review_comment and not reviews["r2"].is_positive_review
    assert reviews["r2"].review_response_days is None


def test_first_review_of_a_repeated_key(staged):
    reviews = staged(
        order_reviews=[
            dict(review_id="r", order_id="late", review_creation_date="2018-02-04 00:00:00"),
            dict(review_id="r", order_id="early", review_creation_date="2018-01-04 00:00:00"),
            dict(review_id="q", order_id="dated", review_creation_date="2018-01-04 00:00:00"),
            dict(review_id="q", order_id="undated"),
        ]
    )["raw_order_reviews"]
    assert {k: r.order_id for k, r in _by(dedupe_reviews(reviews), "review_id").items()} == {
        "r": "early",
        "q": "dated",
    }


def test_report_days_are_floored_and_undelivered_is_not_late(shop):
    orders = _by(reports.orders_enriched(shop), "order_id")
    assert orders["o3"].delivery_days == -1 and orders["o3"].late_delivery is False
    assert orders["o1"].delivery_days == 3 and orders["o1"].late_delivery is True
    assert orders["o2"].late_delivery is False and orders["o2"].delivery_days is None
    assert orders["o4"].customer_state is None and len(orders) == 4


def test_category_falls_back_to_the_original_name(shop):
    lines = reports.items_products(shop).select("product_id", "category").distinct()
    assert {(r.product_id, r.category) for r in lines.collect()} == {
        ("p1", "furniture"), ("p2", "unknown"), ("p3", "jardim"), ("lost", "unknown")
    }


def test_revenue_leaves_out_cancelled_orders_unless_told(warehouse):
    def total(*rules):
        return metrics.total_revenue(warehouse, *rules).first().total_revenue

    assert total() == Decimal("21.00")
    assert total(metrics.Rules(exclude_no_revenue=False)) == Decimal("121.00")
    assert total(metrics.Rules(metrics.ITEM)) == Decimal("31.00")
    assert metrics.average_order_value(warehouse).first()[0] == 10.5
    with pytest.raises(ValueError, match="basis"):
        metrics.revenue("gross")


def test_cards_agree_with_single_metrics(warehouse):
    cards = metrics.kpi_cards(warehouse).first().asDict()
    assert cards.pop("total_revenue") == Decimal("21.00")
    assert cards.pop("revenue_growth_pct") == pytest.approx(-50.0)
    assert cards.pop("average_delivery_days") == pytest.approx((3.08 - 0.21) / 2)
    assert cards.pop("repeat_purchase_rate") == pytest.approx(100 / 3)
    assert cards.pop("late_delivery_rate") == 50.0
    assert cards == dict(
        orders=3, average_order_value=10.5, customers=3, average_review_score=2.5
    )


def test_growth_is_null_without_a_base(warehouse):
    rows = metrics.revenue_growth_monthly(warehouse).collect()
    assert [(r.order_month, r.growth_pct) for r in rows] == [("2018-01", None), ("2018-02", -50.0)]


def test_customer_growth(warehouse):
    rows = [tuple(r) for r in metrics.customer_growth_monthly(warehouse).collect()]
    assert rows == [("2018-01", 1, 1, 0, 1), ("2018-02", 2, 1, 1, 2)]


@pytest.mark.parametrize(
    "filters, kept",
    [
        (metrics.Filters(), {"o1", "o2", "o3"}),
        (metrics.Filters(date_from=date(2018, 2, 15)), {"o2", "o3"}),
        (metrics.Filters(date_to=date(2018, 2, 15)), {"o1", "o2"}),
        (metrics.Filters(customer_states=["RJ"]), {"o1", "o2"}),
        (metrics.Filters(product_categories=["furniture"]), {"o1"}),
        (metrics.Filters(seller_states=["SP"], order_statuses=["delivered"]), {"o1", "o3"}),
    ],
)
def test_filters_keep_each_order_once(warehouse, filters, kept):
    chosen = metrics.select(warehouse, filters)
    ids = [r.order_id for r in chosen["fact_order"].collect()]
    assert sorted(ids) == sorted(kept)


def test_known_orders_are_the_orders_of_the_fact(shop, warehouse):
    known = facts.known_orders(shop["raw_orders"], shop["raw_customers"])
    assert {r[0] for r in known.collect()} == {
        r[0] for r in warehouse["fact_order"].select("order_id").collect()
    }
