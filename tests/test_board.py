"""The board of a selection gives every feed the dashboard has, from one pass."""

from __future__ import annotations

import re
from datetime import date

import pytest

from tallyhouse.operators import board, metrics
from tallyhouse.operators.metrics import Filters, Rules
from tallyhouse.plans.queries import SELECTION
from tallyhouse.plans.warehouse import lazy_warehouse
from tallyhouse.sources.sample_tables import load_sample
from tests.test_load_rules import PEOPLE, order

SMALL = "/root/testdata/sf0.001"

ONE_BY_ONE = {
    "revenue": metrics.monthly_revenue,
    "growth": metrics.revenue_growth_monthly,
    "customers": metrics.customer_growth_monthly,
    "delivery": metrics.delivery_time_trend,
    "late": metrics.late_rate_trend,
    "reviews": metrics.review_score_distribution,
    "cards": metrics.kpi_cards,
}


def same(found, wanted):
    assert found.columns == wanted.columns
    rows = found.collect()
    for ours, theirs in zip(rows, wanted.collect(), strict=True):
        for a, b in zip(ours, theirs, strict=True):
            assert a == (pytest.approx(b) if isinstance(b, float) else b)
    return rows


def test_feeds_of_a_stored_board_equal_those_of_the_orders(spark, tmp_path):
    raw = load_sample(spark, SMALL)
    wide = Filters(date_from=date(1993, 5, 1), date_to=date(1997, 2, 14), order_statuses=["delivered", "shipped"])
    months = board.board(lazy_warehouse(raw, known=False), wide)
    stored = board.store_board(months, str(tmp_path / "board"))
    chosen = metrics.select(lazy_warehouse(raw), wide)
    for name, feed in board.FEEDS.items():
        assert same(feed(stored), ONE_BY_ONE[name](chosen)), name
        plan = feed(stored)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


def test_feeds_of_an_empty_selection_are_empty(spark):
    raw = load_sample(spark, SMALL)
    none = Filters(customer_states=["nowhere"])
    months, chosen = board.board(lazy_warehouse(raw), none), metrics.select(lazy_warehouse(raw), none)
    for name, feed in board.FEEDS.items():
        same(feed(months), ONE_BY_ONE[name](chosen))


def test_people_count_once_however_many_months_they_buy_in(spark, staged):
    days = ["2018-01-03", "2018-01-09", "2018-02-01", "2018-04-01"]
    orders = [order(f"o{i}", "a1" if i % 2 else "a2", day) for i, day in enumerate(days)]
    orders += [order("p1", "b1", "2018-02-02"), order("p2", "b1", None) | {"order_purchase_timestamp": None}]
    reviews = [
        dict(review_id=f"r{i}", order_id=name, review_score=k, review_creation_date="2018-05-01 00:00:00")
        for i, (name, k) in enumerate([("o0", 5), ("o0", 1), ("o2", 5), ("p1", 9), ("unknown", 5)])
    ]
    raw = staged(customers=PEOPLE, orders=orders, order_reviews=reviews)
    every = Filters(date_from=date(2018, 1, 1))
    months = board.board(lazy_warehouse(raw, known=False), every)
    found = {r.order_month: r for r in months.collect()}
    assert [found[m].customers for m in ("2018-01", "2018-02", "2018-04")] == [1, 1, 0]
    assert [found[m].repeaters for m in ("2018-01", "2018-02", "2018-04")] == [1, 0, 0]
    assert (found["2018-01"].score_5, found["2018-01"].score_1, found["2018-02"].score_5) == (1, 1, 1)
    chosen = metrics.select(lazy_warehouse(raw), every)
    for name, feed in board.FEEDS.items():
        same(feed(months), ONE_BY_ONE[name](chosen))


def test_rules_reach_the_board(spark):
    raw = load_sample(spark, SMALL)
    rules = Rules(metrics.ITEM, exclude_no_revenue=False)
    chosen = Filters(date_to=date(1998, 1, 1))
    months = board.board(lazy_warehouse(raw), chosen, rules)
    same(board.revenue(months), metrics.monthly_revenue(metrics.select(lazy_warehouse(raw), chosen), rules))


def test_parts_can_be_left_out(spark):
    raw = load_sample(spark, SMALL)
    months = board.board(lazy_warehouse(raw, known=False), SELECTION, history=False, reviews=False)
    assert not {"buyers", "score_1"} & set(months.columns)
    assert same(board.revenue(months), metrics.monthly_revenue(metrics.select(lazy_warehouse(raw), SELECTION)))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_the_selection_is_planned_once(spark):
    raw = load_sample(spark, SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = board.board(lazy_warehouse(raw, items=False, known=False), SELECTION, history=False)
        cards = metrics.kpi_cards(metrics.select(lazy_warehouse(raw, items=False), SELECTION))
        assert exchanges(board.cards(one)) < 40 < exchanges(cards)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
