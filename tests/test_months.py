"""Months kept up to date one by one give the feeds that all orders give."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import board, metrics
from tallyhouse.plans import months
from tallyhouse.plans.months import VISITS, month_board, read_sums, read_visits, refresh_months
from tallyhouse.plans.warehouse import lazy_warehouse, refresh_warehouse
from tallyhouse.sources.sample_tables import load_sample
from tallyhouse.sources.snapshots import SnapshotStore
from tests.test_board import ONE_BY_ONE, same
from tests.test_load_rules import PEOPLE, order

SMALL = "/root/testdata/sf0.001"


def feeds_match(spark, root, warehouse, rules=metrics.Rules()):
    sums, people = read_sums(spark, root), month_board(read_visits(spark, root))
    same(board.revenue(sums), metrics.monthly_revenue(warehouse, rules))
    same(board.growth(sums), metrics.revenue_growth_monthly(warehouse, rules))
    for name in ("delivery", "late"):
        same(board.FEEDS[name](sums), ONE_BY_ONE[name](warehouse))
    same(board.customers(people), metrics.customer_growth_monthly(warehouse))
    cards, wanted = board_cards(people), metrics.kpi_cards(warehouse, rules).first()
    for name in cards.asDict():
        assert cards[name] == pytest.approx(wanted[name]), name


def board_cards(people):
    scores = {name: F.lit(0).cast("long") for name in board.SCORES.values()}
    return board.cards(people.withColumns(scores)).drop("average_review_score").first()


def month_paths(spark, root):
    tables = SnapshotStore(spark, root).current()
    return {n.removeprefix(VISITS): p for n, p in tables.items() if n.startswith(VISITS)}


def test_feeds_of_stored_months_equal_those_of_the_orders(spark, tmp_path):
    root = str(tmp_path)
    warehouse = lazy_warehouse(load_sample(spark, SMALL))
    touched = refresh_months(spark, warehouse["fact_order"], root)
    assert touched == sorted(month_paths(spark, root)) and len(touched) > 50
    feeds_match(spark, root, warehouse)
    assert refresh_months(spark, warehouse["fact_order"], root) == []


def test_late_orders_change_only_their_months(spark, staged, tmp_path):
    root = str(tmp_path)
    days = ["2018-01-03", "2018-01-09", "2018-02-01", "2018-04-01"]
    first = [order(f"o{i}", "a1" if i % 2 else "b1", day) for i, day in enumerate(days)]
    undated = order("u1", "b1", None) | {"order_purchase_timestamp": None}
    raw = staged(customers=PEOPLE, orders=[*first, undated])
    stored = refresh_warehouse(spark, raw, root)
    assert refresh_months(spark, stored["fact_order"], root) == ["2018-01", "2018-02", "2018-04", "undated"]
    feeds_match(spark, root, lazy_warehouse(raw))
    before = month_paths(spark, root)

    # An order of February comes late: a new first month for its customer, one month to work out.
    raw = staged(customers=PEOPLE, orders=[*first, undated, order("late", "a2", "2018-02-11")])
    stored = refresh_warehouse(spark, raw, root)
    assert refresh_months(spark, stored["fact_order"], root) == ["2018-02"]
    after = month_paths(spark, root)
    assert {m for m in after if after[m] != before.get(m)} == {"2018-02"}
    feeds_match(spark, root, lazy_warehouse(raw))

    # A month whose only order is gone goes; a payment changes the month of its order.
    paid = dict(order_id="o0", payment_sequential=1, payment_type="x", payment_installments=1, payment_value=5.5)
    raw = staged(customers=PEOPLE, orders=first[:3], order_payments=[paid])
    stored = refresh_warehouse(spark, raw, root)
    assert refresh_months(spark, stored["fact_order"], root) == ["2018-01", "2018-02", "2018-04", "undated"]
    assert set(month_paths(spark, root)) == {"2018-01", "2018-02"}
    feeds_match(spark, root, lazy_warehouse(raw))


def test_other_rules_work_all_months_out_again(spark, tmp_path):
    root = str(tmp_path)
    warehouse = lazy_warehouse(load_sample(spark, SMALL))
    some = warehouse["fact_order"].where(F.col("order_purchase_timestamp") < F.lit(date(1993, 1, 1)))
    first = refresh_months(spark, some, root)
    item = metrics.Rules(metrics.ITEM, exclude_no_revenue=False)
    assert refresh_months(spark, some, root, item) == first
    wanted = metrics.monthly_revenue({"fact_order": some}, item)
    same(board.revenue(read_sums(spark, root)), wanted)


def test_a_failure_on_the_way_leaves_the_months_before(spark, staged, tmp_path, monkeypatch):
    root = str(tmp_path)
    raw = staged(customers=PEOPLE, orders=[order("o1", "a1", "2018-01-03")])
    refresh_months(spark, lazy_warehouse(raw)["fact_order"], root)
    before = month_paths(spark, root)
    more = staged(customers=PEOPLE, orders=[order("o1", "a1", "2018-01-03"), order("o2", "a1", "2018-03-03")])
    monkeypatch.setattr(months.Draft, "commit", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        refresh_months(spark, lazy_warehouse(more)["fact_order"], root)
    assert month_paths(spark, root) == before
    same(board.revenue(read_sums(spark, root)), metrics.monthly_revenue(lazy_warehouse(raw)))


def test_no_orders_at_all(spark, staged, tmp_path):
    empty = lazy_warehouse(staged(customers=PEOPLE))["fact_order"]
    assert refresh_months(spark, empty, str(tmp_path)) == []
    assert read_sums(spark, str(tmp_path)).isEmpty()
    with pytest.raises(FileNotFoundError):
        read_visits(spark, str(tmp_path))
