"""Rows that break a rule are kept apart with their reasons; the load goes on with the rest."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import gate
from tallyhouse.operators.gate import QualityGateError, quality_gate, rule_failures
from tallyhouse.plans.quarantine import judge, read_rejected, rejections, rules_from, stage_accepted
from tallyhouse.plans.warehouse import REJECTED_REPORT, STAGING_REPORT, refresh_warehouse, stage_files
from tallyhouse.sources import csv_files
from tallyhouse.sources.snapshots import SnapshotStore
from tallyhouse.sources.warehouse_store import read_delivered, read_report, read_table
from tests.test_csv_files import FILES, folder  # noqa: F401

ORDERS = FILES["shop_orders_dataset.csv"]
GOOD, SECOND = ORDERS.strip().split("\n")[1:]
HEAD = ORDERS.split("\n")[0]


def lines(*rows):
    return "\n".join([HEAD, *rows]) + "\n"


BAD_ORDERS = lines(
    GOOD,
    SECOND,
    SECOND.replace("created", "shipped"),  # a copy of the key
    GOOD.replace("o1,c1", "o3,nobody"),
    GOOD.replace("o1", "o4").replace("2018-01-05 09:00:00", "soon"),
    GOOD.replace("o1", "o5").replace("2018-01-01 10:00:00", "2018-01-09 10:00:00"),  # delivered before
    GOOD.replace("o1", ""),
    GOOD.replace("c1,delivered", ",delivered").replace("o1", "o6"),
)
BAD_PAYMENTS = (
    FILES["shop_order_payments_dataset.csv"]
    + "o1,2,voucher,1,-3.00\no3,1,voucher,1,4.00\nabsent,1,voucher,1,4.00\no1,3,voucher,1,much\n"
)
BAD_ITEMS = FILES["shop_order_items_dataset.csv"] + (
    "o1,2,p1,s1,2018-01-03 00:00:00,-1.00,-2.00\no1,3,p9,s9,2018-01-03 00:00:00,1.00,2.00\n"
)


@pytest.fixture
def bad(folder):  # noqa: F811
    return folder(orders=BAD_ORDERS, order_payments=BAD_PAYMENTS, order_items=BAD_ITEMS)


def rejected(spark, table, root, key):
    rows = read_rejected(spark, table, root).collect()
    return {r.delivered[key]: sorted((x.rule, x.detail) for x in r.reasons) for r in rows}


def test_bad_rows_are_stored_with_their_rules_and_the_load_goes_on(spark, bad, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(QualityGateError):
        stage_files(spark, bad, root)
    raw = stage_accepted(spark, bad, root)
    assert [r.order_id for r in raw["raw_orders"].orderBy("order_id").collect()] == ["o1", "o2", "o5"]
    assert raw["raw_orders"].where("order_id = 'o2'").first().order_status == "created"
    apart = read_rejected(spark, "raw_orders", root)
    assert apart.count() == 5
    customer = "Customer IDs join from orders to customers"
    found = rejected(spark, "raw_orders", root, "order_id")
    assert found["o3"] == [(customer, "not delivered")]
    assert found["o4"] == [("Dates parse successfully", "unreadable raw_orders.order_delivered_customer_date")]
    assert found["o2"] == [("Order IDs are unique in orders", "not the first delivered")]
    assert found[None] == [("Primary keys are non-null", "condition 1")]
    assert found["o6"] == [(customer, "not delivered")]
    # The text of the file stays, also where it could not be read.
    assert apart.where("delivered.order_id = 'o4'").first().delivered.order_delivered_customer_date == "soon"
    # References to orders are warnings: at this level such rows stay.
    assert raw["raw_order_payments"].count() == 3
    items = rejected(spark, "raw_order_items", root, "order_item_id")
    negative = "Negative prices or freight values"
    assert items == {"2": [(negative, "condition 1"), (negative, "condition 2")]}
    # Readers and the refresh see the accepted rows only.
    assert read_table(spark, "raw_orders", root).count() == 3
    stored = refresh_warehouse(spark, read_delivered(spark, root), root)
    assert stored["fact_order"].count() == 3


def test_warnings_reject_too_and_children_follow_their_parents(spark, bad, tmp_path):
    root = str(tmp_path / "store")
    raw = stage_accepted(spark, bad, root, reject=gate.WARNING)
    # The order delivered before its purchase goes as well, and o2 has a review that stays.
    assert {r.order_id for r in raw["raw_orders"].collect()} == {"o1", "o2"}
    join = "Payments join to orders"
    payments = read_rejected(spark, "raw_order_payments", root).collect()
    found = {(r.delivered.order_id, x.detail) for r in payments for x in r.reasons if x.rule == join}
    assert found == {("o3", "rejected"), ("absent", "not delivered")}
    items = rejected(spark, "raw_order_items", root, "order_item_id")
    assert set(items["3"]) == {
        ("Product IDs join from items to products", "not delivered"),
        ("Seller IDs join from items to sellers", "not delivered"),
    }
    # What is stored breaks no rule of that level.
    left = quality_gate(rule_failures(raw)).where(F.col("severity") != gate.INFO)
    assert left.where("failed > 0").isEmpty()


def test_counts_equal_those_of_the_gate(spark, bad, tmp_path, found):
    root = str(tmp_path / "store")
    stage_accepted(spark, bad, root, reject=gate.INFO)
    paths = csv_files.locate(spark, bad)
    texts = {t: csv_files.read_text(spark, t, p) for t, p in paths.items()}
    all_rows = {t: csv_files.to_staging(text, t) for t, text in texts.items()}
    failures = found(rule_failures(all_rows, texts), "rule", "failed")
    report = read_report(spark, REJECTED_REPORT, root).where("detail <> 'rejected'")
    ours = found(report.groupBy("rule").agg(F.sum("failed_rows").alias("n")), "rule", "n")
    for rule, failed in failures.items():
        assert ours.get(rule, 0) == failed, rule
    rows = found(read_report(spark, STAGING_REPORT, root), "check_name", "failed_rows")
    for table, df in all_rows.items():
        assert rows[f"{table} rows accepted"] + rows[f"{table} rows rejected"] == df.count()
        assert rows[f"{table} rows rejected"] == read_rejected(spark, table, root).count()


def test_the_first_good_copy_of_an_order_stays(spark, folder, tmp_path):  # noqa: F811
    broken = SECOND.replace("c2", "nobody")
    copies = lines(GOOD, broken, SECOND, SECOND.replace("created", "shipped"))
    root = str(tmp_path / "store")
    raw = stage_accepted(spark, folder(orders=copies), root)
    assert [r.order_status for r in raw["raw_orders"].where("order_id = 'o2'").collect()] == ["created"]
    assert read_rejected(spark, "raw_orders", root).count() == 2


def test_clean_empty_and_fully_rejected_files(spark, folder, tmp_path):  # noqa: F811
    root = str(tmp_path / "store")
    clean = stage_accepted(spark, folder(), root)
    assert read_rejected(spark, "raw_orders", root).isEmpty()
    plain = stage_files(spark, folder(), str(tmp_path / "plain"))
    for name, df in plain.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, clean[name].collect())), name
    nothing = {name: text.split("\n")[0] + "\n" for name, text in FILES.items() if "orders" in name}
    raw = stage_accepted(
        spark,
        folder(orders=nothing["shop_orders_dataset.csv"], customers=FILES["shop_customers_dataset.csv"].replace("c1", "").replace("c2", "")),
        root,
        reject=gate.WARNING,
    )
    # No customer has a key, there is no order, so nothing that refers to orders stays either.
    for name in ("customers", "orders", "order_items", "order_payments", "order_reviews"):
        assert raw[f"raw_{name}"].isEmpty() and read_table(spark, f"raw_{name}", root).isEmpty(), name
    assert read_rejected(spark, "raw_customers", root).count() == 2
    # A plain load afterwards forgets what was kept apart.
    stage_files(spark, folder(), root)
    assert not [n for n in SnapshotStore(spark, root).current() if n.startswith("rejected")]


def test_a_failure_on_the_way_changes_nothing(spark, folder, bad, tmp_path, monkeypatch):  # noqa: F811
    root = str(tmp_path / "store")
    stage_files(spark, folder(), root)
    before = SnapshotStore(spark, root).current()
    monkeypatch.setattr(gate, "enforce", lambda found: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        stage_accepted(spark, bad, root)
    assert SnapshotStore(spark, root).current() == before


def test_rules_of_a_level():
    assert set(rules_from(gate.ERROR)) < set(rules_from(gate.WARNING)) < set(rules_from(gate.INFO))
    assert "Missing review comments" not in rules_from(gate.WARNING)


def test_a_plan_judges_references_without_sorting_rows(spark, staged):
    raw = staged(
        customers=[{"customer_id": "c1"}, {"customer_id": "c1"}],
        orders=[
            {"order_id": "o1", "customer_id": "c1"},
            {"order_id": "o1", "customer_id": "c1"},
            {"order_id": "o2", "customer_id": "nobody"},
            {"order_id": "o3"},
            {"customer_id": "c1"},
        ],
        order_payments=[
            {"order_id": o, "payment_sequential": i} for i, o in enumerate(["o1", "o2", "o2", "o9", None])
        ],
    )
    found = rejections(judge(raw, gate.WARNING), rules_from(gate.WARNING))
    customer, order = "Customer IDs join from orders to customers", "Payments join to orders"
    key = ("Primary keys are non-null", "condition 1", 1)
    assert sorted(map(tuple, found.collect())) == [
        ("raw_order_payments", order, "not delivered", 2),
        ("raw_order_payments", order, "rejected", 2),
        ("raw_order_payments", *key),
        ("raw_orders", customer, "not delivered", 2),
        ("raw_orders", *key),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
