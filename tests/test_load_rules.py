"""What a load must not lose, double or stop at, and metrics under a selection."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.operators import metrics, reports
from tallyhouse.operators.dimensions import dim_product
from tallyhouse.operators.facts import fact_order_item
from tallyhouse.operators.gate import QualityGateError, quality_gate, rule_failures
from tallyhouse.operators.profile import dataset_profile
from tallyhouse.plans.warehouse import (
    dedupe_all,
    lazy_warehouse,
    refresh_warehouse,
    stage_files,
    surplus_keys,
    validate,
)
from tallyhouse.sources import csv_files
from tallyhouse.sources.sample_tables import load_sample
from tallyhouse.sources.warehouse_store import write_table
from tests.test_csv_files import FILES, folder  # noqa: F401


def order(name, customer, day, status="delivered"):
    return dict(
        order_id=name,
        customer_id=customer,
        order_status=status,
        order_purchase_timestamp=f"{day} 00:00:00",
        order_estimated_delivery_date="2019-01-01 00:00:00",
    )


PEOPLE = [
    dict(customer_id="a1", customer_unique_id="a", customer_state="SP"),
    dict(customer_id="a2", customer_unique_id="a", customer_state="SP"),
    dict(customer_id="b1", customer_unique_id="b", customer_state="RJ"),
]


def test_the_dated_review_stays(spark, staged, tmp_path):
    raw = staged(
        customers=PEOPLE,
        orders=[order("o1", "a1", "2018-01-01")],
        order_reviews=[
            dict(review_id="r", order_id="o1", review_score=1),
            dict(
                review_id="r",
                order_id="o1",
                review_score=5,
                review_creation_date="2018-01-01 00:00:00",
            ),
        ],
    )
    stored = refresh_warehouse(spark, raw, str(tmp_path))
    assert [r.review_score for r in stored["fact_review"].collect()] == [5]


def test_rows_delivered_twice_count_once(spark, staged, tmp_path):
    raw = staged(
        customers=[*PEOPLE, PEOPLE[0]],
        orders=[order("o1", "a1", "2018-01-01"), order("o1", "a1", "2018-01-01")],
        order_payments=[dict(order_id="o1", payment_sequential=1, payment_value=10)] * 2,
        order_items=[
            dict(order_id="o1", order_item_id=1, product_id="p", seller_id="s", price=3)
        ]
        * 3,
    )
    stored = refresh_warehouse(spark, raw, str(tmp_path))
    (row,) = stored["fact_order"].collect()
    assert (row.payment_value, row.item_count) == (Decimal("10.00"), 1)
    assert stored["dim_customer"].where("customer_unique_id = 'a'").first().total_orders == 1
    found = {r.check_name: r.failed_rows for r in surplus_keys(raw).collect()}
    assert found["raw_orders copies of a key"] == 1
    assert found["raw_order_items copies of a key"] == 2
    assert sum(r.failed_rows for r in surplus_keys(dedupe_all(raw)).collect()) == 0


@pytest.mark.parametrize("bad", ["1,234.50", "abc"])
def test_an_unreadable_number_stops_the_load(spark, folder, tmp_path, bad):  # noqa: F811
    broken = FILES["shop_order_payments_dataset.csv"].replace("72.19", f'"{bad}"')
    with pytest.raises(QualityGateError, match="Numbers parse"):
        stage_files(spark, folder(order_payments=broken), str(tmp_path / "store"))


def test_validation_sees_the_text(spark, folder):  # noqa: F811
    place = folder()
    paths = csv_files.locate(spark, place)
    texts = {t: csv_files.read_text(spark, t, p) for t, p in paths.items()}
    raw = csv_files.load_all(spark, place)
    found = {r.check_name: r.failed_rows for r in validate(raw, texts).collect()}
    assert found["zero raw_order_reviews.review_creation_date"] == 1
    assert found["zero raw_order_reviews.review_answer_timestamp"] == 1
    assert found["unreadable raw_order_payments.payment_value"] == 0
    assert found["raw_orders"] == 2
    assert found["raw_order_reviews copies of a key"] == 1
    assert len(found) > 50
    rules = {r.rule: r.outcome for r in quality_gate(rule_failures(raw, texts)).collect()}
    assert rules["Numbers parse successfully"] == "passed"


def test_two_files_for_one_table_stop_the_load(spark, folder, tmp_path):  # noqa: F811
    place = folder()
    name = "shop_order_payments_dataset.csv"
    with open(f"{place}/old_{name}", "w") as out:
        out.write(FILES[name])
    with pytest.raises(csv_files.AmbiguousFiles, match="raw_order_payments"):
        csv_files.locate(spark, place)
    assert csv_files.locate(spark, place, {"raw_order_payments": name})


def test_new_customers_of_a_selection_are_new_in_the_whole_history(staged):
    raw = staged(
        customers=PEOPLE,
        orders=[
            order("o1", "a1", "2017-05-01"),
            order("o2", "a2", "2018-01-10"),
            order("o3", "b1", "2018-01-20"),
        ],
    )
    warehouse = lazy_warehouse(raw, payments=False, items=False)
    chosen = metrics.select(warehouse, metrics.Filters(date_from=date(2018, 1, 1)))
    (row,) = metrics.customer_growth_monthly(chosen).collect()
    assert (row.buyers, row.new_customers, row.repeat_customers) == (2, 1, 1)
    # The repeat rate of a selection is that of its own orders.
    assert metrics.repeat_purchase_rate(chosen).first()[0] == 0


def test_average_order_value_counts_every_paid_order(staged):
    raw = staged(
        customers=PEOPLE,
        orders=[order(f"o{i}", "a1", "2018-01-01") for i in range(4)]
        + [order("o4", "b1", "2018-01-01", None), order("o5", "b1", "2018-01-01", "Canceled")],
        order_payments=[
            dict(order_id="o0", payment_sequential=1, payment_value=100),
            dict(order_id="o1", payment_sequential=1, payment_value=0),
            dict(order_id="o2", payment_sequential=1, payment_value=-50),
            dict(order_id="o4", payment_sequential=1, payment_value=30),
            dict(order_id="o5", payment_sequential=1, payment_value=7),
        ],
    )
    warehouse = lazy_warehouse(raw, items=False)
    assert metrics.total_revenue(warehouse).first()[0] == Decimal("80.00")
    assert metrics.average_order_value(warehouse).first()[0] == 20.0
    assert metrics.average_order_value_per_order(warehouse).first()[0] == 16.0
    assert metrics.kpi_cards(warehouse).first().average_order_value == 20.0


def test_an_extreme_row_does_not_stop_the_facts(staged):
    raw = staged(
        order_items=[
            dict(order_id="o", order_item_id=1, product_id="p", seller_id="s", price="0.01",
                 freight_value="99999.99")
        ],
        products=[
            dict(product_id="p", product_length_cm=999999, product_height_cm=999999,
                 product_width_cm=999999)
        ],
        sellers=[dict(seller_id="s")],
        orders=[order("o", "a1", "2018-01-01")],
    )
    (row,) = fact_order_item(
        raw["raw_order_items"], raw["raw_orders"], raw["raw_products"], raw["raw_sellers"]
    ).collect()
    assert row.freight_rate is None and row.line_total_value == Decimal("100000.00")
    (product,) = dim_product(
        raw["raw_products"], raw["raw_product_category_translation"]
    ).collect()
    assert product.product_category_name == "unknown"


def test_names_that_a_collation_makes_equal_translate_once(staged):
    raw = staged(
        products=[dict(product_id="p", product_category_name="MOVEIS")],
        product_category_translation=[
            dict(product_category_name="moveis", product_category_name_english="furniture"),
            dict(product_category_name="Móveis", product_category_name_english="other"),
        ],
    )
    found = dim_product(
        raw["raw_products"], raw["raw_product_category_translation"], "UNICODE_CI_AI"
    ).collect()
    assert len(found) == 1


def test_stored_tables_are_not_shuffled_to_be_written(spark, staged, tmp_path):
    people = staged(customers=PEOPLE * 20)["raw_customers"].repartition(3)
    people.write.parquet(str(tmp_path / "three"))
    read = spark.read.schema(people.schema).parquet(str(tmp_path / "three"))
    pieces = read.rdd.getNumPartitions()
    write_table(read, "raw_customers", str(tmp_path))
    files = list((tmp_path / "raw_customers").glob("part-*.parquet"))
    assert len(files) == pieces


def test_copies_of_rows_are_counted_exactly(spark):
    rows = [(1, "a"), (1, "a"), (None, "1"), (None, "1"), (None, "1"), (1, None), (2, None)]
    df = spark.createDataFrame(rows, "x int, y string")
    (found,) = dataset_profile({"t": df}).collect()
    assert (found.rows, found.duplicate_rows, found.missing_cells) == (7, 3, 5)


def test_late_by_state_reads_one_shuffle_twice(spark):
    df = reports.late_by_state(load_sample(spark, "/root/testdata/sf0.001"))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
