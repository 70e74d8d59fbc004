"""Loading the nine files: layouts, odd values, and what must stop a load."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.operators import metrics
from tallyhouse.operators.checks import datetime_hygiene
from tallyhouse.operators.gate import QualityGateError, quality_gate, rule_failures
from tallyhouse.plans.warehouse import (
    lazy_warehouse,
    refresh_geography,
    refresh_warehouse,
    stage_files,
    warehouse_row_counts,
)
from tallyhouse.schemas import WAREHOUSE
from tallyhouse.sources import csv_files
from tallyhouse.sources.sample_tables import load_sample
from tallyhouse.sources.warehouse_store import read_table

FILES = {
    "shop_customers_dataset.csv": "customer_id,customer_unique_id,customer_zip_code_prefix,"
    "customer_city,customer_state\n"
    'c1,u1,01037,"sao paulo",SP\nc2,u1,20000,rio,RJ\n',
    "shop_geolocation_dataset.csv": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
    "geolocation_city,geolocation_state\n"
    "1037,-23.5456213,-46.6392922,sao paulo,SP\n1037,-23.5456211,-46.6392920,sao paulo,SP\n",
    "shop_orders_dataset.csv": "order_id,customer_id,order_status,order_purchase_timestamp,"
    "order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,"
    "order_estimated_delivery_date\n"
    "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 00:00:00,"
    "2018-01-05 09:00:00,2018-01-20 00:00:00\n"
    "o2,c2,created,2018-02-01 10:00:00,,,,2018-02-20 00:00:00\n",
    "shop_order_items_dataset.csv": "order_id,order_item_id,product_id,seller_id,"
    "shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2018-01-03 00:00:00,58.90,13.29\n",
    "shop_order_payments_dataset.csv": "order_id,payment_sequential,payment_type,"
    "payment_installments,payment_value\no1,1,credit_card,8,72.19\n",
    "shop_order_reviews_dataset.csv": "review_id,order_id,review_score,review_comment_title,"
    "review_comment_message,review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,"He said ""great""","two\nlines, one comma",2018-01-06 00:00:00,'
    "2018-01-07 12:00:00\n"
    "r2,o1,4,,,0000-00-00 00:00:00,\n"
    "r3,o2,1,,,2018-02-21 00:00:00,0000-00-00 00:00:00\n"
    "r1,o1,1,,,2018-03-06 00:00:00,2018-03-07 12:00:00\n",
    "shop_products_dataset.csv": "product_id,product_category_name,product_name_lenght,"
    "product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,"
    "product_height_cm,product_width_cm\n"
    "p1,moveis,40,287,1,225,16,10,14\np2,,,,,,,,\n",
    "shop_sellers_dataset.csv": "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    "s1,13023,campinas,SP\n",
    "product_category_name_translation.csv": "﻿product_category_name,"
    "product_category_name_english\r\nmoveis,furniture\r\n",
}


@pytest.fixture
def folder(tmp_path):
    def write(**changes):
        for name, text in FILES.items():
            key = name.removeprefix("shop_").removesuffix("_dataset.csv")
            text = changes.get(key, text)
            if text is not None:
                (tmp_path / name).write_bytes(text.encode())
        return str(tmp_path)

    return write


def test_load_all(spark, folder):
    raw = csv_files.load_all(spark, folder())
    assert len(raw) == 9
    customer = raw["raw_customers"].orderBy("customer_id").first()
    assert customer.customer_zip_code_prefix == 1037
    item = raw["raw_order_items"].first()
    assert (item.price, item.order_item_id) == (Decimal("58.90"), 1)
    assert raw["raw_order_items"].dtypes[4:] == [
        ("shipping_limit_date", "timestamp_ntz"),
        ("price", "decimal(12,2)"),
        ("freight_value", "decimal(12,2)"),
    ]
    place = raw["raw_geolocation"].orderBy("geolocation_lat").first()
    assert place.geolocation_lat == Decimal("-23.5456213")


def test_blank_dates_and_numbers_become_null(spark, folder):
    raw = csv_files.load_all(spark, folder())
    order = raw["raw_orders"].where("order_id = 'o2'").first()
    assert order.order_approved_at is None and order.order_delivered_customer_date is None
    assert order.order_purchase_timestamp == datetime(2018, 2, 1, 10)
    product = raw["raw_products"].where("product_id = 'p2'").first()
    assert product.product_weight_g is None and product.product_category_name is None


def test_review_text_and_zero_dates(spark, folder):
    reviews = csv_files.load_all(spark, folder())["raw_order_reviews"]
    assert reviews.count() == 4
    first = reviews.where("review_id = 'r1' and review_score = 5").first()
    assert first.review_comment_title == 'He said "great"'
    assert first.review_comment_message == "two\nlines, one comma"
    assert reviews.where("review_id = 'r2'").first().review_creation_date is None
    assert reviews.where("review_id = 'r3'").first().review_answer_timestamp is None


def test_byte_order_mark_and_carriage_returns(spark, folder):
    rows = csv_files.load_all(spark, folder())["raw_product_category_translation"].collect()
    assert [tuple(r) for r in rows] == [("moveis", "furniture")]


def test_columns_are_found_by_name(spark, folder):
    swapped = "seller_state,extra,seller_id,seller_city,seller_zip_code_prefix\nSP,x,s1,rio,7\n"
    row = csv_files.load_all(spark, folder(sellers=swapped))["raw_sellers"].first()
    assert tuple(row) == ("s1", 7, "rio", "SP")


def test_missing_file_stops_the_load(spark, folder):
    with pytest.raises(csv_files.MissingFiles, match="raw_sellers"):
        csv_files.load_all(spark, folder(sellers=None))


def test_missing_column_stops_the_load(spark, folder):
    with pytest.raises(csv_files.MissingColumns, match="seller_city"):
        csv_files.load_all(spark, folder(sellers="seller_id,seller_state\ns1,SP\n"))


def test_zero_and_unreadable_dates_are_counted_on_text(spark, folder, found):
    bad = FILES["shop_orders_dataset.csv"].replace("2018-01-01 11:00:00", "yesterday")
    directory = folder(orders=bad)
    paths = csv_files.locate(spark, directory)
    reviews = csv_files.read_text(spark, "raw_order_reviews", paths["raw_order_reviews"])
    zero = found(csv_files.zero_moments(reviews, "raw_order_reviews"), "check_name", "failed_rows")
    assert zero == {
        "zero raw_order_reviews.review_creation_date": 1,
        "zero raw_order_reviews.review_answer_timestamp": 1,
    }
    hygiene = found(datetime_hygiene(reviews), "check_name", "failed_rows")
    assert hygiene == {
        "zero review creation date": 1,
        "zero review answer timestamp": 1,
        "missing review creation date": 0,
        "missing review answer timestamp": 1,
    }
    orders = csv_files.read_text(spark, "raw_orders", paths["raw_orders"])
    broken = found(csv_files.unreadable_moments(orders, "raw_orders"), "check_name", "failed_rows")
    assert broken.pop("unreadable raw_orders.order_approved_at") == 1
    assert set(broken.values()) == {0}
    raw = csv_files.load_all(spark, directory)
    assert raw["raw_orders"].where("order_id = 'o1'").first().order_approved_at is None
    gate = quality_gate(rule_failures(raw, {"raw_orders": orders}))
    assert found(gate, "rule", "outcome")["Dates parse successfully"] == "blocked"


def test_files_to_warehouse(spark, folder, tmp_path, found):
    root = str(tmp_path / "store")
    raw = stage_files(spark, folder(), root)
    warehouse = refresh_warehouse(spark, raw, root)
    counts = found(warehouse_row_counts(warehouse), "table_name", "row_count")
    # The second r1 is a repeated key, r2 has no creation date.
    assert counts == {
        "dim_date": 9,
        "dim_customer": 1,
        "dim_product": 2,
        "dim_seller": 1,
        "fact_order": 2,
        "fact_order_item": 1,
        "fact_review": 2,
    }
    again = refresh_warehouse(spark, raw, root)
    assert found(warehouse_row_counts(again), "table_name", "row_count") == counts
    assert again["fact_review"].where("review_id = 'r1'").first().review_score == 5
    january = read_table(spark, "fact_order", root).where("stored_month = '2018-01'")
    assert "PartitionFilters: [isnotnull(stored_month" in (
        january._jdf.queryExecution().executedPlan().toString()
    )
    assert [r.order_id for r in january.collect()] == ["o1"]
    late = metrics.filtered_orders(again, metrics.Filters(date_from=date(2018, 2, 1)))
    assert "stored_month#" in late._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters"
    )[1]
    assert [r.order_id for r in late.collect()] == ["o2"]
    cards = metrics.kpi_cards(again).first()
    assert (cards.orders, cards.customers, cards.total_revenue) == (2, 1, Decimal("72.19"))
    assert refresh_geography(spark, raw, root).first().latitude == pytest.approx(-23.5456212)


def test_error_rule_stops_staging(spark, folder, tmp_path):
    negative = FILES["shop_order_payments_dataset.csv"].replace("72.19", "-72.19")
    with pytest.raises(QualityGateError, match="Negative prices"):
        stage_files(spark, folder(order_payments=negative), str(tmp_path / "store"))


def test_stored_sample_equals_the_lazy_one(spark, tmp_path):
    raw = load_sample(spark, "/root/testdata/sf0.001")
    stored = refresh_warehouse(spark, raw, str(tmp_path), one_row_per_key=False)
    for name, lazy in lazy_warehouse(raw).items():
        columns = WAREHOUSE[name].columns
        assert lazy.columns == columns
        # Identifiers are stored as text, as the contract says.
        ours = lazy.select([lazy[f.name].cast(f.dataType) for f in WAREHOUSE[name].schema])
        theirs = stored[name].select(columns)
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
