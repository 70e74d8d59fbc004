"""Sets of tables change all at once, and loads report what they read, lost and wrote."""

from __future__ import annotations

import json
import random

import pytest

from tallyhouse.operators.gate import QualityGateError
from tallyhouse.plans import warehouse as plans
from tallyhouse.plans.warehouse import (
    STAGING_REPORT,
    WAREHOUSE_REPORT,
    refresh_warehouse,
    stage_files,
    validate,
    warehouse_row_counts,
)
from tallyhouse.sources import csv_files
from tallyhouse.sources.snapshots import COMMITS, FOLDERS, ConcurrentRefresh, SnapshotStore
from tallyhouse.sources.warehouse_store import read_delivered, read_report, read_table
from tests.test_csv_files import FILES, folder  # noqa: F401
from tests.test_load_rules import PEOPLE, order


def people(days):
    return dict(customers=PEOPLE, orders=[order(f"o{i}", "a1", day) for i, day in enumerate(days)])


def test_a_refresh_that_dies_between_tables_changes_nothing(spark, staged, tmp_path, monkeypatch):
    root = str(tmp_path)
    refresh_warehouse(spark, staged(**people(["2018-01-01"])), root)
    reader = read_table(spark, "fact_order", root)
    real = plans.put_table

    def dying(draft, name, *rest):
        if name == "fact_order_item":
            raise RuntimeError("lost")
        return real(draft, name, *rest)

    larger = staged(**people(["2018-01-01", "2018-02-01"]))
    monkeypatch.setattr(plans, "put_table", dying)
    with pytest.raises(RuntimeError, match="lost"):
        refresh_warehouse(spark, larger, root)
    # fact_order and all dimensions of the failed refresh are written; none of them is read.
    assert len(list((tmp_path / FOLDERS).glob("*/fact_order"))) == 2
    assert read_table(spark, "fact_order", root).count() == 1
    assert read_table(spark, "dim_customer", root).where("total_orders = 2").count() == 0
    monkeypatch.setattr(plans, "put_table", real)
    stored = refresh_warehouse(spark, larger, root)
    assert stored["fact_order"].count() == read_table(spark, "fact_order", root).count() == 2
    assert reader.count() == 1  # what was read before the refresh is still there


def test_two_refreshes_of_one_set_do_not_mix(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    first, second = store.begin(), store.begin()
    first.write("a", spark.range(1))
    second.write("a", spark.range(2))
    first.commit()
    with pytest.raises(ConcurrentRefresh):
        second.commit()
    assert spark.read.parquet(store.path("a")).count() == 1


def test_tables_that_are_not_written_stay(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.current() == {} and store.path("a") is None
    for tables in ({"a": 1, "b": 2}, {"b": 3}):
        draft = store.begin()
        for name, n in tables.items():
            draft.write(name, spark.range(n))
        draft.commit()
    assert [spark.read.parquet(store.path(x)).count() for x in "ab"] == [1, 3]


def test_a_commit_that_was_cut_off_is_none(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    draft = store.begin()
    draft.write("a", spark.range(1))
    draft.commit()
    good = (tmp_path / COMMITS / f"{1:012d}.json").read_text()
    (tmp_path / COMMITS / f"{2:012d}.json").write_text(good[:10])
    (tmp_path / COMMITS / f"{3:012d}.json").write_text("")
    assert store.current() == json.loads(good)["tables"]
    draft = store.begin()
    draft.write("a", spark.range(5))
    draft.commit()
    assert spark.read.parquet(store.path("a")).count() == 5


def test_old_folders_expire_and_used_ones_stay(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    for n in (1, 2, 3):
        draft = store.begin()
        draft.write("a", spark.range(n))
        if n == 1:
            draft.write("kept", spark.range(7))
        draft.commit()
    abandoned = store.begin()
    abandoned.write("a", spark.range(9))
    assert store.expire(keep=1) == []  # all were written to a moment ago
    gone = store.expire(keep=1, idle_hours=-1)
    assert len(gone) == 2 and abandoned.folder.split("/")[1] in gone
    assert spark.read.parquet(store.path("a")).count() == 3
    assert spark.read.parquet(store.path("kept")).count() == 7


def test_keys_are_made_unique_once_and_only_where_needed(spark, staged, tmp_path, monkeypatch):
    made = []
    real = plans.dedupe
    monkeypatch.setattr(plans, "dedupe", lambda df, table: (made.append(table), real(df, table))[1])
    raw = staged(customers=PEOPLE, orders=[order("o1", "a1", "2018-01-01")] * 2)
    stored = refresh_warehouse(spark, raw, str(tmp_path))
    assert made == ["raw_orders"]
    assert stored["fact_order"].count() == 1
    # What the tables are built from is stored: their plans hold no step that looks for copies.
    draft = SnapshotStore(spark, str(tmp_path)).begin()
    once = plans.keyed_once(raw, draft)
    for name in ("dim_date", "dim_customer", "fact_order"):
        plan = plans.lazy_warehouse(once)[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan
    assert "keyed_raw_orders" not in draft.tables
    refresh_warehouse(spark, staged(**people(["2018-01-01"])), str(tmp_path))
    assert made == ["raw_orders"] * 2  # one for the draft above, none for keys without copies


def test_a_load_reports_rows_losses_and_checks(spark, folder, tmp_path, found):  # noqa: F811
    place, root = folder(), str(tmp_path / "store")
    raw = stage_files(spark, place, root)
    report = found(read_report(spark, STAGING_REPORT, root), "check_name", "failed_rows")
    paths = csv_files.locate(spark, place)
    texts = {t: csv_files.read_text(spark, t, p) for t, p in paths.items()}
    # The same figures as separate scans of tables and files give.
    for check, failed in found(validate(raw, texts), "check_name", "failed_rows").items():
        assert report[check] == failed, check
    for table, df in raw.items():
        assert report[f"{table} rows written"] == df.count()
    assert report["zero raw_order_reviews.review_creation_date"] == 1
    stored = refresh_warehouse(spark, raw, root)
    rows = found(read_report(spark, WAREHOUSE_REPORT, root), "table_name", "row_count")
    assert rows == found(warehouse_row_counts(stored), "table_name", "row_count")


def test_a_blocked_load_leaves_the_tables_before(spark, folder, tmp_path):  # noqa: F811
    root = str(tmp_path / "store")
    stage_files(spark, folder(), root)
    before = SnapshotStore(spark, root).current()
    negative = FILES["shop_order_payments_dataset.csv"].replace("72.19", "-72.19")
    with pytest.raises(QualityGateError):
        stage_files(spark, folder(order_payments=negative), root)
    assert SnapshotStore(spark, root).current() == before
    assert read_table(spark, "raw_order_payments", root).where("payment_value < 0").isEmpty()


def test_the_first_row_delivered_stays(spark, folder, tmp_path, found):  # noqa: F811
    """Copies of a key differ: the larger one comes first, in one file and over two."""
    people = FILES["shop_customers_dataset.csv"].rstrip("\n").split("\n")
    head, row = people[0], people[1].split(",")
    at = head.replace('"', "").split(",").index("customer_city")
    row[1] = "u9"
    named = lambda city: ",".join([*row[:at], city, *row[at + 1 :]])
    place = folder(customers="\n".join([head, named("zz first"), named("aa second"), *people[2:]]) + "\n")
    root = str(tmp_path / "store")
    raw = stage_files(spark, place, root)
    assert not set(csv_files.PLACE) & set(raw["raw_customers"].columns)
    key = row[0].strip('"')
    delivered = read_delivered(spark, root)
    kept = plans.dedupe(delivered["raw_customers"], "raw_customers").where(f"customer_id = '{key}'")
    assert [r.customer_city for r in kept.collect()] == ["zz first"]
    assert kept.columns == raw["raw_customers"].columns
    stored = refresh_warehouse(spark, delivered, root)
    assert "zz first" in [r.customer_city for r in stored["dim_customer"].collect()]
    by_value = refresh_warehouse(spark, raw, root)
    assert "aa second" in [r.customer_city for r in by_value["dim_customer"].collect()]


def test_places_ascend_in_the_order_of_lines(spark, tmp_path):
    """Also where a file is read in several parts."""
    names = [f"n{i:05}" for i in range(4000)]
    random.Random(2).shuffle(names)
    files = tmp_path / "sellers"
    files.mkdir()
    head = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    for number, some in enumerate((names[:3000], names[3000:])):
        (files / f"part-{number}.csv").write_text(head + "".join(f"{x},1,c,s\n" for x in some))
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "8k")
    try:
        rows = csv_files.with_places(csv_files.read_text(spark, "raw_sellers", str(files)))
        assert rows.rdd.getNumPartitions() > 3
        found = rows.orderBy(*csv_files.PLACE).select("seller_id").collect()
    finally:
        spark.conf.set(size, before)
    assert [r.seller_id for r in found] == names
