"""Quantiles, histograms and ranks against brute force on skewed data."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import distance_km, floored_days, started_days
from tallyhouse.functions.ordering import leading_bits
from tallyhouse.operators.distributions import (
    FIRST_BITS,
    STEPS,
    describe,
    exact_quantiles,
    frequencies,
    histogram,
)
from tallyhouse.operators.geography import geo_by_zip, seller_customer_distance
from tallyhouse.operators.ranking import customer_order_ranks
from tallyhouse.operators.reports import review_summary

QUANTILES = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p99": 0.99, "high": 1.0}


def test_leading_bits_keep_order(spark):
    random.seed(3)
    numbers = sorted(
        {random.randint(-(2**e), 2**e) for e in range(1, 62) for _ in range(20)} | {0, 4095, 4096}
    )
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").orderBy("n")
    coarse = [r[0] for r in df.select(leading_bits(F.col("n"))).collect()]
    assert coarse == sorted(coarse)
    assert all(c <= n for c, n in zip(coarse, numbers, strict=True))


@pytest.mark.parametrize("shape", ["wide", "copies", "negative", "single"])
def test_exact_quantiles(spark, shape):
    rng = np.random.default_rng(5)
    cents = {
        "wide": (rng.pareto(0.6, 2000) * 10_000).astype("int64") % 10**12,
        "copies": np.concatenate([np.full(900, 12_345), rng.integers(0, 10**7, 700)]),
        "negative": rng.integers(-(10**8), 10**6, 1500),
        "single": np.array([777]),
    }[shape]
    df = spark.createDataFrame(
        [("all" if i % 3 else "some", Decimal(int(c)) / 100) for i, c in enumerate(cents)],
        "kind string, amount decimal(14,2)",
    ).union(spark.createDataFrame([("all", None)], "kind string, amount decimal(14,2)"))
    whole = exact_quantiles(df, "amount", QUANTILES).first()
    for name, q in QUANTILES.items():
        assert whole[name] == pytest.approx(np.quantile(cents, q) / 100, rel=1e-12)
    for row in exact_quantiles(df, "amount", QUANTILES, keys=["kind"]).collect():
        part = [c for i, c in enumerate(cents) if ("all" if i % 3 else "some") == row.kind]
        for name, q in QUANTILES.items():
            assert row[name] == pytest.approx(np.quantile(part, q) / 100, rel=1e-12)


def test_quantiles_of_values_that_share_their_leading_bits(spark):
    """Two hundred thousand amounts from a range of 2^38 cents, most in a few coarse slices, some far off."""
    cents = (F.pmod(F.col("id") * 999_999_937, F.lit(2**38)) + 2**38) / F.lit(100)
    df = spark.range(200_000).select(cents.cast("decimal(14,2)").alias("amount"))
    far = spark.sql("select cast(v as decimal(20,2)) as amount from values (-9e16), (9e16), (0), (1) as t(v)")
    df = df.union(far)
    values = [int(r.amount * 100) for r in df.collect()]
    found = exact_quantiles(df, "amount", QUANTILES).first()
    for name, q in QUANTILES.items():
        assert found[name] == pytest.approx(np.quantile(np.array(values, "float64"), q) / 100, rel=1e-9)


@pytest.mark.parametrize("bits", range(64 - FIRST_BITS))
def test_steps_leave_single_values_and_stay_narrow(bits):
    left, widest = bits, 0
    for steps in range(STEPS, 0, -1):
        step = -(-left // steps)
        left, widest = left - step, max(widest, step)
    assert left == 0
    assert widest <= (12 if bits + FIRST_BITS <= 42 else 20)


def test_quantiles_are_planned_as_one_chain(spark):
    """The array of wanted slices is a subquery at each step, not one for each use of its fields."""
    df = spark.range(50).select(F.col("id").cast("decimal(12,2)").alias("v"))
    plan = describe(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") <= 2 * (STEPS + 1)


def test_describe_both_ways(spark):
    values = [1, 1, 2, 3, 5, 8, 13, 21, None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    expected = pd.Series(values).describe(percentiles=[0.5, 0.75, 0.9, 0.95, 0.99]).tolist()
    assert list(describe(df, "v").first()) == pytest.approx(expected)
    assert list(describe(df, "v", few_values=True).first()) == pytest.approx(expected)


def test_histogram_closes_the_last_bar(spark):
    values = [0, 0, 1, 5, 9, 10, 10, None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    counts, edges = np.histogram([v for v in values if v is not None], bins=5)
    rows = {r.bin: r for r in histogram(df, "v", bins=5).collect()}
    assert [rows[i + 1].n if i + 1 in rows else 0 for i in range(5)] == counts.tolist()
    assert all(r.bin_start == pytest.approx(edges[b - 1]) for b, r in rows.items())
    same = histogram(df.where("v = 10"), "v", bins=4).collect()
    assert [(r.n, r.bin_start, r.bin_end) for r in same] == [(2, 10.0, 10.25)]


def test_frequencies_leave_out_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    rows = {r.v: (r.share, r.n) for r in frequencies(df, "v", "n", share=True).collect()}
    assert rows == {"a": (pytest.approx(2 / 3), 2), "b": (pytest.approx(1 / 3), 1)}


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_ranks_of_a_very_large_person(spark, kind):
    random.seed(11)
    name = (lambda i: i) if kind == "bigint" else (lambda i: f"{i * 7919 % 10**6:06x}")
    people = [(name(i), "big" if i % 3 else f"p{i % 50}") for i in range(600)]
    start = datetime(2018, 1, 1)
    visits = [
        (name(random.randrange(0, 450)), start + timedelta(minutes=random.randrange(9_000)))
        for _ in range(900)
    ]
    customers = spark.createDataFrame(people, f"customer_id {kind}, customer_unique_id string")
    orders = spark.createDataFrame(
        visits, f"customer_id {kind}, order_purchase_timestamp timestamp_ntz"
    )
    got = customer_order_ranks(customers, orders).collect()
    left = pd.DataFrame(people, columns=["id", "person"])
    merged = left.merge(pd.DataFrame(visits, columns=["id", "at"]), on="id", how="left")
    merged = merged.sort_values(["person", "at", "id"], na_position="first")
    merged["rank"] = merged.groupby("person").cumcount() + 1
    sizes = merged.groupby("person")["id"].transform("size")
    merged["back"] = sizes + 1 - merged["rank"]
    expected = sorted(zip(merged.person, merged.id, merged["rank"], merged.back, strict=True))
    assert expected == sorted(
        (r.customer_unique_id, r.customer_id, r.first_order_rank, r.latest_order_rank)
        for r in got
    )


def test_zone_never_changes_a_duration(spark):
    df = spark.sql(
        "select timestamp_ntz'2018-03-11 00:00:00' a, timestamp_ntz'2018-03-11 12:00:00' b"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(started_days(F.col("a"), F.col("b")), floored_days(F.col("b"), F.col("a")))
        assert list(row.first()) == [Decimal("0.50"), -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_distance(spark):
    def km(*spots):
        return spark.range(1).select(distance_km(*[F.lit(s) for s in spots])).first()[0]

    assert km(0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * 6371)
    assert km(-23.55, -46.63, -22.91, -43.17) == pytest.approx(361, abs=2)
    assert km(1.0, 1.0, 1.0, 1.0) == 0
    assert km(1.0, 1.0, None, 1.0) is None


def test_places_and_distances(spark, staged):
    spots = [(1, lat, 10.0) for lat in (1.0, 2.0, 9.0)] + [(2, 5.0, 5.0), (2, 6.0, 7.0)]
    tables = staged(
        geolocation=[
            dict(geolocation_zip_code_prefix=z, geolocation_lat=a, geolocation_lng=b)
            for z, a, b in spots
        ],
        customers=[
            dict(customer_id="c1", customer_zip_code_prefix=1),
            dict(customer_id="c2", customer_zip_code_prefix=3),
        ],
        sellers=[dict(seller_id="s1", seller_zip_code_prefix=2)],
        orders=[dict(order_id="o1", customer_id="c1"), dict(order_id="o2", customer_id="c2")],
        order_items=[
            dict(order_id=o, order_item_id=1, product_id="p", seller_id=s)
            for o, s in (("o1", "s1"), ("o2", "s1"), ("o1", "lost"), ("gone", "s1"))
        ],
    )
    geo = geo_by_zip(tables["raw_geolocation"])
    places = {r.zip_code_prefix: (r.latitude, r.longitude) for r in geo.collect()}
    assert places == {1: (2.0, 10.0), 2: (5.5, 6.0)}
    rows = seller_customer_distance(
        tables["raw_order_items"],
        tables["raw_orders"],
        tables["raw_customers"],
        tables["raw_sellers"],
        geo,
    ).collect()
    known = [r for r in rows if r.distance_km is not None]
    assert len(rows) == 4 and len(known) == 1
    assert known[0].distance_km == pytest.approx(589.6, abs=1)


def test_reviews_of_one_hot_order_weigh_fully(staged):
    tables = staged(
        orders=[
            dict(order_id="hot", customer_id="c", order_purchase_timestamp="2018-01-01 00:00:00",
                 order_delivered_customer_date="2018-01-11 00:00:00",
                 order_estimated_delivery_date="2018-01-05 00:00:00"),
            dict(order_id="cold", customer_id="c", order_purchase_timestamp="2018-01-01 00:00:00",
                 order_delivered_customer_date="2018-01-02 00:00:00",
                 order_estimated_delivery_date="2018-01-05 00:00:00"),
        ],
        order_payments=[dict(order_id="hot", payment_value=100)],
        order_reviews=[
            dict(review_id=f"r{i}", order_id="hot" if i < 8 else "cold", review_score=5)
            for i in range(10)
        ],
    )
    row = review_summary(tables).first()
    assert tuple(row) == (5, 10, pytest.approx(8.2), pytest.approx(0.8), pytest.approx(100.0))
