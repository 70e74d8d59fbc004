"""Tables dealt by block: rows added in turn, read together and co-grouped without a shuffle."""

from __future__ import annotations

import pytest

from tallyhouse.llm.shared import BlockTable

SCHEMA = "block long, x long"


def rows(spark, first, n=20):
    return spark.createDataFrame([(i % 5, first + i) for i in range(n)], SCHEMA)


def test_added_rows_are_read_together_after_the_entry_is_gone(spark):
    with BlockTable(spark, 4, "kept") as table:
        one = table.add(rows(spark, 0))
        assert one.count() == 20
        both = table.add(rows(spark, 100))
        name = table.entry
    assert not spark.catalog.tableExists(name)
    assert sorted(r.x for r in both.collect()) == [*range(20), *range(100, 120)]


def test_co_groups_do_not_shuffle(spark):
    with BlockTable(spark, 4, "left") as left, BlockTable(spark, 4, "right") as right:
        one = left.add(rows(spark, 0))
        right.add(rows(spark, 0))
        two = right.add(rows(spark, 100)).where("block >= 0").select("x", "block")
        met = one.groupBy("block").cogroup(two.groupBy("block")).applyInArrow(lambda a, b: a, SCHEMA)
        plan = met._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert sorted(r.x for r in met.collect()) == [*range(20)]


def test_the_entry_goes_when_a_step_fails(spark):
    with pytest.raises(ValueError), BlockTable(spark, 4, "kept") as table:
        table.add(rows(spark, 0))
        raise ValueError
    assert not spark.catalog.tableExists(table.entry)


def test_an_empty_table(spark):
    with BlockTable(spark, 0, "kept") as table:
        assert table.parts == 1
        assert table.add(rows(spark, 0, 0)).count() == 0
