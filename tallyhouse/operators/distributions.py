"""Exact quantiles, summaries, histograms and frequency tables of one column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import mean, ratio
from tallyhouse.functions.ordering import cleared_bits, leading_bits

# The quantiles of the summaries and the number of histogram bars.
SUMMARY_QUANTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
HISTOGRAM_BINS = 80

# Quantiles of a whole column are found by narrowing: six leading bits first, then a third of the bits
# still open in each of three steps. A step ranks at most 4,096 slices of one slice before for values up
# to 2^42 units (44 billion with two decimals), and 2^19 at the end of the 64-bit range.
FIRST_BITS, STEPS = 6, 3


def exact_quantiles(
    df: DataFrame,
    column: str,
    quantiles: Mapping[str, float],
    keys: Sequence[str] = (),
    scale: int = 2,
) -> DataFrame:
    """Quantiles with linear interpolation, overall or per ``keys``, at any number of values.

    Spark's own ``percentile`` gathers a group's distinct values in one task. Here they are counted
    where they are (grouped by value). Without ``keys``, slices that hold wanted ranks are then cut
    step by step into narrower ones (``_narrowed``). With them, values are counted by coarse value: a
    bounded number of slices per group shows in which slice each wanted rank lies, and only those
    slices are ranked value by value.
    ``column`` holds integers or decimals with at most ``scale`` decimals, up to 9.2e18 counted in
    units of the last one (with two decimals, amounts up to 92 quadrillion); larger ones raise.
    NULLs, in the column or in a key, are left out.
    """
    keys = list(keys)
    units = (F.col(column) * 10**scale).cast("bigint")
    counted = (
        df.dropna(subset=[column, *keys])
        .groupBy(*keys, units.alias("units"))
        .agg(F.count("*").alias("n"))
    )
    position = {name: (F.col("total") - 1) * F.lit(q) for name, q in quantiles.items()}
    ranks = [rank for p in position.values() for rank in (F.floor(p), F.ceil(p))]
    values = _ranked(counted, keys, ranks) if keys else _narrowed(counted, ranks)

    def value_at(rank):
        here = _holds(rank, F.col("from_rank"), F.col("to_rank"))
        return F.max(F.when(here, F.col("units")))

    ends = values.groupBy(*keys, "total").agg(
        *[value_at(F.floor(p)).alias(f"{name}_low") for name, p in position.items()],
        *[value_at(F.ceil(p)).alias(f"{name}_high") for name, p in position.items()],
    )

    def interpolated(name):
        low, high = F.col(f"{name}_low").cast("double"), F.col(f"{name}_high").cast("double")
        part = position[name] - F.floor(position[name])
        return ((low + (high - low) * part) / 10**scale).alias(name)

    return ends.select(*keys, *[interpolated(name) for name in quantiles])


def _holds(rank: Column, start: Column, end: Column) -> Column:
    return (rank >= start) & (rank < end)


def _any_in(ranks: Sequence[Column], start: Column, end: Column) -> Column:
    found = F.lit(False)
    for rank in ranks:
        found = found | _holds(rank, start, end)
    return found


def _up_to_here(*partition: str, order: str):
    return (
        Window.partitionBy(*partition)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _ranked(counted: DataFrame, keys: Sequence[str], ranks: Sequence[Column]) -> DataFrame:
    """``units, total, from_rank, to_rank`` of the values near the wanted ranks, per ``keys``."""
    # Never NULL, and said so: then both uses below have the same plan and share its result.
    counted = counted.withColumn("slice", F.coalesce(leading_bits(F.col("units")), F.lit(0)))
    slices = (
        counted.groupBy(*keys, "slice")
        .agg(F.sum("n").alias("size"))
        .withColumn("end", F.sum("size").over(_up_to_here(*keys, order="slice")))
        .withColumn("total", F.sum("size").over(Window.partitionBy(*keys)))
        .withColumn("start", F.col("end") - F.col("size"))
    )
    wanted_here = _any_in(ranks, F.col("start"), F.col("end"))
    wanted = slices.where(wanted_here).select(*keys, "slice", "start", "total")
    upto = F.col("start") + F.sum("n").over(_up_to_here(*keys, "slice", order="units"))
    return counted.join(wanted, [*keys, "slice"]).select(
        *keys, "units", "total", (upto - F.col("n")).alias("from_rank"), upto.alias("to_rank")
    )


def _narrowed(counted: DataFrame, ranks: Sequence[Column]) -> DataFrame:
    """``units, total, from_rank, to_rank`` of the values at the wanted ranks, over all rows.

    A slice is a range of values: their leading bits, the bits that follow (``prefix``) and how many are
    still open (``shift``). Those that hold a wanted rank, two for a quantile at most, come as one small array
    (a scalar subquery) to the counted values, which stay where they are: each step adds up the values of
    these slices by the next bits, in the map task first, and keeps the narrower slices that hold
    the ranks. After the last step a slice is one value.
    """
    units = F.col("units")
    coarse = leading_bits(units, FIRST_BITS)
    counted = counted.select(
        "n",
        coarse.alias("coarse"),
        (units - coarse).alias("rest"),
        cleared_bits(units, FIRST_BITS).alias("bits"),
    )
    first = counted.groupBy("coarse").agg(F.sum("n").alias("size"), F.max("bits").alias("shift"))
    end = F.sum("size").over(_up_to_here(order="coarse"))
    slices = first.select(
        "coarse",
        F.lit(0).cast("bigint").alias("prefix"),
        "shift",
        (end - F.col("size")).alias("start"),
        end.alias("end"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )

    def wanted(slices: DataFrame) -> DataFrame:
        one = F.struct("coarse", "prefix", "shift", "start", "end", "total")
        here = _any_in(ranks, F.col("start"), F.col("end"))
        return slices.where(here).agg(F.collect_list(one).alias("slices"))

    def rest_above(shift: Column) -> Column:
        return F.call_function("shiftright", F.col("rest"), shift)

    for left in range(STEPS, 0, -1):
        found = F.filter(
            "slices",
            lambda s: (s["coarse"] == F.col("coarse")) & (s["prefix"] == rest_above(s["shift"])),
        )
        # Values outside add up under NULL, which holds no rank; a filter would plan the array twice.
        inside = counted.withColumn("slices", wanted(slices).scalar()).select(
            "n", "rest", F.get(found, F.lit(0)).alias("slice")
        )
        shift = F.col("slice.shift")
        narrower = (shift - F.ceil(shift / left)).cast("int")
        sizes = (
            inside.groupBy(
                F.col("slice.coarse").alias("coarse"),
                narrower.alias("shift"),
                rest_above(narrower).alias("prefix"),
                F.col("slice.start").alias("before"),
                F.col("slice.total").alias("total"),
            )
            .agg(F.sum("n").alias("size"))
        )
        end = F.col("before") + F.sum("size").over(_up_to_here("before", order="prefix"))
        slices = sizes.select(
            "coarse", "prefix", "shift", (end - F.col("size")).alias("start"), end.alias("end"), "total"
        )
    return wanted(slices).select(F.inline("slices")).select(
        (F.col("coarse") + F.col("prefix")).alias("units"),
        "total",
        F.col("start").alias("from_rank"),
        F.col("end").alias("to_rank"),
    )


def describe(df: DataFrame, column: str, few_values: bool = False) -> DataFrame:
    """One row: count, mean, sample standard deviation, minimum, five quantiles, maximum.

    ``few_values`` says that the column has a small range of integers (such as days), so that the
    built-in quantile is the shorter way to the same numbers.
    """
    value = F.col(column)
    moments = [
        F.count(value).alias("count"),
        mean(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"),
    ]
    largest = F.max(value).cast("double").alias("max")
    if few_values:
        at = F.array(*[F.lit(q) for q in SUMMARY_QUANTILES.values()])
        one = df.agg(*moments, F.percentile(value, at).alias("found"), largest)
        inner = [F.col("found")[i].alias(name) for i, name in enumerate(SUMMARY_QUANTILES)]
        return one.select("count", "mean", "std", "min", *inner, "max")
    found = exact_quantiles(df, column, SUMMARY_QUANTILES).select(
        F.struct(*SUMMARY_QUANTILES).alias("found")
    )
    # Taken apart by a generator: fields of a subquery would each plan it anew.
    one = df.agg(*moments, largest).select("*", F.inline(F.array(found.scalar())))
    return one.select("count", "mean", "std", "min", *SUMMARY_QUANTILES, "max")


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``bin, bin_start, bin_end, n`` for the non-empty ones of ``bins`` equal-width bars.

    The bars span minimum to maximum; the last one includes the maximum. When all values are equal
    the span is one unit around them.
    """
    value = F.col(column).cast("double")
    filled = df.where(F.col(column).isNotNull()).select(value.alias("value"))
    margin = F.when(F.min("value") == F.max("value"), 0.5).otherwise(0.0)
    span = filled.agg(
        F.struct(
            (F.min("value") - margin).alias("low"), (F.max("value") + margin).alias("high")
        ).alias("span")
    )
    low, high = F.col("span.low"), F.col("span.high")
    number = F.least(F.floor((F.col("value") - low) / (high - low) * bins) + 1, F.lit(bins))
    width = (high - low) / bins
    return (
        filled.select("value", span.scalar().alias("span"))
        .groupBy(number.alias("bin"), low.alias("low"), width.alias("width"))
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (F.col("low") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_end"),
            "n",
        )
    )


def frequencies(df: DataFrame, column: str, count_name: str, share: bool = False) -> DataFrame:
    """Rows per non-NULL value of a column and, on request, their share of all such rows.

    The total is one number from a scalar subquery, so no task holds all values.
    """
    filled = df.dropna(subset=[column])
    table = filled.groupBy(column).agg(F.count("*").alias(count_name))
    if not share:
        return table
    of_all = ratio(F.col(count_name), table.agg(F.sum(count_name)).scalar())
    return table.select(column, of_all.alias("share"), count_name)
