"""Read CSV files whose quoted fields hold line breaks, many tasks to a file.

Whether a line break ends a record depends on all quotes before it, so Spark's own parser gives such
a file to one task. Here the file is read as lines, in pieces as Spark cuts them. Doubled quotes do not
change whether a field is open, so the parity of quotes tells it: each line knows the parity of its
piece before it, each piece counts its quotes and the records that would start in it either way, and
sums over the few pieces of a file say how each piece begins. Lines that are whole records, nearly
all, stay where they are; only the lines of the others are brought together by record number.

Quotes are expected where the format allows them: around a field, doubled inside. A file that ends
inside quotes, or has another header than the first one, stops the load. Empty lines are no records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE, PIECE, LINE, VALUE = "file", "piece", "line", "value"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place, whether their quotes are odd, and the parity before them in the piece."""
    quotes = F.length(VALUE) - F.length(F.replace(F.col(VALUE), F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(PIECE),
        F.monotonically_increasing_id().alias(LINE),
        VALUE,
        (quotes % 2).alias("odd"),
    )
    before = _in_piece().rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)


def _in_piece():
    return Window.partitionBy(FILE, PIECE).orderBy(LINE)


def _pieces(lines: DataFrame) -> DataFrame:
    """Per piece: the parity it begins with and the records of its file that start before it."""
    counts = lines.groupBy(FILE, PIECE).agg(
        F.sum("odd").alias("odd"),
        F.count_if(F.col("inside") == 0).alias("starts_0"),
        F.count_if(F.col("inside") == 1).alias("starts_1"),
    )
    whole = Window.partitionBy(FILE)
    before = whole.orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.withColumn("begins", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).withColumn(
        "unclosed", F.sum("odd").over(whole) % 2 == 1
    )
    own = F.when(F.col("begins") == 0, F.col("starts_0")).otherwise(F.col("starts_1"))
    first = F.coalesce(F.sum("own").over(before), F.lit(0))
    broken = F.raise_error(F.concat(FILE, F.lit(" ends inside quotes"))).cast("bigint")
    return begun.withColumn("own", own).select(
        FILE, PIECE, "begins", F.when(F.col("unclosed"), broken).otherwise(first).alias("first")
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, piece, line, record, value``: the records of all files behind a path, numbered per file
    from 1 (the header), each with the place of its first line."""
    lines = _lines(spark, path)
    placed = lines.join(_pieces(lines), [FILE, PIECE])
    starts = F.col("inside") == F.col("begins")
    so_far = _in_piece().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("record", F.col("first") + F.count_if(starts).over(so_far))
    whole = starts & (F.col("odd") == 0)
    alone = numbered.where(whole).select(FILE, PIECE, LINE, "record", VALUE)
    parts = F.array_sort(F.collect_list(F.struct(PIECE, LINE, VALUE)))
    joined = (
        numbered.where(~whole)
        .groupBy(FILE, "record")
        .agg(parts.alias("parts"))
        .select(
            FILE,
            F.col("parts")[0][PIECE].alias(PIECE),
            F.col("parts")[0][LINE].alias(LINE),
            "record",
            F.array_join(F.transform("parts", lambda x: x[VALUE]), "\n").alias(VALUE),
        )
    )
    ended = F.regexp_replace(VALUE, r"\r\z", "")
    return alone.unionByName(joined).withColumn(VALUE, ended).where(F.length(VALUE) > 0)


def _agrees(record: Column, header: Sequence[str], layout: Mapping[str, str]) -> Column:
    """True for a header that names the same columns; raises for another one."""
    names = ", ".join(f"c{i} string" for i in range(len(header) + 1))
    found = F.from_csv(F.regexp_replace(record, "^﻿", ""), names, dict(layout))
    same = F.lit(True)
    for i, name in enumerate([*header, None]):
        same = same & found[f"c{i}"].eqNullSafe(F.lit(name))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col(FILE))).cast("boolean")
    return F.when(same, True).otherwise(other)


def read_quoted(
    spark: SparkSession, path: str, header: Sequence[str], layout: Mapping[str, str], places: Sequence[str]
) -> DataFrame:
    """All columns of the header as text, and the file, piece and line of each record as ``places``."""
    layout = {k: v for k, v in layout.items() if k in ("sep", "quote", "escape")}
    types = ", ".join(f"`{name}` string" for name in header)
    body = records(spark, path).where(
        F.when(F.col("record") > 1, True).otherwise(~_agrees(F.col(VALUE), header, layout))
    )
    parsed = F.from_csv(VALUE, types, layout | {"multiLine": "true"}).alias("parsed")
    at = [F.col(c).alias(p) for c, p in zip((FILE, PIECE, LINE), places, strict=True)]
    return body.select(parsed, *at).select("parsed.*", *places)
