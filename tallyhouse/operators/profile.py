"""First look at a set of tables: sizes, duplicates, gaps, column types, leading rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import ratio
from tallyhouse.operators.checks import together

Tables = Mapping[str, DataFrame]


def dataset_profile(tables: Tables) -> DataFrame:
    """Rows, columns, surplus copies of rows, and empty cells of each table, largest first.

    Copies are found by two 64-bit hashes of the row, so 24 bytes a row are shuffled instead of the
    row; only rows whose hashes repeat are then compared in full, which keeps the count exact.
    """
    parts = []
    for name, df in tables.items():
        gaps = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
        parts.append(
            df.agg(
                F.count("*").alias("rows"),
                F.lit(len(df.columns)).alias("columns"),
                _total(gaps).alias("missing_cells"),
            ).select(
                F.lit(name).alias("dataset"),
                "rows",
                "columns",
                _surplus_rows(df).scalar().alias("duplicate_rows"),
                "missing_cells",
                ratio(F.col("missing_cells"), F.col("rows") * F.col("columns")).alias(
                    "missing_pct"
                ),
            )
        )
    return together(parts).orderBy(F.desc("rows"), "dataset")


def missing_summary(tables: Tables) -> DataFrame:
    """Columns with empty cells: how many, and as a share of the table's rows; most first."""
    gaps = together([_gaps_per_column(name, df) for name, df in tables.items()])
    return (
        gaps.where(F.col("missing_count") > 0)
        .select(
            "dataset",
            "column",
            "missing_count",
            ratio(F.col("missing_count"), F.col("rows")).alias("missing_pct"),
        )
        .orderBy(F.desc("missing_count"), "dataset", "column")
    )


def dtype_summary(tables: Tables) -> DataFrame:
    """Type and number of empty cells of every column."""
    return together([_gaps_per_column(name, df) for name, df in tables.items()]).select(
        "dataset", "column", "dtype", F.col("missing_count").alias("missing")
    )


def preview(df: DataFrame, key: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(*key).limit(rows)


def _gaps_per_column(name: str, df: DataFrame) -> DataFrame:
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"gaps_{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(dtype).alias("dtype"),
            F.col(f"gaps_{i}").alias("missing_count"),
        )
        for i, (column, dtype) in enumerate(df.dtypes)
    ]
    return counts.select(F.lit(name).alias("dataset"), "rows", F.inline(F.array(*entries)))


def _surplus_rows(df: DataFrame) -> DataFrame:
    """One number: rows beyond the first of each group of equal rows."""
    marks = [F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *reversed(df.columns))]
    marked = df.withColumns({"__one": marks[0], "__two": marks[1]})
    repeated = (
        marked.groupBy("__one", "__two").agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    )
    suspects = marked.join(repeated, ["__one", "__two"], "left_semi")
    copies = suspects.groupBy("__one", "__two", *df.columns).agg(F.count("*").alias("__copies"))
    return copies.agg(_total(F.col("__copies") - 1))


def _total(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))
