"""Read the nine raw CSV files.

Two layers: ``read_text`` keeps every column as the text in the file, so that checks can still
see blank and malformed values; ``to_staging`` turns that into the typed staging table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import is_blank
from tallyhouse.schemas import STAGING
from tallyhouse.sources.quoted_files import read_quoted

# The file behind each staging table. The part before the table's own words differs
# between data providers, so it is left open.
FILE_PATTERNS: dict[str, str] = {
    "raw_customers": "*customers_dataset.csv",
    "raw_geolocation": "*geolocation_dataset.csv",
    "raw_orders": "*orders_dataset.csv",
    "raw_order_items": "*order_items_dataset.csv",
    "raw_order_payments": "*order_payments_dataset.csv",
    "raw_order_reviews": "*order_reviews_dataset.csv",
    "raw_products": "*products_dataset.csv",
    "raw_sellers": "*sellers_dataset.csv",
    "raw_product_category_translation": "*product_category_name_translation.csv",
}

# Where a row stood when it was delivered; kept beside the contract's columns.
PLACE = ("delivered_file", "delivered_part", "delivered_row")
PLACE_SCHEMA = "delivered_file string, delivered_part bigint, delivered_row bigint"

# Fixed value: how an unset date-time is written in some exports.
ZERO_MOMENT = "0000-00-00 00:00:00"

# Only free text can hold a line break, so only this table needs its lines put together again.
MULTI_LINE_TABLES = frozenset({"raw_order_reviews"})


class MissingFiles(FileNotFoundError):
    """A raw file that the load needs is not there."""


class AmbiguousFiles(ValueError):
    """A pattern matches more than one file."""


class MissingColumns(ValueError):
    """A raw file lacks columns of its contract."""


def file_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob matches anything, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    file_system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = file_system.globStatus(path)
    return found is not None and len(found) > 0


def locate(
    spark: SparkSession, directory: str, patterns: dict[str, str] | None = None
) -> dict[str, str]:
    """Path of each table's file; raises ``MissingFiles`` naming every file that is absent.

    A pattern that matches files of more than one name would add strangers together, so it raises
    ``AmbiguousFiles``; name the file in ``patterns``, or a folder per table that holds its parts.
    """
    chosen = FILE_PATTERNS | (patterns or {})
    paths = {table: f"{directory.rstrip('/')}/{pattern}" for table, pattern in chosen.items()}
    absent = [table for table, path in paths.items() if not file_exists(spark, path)]
    if absent:
        raise MissingFiles(f"no file in {directory} for: {', '.join(absent)}")
    many = {table: file_names(spark, path) for table, path in paths.items()}
    if found := {table: names for table, names in many.items() if len(names) > 1}:
        raise AmbiguousFiles(f"several files in {directory} for: {found}")
    return paths


def file_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files or folders that a path or glob matches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    file_system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(s.getPath().getName()) for s in file_system.globStatus(path) or [])


def read_text(spark: SparkSession, table: str, path: str) -> DataFrame:
    """All contract columns of one file as text, picked by header name, not by position.

    Extra columns are left out. ``enforceSchema=False`` makes Spark compare the header of every
    file behind ``path`` with the first one, so a file with another layout stops the load. Files whose
    fields may hold line breaks are read by ``read_quoted``, which adds the places of rows.
    """
    layout = dict(
        header=True,
        sep=",",
        quote='"',
        escape='"',
        encoding="UTF-8",
        multiLine=table in MULTI_LINE_TABLES,
    )
    header = spark.read.options(**layout).csv(path).columns
    contract = STAGING[table]
    absent = [c for c in contract.columns if c not in header]
    if absent:
        raise MissingColumns(f"{table} lacks: {', '.join(absent)}")
    if table in MULTI_LINE_TABLES:
        return read_quoted(spark, path, header, layout, PLACE).select(*contract.columns, *PLACE)
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return (
        spark.read.schema(text)
        .options(enforceSchema=False, **layout)
        .csv(path)
        .select(*contract.columns)
    )


def to_staging(text: DataFrame, table: str) -> DataFrame:
    """Typed staging table; a blank, zero or unreadable value becomes NULL.

    Free-text and identifier columns are taken as they are.
    """
    return text.select(
        *[
            F.col(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.trim(field.name).try_cast(field.dataType).alias(field.name)
            for field in STAGING[table].schema
        ]
    )


def load_all(
    spark: SparkSession, directory: str, patterns: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """The nine typed staging tables by name. Missing files or columns raise before any load."""
    paths = locate(spark, directory, patterns)
    return {table: to_staging(read_text(spark, table, p), table) for table, p in paths.items()}


def unreadable_moments(text: DataFrame, table: str) -> DataFrame:
    """``check_name, failed_rows``: date-times that are filled in but cannot be read.

    The zero date-time is not counted here; ``zero_moments`` counts it.
    """
    return _count_per_moment(
        text,
        table,
        "unreadable",
        lambda value: ~is_blank(value)
        & (value != ZERO_MOMENT)
        & value.try_cast("timestamp_ntz").isNull(),
    )


def lost_values(table: str, prefix: str = "") -> dict[str, Column]:
    """Per check name, whether a filled-in value of a typed column is lost by ``to_staging``."""
    out = {}
    for field in STAGING[table].schema:
        if not isinstance(field.dataType, T.StringType):
            value = F.trim(F.col(prefix + field.name))
            read = value.try_cast(field.dataType)
            out[f"unreadable {table}.{field.name}"] = ~is_blank(value) & (value != ZERO_MOMENT) & read.isNull()
    return out


def unreadable_values(text: DataFrame, table: str) -> DataFrame:
    """``check_name, failed_rows``: filled-in values of typed columns that ``to_staging`` loses."""
    lost = lost_values(table)
    if not lost:
        return text.sparkSession.createDataFrame([], "check_name string, failed_rows long")
    counts = text.agg(*[F.count_if(failing).alias(n) for n, failing in lost.items()])
    return counts.unpivot([], [F.col(f"`{n}`") for n in lost], "check_name", "failed_rows")


TEXT = "text_"


def with_places(text: DataFrame) -> DataFrame:
    """Rows read from files with where they stood: the file, the part of it that one task reads, and a
    number that ascends within the part. By these three, rows are in the order of delivery, files in
    the order of their names. Rows that have places already keep them."""
    if set(PLACE) <= set(text.columns):
        return text
    return text.select(
        "*",
        F.col("_metadata.file_path").alias(PLACE[0]),
        F.col("_metadata.file_block_start").alias(PLACE[1]),
        F.monotonically_increasing_id().alias(PLACE[2]),
    )


def with_losses(text: DataFrame, table: str) -> tuple[DataFrame, dict[str, Column]]:
    """The typed staging table beside its text columns, and aggregates over both: values that cannot
    be read and zero date-times, by check name. So they are counted where rows pass anyway."""
    fields = STAGING[table].schema
    as_text = text.select("*", *[F.col(f.name).alias(TEXT + f.name) for f in fields])
    typed = {
        f.name: F.trim(f.name).try_cast(f.dataType)
        for f in fields
        if not isinstance(f.dataType, T.StringType)
    }
    counts = {name: F.count_if(failing) for name, failing in lost_values(table, TEXT).items()}
    for c in STAGING[table].moments:
        zero = F.trim(F.col(TEXT + c)) == ZERO_MOMENT
        counts[f"zero {table}.{c}"] = F.count_if(zero)
    return as_text.withColumns(typed), counts


def zero_moments(text: DataFrame, table: str) -> DataFrame:
    """``check_name, failed_rows``: date-times written as the zero date-time."""
    return _count_per_moment(text, table, "zero", lambda value: value == ZERO_MOMENT)


def _count_per_moment(text: DataFrame, table: str, word: str, fails) -> DataFrame:
    names = {c: f"{word} {table}.{c}" for c in STAGING[table].moments}
    counts = text.agg(*[F.count_if(fails(F.trim(c))).alias(n) for c, n in names.items()])
    columns = [F.col(f"`{n}`") for n in names.values()]
    return counts.unpivot([], columns, "check_name", "failed_rows")
