"""Loads that go on: rows that break a rule are kept apart with their reasons, the rest is stored.

Every row carries an array of reasons, one for each condition it breaks: a rule of the quality gate
and what is wrong. Rules that a row breaks by itself and values that cannot be read are judged while
the files are parsed. References are judged parents first and against the rows that stay, so that
what is stored refers only to what is stored. Rows and reasons are counted while they are written.

Only keys are shuffled to find broken references and copies, those of child and parent in one
aggregate: the keys that fail are stored, and rows meet that table, which Spark broadcasts if it is
small. As a plan (``judge``) nothing is stored: rows are shuffled to the keys that fail, but not sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import checks, gate
from tallyhouse.plans.warehouse import (
    REJECTED,
    REJECTED_REPORT,
    STAGING_REPORT,
    counted,
    forget_rejected,
    validate,
)
from tallyhouse.schemas import STAGING
from tallyhouse.sources.csv_files import (
    PLACE,
    PLACE_SCHEMA,
    TEXT,
    locate,
    lost_values,
    read_text,
    with_losses,
    with_places,
)
from tallyhouse.sources.snapshots import Draft, SnapshotStore
from tallyhouse.sources.warehouse_store import lookup_options, put_report, put_table

REASONS, DELIVERED = "reasons", "delivered"
REASON = "struct<rule: string, detail: string>"
UNIQUE_ORDERS = "Order IDs are unique in orders"
NOT_DELIVERED, NOT_KEPT = "not delivered", "rejected"
GRAVEST_FIRST = (gate.ERROR, gate.WARNING, gate.INFO)


def rules_from(level: str, severities: Mapping[str, str] = gate.SEVERITIES) -> list[str]:
    """Rules of severity ``level`` or a graver one."""
    grave = GRAVEST_FIRST[: GRAVEST_FIRST.index(level) + 1]
    return [rule for rule, severity in severities.items() if severity in grave]


def _reason(rule: str, detail: Column | str, broken: Column) -> Column:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return F.when(broken, F.struct(F.lit(rule).alias("rule"), detail.alias("detail")))


def row_reasons(table: str, text: bool = True) -> Column:
    """What a row breaks by itself, from the typed columns and, with ``text``, those of the file beside them."""
    found = []
    for rule, conditions in gate.row_rules().get(table, {}).items():
        found += [_reason(rule, f"condition {i}", c) for i, c in enumerate(conditions, 1)]
    moments = {f"unreadable {table}.{c}" for c in STAGING[table].moments}
    for check, broken in lost_values(table, TEXT).items() if text else ():
        rule = "Dates parse successfully" if check in moments else gate.NUMBERS_READ
        found.append(_reason(rule, check, broken))
    return F.array_compact(F.array(*found)).cast(f"array<{REASON}>")


def _grave(rules: list[str]) -> Column:
    return F.exists(REASONS, lambda reason: reason["rule"].isin(*rules))


def _told(detail: str) -> Column:
    return F.exists(REASONS, lambda reason: reason["detail"] == detail)


def _parsed(text: DataFrame, table: str) -> DataFrame:
    typed, _ = with_losses(with_places(text), table)
    columns = STAGING[table].columns
    delivered = F.struct(*[F.col(TEXT + c).alias(c) for c in columns])
    return typed.select(
        *columns, *PLACE, delivered.alias(DELIVERED), row_reasons(table).alias(REASONS)
    )


# Keeps a table that judging reads more than once, or takes it as it is.
Keep = Callable[[str, DataFrame], DataFrame]


def _stepping_stones(draft: Draft) -> Keep:
    def keep(name: str, df: DataFrame) -> DataFrame:
        path = draft.write(name, df, listed=False)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return keep


def _judge(
    df: DataFrame, table: str, judged: Mapping[str, DataFrame], rules: list[str], keep: Keep
) -> DataFrame:
    """``df``, which has the reasons of its rows alone, held against its parents and its own copies."""
    references = [
        (rule, parent, key)
        for check, (child, parent, key) in checks.REFERENCES.items()
        if child == table and (rule := gate.RULE_OF_REFERENCE[check]) in rules
    ]
    unique = table == "raw_orders" and UNIQUE_ORDERS in rules and set(PLACE) <= set(df.columns)
    if references or unique:
        df = keep(f"parsed_{table}", df)
    for rule, parent, key in references:
        df = _judge_reference(keep, table, df, judged[parent], key, rule)
    if unique:
        df = _judge_copies(keep, table, df, UNIQUE_ORDERS, rules)
    return df.withColumn(REJECTED, _grave(rules))


def judge(
    raw: Mapping[str, DataFrame],
    reject: str = gate.ERROR,
    severities: Mapping[str, str] = gate.SEVERITIES,
) -> dict[str, DataFrame]:
    """Typed staging tables with ``reasons`` and ``rejected`` beside their columns, as plans.

    Values that could not be read are gone from typed tables, and copies of an order have a first one
    only where rows know their places; both are judged by ``stage_accepted``.
    """
    rules = rules_from(reject, severities)
    judged: dict[str, DataFrame] = {}
    for table in _parents_first():
        df = raw[table].withColumn(REASONS, row_reasons(table, text=False))
        judged[table] = _judge(df, table, judged, rules, lambda name, df: df)
    return judged


def rejections(judged: Mapping[str, DataFrame], rules: list[str]) -> DataFrame:
    """``table_name, rule, detail, failed_rows``: why rows are rejected, by the given rules."""
    parts = [
        df.where(REJECTED).select(F.lit(table).alias("table_name"), F.inline(REASONS))
        for table, df in judged.items()
    ]
    found = checks.together(parts).where(F.col("rule").isin(*rules))
    return found.groupBy("table_name", "rule", "detail").agg(F.count("*").alias("failed_rows"))


def _judge_reference(
    keep: Keep, name: str, child: DataFrame, parent: DataFrame, key: str, rule: str
) -> DataFrame:
    """``child`` with a reason more where ``key`` is NULL, was not delivered, or was rejected."""
    used = child.select(key, F.lit(None).cast("boolean").alias("gone"), F.lit(True).alias("used"))
    known = parent.select(key, F.col(REJECTED).alias("gone"), F.lit(False).alias("used"))
    keys = (
        used.unionByName(known)
        .dropna(subset=[key])
        .groupBy(key)
        .agg(F.min("gone").alias("gone"), F.max("used").alias("used"))
        .where("used")
    )
    why = F.when(F.col("gone").isNull(), NOT_DELIVERED).when(F.col("gone"), NOT_KEPT)
    lost = keys.select(key, why.alias("why")).dropna(subset=["why"])
    # Not stored, lost keys are hashed, a task's at a time, and rows pass by them unsorted: a task then
    # holds keys only. A stored table has a size that Spark plans by, and forgets the hint.
    lost = keep(f"{name}_without_{key}", lost.hint("shuffle_hash"))
    why = F.when(F.col(key).isNull(), NOT_DELIVERED).otherwise(F.col("why"))
    reason = F.array(_reason(rule, why, why.isNotNull())).cast(f"array<{REASON}>")
    reasons = F.concat(F.col(REASONS), F.array_compact(reason))
    return child.join(lost, key, "left").withColumn(REASONS, reasons).drop("why")


def _judge_copies(keep: Keep, name: str, df: DataFrame, rule: str, rules: list[str]) -> DataFrame:
    """``df`` with a reason more on all rows of a key but the first delivered of those that stay."""
    key, place = list(STAGING[name].key), F.struct(*PLACE)
    stays = ~_grave(rules)
    firsts = (
        df.where(stays)
        .groupBy(*key)
        .agg(F.count("*").alias("copies"), F.min(place).alias("first"))
        .where("copies > 1")
        .drop("copies")
    )
    firsts = keep(f"{name}_copies", firsts)
    later = stays & F.col("first").isNotNull() & (place != F.col("first"))
    reason = F.array(_reason(rule, "not the first delivered", later)).cast(f"array<{REASON}>")
    reasons = F.concat(F.col(REASONS), F.array_compact(reason))
    return df.join(firsts, key, "left").withColumn(REASONS, reasons).drop("first")


def _parents_first() -> list[str]:
    parents = {name: {p for c, p, _ in checks.REFERENCES.values() if c == name} for name in STAGING}
    order: list[str] = []
    while len(order) < len(parents):
        order += [t for t in STAGING if t not in order and parents[t] <= set(order)]
    return order


def stage_accepted(
    spark: SparkSession,
    directory: str,
    root: str,
    reject: str = gate.ERROR,
    patterns: Mapping[str, str] | None = None,
    severities: Mapping[str, str] = gate.SEVERITIES,
) -> dict[str, DataFrame]:
    """Load the nine files and store the rows that break no rule of severity ``reject`` or graver.

    The others are stored in the same set as ``rejected_<table>``: as delivered, with all their reasons
    (``read_rejected``), and counted by table, rule and detail (``rejected_report``). The gate is then
    held against what stays. Missing files and columns still stop the load. Of orders that share an
    identifier the first delivered one that breaks no other rule stays. A row whose parent was rejected is
    rejected too if the rule of that reference is grave enough; its detail says so. Everything is
    committed at once, as by ``stage_files``.
    """
    paths = locate(spark, directory, dict(patterns or {}))
    texts = {table: read_text(spark, table, path) for table, path in paths.items()}
    rules = rules_from(reject, severities)
    draft = SnapshotStore(spark, root).begin()
    forget_rejected(draft)
    judged: dict[str, DataFrame] = {}
    stored: dict[str, DataFrame] = {}
    lost: dict[str, int] = {}
    rows: dict[str, int] = {}
    for table in _parents_first():
        df = _judge(_parsed(texts[table], table), table, judged, rules, _stepping_stones(draft))
        judged[table], seen = _split(draft, table, df)
        stored[table] = _list(draft, table, judged[table], seen)
        rows |= {f"{table} rows {word}": seen[word] for word in ("accepted", "rejected")}
        lost |= {name: n for name, n in seen.items() if name.startswith("unreadable ")}
    gate.enforce(gate.quality_gate(gate.rule_failures(stored, lost=lost), severities))
    found = [counted(spark, lost), counted(spark, rows), validate(stored)]
    put_report(draft, STAGING_REPORT, checks.together(found))
    put_report(draft, REJECTED_REPORT, rejections(judged, list(severities)))
    draft.commit()
    return {table: stored[table] for table in STAGING}


def _split(draft: Draft, table: str, df: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Write accepted and rejected rows into a folder each, in one pass, and count them on the way.

    Values that cannot be read are counted among the accepted rows; rejected ones tell in their reasons.
    """
    stays = ~F.col(REJECTED)
    counts = {"accepted": F.count_if(stays), "rejected": F.count_if(REJECTED)}
    for check in lost_values(table):
        counts[check] = F.count_if(stays & _told(check))
    df = df.withColumn(DELIVERED, F.when(F.col(REJECTED), F.col(DELIVERED)))
    name = f"judged_{table}"
    path = draft.write(
        name,
        df,
        counts=counts,
        listed=False,
        folder_column=REJECTED,
        options=lookup_options(table),
    )
    seen = draft.observed[name]
    if not seen["rows"]:  # then there is no folder that could be read
        return df.limit(0), seen
    return df.sparkSession.read.schema(df.schema).parquet(path), seen


def _list(draft: Draft, table: str, judged: DataFrame, seen: Mapping[str, int]) -> DataFrame:
    """Enter both folders of a table into the set; without accepted rows, an empty table."""
    where = f"{draft.folder}/judged_{table}/{REJECTED}="
    if seen["rejected"]:
        draft.tables[f"{REJECTED}_{table}"] = f"{where}true"
    if not seen["accepted"]:
        return put_table(draft, table, judged.where(F.lit(False)))
    draft.tables[table] = f"{where}false"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in STAGING[table].schema])
    return judged.sparkSession.read.schema(schema).parquet(f"{draft.store.root}/{where}false")


def read_rejected(spark: SparkSession, table: str, root: str) -> DataFrame:
    """``reasons`` and ``delivered`` (the file's columns as text) of the rows of ``table`` that the newest
    load kept apart, and where they stood."""
    contract = STAGING[table]
    delivered = T.StructType([T.StructField(c, T.StringType()) for c in contract.columns])
    schema = T.StructType(
        [
            T.StructField(REASONS, T.ArrayType(T.StructType.fromDDL("rule string, detail string"))),
            T.StructField(DELIVERED, delivered),
            *T.StructType.fromDDL(PLACE_SCHEMA),
        ]
    )
    path = SnapshotStore(spark, root).path(f"{REJECTED}_{table}")
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)
