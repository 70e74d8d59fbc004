"""Mix sources to target weights by Sainte-Laguë apportionment.

Targets come from weights and a budget, capped at a multiple of what a source has. Equal blocks of
words are then given to sources one by one to the highest quotient ``target / (2 * blocks + 1)``,
and each source's blocks to its shards in the same way by shard size. Inside a shard the documents
stand in a seeded order, cut into blocks; every block is taken ``blocks // all`` times and the first
ones in that order once more, so documents stay whole but for one per shard.

A shard is a hash slice of a source of about ``SHARD_DOCS`` documents: a source with a third of all
rows is many shards, and the only windows run inside shards.

Defined cases: null source is the last source; null and empty texts have size 0 and are never
taken; null and repeated ids are rows of their own; an empty table gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import WORD, stored

BLOCK_WORDS = 32
SHARD_DOCS = 1000
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_COPIES = 2
SEED = 17


def capped_targets(weights: np.ndarray, caps: np.ndarray, budget: float) -> np.ndarray:
    """Shares of a budget by weight; what exceeds a cap is shared again among the others."""
    targets = np.zeros(len(caps))
    open_ = caps > 0
    left = min(float(budget), float(caps.sum()))
    while open_.any():
        share = left * weights / weights[open_].sum()
        over = open_ & (share >= caps)
        if not over.any():
            targets[open_] = share[open_]
            break
        targets[over] = caps[over]
        left -= caps[over].sum()
        open_ &= ~over
    return targets


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients votes / 1, / 3, / 5 ...; of equal quotients the earlier one wins.

    The divisor is bisected, which gives all seats above the last quotient at once; seats at the
    last quotient go in order.
    """
    votes = np.asarray(votes, float)
    if seats <= 0 or not len(votes) or votes.sum() <= 0:
        return np.zeros(len(votes), np.int64)
    # Seats at divisor d: quotients votes / (2k + 1) >= d / 2.
    given = lambda d: np.floor(votes / d + 0.5).astype(np.int64)
    low, high = votes.sum() / (seats + len(votes)) / 2, 2 * votes.max() + 1
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    held = given(high)
    rest = seats - int(held.sum())
    if rest > 0:
        quotient = votes / (2 * held + 1)
        held[np.argsort(-quotient, kind="stable")[:rest]] += 1
    return held


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size in words and a seeded order of every document."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        "doc_id",
        "source",
        size.alias("size"),
        F.xxhash64("doc_id", "text", F.lit(seed)).alias("place"),
    )


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """source, source_size, target, blocks, shards: one row per source.

    Sources are a registry, not data: one small table, worked on whole by one task.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        known = frame[frame.source.notna()]
        known = known.iloc[np.argsort([s.encode() for s in known.source], kind="stable")]
        frame = pd.concat([known, frame[frame.source.isna()]])
        size = frame.source_size.to_numpy(float)
        weight = np.array([weights[i % len(weights)] for i in range(len(frame))], float)
        target = capped_targets(weight, most * size, budget * size.sum())
        seats = int(np.floor(target.sum() / block_words + 0.5))
        return pd.DataFrame(
            {
                "source": frame.source.where(frame.source.notna(), None),
                "source_size": frame.source_size,
                "target": target,
                "blocks": sainte_lague(target, seats),
                "shards": -(-frame.documents // SHARD_DOCS),
            }
        )

    return totals.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        plan, "source string, source_size long, target double, blocks long, shards long"
    )


def mix(
    sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """What the mix takes: the columns of ``sizes``, source_size, target and taken (words).

    ``sizes`` is what :func:`sized` gives, stored: it is read three times.
    """
    targets = stored(source_targets(sizes, weights, budget, most, block_words), "targets")
    same = sizes["source"].eqNullSafe(targets["source"])
    placed = sizes.join(targets.drop("source_size", "blocks"), same, "left").select(
        sizes["*"], F.expr("pmod(place, shards)").alias("shard")
    )
    shard_sizes = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))

    def quotas(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard", kind="stable")
        seats = int(frame.blocks.iloc[0])
        blocks = sainte_lague(frame.shard_size.to_numpy(float), seats)
        words = np.minimum(blocks * block_words, most * frame.shard_size.to_numpy())
        return frame[["source_place", "shard"]].assign(quota=words)

    numbered = targets.withColumn("source_place", F.xxhash64("source", F.col("source").isNull()))
    listed = shard_sizes.join(
        numbered.select(F.col("source").alias("s"), "blocks", "source_place"),
        shard_sizes["source"].eqNullSafe(F.col("s")),
    )
    plans = listed.groupBy("source_place").applyInPandas(
        quotas, "source_place long, shard long, quota long"
    )
    plans = (
        numbered.join(plans, "source_place", "left")
        .select(F.col("source").alias("s"), "source_size", "target", F.col("shard").alias("h"), "quota")
    )
    line = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size")
    before = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    whole = F.sum("size").over(Window.partitionBy("source", "shard"))
    lined = placed.withColumn("before", before).withColumn("shard_size", whole)
    joined = lined.join(
        plans, lined["source"].eqNullSafe(plans["s"]) & (lined["shard"] == plans["h"]), "left"
    )
    rest = F.expr("quota % shard_size") - F.col("before")
    taken = F.when(
        F.col("shard_size") > 0,
        F.expr("quota div shard_size") * F.col("size")
        + F.greatest(F.lit(0), F.least(F.col("size"), rest)),
    ).otherwise(F.lit(0))
    return joined.select(
        *[F.col(n) for n in sizes.columns],
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns.

    Whole copies come first; of a document taken in part, one more row holds its first words.
    n_chars, where there is such a column, follows the text. Rows that repeat an id and a text
    share what they are taken evenly, rounded up to a word each.
    """
    names = docs.columns
    sizes = stored(sized(docs), "sizes")
    chosen = (
        mix(sizes, **options)
        .groupBy(F.col("doc_id").alias("mix_id"), F.col("place").alias("mix_place"), "size")
        .agg(F.ceil(F.avg("taken")).alias("taken"))
        .where("taken > 0")
    )
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    place = F.xxhash64("row.doc_id", "row.text", F.lit(SEED))
    joined = rows.join(
        chosen, F.col("row.doc_id").eqNullSafe(F.col("mix_id")) & (place == F.col("mix_place"))
    )
    copies = joined.select(
        "row", "size", F.posexplode(F.sequence(F.lit(1), F.expr("(taken + size - 1) div size"))),
        (F.col("taken") % F.col("size")).alias("part"), "taken",
    )
    cut = (F.col("part") > 0) & (F.col("col") * F.col("size") > F.col("taken"))
    # The first ``part`` words with the space before each.
    head = F.concat_ws(
        "", F.slice(F.regexp_extract_all("row.text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, F.col("part").cast("int"))
    )
    text = F.when(cut, head).otherwise(F.col("row.text"))
    final = copies.withColumn("new_text", text)
    out = []
    for n in names:
        if n == "text":
            out.append(F.col("new_text").alias(n))
        elif n == "n_chars":
            kind = docs.schema[n].dataType
            out.append(F.when(cut, F.length("new_text")).otherwise(F.col("row.n_chars")).cast(kind).alias(n))
        else:
            out.append(F.col(f"row.`{n}`").alias(n))
    return final.select(*out)
