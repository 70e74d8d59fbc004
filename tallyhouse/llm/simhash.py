"""SimHash near-duplicates by pigeonhole blocks.

Texts become 64-bit fingerprints of their word shingles. Fingerprints are cut into ``max_bits + 2``
blocks, so two that differ in at most ``max_bits`` bits agree on at least two blocks: they meet in
the table of one pair of blocks, and the Hamming distance decides. Only distinct fingerprints are
joined; copies of a fingerprint are linked by it.

A block key shared by many fingerprints (a large group of near copies) is not paired out. Its
fingerprints are linked exactly through the values one bit away from them: two fingerprints differ
in at most two bits if and only if such a value is common to both, so 65 rows per fingerprint
replace the square of the group.

Defined cases: null and empty texts have fingerprint zero and link with each other. Null doc_ids
are never the smallest; a component of null ids only has a null id. Repeated ids are rows of their
own. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import batch_texts, stored

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CROWD = 48  # fingerprints of one block key that are still compared pairwise


def _vote(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 200_000):
        part = hashes[at : at + 200_000]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprint_of(text: bytes, words_each: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < words_each:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_each)), strict=False))
    digest = xxhash.xxh64_intdigest
    return _vote(np.array([digest(s, seed) for s in shingles], np.uint64))


def fingerprints(
    docs: DataFrame, words_each: int = SHINGLE_WORDS, seed: int = SEED, more: tuple[Column, ...] = ()
) -> DataFrame:
    """doc_id, tag (a hash of the text) and fingerprint (a signed 64-bit integer) of every row."""

    @F.arrow_udf("long")
    def fingerprint(text: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, words_each, seed) for t in batch_texts(text)], pa.int64())

    return docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("tag"),
        fingerprint("text").alias("fingerprint"),
        *more,
    )


def block_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Masks of all pairs out of ``max_bits + 2`` blocks of the 64 bits, as signed integers."""
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Pairs (low, high) of different fingerprints within ``max_bits``, enough to connect all."""
    if max_bits not in (1, 2):
        raise ValueError("crowded keys are linked by values one bit away: one or two bits only")
    keys = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
            for t, m in enumerate(block_masks(max_bits))
        ]
    )
    keyed = stored(distinct.select("fingerprint", F.inline(keys)), "keys")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    small = keyed.join(sizes.where(F.col("n") <= crowd).select("t", "key"), ["t", "key"])
    left = small.select("t", "key", F.col("fingerprint").alias("low"))
    right = small.select("t", "key", F.col("fingerprint").alias("high"))
    distance = F.bit_count(F.col("low").bitwiseXOR(F.col("high")))
    pairs = (
        left.join(right, ["t", "key"])
        .where((F.col("low") < F.col("high")) & (distance <= max_bits))
        .select("low", "high")
    )
    # Crowded keys: each fingerprint once, however many of its keys are crowded.
    crowded = (
        keyed.join(sizes.where(F.col("n") > crowd).select("t", "key"), ["t", "key"])
        .select("fingerprint")
        .distinct()
    )
    flips = [1 << i for i in range(63)] + [-(1 << 63)]
    reach = [F.col("fingerprint")]
    if max_bits == 2:
        reach += [F.col("fingerprint").bitwiseXOR(F.lit(x)) for x in flips]
        near = crowded.select("fingerprint", F.explode(F.array(*reach)).alias("value"))
    else:
        # One bit apart: the value with that bit cleared, and which bit it was.
        near = crowded.select(
            "fingerprint",
            F.explode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(~x)) for x in flips])).alias("value"),
        )
    hubs = near.groupBy("value").agg(
        F.min("fingerprint").alias("low"), F.max("fingerprint").alias("top")
    )
    hubs = hubs.where(F.col("low") < F.col("top")).select("value", "low")
    star = (
        near.join(hubs, "value")
        .withColumnRenamed("fingerprint", "high")
        .where((F.col("low") < F.col("high")) & (distance <= max_bits))
        .select("low", "high")
    )
    return pairs.union(star).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Every node points once at most, and what it points to doesn't point on."""
    several = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    passed = edges.select(F.col("v").alias("u"))
    return several.isEmpty() and edges.join(passed, "u", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge.

    Alternates the large-star and small-star steps: every node passes its neighbours its smallest
    neighbour, first to larger ones, then to smaller ones. Both are a grouped minimum, which
    combines in the map task, and a join; each step is stored, so a loss repeats one step only.
    Edges point to smaller nodes; it is done when all of them form stars.
    """
    edges = stored(edges.select(F.col("high").alias("u"), F.col("low").alias("v")), "edges")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
        )
        large = stored(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = stored(small, "small")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def groups(
    docs: DataFrame,
    words_each: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    crowd: int = CROWD,
) -> DataFrame:
    """doc_id, tag, fingerprint and component_id (smallest doc_id reachable) of every row."""
    prints = stored(fingerprints(docs, words_each, seed), "fingerprints")
    found = _with_least(prints, F.col("doc_id"), "component_id", max_bits, crowd)
    return found.select("doc_id", "tag", "fingerprint", "component_id")


def _with_least(
    prints: DataFrame, value: Column, name: str, max_bits: int, crowd: int
) -> DataFrame:
    """Stored fingerprints with the least ``value`` of each one's component."""
    distinct = prints.groupBy("fingerprint").agg(F.min(value).alias("first"))
    roots = components(links(distinct.select("fingerprint"), max_bits, crowd))
    placed = distinct.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    placed = stored(placed, "placed")
    firsts = placed.groupBy("root").agg(F.min("first").alias(name))
    named = placed.join(firsts, "root").select("fingerprint", name)
    return prints.join(named, "fingerprint")


def one_of_each(
    docs: DataFrame,
    words_each: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    crowd: int = CROWD,
) -> DataFrame:
    """Exactly one row of each group, all columns: that with the smallest doc_id, null last; of rows
    that share it, the one with the smallest hash of its text, and of equal ones any."""
    key = "row_key"
    while key in map(str.lower, docs.columns):
        key += "_"
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    found = fingerprints(rows, words_each, seed, (F.col(key).alias("row"),))
    prints = stored(found, "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag", "row")
    found = _with_least(prints, order, "kept", max_bits, crowd)
    lost = found.where(F.col("row") != F.col("kept.row")).select(F.col("row").alias(key))
    return rows.join(lost, key, "left_anti").drop(key)
