"""A trie of conversation prefixes with totals per subtree, rolled up by bands of depths.

Conversations are numbered, rebuilt on the opening of their donor, and turned into chains of node
keys; a node is a distinct sequence of first turns. Depths are cut into bands of ``height``. Within a
band every node adds its figures to its ancestors of the band only, so a row becomes ``height`` rows
at most. What a band's top nodes got so far are the figures of a smaller trie, whose depths are whole
bands; its totals come from the same rollup, one level up, and are then added to the ``height`` nodes
between a top and the next. A trie of depth D takes log D to the base ``height`` levels, whatever its
width, so a conversation of millions of turns needs no round for each turn or band.

Keys are made the same way: a block of ``height`` turns has one digest, blocks of blocks have one, and
a prefix is the digest of the blocks before it and the turns after those. All are SHA-256, so equal
keys mean equal sequences. No conversation is gathered in a task: turns are numbered in a global sort,
by running counts per partition and one offset for each partition that goes on with a conversation.
The ids that end at a node are sorted the same way, packed, and hashed as a stream.

Defined cases: turns without a conv_id belong to no conversation and take no part. Turns come in the
order of turn (null first), then role and text; a null role or text is empty. Equal turns of equal
places are rows of their own. The donor of c is c - c % 20 with the sign of Spark's remainder. An
empty table has no root and gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import WORD, stored

# Fixed by the contract.
DONOR_EACH, OPENINGS = 20, 4

HEIGHT = 16
PIECE = 4096  # ids of one packed row
LEADING = 64  # characters of a text that decide the partition of a turn


def _root() -> Column:
    """The key of the prefix without turns."""
    return F.lit(b"").cast("binary")


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, place, digest, words, part): the turns of every conversation, places from 0; ``part``
    is the partition of the sort that a turn came in."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # The bounds of the partitions are kept by the driver, so they hold no whole texts. Equal short
    # turns may be parted anywhere.
    tie = F.when(F.length("text") <= LEADING, F.col("tie")).otherwise(F.lit(0))
    bounds = ["conv_id", "turn", F.substring("role", 1, LEADING), F.substring("text", 1, LEADING), tie]
    order = ["conv_id", "turn", "role", "text", "tie"]
    alike = F.length("role") <= LEADING
    bounds[4] = F.when(alike, tie).otherwise(F.lit(0))
    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("conv_id", pa.int64()),
            ("local", pa.int64()),
            ("digest", pa.binary()),
            ("words", pa.int64()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        last, seen = None, 0  # the conversation that the last batch ended in, its turns so far
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            convs = np.asarray(batch["conv_id"])
            opens = np.flatnonzero(np.r_[True, convs[1:] != convs[:-1]])
            local = np.arange(n) - np.repeat(opens, np.diff(np.r_[opens, n]))
            if convs[0] == last:
                local[: opens[1] if len(opens) > 1 else n] += seen
            last, seen = convs[-1], int(local[-1]) + 1
            columns = [np.full(n, part, np.int32), batch["conv_id"], local, batch["digest"], batch["words"]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    turn = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    placed = (
        rows.repartitionByRange(*bounds)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.unhex(F.sha2(turn, 256)).alias("digest"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        )
        .mapInArrow(count, "part int, conv_id long, local long, digest binary, words long")
    )
    placed = stored(placed, "turns")
    # Only conversations in several partitions have a part that does not start at 0: one for each
    # partition at most.
    counts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    several = counts.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.join(several, "conv_id", "left_semi")
        .withColumn("before", F.sum("n").over(before))
        .where("before > 0")
        .select("conv_id", "part", "before")
    )
    return placed.join(offsets, ["conv_id", "part"], "left").select(
        "conv_id",
        (F.col("local") + F.coalesce("before", F.lit(0))).alias("place"),
        "digest",
        "words",
        "part",
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (conv, i, digest, words), and (conv, length) of all; stored."""
    placed = numbered(turns)
    own = placed.groupBy("conv_id").agg(F.count("*").alias("own"))
    number = F.col("conv_id").cast("string").cast("binary")
    convs = own.select(
        F.col("conv_id").alias("conv"),
        "own",
        (F.crc32(number) % OPENINGS).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % DONOR_EACH).alias("donor"),
    )
    donors = own.where(F.col("conv_id") % DONOR_EACH == 0).select(
        F.col("conv_id").alias("donor"), F.col("own").alias("given")
    )
    taken = F.least("h", F.coalesce("given", F.lit(0)))
    convs = convs.join(donors, "donor", "left").select("conv", "donor", "own", "h", taken.alias("taken"))
    convs = stored(convs, "conversations")
    rest = (
        placed.withColumnRenamed("conv_id", "conv")
        .join(convs.select("conv", "h", "taken"), "conv")
        .where("place >= h")
        .select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("i"), "digest", "words")
    )
    openings = (
        placed.where((F.col("conv_id") % DONOR_EACH == 0) & (F.col("place") < OPENINGS))
        .withColumnRenamed("conv_id", "donor")
        .join(convs.select("donor", "conv", "h"), "donor")
        .where("place < h")
        .select("conv", F.col("place").alias("i"), "digest", "words")
    )
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return stored(rest.union(openings), "rebuilt"), convs.select("conv", length.alias("length"))


def _digest(data: Column) -> Column:
    return F.unhex(F.sha2(data, 256))


def chains(items: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Per level, (conv, i, key, path, words) of every item (conv, i, digest, words); stored.

    ``key`` names the prefix that ends with item i; ``path`` holds the keys of the shorter prefixes
    down to the last whole number of blocks. Items of the next level are the whole blocks.
    """
    turn = F.struct("i", "digest", "words")
    blocks = items.groupBy("conv", F.floor(F.col("i") / height).alias("block")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    together = F.aggregate("turns", _root(), lambda held, x: F.concat(held, x["digest"]))
    whole = blocks.where(F.size("turns") == height).select(
        "conv", F.col("block").alias("i"), _digest(together).alias("digest"), F.lit(0).cast("long").alias("words")
    )
    above: list[DataFrame] = []
    if whole.isEmpty():
        blocks = blocks.withColumn("start", _root()).withColumn("end", F.lit(None).cast("binary"))
    else:
        above = chains(stored(whole, "blocks"), height)
        none = F.lit(None).cast("binary")
        edges = above[0].select(
            "conv",
            F.inline(
                F.array(
                    F.struct(F.col("i").alias("block"), none.alias("start"), F.col("key").alias("end")),
                    F.struct((F.col("i") + 1).alias("block"), F.col("key").alias("start"), none.alias("end")),
                )
            ),
        )
        edges = edges.groupBy("conv", "block").agg(F.max("start").alias("start"), F.max("end").alias("end"))
        blocks = blocks.join(edges, ["conv", "block"], "left").withColumn("start", F.coalesce("start", _root()))

    def key(t: Column) -> Column:
        held = F.aggregate(F.slice("turns", 1, t + 1), F.col("start"), lambda a, x: F.concat(a, x["digest"]))
        return F.when((t == height - 1) & F.col("end").isNotNull(), F.col("end")).otherwise(_digest(held))

    keys = F.concat(F.array("start"), F.transform("turns", lambda x, t: key(t)))
    rows = F.transform(
        "turns",
        lambda x, t: F.struct(
            x["i"].alias("i"),
            F.element_at("keys", t + 2).alias("key"),
            F.slice("keys", 1, t + 1).alias("path"),
            x["words"].alias("words"),
        ),
    )
    found = blocks.withColumn("keys", keys).select("conv", F.inline(rows))
    return [stored(found, "chains"), *above]


FIGURES = ("n_leaves", "saved_tokens")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(*[F.sum(x).alias(x) for x in FIGURES])


def rollup(levels: list[DataFrame], own: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(key, figures) summed over subtrees: ``own`` has them per node, the root included.

    ``levels`` has the nodes (key, i, path) of each level without the root, one row each.
    """
    nodes, above = levels[0], levels[1:]
    tops = (F.col("i") + 1) % height == 0  # a band's last node is the top of the next band
    lists = F.when(tops, F.array("key")).otherwise(F.concat("path", F.array("key")))
    known = own.join(nodes.select("key", lists.alias("keys")), "key", "left")
    keys = F.coalesce("keys", F.array("key"))
    within = _summed(known.select(F.explode(keys).alias("key"), *FIGURES))
    if not above:
        return within
    within = stored(within, "within")
    root = within.where(F.col("key") == _root())
    upper = within.join(above[0].select("key"), "key", "left_semi").union(root)
    totals = stored(rollup(above, upper, height), "totals")
    # From the top of a band to the nodes of the band above it, save that one's own top.
    passed = totals.join(nodes.where(tops).select("key", "path"), "key").select(
        F.explode(F.slice("path", 2, height)).alias("key"), *FIGURES
    )
    return _summed(within.join(totals.select("key"), "key", "left_anti").union(passed).union(totals))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv): the ids of each key, ascending, joined by commas."""
    packed = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())])
    hashed = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, convs = batch["key"].to_pylist(), batch["conv"].to_pylist()
            out, at = [], 0
            for stop in range(1, len(keys) + 1):
                if stop == len(keys) or keys[stop] != keys[at] or stop - at == PIECE:
                    ids = ",".join(map(str, convs[at:stop])).encode()
                    out.append({"key": keys[at], "first": convs[at], "ids": ids})
                    at = stop
            for at in range(0, len(out), 256):
                yield pa.RecordBatch.from_pylist(out[at : at + 256], packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, out = None, None, []
        for batch in batches:
            for key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if state is not None and key == held:
                    state.update(b",")
                else:
                    if state is not None:
                        out.append({"key": held, "ends_sha256": state.hexdigest()})
                    held, state = key, hashlib.sha256()
                state.update(ids)
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, hashed)
                out = []
        if state is not None:
            out.append({"key": held, "ends_sha256": state.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, hashed)

    pieces = (
        ends.repartitionByRange("key", "conv")
        .sortWithinPartitions("key", "conv")
        .mapInArrow(put, "key binary, first long, ids binary")
    )
    return (
        pieces.repartition("key")
        .sortWithinPartitions("key", "first")
        .select("key", "ids")
        .mapInArrow(run, "key binary, ends_sha256 string")
    )


def trie(turns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """All nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    if height < 2:
        raise ValueError("a band has two depths at least")
    items, lengths = rebuilt(turns)
    levels = chains(items, height)

    def one_each(found: DataFrame, *more: Column) -> DataFrame:
        # Equal keys have equal paths and places.
        return found.groupBy("key").agg(F.first("i").alias("i"), F.first("path").alias("path"), *more)

    figures = [F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("words").alias("words")]
    nodes = stored(
        one_each(levels[0], *figures).withColumn("parent", F.element_at("path", -1)), "nodes"
    )
    upper = [stored(one_each(x), "tops") for x in levels[1:]]
    root = lengths.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    every = nodes.select("key", (F.col("i") + 1).alias("depth"), "parent", "conv_id", "n_convs", "words").union(
        root.select(_root(), F.lit(0), F.lit(None), "conv_id", "n_convs", F.lit(0))
    )
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    every = stored(every.join(children, "key", "left").na.fill(0, ["n_children"]), "every")
    own = every.select(
        "key",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = rollup([nodes.select("key", "i", "path"), *upper], own, height)
    last = levels[0].join(lengths, "conv").where("i = length - 1").select("key", "conv")
    ends = last.union(lengths.where("length = 0").select(_root(), "conv"))
    parents = every.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256().hexdigest()
    return (
        every.join(totals, "key")
        .join(parents, "parent", "left")
        .join(ends_digest(ends), "key", "left")
        .select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )
