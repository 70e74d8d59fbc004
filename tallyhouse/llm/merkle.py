"""Document fingerprints: a Merkle tree over paragraphs and sections.

Lines are paragraphs; a section ends at a blank line or at a paragraph whose hash says so, so an
edit does not move the borders of other sections. Paragraphs are cut into leaves at places chosen
by their content. A node's hash is the hash of its children's, and the root is the fingerprint:
equal roots mean equal texts, and where roots differ, walking down differing branches finds the
first leaf that was edited. Likeness is the share of bytes in leaves that both trees hold.

Defined cases: null and empty texts have the root of no sections and are fully alike; rows are
ordered by doc_id (null last), then text; the document after the last one is the first; a single
document is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.ranges import ROWS_EACH, slice_bounds, sliced
from tallyhouse.llm.shared import batch_texts

# Bytes: a leaf ends at the first chosen place after the least, and never holds more than the most.
LEAST_LEAF, MOST_LEAF = 24, 96


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def leaf_edges(text: bytes) -> list[int]:
    """Ends of the leaves: after line breaks, and before some spaces and rarer other places.

    Whether a place is chosen depends on the four bytes before it only.
    """
    n = len(text)
    if not n:
        return []
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    mix = np.zeros(n, np.uint32)
    mix[3:] = a[:-3] * 7 + a[1:-2] * 131 + a[2:-1] * 1031 + a[3:] * 8209
    mix = (mix * np.uint32(2654435761)) >> np.uint32(20)  # of the bytes up to this one
    chosen = np.zeros(n + 1, bool)
    chosen[1:n] = ((a[1:] == 32) & (mix[:-1] % 2 == 0)) | (
        ((a[1:] & 0xC0) != 0x80) & (mix[:-1] % 256 == 0)
    )
    lines = a == 10
    places = np.flatnonzero(chosen | np.concatenate([[False], lines]))
    hard = np.concatenate([[False], lines])[places]
    edges, last = [], 0
    for place, line in zip([*places.tolist(), n], [*hard.tolist(), True], strict=True):
        if line or place - last >= LEAST_LEAF:
            edges += range(last + MOST_LEAF, place, MOST_LEAF)
            if place > last:
                edges.append(place)
            last = place
    return edges


class Tree:
    """Root and nodes of a text: sections of paragraphs of leaves."""

    __slots__ = ("leaves", "root", "sections", "size")

    def __init__(self, text: bytes):
        self.size = len(text)
        self.leaves: Counter = Counter()  # bytes by leaf hash
        self.sections = []  # (hash, bytes, [(hash, bytes, [(hash, bytes)])])
        paragraphs, leaves, start = [], [], 0
        for end in leaf_edges(text):
            piece = text[start:end]
            leaf = _digest(piece)
            leaves.append((leaf, end - start))
            self.leaves[leaf] += end - start
            start = end
            if piece[-1] == 10 or end == len(text):
                paragraph = _digest(b"P" + b"".join(h for h, _ in leaves))
                paragraphs.append((paragraph, sum(n for _, n in leaves), leaves))
                leaves = []
                if piece == b"\n" or paragraph[0] % 8 == 0 or end == len(text):
                    section = _digest(b"S" + b"".join(h for h, _, _ in paragraphs))
                    self.sections.append((section, sum(n for _, n, _ in paragraphs), paragraphs))
                    paragraphs = []
        self.root = hashlib.sha256(b"".join(h for h, _, _ in self.sections)).hexdigest()


def likeness(one: Tree, other: Tree) -> float:
    """Share of bytes in common leaves, 0 to 1."""
    if one.root == other.root:
        return 1.0
    few, many = sorted((one.leaves, other.leaves), key=len)
    common = sum(min(n, many[leaf]) for leaf, n in few.items() if leaf in many)
    return 2 * common / (one.size + other.size)


def first_difference(one: Tree, other: Tree) -> int | None:
    """Byte at which the first differing leaf starts, found along differing branches; None if
    the texts are equal."""
    if one.root == other.root:
        return None
    at, left, right = 0, one.sections, other.sections
    while True:
        same = 0
        while same < min(len(left), len(right)) and left[same][0] == right[same][0]:
            at += left[same][1]
            same += 1
        if same >= min(len(left), len(right)) or len(left[same]) == 2:
            return at
        left, right = left[same][2], right[same][2]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, edit_at long"
)


def ordered_with_next(docs: DataFrame, rows_each: int = ROWS_EACH) -> DataFrame:
    """(slice, guest, doc_id, text) sorted inside slices; each slice ends with a guest row.

    The guest is the first document of the next slice that has any (of the first slice after the
    last), so every document's successor stands right after it and texts move once.
    """
    bounds = slice_bounds(docs, rows_each)
    rows = sliced(docs, bounds)
    # The first id and, of rows that repeat it, the least text, by slice: ids first, so that only
    # the rows of these few ids are looked at again.
    firsts = rows.groupBy("slice").agg(F.min("doc_id").alias("first"))
    line = Window.orderBy("slice")
    before = firsts.select(
        F.col("slice").alias("of"),
        "first",
        F.coalesce(F.lag("slice").over(line), F.max("slice").over(Window.partitionBy())).alias("to"),
    )
    # One row per slice: as many as there are bounds, which are limited.
    hosts = F.broadcast(before)
    guests = (
        rows.join(hosts, (rows["slice"] == hosts["of"]) & rows["doc_id"].eqNullSafe(hosts["first"]))
        .groupBy("to", "doc_id")
        .agg(F.min("text").alias("text"))
        .select(F.col("to").alias("slice"), F.lit(1).alias("guest"), "doc_id", "text")
    )
    both = rows.select("slice", F.lit(0).alias("guest"), "doc_id", "text").unionByName(guests)
    return both.repartition(len(bounds) + 2, "slice").sortWithinPartitions(
        "slice", "guest", F.col("doc_id").asc_nulls_last(), "text"
    )


def fingerprints(docs: DataFrame, rows_each: int = ROWS_EACH) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likeness to each other and to the
    next document, and where the edit starts (the byte of the first differing leaf)."""

    def compare(key, text: bytes, tree: Tree, after: bytes, follower: Tree) -> tuple:
        whole, nxt = text.decode(), after.decode()
        k = len(whole) // 2
        edited = (whole[: len(whole) - k] + nxt[:k]).encode()
        changed = Tree(edited)
        return (
            key,
            len(whole),
            hashlib.sha256(edited).hexdigest(),
            tree.root,
            changed.root,
            likeness(tree, changed),
            likeness(tree, follower),
            first_difference(tree, changed),
        )

    names = [x.split()[0] for x in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (slice, id, text, tree) still without its successor
        for batch in batches:
            out = []
            for number, guest, key, text in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2).to_pylist(),
                batch_texts(batch.column(3)),
                strict=True,
            ):
                if guest and held is None:
                    continue
                tree = Tree(text)
                if held is not None:
                    out.append(compare(*held[1:], text, tree))
                held = None if guest else (number, key, text, tree)
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return ordered_with_next(docs, rows_each).mapInArrow(run, RESULT)
