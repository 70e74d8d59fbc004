"""Hard negatives by coordinate pruning: length buckets, sorted coordinate lists, exact verification.

The vectors are dealt evenly into *shelves*. A shelf sorts its vectors by length and cuts them into
buckets: no vector of a bucket is shorter than ``LENGTH_RATIO`` of its longest one. For every
coordinate a bucket keeps the list of its unit vectors' values in ascending order, with the row each
belongs to. This index is built once and stored; two searches read it.

A search takes queries: an anchor's vector, a range of scores, the wanted side of the label. A vector
p of a bucket with longest length l can reach the score t > 0 with the anchor q only if the cosine of
the two is at least t / (|q| l), which bounds the angle between them, and so the value of every single
coordinate of p to a range around that of q. The ranges of the anchor's ``FOCUS`` largest coordinates
are looked up in the sorted lists, the candidate rows of the shortest list are intersected with the
other ranges, and the inner products of those left are computed. Buckets come longest first and t
rises with the k-th best score found, so buckets are skipped whole once |q| l < t. Where the shortest
list holds most of a bucket, the bucket is verified as one matrix product.

First the positives: the best rows of the anchor's own label. Their scores give, per anchor and
positive, the range in which the second search finds negatives of other labels.

What moves: vectors once into shelves; packs of anchors to every shelf, shelves to every chunk of
``CHUNK`` anchors. So a task holds one shelf and one chunk, both of bounded size, however many anchors
there are, and returns ``k`` rows for each query at most. Shelves are dealt by row number, so equal
vectors, labels or ids never gather in one.

Defined cases: rows without a label or a vector, or with a null or non-finite component, take no part.
A null vec_id is no anchor and keeps its label; as a candidate it comes after all ids of equal score.
Rows that repeat an id are rows of their own: an anchor is never its own positive, an equal row may
be. Shorter vectors count as if zeros followed, an empty one as all zeros. Scores are exact integers;
one that does not fit a long raises an OverflowError. An anchor without positives, or a positive
without a negative in range, has no row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import pack, stored, unpack

# Fixed by the contract.
RELABEL_EACH, LABELS, SCALE, ANCHOR_EACH = 7, 10, 256.0, 100
POSITIVES, NEGATIVES = 5, 5
LEAST_PART, WHOLE = 80, 100  # a negative's score is between 80 % and 100 % of the positive's

SHELF_ROWS = 262_144  # most vectors of a shelf, on average
SPREAD = 64  # shelves that a small table is dealt into, if they get LEAST_ROWS each
LEAST_ROWS = 512
BUCKET_ROWS = 4096
LENGTH_RATIO = 0.9
FOCUS = 4
CHUNK = 65_536  # anchors of one task
PACK = 1024  # anchors of one row
DENSE = 1 / 3  # candidate share of a bucket from which a matrix product is cheaper than a list
AT_ONCE = 512  # queries of one matrix product
SLACK = 1e-6  # coordinates are kept as 32-bit floats; ranges are wider by more than their error
NO_ID = np.iinfo(np.int64).max

INDEX_SCHEMA = "shelf int, bucket int, top double, n_anchors long, payload binary"
PACK_SCHEMA = "chunk int, pack long, payload binary"
FOUND_SCHEMA = "pack long, anchor long, place int, anchor_id long, id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, labels changed as the contract says."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    label = F.col("label").cast("long")
    changed = F.when(F.col("vec_id") % RELABEL_EACH == 0, (label + 1) % LABELS).otherwise(label)
    return vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        changed.alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Whole components, one row a vector, shorter ones filled up with zeros."""
    lengths = np.asarray(column.value_lengths(), np.int64)
    values = np.floor(SCALE * np.asarray(column.flatten(), np.float64))
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers as 16-bit integers where all of them fit."""
    fits = x.size == 0 or np.abs(x).max() < 2**15
    return x.astype(np.int16) if fits else x


@dataclass
class Bucket:
    """Vectors of about one length in the order of their ids, with their sorted coordinate lists."""

    top: float
    whole: np.ndarray  # rows x width, whole numbers
    ids: np.ndarray  # NO_ID where missing
    missing: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    order: np.ndarray  # width x rows: rows by ascending value of a coordinate
    values: np.ndarray  # width x rows: those values, of the unit vectors

    def sealed(self) -> bytes:
        arrays = (_small(self.whole.ravel()), self.ids, self.missing, self.labels, self.keys)
        return pack(*arrays, self.order.ravel(), self.values.ravel())

    @classmethod
    def opened(cls, top: float, payload: bytes) -> Bucket:
        whole, ids, missing, labels, keys, order, values = unpack(payload)
        n = len(ids)
        whole = whole.astype(np.float64).reshape(n, -1)
        return cls(top, whole, ids, missing, labels, keys, order.reshape(-1, n), values.reshape(-1, n))


def _unit(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and vectors of length one (zero vectors stay)."""
    most = np.abs(whole).max(axis=1, initial=0)
    scaled = whole / np.where(most > 0, most, 1)[:, None]
    lengths = np.sqrt((scaled**2).sum(axis=1))
    return lengths * most, scaled / np.where(lengths > 0, lengths, 1)[:, None]


def _shelf_index(shelf: int, table: pa.Table) -> Iterator[dict]:
    """The buckets of a shelf, longest first, and how many anchors each holds."""
    table = table.combine_chunks()
    whole = _matrix(table["embedding"].combine_chunks())
    lengths, unit = _unit(whole)
    ids = table["vec_id"].combine_chunks()
    missing = np.asarray(ids.is_null())
    ids = np.where(missing, NO_ID, np.asarray(ids.fill_null(0)))
    labels = np.asarray(table["label"])
    by_length = np.lexsort((ids, -lengths))
    at, number = 0, 0
    while at < len(by_length):
        top = lengths[by_length[at]]
        near = np.searchsorted(-lengths[by_length], -LENGTH_RATIO * top, "right")
        rows = by_length[at : max(at + 1, min(near, at + BUCKET_ROWS))]
        at += len(rows)
        rows = rows[np.lexsort((ids[rows], missing[rows]))]
        order = np.argsort(unit[rows], axis=0, kind="stable").T
        values = np.take_along_axis(unit[rows].T, order, axis=1)
        anchors = ~missing[rows] & (ids[rows] % ANCHOR_EACH == 0)
        made = Bucket(
            top,
            whole[rows],
            ids[rows],
            missing[rows],
            labels[rows],
            (shelf << 36) + (number << 18) + np.arange(len(rows)),
            order.astype(np.uint16),
            values.astype(np.float32),
        )
        yield {
            "shelf": shelf,
            "bucket": number,
            "top": float(top),
            "n_anchors": int(anchors.sum()),
            "payload": made.sealed(),
        }
        number += 1


def shelves_for(rows: int) -> int:
    return max(1, -(-rows // SHELF_ROWS), min(SPREAD, -(-rows // LEAST_ROWS)))


def index(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The stored index of all usable rows, one row a bucket, and the number of shelves."""
    n = shelves_for(vectors.count())
    schema = pa.schema(
        [
            ("shelf", pa.int32()),
            ("bucket", pa.int32()),
            ("top", pa.float64()),
            ("n_anchors", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def build(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(_shelf_index(table["shelf"][0].as_py(), table)), schema)

    # Dealt by where a row stands, whatever it holds.
    shelf = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    rows = usable(vectors).withColumn("shelf", shelf)
    return stored(rows.groupBy("shelf").applyInArrow(build, INDEX_SCHEMA), "index"), n


@dataclass
class Queries:
    """Anchors with a range of scores each: rows of equal place in the arrays belong together."""

    vectors: np.ndarray
    keys: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    places: np.ndarray
    low: np.ndarray  # least and greatest score
    high: np.ndarray
    packs: np.ndarray

    def sealed(self) -> bytes:
        rest = (self.keys, self.ids, self.labels, self.places, self.low, self.high, self.packs)
        return pack(_small(self.vectors.ravel()), *rest)

    @classmethod
    def opened(cls, payload: bytes) -> Queries:
        vectors, *rest = unpack(payload)
        return cls(vectors.astype(np.float64).reshape(len(rest[0]), -1), *rest)

    def taken(self, rows: np.ndarray) -> Queries:
        return Queries(*(getattr(self, f)[rows] for f in self.__dataclass_fields__))


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _joined(parts: list[Queries]) -> Queries:
    width = max(x.vectors.shape[1] for x in parts)
    names = [f for f in Queries.__dataclass_fields__ if f != "vectors"]
    vectors = np.concatenate([_wide(x.vectors, width) for x in parts])
    return Queries(vectors, *(np.concatenate([getattr(x, f) for x in parts]) for f in names))


def anchor_packs(found: DataFrame) -> tuple[DataFrame, int]:
    """The index's anchors as stored packs of queries without bounds, and the number of chunks."""
    total = found.agg(F.sum("n_anchors")).first()[0] or 0
    chunks = max(1, -(-total // CHUNK))
    schema = pa.schema([("chunk", pa.int32()), ("pack", pa.int64()), ("payload", pa.binary())])

    def row(queries: Queries) -> pa.RecordBatch:
        first = int(queries.keys[0])
        queries.packs[:] = first
        # Shelf numbers are dense and packs of one shelf few, so chunks come out about even.
        chunk = ((first >> 18) * 2_654_435_761 >> 7) % chunks
        values = [{"chunk": chunk, "pack": first, "payload": queries.sealed()}]
        return pa.RecordBatch.from_pylist(values, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for top, payload in zip(batch["top"].to_pylist(), batch["payload"].to_pylist(), strict=True):
                bucket = Bucket.opened(top, payload)
                rows = np.flatnonzero(~bucket.missing & (bucket.ids % ANCHOR_EACH == 0))
                zero = np.zeros(len(rows), np.int64)
                given = Queries(
                    bucket.whole[rows],
                    bucket.keys[rows],
                    bucket.ids[rows],
                    bucket.labels[rows],
                    zero,
                    zero - NO_ID,
                    zero + NO_ID,
                    zero,
                )
                if n and n + len(rows) > PACK:
                    yield row(_joined(held))
                    held, n = [], 0
                if len(rows):
                    held.append(given)
                    n += len(rows)
        if n:
            yield row(_joined(held))

    return stored(found.where("n_anchors > 0").mapInArrow(run, PACK_SCHEMA), "anchors"), chunks


def _ranges(bucket: Bucket, unit: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per query and focus coordinate: the coordinate, feasible values, first and last list place."""
    width = unit.shape[1]
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, : min(FOCUS, width)]
    angle = np.arccos(np.clip(np.take_along_axis(unit, focus, 1), -1, 1))
    reach = np.arccos(np.clip(least, -1, 1))[:, None]
    low = np.cos(np.minimum(np.pi, angle + reach)) - SLACK
    high = np.cos(np.maximum(0, angle - reach)) + SLACK
    first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus):
        where = focus == f
        first[where] = np.searchsorted(bucket.values[f], low[where], "left")
        last[where] = np.searchsorted(bucket.values[f], high[where], "right")
    return focus, low, high, first, last


def _products(whole: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products, vectors by queries: floats while all sums are below 2**53."""
    bound = np.abs(whole).max(initial=0) * np.abs(queries).max(initial=0) * max(1, whole.shape[1])
    if bound < 2**53:
        return whole @ queries.T
    exact = [[int(x) for x in row] for row in whole]
    asked = [[int(x) for x in row] for row in queries]
    out = np.empty((len(exact), len(asked)), object)
    for i, x in enumerate(exact):
        for j, y in enumerate(asked):
            out[i, j] = sum(a * b for a, b in zip(x, y, strict=True))
    return out


class Best:
    """The best ``k`` (score, id) of every query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.zeros((n, k), np.int64)
        self.ids = np.full((n, k), NO_ID)
        self.missing = np.ones((n, k), bool)
        self.empty = np.ones((n, k), bool)
        self.least = np.full(n, -np.inf)  # just below the k-th score, if there are as many

    def add(self, query: int, scores: np.ndarray, bucket: Bucket, rows: np.ndarray) -> None:
        """Rows ascend, so they are in the order of ids."""
        scores = scores.astype(np.int64)  # raises where a score does not fit
        if len(rows) > self.k:
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = np.flatnonzero(scores >= kth)
            keep = keep[np.argsort(-scores[keep], kind="stable")[: self.k]]
            scores, rows = scores[keep], rows[keep]
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.ids[query], bucket.ids[rows]])
        missing = np.concatenate([self.missing[query], bucket.missing[rows]])
        empty = np.concatenate([self.empty[query], np.zeros(len(rows), bool)])
        first = np.lexsort((ids, missing, -scores, empty))[: self.k]
        self.scores[query], self.ids[query] = scores[first], ids[first]
        self.missing[query], self.empty[query] = missing[first], empty[first]
        if not self.empty[query, -1]:
            kth = float(self.scores[query, -1])
            self.least[query] = kth - 1e-12 * abs(kth)


def _lengths(whole: np.ndarray) -> np.ndarray:
    return np.sqrt((whole**2).sum(axis=1))


def _search(buckets: list[Bucket], queries: Queries, k: int, same: bool) -> Best:
    """The best ``k`` rows of the shelf for every query, of its own label or of any other."""
    best = Best(len(queries.keys), k)
    lengths, unit = _unit(queries.vectors)
    for bucket in buckets:
        width = max(bucket.whole.shape[1], queries.vectors.shape[1])
        whole, vectors = _wide(bucket.whole, width), _wide(queries.vectors, width)
        floor = np.maximum(queries.low, best.least)
        reach = lengths * bucket.top
        # Only a positive bound says anything about angles; others leave all values feasible.
        bounded = (floor > 0) & (reach > 0)
        open_ = ~((floor > 0) & (floor > reach * (1 + 1e-9)))
        cosine = np.where(bounded, floor / np.where(reach > 0, reach, 1), -1.0)
        asked = np.flatnonzero(open_)
        n = len(bucket.ids)
        share = np.full(len(queries.keys), n)
        if bucket.order.size and unit.shape[1] and len(asked):
            shared = min(unit.shape[1], len(bucket.order))  # beyond it one side is all zeros
            focus, low, high, first, last = _ranges(bucket, unit[asked, :shared], cosine[asked])
            shortest = np.argmin(last - first, axis=1)
            share[asked] = (last - first)[np.arange(len(asked)), shortest]
        dense = asked[share[asked] > DENSE * n]
        for at in range(0, len(dense), AT_ONCE):
            part = dense[at : at + AT_ONCE]
            scores = _products(whole, vectors[part])
            fits = (scores >= floor[part]) & (scores <= queries.high[part]) & (scores >= queries.low[part])
            fits &= (bucket.labels[:, None] == queries.labels[part]) == same
            if same:
                fits &= bucket.keys[:, None] != queries.keys[part]
            for j, query in enumerate(part):
                rows = np.flatnonzero(fits[:, j])
                if len(rows):
                    best.add(query, scores[rows, j], bucket, rows)
        for i in np.flatnonzero((share[asked] <= DENSE * n) & (share[asked] > 0)):
            query, slot = asked[i], shortest[i]
            rows = bucket.order[focus[i, slot], first[i, slot] : last[i, slot]]
            rows = np.sort(rows.astype(np.int64))
            right = bucket.labels[rows] == queries.labels[query]
            rows = rows[right if same else ~right]
            size = _lengths(whole[rows])
            for other in range(focus.shape[1]):
                if other != slot and len(rows):
                    value = whole[rows, focus[i, other]]
                    keep = (value >= low[i, other] * size) & (value <= high[i, other] * size)
                    rows, size = rows[keep], size[keep]
            if same:
                rows = rows[bucket.keys[rows] != queries.keys[query]]
            if len(rows):
                scores = _products(whole[rows], vectors[query : query + 1])[:, 0]
                keep = (scores >= queries.low[query]) & (scores <= queries.high[query])
                if keep.any():
                    best.add(query, scores[keep], bucket, rows[keep])
    return best


def search(found: DataFrame, shelves: int, packs: DataFrame, chunks: int, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows of every query over all shelves, with their rank from 1."""
    schema = pa.schema(
        [
            ("pack", pa.int64()),
            ("anchor", pa.int64()),
            ("place", pa.int32()),
            ("anchor_id", pa.int64()),
            ("id", pa.int64()),
            ("score", pa.int64()),
        ]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        rows = sorted(zip(left["top"].to_pylist(), left["payload"].to_pylist(), strict=True), reverse=True)
        buckets = [Bucket.opened(top, payload) for top, payload in rows]
        queries = _joined([Queries.opened(x) for x in right["payload"].to_pylist()])
        best = _search(buckets, queries, k, same)
        query, slot = np.nonzero(~best.empty)
        return pa.table(
            {
                "pack": queries.packs[query],
                "anchor": queries.keys[query],
                "place": queries.places[query].astype(np.int32),
                "anchor_id": queries.ids[query],
                "id": pa.array(best.ids[query, slot], mask=best.missing[query, slot]),
                "score": best.scores[query, slot],
            },
            schema,
        )

    left = found.select(
        "shelf", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "top", "payload"
    )
    right = packs.select(
        F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))).alias("shelf"), "chunk", "payload"
    )
    met = (
        left.groupBy("shelf", "chunk")
        .cogroup(right.groupBy("shelf", "chunk"))
        .applyInArrow(run, FOUND_SCHEMA)
    )
    order = Window.partitionBy("anchor", "place").orderBy(
        F.desc("score"), F.asc_nulls_last("id")
    )
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ranged(packs: DataFrame, positives: DataFrame) -> DataFrame:
    """A query for every anchor and positive: negatives score in its range."""
    schema = pa.schema([("chunk", pa.int32()), ("pack", pa.int64()), ("payload", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        (row,) = left.to_pylist()
        queries = Queries.opened(row["payload"])
        order = np.argsort(queries.keys)
        score = right["score"].to_pylist()
        rows = order[np.searchsorted(queries.keys[order], np.asarray(right["anchor"]))]
        asked = queries.taken(rows)
        asked.places = np.asarray(right["rank"], np.int64)
        asked.low = np.array([-((-LEAST_PART * s) // WHOLE) for s in score], np.int64)
        asked.high = np.array(score, np.int64)
        keep = np.array([s >= 0 for s in score], bool)  # 80 % of less than nothing is more than it
        if not keep.any():
            return schema.empty_table()
        return pa.Table.from_pylist([row | {"payload": asked.taken(np.flatnonzero(keep)).sealed()}], schema)

    return packs.groupBy("pack").cogroup(positives.groupBy("pack")).applyInArrow(run, PACK_SCHEMA)


def hard_negatives(
    vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """Per anchor and positive, the best negatives in range: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score."""
    found, shelves = index(vectors)
    packs, chunks = anchor_packs(found)
    near = stored(search(found, shelves, packs, chunks, positives, True), "positives")
    asked = stored(_ranged(packs, near), "ranges")
    far = search(found, shelves, asked, chunks, negatives, False)
    near = near.select(
        "anchor",
        F.col("rank").alias("place"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return far.join(near, ["anchor", "place"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
