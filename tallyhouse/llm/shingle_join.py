"""Documents whose word shingles overlap: an exact Jaccard join that skips by set relations.

A document's set is that of its ``words_each``-word shingles, as 64-bit keys. Equal sets are one set
from then on. Shingles are ordered by how many documents hold them (in powers of two), rarest first;
two sets that reach ``percent`` of Jaccard similarity share a shingle among the first few of each, its
*prefix*. Only shingles that a second document holds enter the index, so a document whose prefix is
all its own is settled at once.

An index list holds, for one shingle, the sets with it in their prefix, with their size and the place
of the shingle in them. Relations between sets save most comparisons:

1. Every set of a list is compared with the list's first set only, its *leader*: a number of pairs
   linear in the index. Sizes and places that cannot reach the similarity are skipped. The exact
   overlaps are kept as the leader's answers.
2. Sets that these links connect need no comparison with each other, so lists within one component
   are skipped whole. In the other lists a second leader, up to the ``LEADERS``-th, is compared with the
   sets of other components, which connects most of a large group of near copies.
3. In what lists are still open, entries form blocks of equal size, place and component, and pairs of
   blocks are skipped by position: after the places only so many shingles are left.
4. What is left is answered from the first leader's answers: x and y cannot share more than
   min(x's overlap, y's overlap) inside the leader and min(x's rest, y's rest) outside of it. Only
   pairs that still could reach the similarity are compared, each once.

Shingles are counted, and ordered, per block of documents and bucket of keys (see ``shared``), so what
moves is one key per block, not one per occurrence. A list of more than ``CELL`` sets is cut into
chunks, and every pair of chunks is a group of its own: no task holds a longer list, and no pair is
left out. The text of a document is never compared in full with all others, and no group of copies
is paired out.

Defined cases: null and texts without words have an empty set, which is linked with nothing, copies of
it included. Rows that repeat an id are rows of their own. A null doc_id is never the smallest; a
component of null ids only has a null one. An empty table gives an empty result. Keys of 64 bits stand
for shingles: a comparison would have to meet two different ones with equal keys to be wrong.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import ask, cut_blocks, meet, narrow, open_block, pack, stored, unpack
from tallyhouse.llm.simhash import components

SHINGLE_WORDS = 4
PERCENT = 85
SEED = 42
BUCKET_BYTES = 16 * 1024**2  # of text whose keys meet in one bucket
FOLD = 48  # leading bits of a key that are counted; equal ones only change the order
LEADERS = 3  # sets of a list that all others are compared with, before pairs of others are
CELL = 4096
AT_ONCE = 2_000_000  # pairs of one step within a list
GOLD = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words, each made once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits: the usual steps of shifts and odd factors."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_keys(text: bytes, known: _Words, words_each: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct keys of a text's shingles, ascending; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(len(words), words_each)
    n = len(words) - width + 1
    keys = np.full(n, width, np.uint64)
    for at in range(width):
        keys = _mixed((keys + GOLD) ^ hashes[at : at + n])
    return np.unique(keys)


def _block_keys(row: dict, words_each: int) -> list[np.ndarray]:
    _, offsets, data = open_block(row)
    known, ends = _Words(), offsets.tolist()
    return [
        shingle_keys(data[a:b], known, words_each) for a, b in zip(ends[:-1], ends[1:], strict=True)
    ]


def _folds(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The leading bits of a block's keys, each once and ascending, and how many texts hold them."""
    every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    return np.unique(every >> np.uint64(64 - FOLD), return_counts=True)


def _edges(folds: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, a range of keys, starts."""
    starts = [(b << FOLD) // buckets for b in range(buckets + 1)]
    return np.searchsorted(folds, np.array(starts, np.uint64))


def _planes(x: np.ndarray) -> np.ndarray:
    """Bytes of numbers below 2**48, one place after the other, which compresses better."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T[: FOLD // 8].ravel()


def _numbers(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x) // (FOLD // 8), 8), np.uint8)
    out[:, : FOLD // 8] = x.reshape(FOLD // 8, -1).T
    return out.view("<u8").ravel()


def _asked(row: dict, buckets: int, words_each: int) -> Iterator[tuple[int, bytes]]:
    folds, counts = _folds(_block_keys(row, words_each))
    edges = _edges(folds, buckets)
    for b in np.flatnonzero(np.diff(edges)):
        some = folds[edges[b] : edges[b + 1]]
        steps = np.diff(some, prepend=np.uint64((int(b) << FOLD) // buckets))
        yield int(b), pack(_planes(steps), narrow(counts[edges[b] : edges[b + 1]]))


def _answered(rows: pa.Table) -> pa.Table:
    """For the keys each block asked, the bits of the number of texts that hold them."""
    folds, counts = [], []
    for blob in rows["payload"].to_pylist():
        steps, n = unpack(blob)
        folds.append(np.cumsum(_numbers(steps)))
        counts.append(n.astype(np.int64))
    _, at = np.unique(np.concatenate(folds), return_inverse=True)
    sums = np.bincount(at, np.concatenate(counts)).astype(np.int64)
    bits = (np.frexp(sums)[1]).astype(np.uint8)[at]
    ends = np.cumsum([len(x) for x in folds])
    payload = [pack(x) for x in np.split(bits, ends[:-1])]
    return rows.select(["bucket", "block", "crc"]).append_column("payload", pa.array(payload, pa.binary()))


def _prefix(keys: np.ndarray, bits: np.ndarray, percent: int) -> bytes | None:
    """Shared keys among the first of a set, rarest first, with their places from 1; or None."""
    n = len(keys)
    first = n - -(-percent * n // 100) + 1
    order = np.lexsort((keys, bits))[:first]
    at = np.flatnonzero(bits[order] > 1)
    return pack(keys[order[at]], narrow(at + 1)) if len(at) else None


SETS = "doc_id long, n long, sig binary, prefix binary, keys binary"


def sets(docs: DataFrame, words_each: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n (size of the set), sig (equal for equal sets) of every row, stored; and for those
    that may be linked, prefix (shared keys and their places) and all keys."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    blocks = cut_blocks(docs, exchange=False)
    answers = (
        ask(blocks, lambda row: _asked(row, buckets, words_each), buckets)
        .groupBy("bucket")
        .applyInArrow(_answered, "bucket int, block long, crc long, payload binary")
    )

    def finish(row: dict, given: dict[int, bytes]) -> pa.Table:
        keys = _block_keys(row, words_each)
        folds, _ = _folds(keys)
        bits = [unpack(given[b])[0] for b in sorted(given)]
        bits = np.concatenate(bits) if bits else np.zeros(0, np.uint8)
        out = []
        for doc_id, own in zip(row["ids"], keys, strict=True):
            data = own.tobytes()
            sig = hashlib.blake2b(data, digest_size=16).digest()
            seen = bits[np.searchsorted(folds, own >> np.uint64(64 - FOLD))]
            prefix = _prefix(own, seen, percent) if len(own) else None
            out.append((doc_id, len(own), sig, prefix, data if prefix else None))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        names = ["doc_id", "n", "sig", "prefix", "keys"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return stored(meet(blocks, answers, finish, SETS), "sets")


def index_lists(found: DataFrame) -> DataFrame:
    """Entries (token, sig, n, pos) of all lists with two sets or more, with the list's number of
    sets and its leader (leader, leader_n, leader_pos); stored."""
    schema = pa.schema([("token", pa.int64()), ("sig", pa.binary()), ("n", pa.int64()), ("pos", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sig, n, prefix in zip(*(batch[x].to_pylist() for x in ("sig", "n", "prefix")), strict=True):
                keys, places = unpack(prefix)
                m = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array([sig] * m, pa.binary()),
                        pa.array(np.full(m, n)),
                        pa.array(places.astype(np.int64)),
                    ],
                    schema=schema,
                )

    one_each = found.where("prefix is not null").select("sig", "n", "prefix").dropDuplicates(["sig"])
    entries = stored(one_each.mapInArrow(spread, "token long, sig binary, n long, pos long"), "entries")
    leader = F.min(F.struct("sig", "n", "pos"))
    lists = entries.groupBy("token").agg(F.count("*").alias("n_sets"), leader.alias("first"))
    lists = lists.where("n_sets > 1").select(
        "token",
        "n_sets",
        F.col("first.sig").alias("leader"),
        F.col("first.n").alias("leader_n"),
        F.col("first.pos").alias("leader_pos"),
    )
    return stored(entries.join(lists, "token"), "lists")


def _may_reach(n: Column, pos: Column, m: Column, place: Column, percent: int) -> Column:
    """Sizes allow the similarity, and so do the shingles left after the places."""
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    left = 1 + F.least(n - pos, m - place)
    return sizes & ((100 + percent) * left >= percent * (n + m))


def _overlap(x: pa.Array, y: pa.Array) -> pa.Array:
    """Sizes of what sets of ascending keys share."""
    out = []
    for a, b in zip(x, y, strict=True):
        a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (a, b))
        a, b = (a, b) if len(a) <= len(b) else (b, a)
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        out.append(int((b[at] == a).sum()))
    return pa.array(out, pa.int64())


def compared(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their sets and of what they share; stored. Many pairs may have
    one a, none many of one b: the join on a is the one to split."""
    texts = found.where("prefix is not null").select("sig", "n", "keys").dropDuplicates(["sig"])
    b = texts.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))
    a = texts.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
    met = pairs.join(b, "b").join(a, "a")
    shared = F.arrow_udf(_overlap, "long")("keys_a", "keys_b").alias("shared")
    return stored(met.select("a", "b", "n_a", "n_b", shared), "compared")


def _links(answers: DataFrame, percent: int) -> DataFrame:
    near = answers.where(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared")))
    return near.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))


def _list_pairs(n, pos, comp, shared, side, cell, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one list that neither their blocks nor the leader's answers rule out."""
    order = np.lexsort((comp, pos, n))
    n, pos, comp, shared, side = (x[order] for x in (n, pos, comp, shared, side))
    opens = np.flatnonzero(np.r_[True, (np.diff(n) != 0) | (np.diff(pos) != 0) | (np.diff(comp) != 0)])
    sizes = np.diff(np.r_[opens, len(n)])
    bn, bp, bc = n[opens], pos[opens], comp[opens]
    # Blocks ascend in size: beyond the last one that is not too large, all are skipped.
    stops = np.searchsorted(percent * bn, 100 * bn, "right")
    for i in range(len(opens)):
        j = np.arange(i + 1, stops[i])
        left = 1 + np.minimum(bn[i] - bp[i], bn[j] - bp[j])
        j = j[((100 + percent) * left >= percent * (bn[i] + bn[j])) & (bc[j] != bc[i])]
        if not len(j):
            continue
        ys = np.repeat(opens[j], sizes[j]) + np.arange(sizes[j].sum()) - np.repeat(
            np.cumsum(sizes[j]) - sizes[j], sizes[j]
        )
        xs = np.arange(opens[i], opens[i] + sizes[i])
        step = max(1, AT_ONCE // len(ys))
        for at in range(0, len(xs), step):
            x, y = (z.ravel() for z in np.meshgrid(xs[at : at + step], ys, indexing="ij"))
            # An overlap of -1 is unknown: then all of the smaller set may be shared.
            inside = np.minimum(shared[x], shared[y])
            most = inside + np.minimum(n[x] - shared[x], n[y] - shared[y])
            most = np.where(inside < 0, np.minimum(n[x], n[y]), most)
            keep = (100 + percent) * most >= percent * (n[x] + n[y])
            if cell[0] != cell[1]:
                keep &= side[x] != side[y]
            yield order[x[keep]], order[y[keep]]


def open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries of the lists that hold sets of several components, with the component; stored."""
    placed = lists.join(roots.select(F.col("node").alias("sig"), "root"), "sig", "left").withColumn(
        "comp", F.coalesce("root", "sig")
    )
    several = placed.groupBy("token").agg(F.min("comp").alias("one"), F.max("comp").alias("other"))
    several = several.where("one <> other").select("token")
    columns = [x for x in lists.columns if x != "comp"]
    return stored(placed.join(several, "token", "left_semi").select(*columns, "comp"), "open")


def _undone(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """Pairs that no answer holds, either way round."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    done = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.join(done, ["a", "b"], "left_anti")


def with_next_leader(entries: DataFrame) -> DataFrame:
    """Entries of open lists with another leader: the set in which the list's shingle comes first, so
    that it has the fewest rarer ones of its own; stored."""
    first = F.min(F.struct("pos", "sig", "n", "comp")).alias("first")
    leaders = entries.groupBy("token").agg(first)
    return stored(entries.join(leaders, "token"), "led")


def led_pairs(led: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """Pairs of the leader of each open list, and the sets of other components in it."""
    first = [F.col(f"first.{x}") for x in ("n", "pos")]
    reach = _may_reach(F.col("n"), F.col("pos"), *first, percent)
    met = led.where((F.col("comp") != F.col("first.comp")) & reach)
    return _undone(met.select(F.col("first.sig").alias("a"), F.col("sig").alias("b")), answers)


def left_pairs(entries: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that may be linked and were not compared."""
    known = answers.select(F.col("a").alias("leader"), F.col("b").alias("sig"), "shared")
    rows = (
        entries.where(F.col("sig") != F.col("leader"))
        .join(known, ["sig", "leader"], "left")
        .select(
            "token",
            "sig",
            "n",
            "pos",
            "comp",
            F.coalesce("shared", F.lit(-1)).alias("shared"),
            F.ceil(F.col("n_sets") / CELL).alias("chunks"),
        )
    )
    side = F.pmod(F.xxhash64("sig"), F.col("chunks"))
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda j: F.struct(F.least("side", j).alias("i"), F.greatest("side", j).alias("j")),
    )
    spread = (
        rows.withColumn("side", side)
        .select("token", "sig", "n", "pos", "comp", "shared", "side", F.inline(cells))
        .repartition("token", "i", "j")
        .sortWithinPartitions("token", "i", "j")
    )
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def of_list(part: pa.Table) -> Iterator[pa.RecordBatch]:
        part = part.combine_chunks()
        numbers = [part[x].to_numpy() for x in ("n", "pos")]
        comp = part["comp"].combine_chunks().dictionary_encode().indices.to_numpy()
        rest = [part[x].to_numpy() for x in ("shared", "side")]
        cell = (part["i"][0].as_py(), part["j"][0].as_py())
        sigs = part["sig"].combine_chunks()
        for x, y in _list_pairs(*numbers, comp, *rest, cell, percent):
            if len(x):
                yield pa.RecordBatch.from_arrays([sigs.take(pa.array(x)), sigs.take(pa.array(y))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = [table[x].to_numpy() for x in ("token", "i", "j")]
            new = np.logical_or.reduce([np.diff(k) != 0 for k in keys])
            opens = np.r_[0, np.flatnonzero(new) + 1]
            for at, stop in zip(opens[:-1], opens[1:], strict=True):
                if stop - at > 1:
                    yield from of_list(table.slice(at, stop - at))
            held = table.slice(opens[-1])
        if held is not None and held.num_rows > 1:
            yield from of_list(held)

    return _undone(spread.mapInArrow(run, "a binary, b binary"), answers)


def groups(docs: DataFrame, words_each: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every row."""
    if words_each < 1 or not 0 < percent <= 100:
        raise ValueError("shingles have a word at least, and the similarity is above 0 and at most 100 %")
    found = sets(docs, words_each, percent)
    lists = index_lists(found)
    reach = _may_reach(*(F.col(x) for x in ("n", "pos", "leader_n", "leader_pos")), percent)
    star = lists.where((F.col("sig") != F.col("leader")) & reach)
    star = star.select(F.col("leader").alias("a"), F.col("sig").alias("b")).distinct()
    first = compared(found, star)
    answers = first
    roots = stored(components(_links(first, percent)), "roots")
    entries = open_lists(lists, roots)
    for _ in range(1, LEADERS):
        led = with_next_leader(entries)
        answers = answers.union(compared(found, led_pairs(led, answers, percent)))
        roots = stored(components(_links(answers, percent)), "roots")
        # A leader has been compared with all of its list that it could be linked with.
        entries = open_lists(led.where(F.col("sig") != F.col("first.sig")).drop("first"), roots)
        if entries.isEmpty():
            break
    # Bounds come from the first leaders, which all sets of their lists were compared with.
    answers = answers.union(compared(found, left_pairs(entries, answers, percent)))
    roots = components(_links(answers, percent))
    distinct = found.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first"))
    placed = distinct.join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    placed = stored(placed.select("sig", "first", F.coalesce("root", "sig").alias("root")), "placed")
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    named = placed.join(least, "root").select("sig", "least")
    return found.join(named, "sig", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
