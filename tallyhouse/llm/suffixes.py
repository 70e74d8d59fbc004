"""Exact removal of repeated 100-byte strings by blockwise suffix sorting with a cover sample.

The suffixes of all documents, as far as their first ``LENGTH`` bytes go, are brought into buckets
and sorted one bucket at a time; equal neighbours are repeats, and all but the earliest are removed.

A difference cover modulo ``PERIOD`` picks sample positions so that any two positions have a common
distance below ``PERIOD`` to samples. Two equal strings of ``LENGTH`` bytes therefore hold an equal
sampled string of ``LENGTH - PERIOD + 1`` bytes at the same place. The sampled strings are sorted and
ranked first; a suffix none of whose samples is repeated has no equal and needs no sorting. The
others enter their suffix bucket with a 64-bit key of their first ``LENGTH`` bytes, so the bucket
decides long ties in one comparison. Memory is bounded by one slice of documents on the asking and
one bucket of keys on the answering side.

Slices are doc_id ranges, so a smaller slice number is an earlier document, and what a slice sends
is its distinct keys in ascending order; the answer is one bit each: does it start in an earlier
slice? Repeats inside a slice are seen there. A passage in a third of all documents is one key per
slice.

Texts are dealt out by slice once, into a table that every step reads without a shuffle. The buckets
of suffixes take ``TURNS`` turns, of which each leaves one bit per key, and files of a turn are given
up before the next begins: so the disk holds the table and the keys of one turn, not all at once.

Keys are 64-bit hashes: two different strings among ``n`` share one with probability of about
``n * n / 2**65``.

Defined cases: null and empty texts have no bytes; texts shorter than ``LENGTH`` lose none; null ids
come last; rows that repeat an id stand in the order of their texts; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.ranges import slice_bounds, sliced
from tallyhouse.llm.shared import BlockTable, batch_texts, pack, stored, unpack

LENGTH = 100
PERIOD = 57
# A perfect difference set: every distance modulo 57 is a difference of two of its members.
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
SAMPLE_LENGTH = LENGTH - PERIOD + 1
SAMPLE_BITS = 44  # of the sample hashes that are compared: too few only lets more suffixes through
ROWS_EACH = 2048
TURNS = 2  # of the suffix buckets: more need less disk and go over the texts once more each
CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTERS = np.random.default_rng(7).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE)
        down = np.full(n, _BACK)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


class Hashes:
    """64-bit hashes of any substrings of one run of bytes, from running sums."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(20, int(len(data) + 1).bit_length())
        up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, length: int) -> np.ndarray:
        return _mixed((self.sums[starts + length] - self.sums[starts]) * self.down[starts])


def chunks(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``CHUNK`` bytes: (first, last + 1)."""
    first, at = 0, 0
    for i, end in enumerate(ends.tolist()):
        if i > first and end - at > CHUNK:
            yield first, i
            first, at = i, int(ends[i - 1])
    if first < len(ends):
        yield first, len(ends)


class Slice:
    """Documents of a slice in order, end to end."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        texts = list(batch_texts(table.column("text").combine_chunks()))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids = [ids[i] for i in order]
        self.sizes = np.array([len(texts[i]) for i in order], np.int64)
        self.data = np.frombuffer(b"".join([texts[i] for i in order]), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def chunks(self):
        """(hashes, first byte, last byte + 1, document of each byte's end) of runs of documents."""
        for a, b in chunks(self.ends):
            lo, hi = int(self.starts[a]), int(self.ends[b - 1])
            stop = np.repeat(self.ends[a:b], self.sizes[a:b])
            begin = np.repeat(self.starts[a:b], self.sizes[a:b])
            yield Hashes(self.data[lo:hi]), lo, hi, begin, stop

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, shortened hashes) of all cover samples."""
        member = np.zeros(PERIOD, bool)
        member[list(COVER)] = True
        places, values = [], []
        for hashes, lo, hi, begin, stop in self.chunks():
            at = np.arange(lo, hi)
            at = at[member[(at - begin) % PERIOD] & (at + SAMPLE_LENGTH <= stop)]
            places.append(at)
            values.append(hashes.of(at - lo, SAMPLE_LENGTH) >> np.uint64(64 - SAMPLE_BITS))
        return _joined(places, np.int64), _joined(values, np.uint64)

    def suffixes(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, keys) of the suffixes that hold a repeated sample near their start."""
        before = np.zeros(len(self.data) + PERIOD + 1, np.int32)
        before[repeated + 1] = 1
        np.cumsum(before, out=before)
        places, values = [], []
        for hashes, lo, hi, _, stop in self.chunks():
            at = np.arange(lo, hi)
            at = at[at + LENGTH <= stop]
            at = at[before[at + PERIOD] > before[at]]
            places.append(at)
            values.append(hashes.of(at - lo, LENGTH))
        return _joined(places, np.int64), _joined(values, np.uint64)


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _firsts(ascending: np.ndarray) -> np.ndarray:
    """Where each distinct one of ascending values begins."""
    new = np.ones(len(ascending), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
    return np.flatnonzero(new)


def _bucket(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Buckets of keys by their leading bits."""
    return (keys >> np.uint64(bits - 32)).astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)


def _dealt(keys: np.ndarray, bits: int, buckets: int, extra: np.ndarray | None = None):
    """(bucket, packed keys) of ascending keys, by their leading bits."""
    bucket = _bucket(keys, bits, buckets)
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(edges)):
        own = slice(edges[b], edges[b + 1])
        yield int(b), pack(*_steps(keys[own]), *([extra[own]] if extra is not None else []))


def _steps(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how many, bytes) of ascending keys: steps from one to the next, first all their lowest
    bytes, then all their second bytes and so on, as far as any is not zero."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = 8 - int(np.argmax(planes.any(axis=1)[::-1])) if planes.any() else 1
    return np.array([len(keys)], np.uint32), planes[:used].ravel()


def _keys(n: np.ndarray, planes: np.ndarray) -> np.ndarray:
    whole = np.zeros((8, int(n[0])), np.uint8)
    whole[: len(planes) // int(n[0])] = planes.reshape(-1, int(n[0]))
    return np.cumsum(np.ascontiguousarray(whole.T).view("<u8").ravel(), dtype=np.uint64)


ASKED = "bucket int, slice int, payload binary"


def _asked(number: int, parts) -> pa.Table:
    parts = list(parts)
    return pa.table(
        {
            "bucket": pa.array([b for b, _ in parts], pa.int32()),
            "slice": pa.array([number] * len(parts), pa.int32()),
            "payload": pa.array([p for _, p in parts], pa.binary()),
        }
    )


def _answered(asked: DataFrame, judge) -> DataFrame:
    """Per asked row, a bit for each of its keys from ``judge(lists, slices)``, bucket by bucket."""

    def run(rows: pa.Table) -> pa.Table:
        numbers = rows.column("slice").to_pylist()
        order = np.argsort(numbers, kind="stable")
        lists = [unpack(rows.column("payload")[int(i)].as_py()) for i in order]
        bits = judge(lists)
        return pa.table(
            {
                "bucket": rows.column("bucket"),
                "slice": pa.array([numbers[i] for i in order], pa.int32()),
                "payload": pa.array([pack(np.packbits(b)) for b in bits], pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(run, ASKED)


def _ranked(lists: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Samples that are repeated: in two slices, or twice in one."""
    keys = [_keys(*x[:2]) for x in lists]
    every = np.concatenate(keys)
    rank, counts = np.unique(every, return_counts=True)
    often = counts >= 2
    for own, (_, _, twice) in zip(keys, lists, strict=True):
        often[np.searchsorted(rank, own[twice.astype(bool)])] = True
    return [often[np.searchsorted(rank, own)] for own in keys]


def _sorted(lists: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Suffixes of a bucket that start in an earlier slice too: all but the first of equal keys.

    Lists come in slice order and the sort is stable, so of equal keys the earliest is first.
    """
    keys = [_keys(*x[:2]) for x in lists]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    later = np.zeros(len(every), bool)
    later[order[1:]] = every[order[1:]] == every[order[:-1]]
    return np.split(later, np.cumsum([len(k) for k in keys])[:-1])


def _bits(payloads: dict[int, bytes], counts: np.ndarray) -> np.ndarray:
    """Bits of all buckets of a slice, in key order."""
    parts = [
        np.unpackbits(unpack(payloads[b])[0])[: counts[b]] for b in sorted(payloads)
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _bucket_counts(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    return np.bincount(_bucket(keys, bits, buckets).astype(np.int64), minlength=buckets)


@contextmanager
def _own_files_only(spark: SparkSession) -> Iterator[None]:
    """Within this, Spark removes the shuffle files of a write as soon as the write ends.

    Frames that are only made, not run, within this would lose theirs too, and make them anew when
    they run again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def without_repeats(
    docs: DataFrame,
    digests: bool = False,
    rows_each: int = ROWS_EACH,
    rows_a_bucket: int = 1000,
    turns: int = TURNS,
) -> DataFrame:
    """What is left of every document: n_bytes, n_removed, n_spans and the kept bytes.

    With ``digests`` the SHA-256 of the kept bytes stands in their place.
    """
    n_buckets = max(64, -(-docs.count() // rows_a_bucket))
    bounds = slice_bounds(docs, rows_each)
    spark = docs.sparkSession
    with BlockTable(spark, len(bounds) + 2, "slices") as table:
        with _own_files_only(spark):
            rows = table.add(sliced(docs, bounds).withColumnRenamed("slice", "block"))
        return _judged(rows, n_buckets, turns, digests)


def _judged(rows: DataFrame, n_buckets: int, turns: int, digests: bool) -> DataFrame:
    """The result of slices (block, doc_id, text) that lie dealt by ``block``."""

    def ask_samples(table: pa.Table) -> pa.Table:
        _, values = Slice(table).samples()
        keys, counts = np.unique(values, return_counts=True)
        number = table.column("block")[0].as_py()
        return _asked(number, _dealt(keys, SAMPLE_BITS, n_buckets, (counts > 1).astype(np.uint8)))

    def repeated(own: Slice, payloads: dict[int, bytes]) -> np.ndarray:
        """Positions of repeated samples."""
        places, values = own.samples()
        keys, back = np.unique(values, return_inverse=True)
        bits = _bits(payloads, _bucket_counts(keys, SAMPLE_BITS, n_buckets))
        return places[bits[back]] if len(places) else places

    def ask_suffixes(turn: int):
        first, end = (-(-t * n_buckets // turns) for t in (turn, turn + 1))

        def run(table: pa.Table, answers: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _asked(0, [])
            own = Slice(table)
            given = dict(zip(*(answers.column(c).to_pylist() for c in ("bucket", "payload")), strict=True))
            _, values = own.suffixes(repeated(own, given))
            bucket = _bucket(values, 64, n_buckets)
            keys = np.sort(values[(bucket >= first) & (bucket < end)])
            number = table.column("block")[0].as_py()
            return _asked(number, _dealt(keys[_firsts(keys)], 64, n_buckets))

        return run

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = Slice(table)
        given: list[dict[int, bytes]] = [{}, {}]
        for row in answers.to_pylist():
            given[row["step"]][row["bucket"]] = row["payload"]
        places, values = own.suffixes(repeated(own, given[0]))
        order = np.argsort(values)
        begins = _firsts(values[order])
        earliest = np.minimum.reduceat(order, begins) if len(order) else order
        later = np.ones(len(values), bool)
        later[earliest] = _bits(given[1], _bucket_counts(values[earliest], 64, n_buckets))
        gone = np.zeros(len(own.data) + 1, np.int32)
        gone[places[later]] += 1
        gone[places[later] + LENGTH] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        return _kept(own, gone, digests)

    slices = rows.groupBy("block")
    with _own_files_only(rows.sparkSession):
        asked = slices.applyInArrow(ask_samples, ASKED)
        ranks = stored(_answered(asked.repartition("bucket"), _ranked), "ranks")
        answers = [ranks]
        for turn in range(turns):
            asked = slices.cogroup(ranks.groupBy("slice")).applyInArrow(ask_suffixes(turn), ASKED)
            answers.append(stored(_answered(asked.repartition("bucket"), _sorted), f"later{turn}"))
    steps = [x.select(F.lit(min(i, 1)).alias("step"), "*") for i, x in enumerate(answers)]
    both = reduce(DataFrame.unionByName, steps)
    return slices.cogroup(both.groupBy("slice")).applyInArrow(finish, DIGESTS if digests else RESULT)


def _kept(own: Slice, gone: np.ndarray, digests: bool) -> pa.Table:
    """Rows of the result from the bytes that are gone."""
    removed, spans, kept = [], [], []
    for a, b in zip(own.starts.tolist(), own.ends.tolist(), strict=True):
        mask = gone[a:b]
        n = int(mask.sum())
        removed.append(n)
        spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if n else 0)
        left = (own.data[a:b][~mask] if n else own.data[a:b]).tobytes()
        kept.append(hashlib.sha256(left).hexdigest() if digests else left)
    return pa.table(
        {
            "doc_id": pa.array(own.ids, pa.int64()),
            "n_bytes": pa.array(own.sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            ("kept_sha256" if digests else "kept"): pa.array(
                kept, pa.string() if digests else pa.binary()
            ),
        }
    )
