"""Language-model scores from a probabilistic suffix tree over words.

Contexts are grown level by level from the training documents, up to ``DEPTH`` words: a context or a
next symbol is a candidate if it was seen ``LEAST`` times, whatever the size of the corpus, and a
context is retained if its next-symbol distribution diverges from its suffix's by more than
``DIVERGENCE`` (Kullback-Leibler, times its count). Next symbols that are candidates keep their own
probability, discounted; the rest of the mass goes to the suffix's distribution, down to the root,
which is the add-one unigram distribution. So every state's distribution sums to one, and a text is
scored by the longest retained suffix before each token.

Sizes: vocabulary and tree grow with the corpus, so neither is broadcast nor collected. Each block
of documents asks for the counts of its distinct words, then, level by level, for its distinct
contexts and next symbols; buckets of words and of contexts add up the counts, decide, and answer.
Words, and strings of words that may be contexts of the next level, get exact numbers from their
bucket. Sequences and answers are kept in tables dealt by block, so each answer moves once and the
levels above read it where it is. A context seen more than ``HOT`` times is dealt over several buckets by its next symbols;
only the sums of such contexts pass the driver, at most two rows for each ``HOT`` training tokens.

Defined cases: null and empty texts are one end token; a null doc_id counts as the text "" and so
is trained on; rows that repeat an id are rows of their own; without any training document every
count is 0 and the only outcome is the unknown word; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import (
    ASK_SCHEMA,
    BLOCK_BYTES,
    BlockTable,
    ask,
    cut_blocks,
    meet,
    narrow,
    open_block,
    pack,
    remove,
    runs,
    scratch_folder,
    stored,
    unpack,
)

LEAST = 2
DEPTH = 2
HOT = 1_000_000
BLOCK = 8 * 1024**2  # bytes of text: a task holds some thirty numbers for each of its tokens
DIVERGENCE = 3.0
DISCOUNT = 0.7
FOLDS, HELD_OUT = 7, 2  # fixed by the contract
END = b"\n"  # no word can hold it, so it stands for the end of a text
SHIFT = np.int64(1 << 24)  # numbers of frequent words of a tree in memory are below it


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


@dataclass
class Sequence:
    """Texts as word numbers: distinct words, the numbers, where each text ends."""

    words: list[bytes]
    numbers: np.ndarray
    ends: np.ndarray


def sequence(texts: list[bytes]) -> Sequence:
    offsets = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    data = b"".join(texts).lower()
    lowered = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data))
    split = pc.ascii_split_whitespace(lowered)
    words = split.flatten()
    filled = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves empty ones
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False), dtype=np.int64)])
    ends = before[split.offsets.to_numpy()[1:]] + np.arange(1, len(texts) + 1)
    coded = words.filter(filled).dictionary_encode()
    numbers = np.zeros(len(coded) + len(texts), np.int64)
    inner = np.ones(len(numbers), bool)
    inner[ends - 1] = False
    numbers[inner] = coded.indices.to_numpy() + np.int64(1)
    sizes = pc.binary_length(coded.dictionary).to_numpy()
    known = _split(sizes, np.frombuffer(coded.dictionary.buffers()[2] or b"", np.uint8))
    return Sequence([END, *known], numbers, ends)


def _block_texts(row: dict) -> tuple[list, list[bytes]]:
    ids, offsets, data = open_block(row)
    return ids, [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _trained(ids: list, found: Sequence) -> np.ndarray:
    """True for the tokens of training texts."""
    chosen = np.array([not held_out(i) for i in ids], bool)
    return np.repeat(chosen, np.diff(np.concatenate([[0], found.ends])))


def _planes(x: np.ndarray) -> np.ndarray:
    """Numbers as bytes of one place after the other, which compress better: :func:`_numbers`."""
    x = x if x.dtype.kind == "f" else narrow(x)
    head = np.frombuffer(x.dtype.str[1:].encode().ljust(4), np.uint8)
    return np.concatenate([head, x.view(np.uint8).reshape(-1, x.itemsize).T.ravel()])


def _numbers(x: np.ndarray) -> np.ndarray:
    kind = np.dtype(x[:4].tobytes().decode().strip())
    return np.ascontiguousarray(x[4:].reshape(kind.itemsize, -1).T).view(kind).ravel()


# Sorting


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, not below 0, in ascending order, and the place of each, as from a stable argsort.

    Keys and places are sorted as one number where they fit into it, which is several times faster."""
    bits = max(len(keys) - 1, 1).bit_length()
    if int(keys.max(initial=0)) >> (63 - bits):
        order = np.argsort(keys, kind="stable")
        return keys[order], order
    both = keys.astype(np.int64)
    both <<= bits
    both |= np.arange(len(keys))
    both.sort()
    place = both & ((1 << bits) - 1)
    both >>= bits
    return both, place


def different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, not below 0, in ascending order, and which of them each key is."""
    ordered, place = ranked(keys)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    ordered = ordered[new]
    which = np.empty(len(new), np.int64)
    which[place] = np.cumsum(new)
    which -= 1
    return ordered, which


# Counts of words


def _counts(ids: list, found: Sequence) -> np.ndarray:
    """Training count of each distinct word."""
    return np.bincount(found.numbers[_trained(ids, found)], minlength=len(found.words))


def _split(sizes: np.ndarray, data: np.ndarray) -> list[bytes]:
    data = data.tobytes()
    ends = np.cumsum(sizes.astype(np.int64)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


SEQUENCES = "block long, ids array<long>, crc long, words binary, payload binary"


def sequences(blocks: DataFrame, buckets: int) -> DataFrame:
    """Blocks of texts as sequences: distinct words by bucket with training counts, and where each
    text ends and the word of each token. So answers for words come in the words' order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, texts = _block_texts(row)
                found = sequence(texts)
                bucket, order = _word_order(found.words, buckets)
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                words = [found.words[i] for i in order]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                data = np.frombuffer(b"".join(words), np.uint8)
                counts = _counts(ids, found)[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([ids], pa.list_(pa.int64())),
                        pa.array([row["crc"]], pa.int64()),
                        pa.array([pack(narrow(edges), narrow(sizes), narrow(counts), data)], pa.binary()),
                        pa.array([pack(narrow(found.ends), _planes(place[found.numbers]))], pa.binary()),
                    ],
                    names=["block", "ids", "crc", "words", "payload"],
                )
                del found, words, data, texts
                pa.default_memory_pool().release_unused()

    return blocks.mapInArrow(run, SEQUENCES)


def _word_order(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    return bucket, ranked(bucket)[1]


def word_counts(blocks: DataFrame, buckets: int, listed: bool = True) -> DataFrame:
    """Per block and bucket, the training counts and numbers of the words asked; and, as a block
    below 0, per bucket the number of tokens and of distinct words, and if ``listed`` its words by
    count."""

    def request(row: dict) -> Iterator[tuple[int, bytes]]:
        if "words" in row:
            edges, sizes, counts, data = unpack(row["words"])
            at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            for b in np.flatnonzero(np.diff(edges)):
                first, last = edges[b], edges[b + 1]
                some = data[at[first] : at[last]]
                yield int(b), pack(narrow(sizes[first:last]), narrow(counts[first:last]), some)
            return
        ids, texts = _block_texts(row)
        found = sequence(texts)
        words, counts = found.words, _counts(ids, found)
        bucket, order = _word_order(words, buckets)
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            some = order[edges[b] : edges[b + 1]]
            chosen = [words[i] for i in some]
            sizes = np.fromiter(map(len, chosen), np.int64, len(chosen))
            data = np.frombuffer(b"".join(chosen), np.uint8)
            yield int(b), pack(narrow(sizes), narrow(counts[some]), data)

    def answer(rows: pa.Table) -> pa.Table:
        given = [unpack(blob.as_py()) for blob in rows.column("payload")]
        sizes, data = (np.concatenate([x[i] for x in given]) for i in (0, 2))
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        asked = np.split(
            words.indices.to_numpy().astype(np.int64), np.cumsum([len(x[0]) for x in given])[:-1]
        )
        sums = np.zeros(len(words.dictionary), np.int64)
        for where, (_, counts, _) in zip(asked, given, strict=True):
            np.add.at(sums, where, counts.astype(np.int64))
        bucket = rows.column("bucket")[0].as_py()
        payload = [pack(narrow(sums[where]), _planes(where * buckets + bucket)) for where in asked]
        seen = np.flatnonzero(sums)
        n_seen = len(seen)
        seen = seen[np.argsort(-sums[seen], kind="stable")] if listed else seen[:0]
        n = len(payload)
        return pa.table(
            {
                "bucket": pa.array([bucket] * (n + 1), pa.int32()),
                "block": pa.concat_arrays(
                    [rows.column("block").combine_chunks(), pa.array([-1 - bucket], pa.int64())]
                ),
                "crc": pa.concat_arrays(
                    [rows.column("crc").combine_chunks(), pa.array([0], pa.int64())]
                ),
                "payload": pa.array([*payload, None], pa.binary()),
                "tokens": pa.array([None] * n + [int(sums.sum())], pa.int64()),
                "distinct": pa.array([None] * n + [n_seen], pa.int64()),
                "words": pa.array([None] * n + [words.dictionary.take(seen).to_pylist()], pa.list_(pa.binary())),
                "counts": pa.array([None] * n + [sums[seen].tolist()], pa.list_(pa.int64())),
            }
        )

    return (
        ask(blocks, request, None)
        .groupBy("bucket")
        .applyInArrow(
            answer,
            "bucket int, block long, crc long, payload binary, tokens long, distinct long, "
            "words array<binary>, counts array<long>",
        )
    )


# The tree


@dataclass
class Level:
    """Next symbols of contexts: keys are context * SHIFT + word, ascending."""

    keys: np.ndarray
    chance: np.ndarray  # discounted probability of the symbol itself
    rest: np.ndarray  # by context: mass left to the suffix
    retained: np.ndarray  # by context


@dataclass
class Model:
    numbers: dict[bytes, int]  # frequent words
    tokens: int
    distinct: int
    pairs: np.ndarray  # keys of frequent pairs, ascending: contexts of two words by place
    levels: list[Level]


def count_level(blocks_of: DataFrame, numbers: dict, pairs: np.ndarray | None, least: int):
    """(keys, counts) of training pairs of frequent words, or of a frequent pair and a word.

    Counts combine per block first, then in Spark; only keys with ``least`` or more leave it.
    """
    spark = blocks_of.sparkSession
    shared = spark.sparkContext.broadcast((numbers, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chosen = shared.value
        for ids, texts in runs(batches, BLOCK_BYTES):
            found = sequence(texts)
            keys = _keys(found, known, chosen)
            keys = keys[(keys >= 0) & _trained(ids, found)]
            keys, counts = np.unique(keys, return_counts=True)
            for a in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a : a + 100_000]), pa.array(counts[a : a + 100_000])],
                    names=["key", "n"],
                )

    counted = (
        blocks_of.mapInArrow(run, "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )
    table = counted.toArrow()
    keys = table.column("key").to_numpy()
    order = np.argsort(keys, kind="stable")
    return keys[order], table.column("n").to_numpy()[order]


def _frequent(found: Sequence, known: dict) -> np.ndarray:
    """Number of each token's word among the frequent ones, or -1."""
    return np.fromiter((known.get(w, -1) for w in found.words), np.int64, len(found.words))[
        found.numbers
    ]


def _before(x: np.ndarray, found: Sequence, steps: int) -> np.ndarray:
    """``x`` of the token so many places before in the same text, or -1."""
    out = np.full(len(x), -1, np.int64)
    out[steps:] = x[: len(x) - steps]
    starts = np.concatenate([[0], found.ends])[:-1]
    for k in range(steps):
        at = starts + k
        out[at[at < len(x)]] = -1
        # A text of one token: the place after its start belongs to the next text, which is set too.
    return out


def _keys(found: Sequence, known: dict, pairs: np.ndarray | None) -> np.ndarray:
    number = _frequent(found, known)
    one = _before(number, found, 1)
    if pairs is None:
        return np.where((one >= 0) & (number >= 0), one * SHIFT + number, -1)
    context = _pair_context(found, number, pairs)
    return np.where((context >= 0) & (number >= 0), context * SHIFT + number, -1)


def _pair_context(found: Sequence, number: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Place of the pair of words before each token among the frequent pairs, or -1."""
    one, two = _before(number, found, 1), _before(number, found, 2)
    key = np.where((one >= 0) & (two >= 0), two * SHIFT + one, -1)
    return find(pairs, key)


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in an ascending table, or -1."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where((table[place] == keys) & (keys >= 0), place, -1)


def _sums(context, counts, totals, suffix_chance) -> list[np.ndarray]:
    """By context: discounted and plain mass of its next symbols, their divergence, and their mass
    in the suffix's distribution. Shares of a context's next symbols add up."""
    total = totals[context].astype(float)
    plain = counts / total
    return [
        np.bincount(context, x, len(totals)).astype(float)
        for x in (
            (counts - DISCOUNT) / total,
            plain,
            plain * np.log(plain / suffix_chance),
            suffix_chance,
        )
    ]


def _decide(totals, kept, shared, gain, below) -> tuple[np.ndarray, np.ndarray]:
    """By context: the mass left to the suffix, and whether the context is retained."""
    gain = gain.copy()
    left, suffix_left = 1 - shared, 1 - below
    some = (left > 1e-12) & (suffix_left > 1e-12)
    gain[some] += left[some] * np.log(left[some] / suffix_left[some])
    return np.clip(1 - kept, 0, 1), (kept > 0) & (gain * totals > DIVERGENCE)


def grow(keys, counts, context_counts, suffix_chance) -> Level:
    """A level of the tree: discounted next symbols, rest mass, and the divergence test."""
    context = keys // SHIFT
    chance = (counts - DISCOUNT) / context_counts[context].astype(float)
    sums = _sums(context, counts, context_counts, suffix_chance)
    rest, retained = _decide(context_counts, *sums)
    return Level(keys, chance, rest, retained)


def _sizes(counted: DataFrame, share: float) -> tuple[int, int, int]:
    """Training tokens, distinct words, and the count from which on a candidate is one."""
    sums = counted.where("block < 0").agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct = int(sums[0] or 0), int(sums[1] or 0)
    return tokens, distinct, max(LEAST, int(np.ceil(share * tokens)))


def learn(docs: DataFrame, counted: DataFrame, share: float = 0.0) -> Model:
    """The tree of two levels in the driver's memory: for small corpora, to hold scores against."""
    stats = counted.where("block < 0")
    tokens, distinct, least = _sizes(counted, share)
    listed = (
        stats.select(F.explode(F.arrays_zip("words", "counts")).alias("x"))
        .select("x.words", "x.counts")
        .where(F.col("counts") >= least)
        .toArrow()
    )
    words = listed.column("words").to_pylist()
    counts = listed.column("counts").to_numpy()
    order = sorted(range(len(words)), key=lambda i: words[i])
    numbers = {words[i]: k for k, i in enumerate(order)}
    word_count = counts[np.array(order, np.int64)] if len(order) else counts
    root = (word_count + 1) / (tokens + distinct + 1)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pairs, pair_count = count_level(plain, numbers, None, least)
    one = grow(pairs, pair_count, word_count, root[pairs % SHIFT])
    triples, triple_count = count_level(plain, numbers, pairs, least)
    # What the suffix, a context of one word, gives to the last word of each triple.
    last = pairs[triples // SHIFT] % SHIFT
    word = triples % SHIFT
    two = grow(triples, triple_count, pair_count, _chance(one, last, word, root[word]))
    return Model(numbers, tokens, distinct, pairs, [one, two])


def _chance(level: Level, context: np.ndarray, word: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probability of words (-1: not frequent) after contexts (-1: none), given the suffix's."""
    known = context >= 0
    if not known.any() or not len(level.retained):
        return below
    known &= level.retained[np.maximum(context, 0)]
    place = find(level.keys, np.where(known & (word >= 0), context * SHIFT + word, -1))
    own = np.where(place >= 0, level.chance[np.maximum(place, 0)] if len(level.chance) else 0.0, 0.0)
    return np.where(known, own + level.rest[np.maximum(context, 0)] * below, below)


# The tree as tables


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit values of integers."""
    z = np.asarray(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _context_bucket(number: np.ndarray, part: np.ndarray, buckets: int) -> np.ndarray:
    mixed = _mix(number) + _mix(part)
    return (_mix(mixed) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Walk:
    """A block at a level of the tree: its distinct strings of a context and a word there (at the
    root, its distinct words), and for each token the string that ends with it."""

    ends: np.ndarray
    trained: np.ndarray
    words: np.ndarray  # number of each distinct word
    index: np.ndarray  # by token: its distinct word
    place: np.ndarray  # by token: its string, or -1
    number: np.ndarray  # by string
    n: np.ndarray  # by string: training count, 0 if no candidate
    below: np.ndarray  # by token: probability after the longest retained context so far


@dataclass
class Question:
    """What a block asks at a level: units are contexts by bucket, each with its next symbols."""

    before: np.ndarray  # by token: its context as a string of the level below, or -1
    place: np.ndarray  # by token: its next symbol, or -1
    context: np.ndarray  # by next symbol
    order: np.ndarray  # next symbols as asked
    units: np.ndarray  # context of each unit
    packed: list[tuple[int, bytes]]


def question(walk: Walk, least: int, buckets: int, hot: int, again: bool = False) -> Question:
    """Contexts of the level above the walk's, and the next symbols that can be candidates there:
    a string is seen no more often than its suffix. ``again``: it was asked, so nothing is packed."""
    n, place = walk.n, walk.place
    before = _before(place, walk, 1)
    at = np.flatnonzero(before >= 0)
    at = at[n[before[at]] >= least]
    keep = np.full(len(before), -1, np.int64)
    keep[at] = before[at]
    asked = np.flatnonzero(np.bincount(before[at], minlength=len(n)))
    asked = asked[n[asked] <= hot]
    at = at[place[at] >= 0]
    at = at[n[place[at]] >= least]
    size = len(walk.words)
    keys, inverse = different(keep[at] * size + walk.index[at])
    new = np.full(len(before), -1, np.int64)
    new[at] = inverse
    if not again:
        a_token = np.zeros(len(keys), np.int64)
        a_token[inverse] = at
        suffix = walk.below[a_token].astype(np.float32)
        counts = np.bincount(inverse[walk.trained[at]], minlength=len(keys))
        del a_token
    del at, before, inverse
    context, last = np.divmod(keys, size)
    word = walk.words[last]
    del keys

    strings = max(len(n), 1)
    home = _context_bucket(walk.number[asked], np.zeros(len(asked), np.int64), buckets)
    bucket = np.zeros(len(n), np.int64)
    bucket[asked] = home
    bucket = bucket[context]
    crowded = np.flatnonzero(n[context] > hot)
    own = context[crowded]
    part = _mix(word[crowded]) % (-(-n[own] // hot)).astype(np.uint64)
    bucket[crowded] = _context_bucket(walk.number[own], part, buckets)
    shares, share = np.unique(bucket[crowded] * strings + own, return_inverse=True)
    units = np.concatenate([asked, shares % strings])
    homes = np.concatenate([home, shares // strings])
    by_home = ranked(walk.number[units])[1]
    by_home = by_home[ranked(homes[by_home])[1]]
    if not again:
        rank = np.empty(len(units), np.int64)
        rank[by_home] = np.arange(len(units))
        of = np.zeros(len(n), np.int64)
        of[asked] = rank[: len(asked)]
        of = of[context]
        of[crowded] = rank[len(asked) + share]
    units = units[by_home]
    nth = np.empty(size, np.int64)
    nth[ranked(walk.words)[1]] = np.arange(size)
    order = ranked(bucket * size + nth[last])[1]
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    edges = np.searchsorted(homes[by_home], np.arange(buckets + 1))
    packed = []
    for b in np.flatnonzero(np.diff(edges)):
        if again:
            packed.append((int(b), b""))
            continue
        own = units[edges[b] : edges[b + 1]]
        some = order[ends[b] : ends[b + 1]]
        blob = pack(
            _planes(np.diff(walk.number[own], prepend=0)),
            _planes(n[own]),
            _planes(of[some] - edges[b]),
            _planes(np.diff(word[some], prepend=0)),
            narrow(counts[some]),
            _planes(suffix[some[counts[some] > 0]]),  # a candidate was seen in some training text
            level=3,
        )
        packed.append((int(b), blob))
    return Question(keep, new, context, order, units, packed)


def climb(
    walk: Walk, asked: Question, given: list[bytes], crowd: tuple, buckets: int, hot: int
) -> Walk:
    """The walk one level up, by the answers in the order of their buckets."""
    answers = []
    for (bucket, _), blob in zip(asked.packed, given, strict=True):
        rest, n, rank = unpack(blob)
        answers.append((_numbers(rest), n, _numbers(rank).astype(np.int64) * buckets + bucket))
    join = lambda i, kind: np.concatenate([np.zeros(0, kind), *[x[i].astype(kind) for x in answers]])
    rest = np.full(len(walk.n), -1.0)
    rest[asked.units] = join(0, np.float64)
    crowded = np.flatnonzero(walk.n > hot)
    at = find(crowd[0], walk.number[crowded])
    rest[crowded] = np.where(at >= 0, crowd[1][at], -1.0) if len(crowd[0]) else -1.0
    n, number = np.zeros(len(asked.order), np.int64), np.zeros(len(asked.order), np.int64)
    n[asked.order] = join(1, np.int64)
    numbers = join(2, np.int64)
    if len(numbers):  # the last level has none
        number[asked.order[n[asked.order] > 0]] = numbers
    own = np.where(n > 0, (n - DISCOUNT) / walk.n[asked.context], 0.0)
    below = walk.below.copy()
    tokens = np.flatnonzero(asked.before >= 0)
    left = rest[asked.before[tokens]]
    tokens, left = tokens[left >= 0], left[left >= 0]
    below[tokens] *= left
    known = tokens[asked.place[tokens] >= 0]
    below[known] += own[asked.place[known]]
    return Walk(walk.ends, walk.trained, walk.words, walk.index, asked.place, number, n, below)


def level_answers(asked: DataFrame, least: int, hot: int, last: bool) -> DataFrame:
    """Per block and bucket: what is left to the suffix by unit (-1 if not retained), count and
    (but for the last level) number by next symbol; and, as a block below 0, the sums of a
    bucket's shares of hot contexts."""

    def answer(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        given, start = [], 0
        for blob in rows.column("payload"):
            number, total, of, word, count, suffix = unpack(blob.as_py())
            number, total, word = (_numbers(x).astype(np.int64) for x in (number, total, word))
            of = _numbers(of).astype(np.int64) + start
            given.append((np.cumsum(number), total, of, np.cumsum(word), count, _numbers(suffix)))
            start += len(number)
        number, total, of, word, count, suffix = (np.concatenate(x) for x in zip(*given, strict=True))
        spans = [(len(x[0]), len(x[2])) for x in given]
        del given
        contexts, unit = different(number)
        totals = np.zeros(len(contexts), np.int64)
        totals[unit] = total
        if len(contexts) * (int(word.max(initial=0)) + 1) >= 1 << 63:
            _, word = different(word)
        top = int(word.max(initial=0)) + 1
        keys, symbol = different(unit[of] * top + word)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, symbol, count)
        chance = np.zeros(len(keys))
        chance[symbol[count > 0]] = suffix
        often = np.flatnonzero(n >= least)
        sums = _sums(keys[often] // top, n[often], totals, chance[often])
        rest, retained = _decide(totals, *sums)
        rest[~retained] = -1.0
        new = np.zeros(len(keys), np.int64)
        new[often] = np.arange(len(often))  # the asking block makes it a number of all buckets
        n[n < least] = 0
        payload, u, s = [], 0, 0
        for n_units, n_symbols in spans:
            units, symbols = unit[u : u + n_units], symbol[s : s + n_symbols]
            found = symbols[:0] if last else symbols[n[symbols] > 0]
            payload.append(pack(_planes(rest[units]), narrow(n[symbols]), _planes(new[found]), level=3))
            u, s = u + n_units, s + n_symbols
        crowded = np.flatnonzero(totals > hot)
        shares = pack(contexts[crowded], totals[crowded], *[x[crowded] for x in sums])
        more = [shares] if len(crowded) else []
        return pa.table(
            {
                "bucket": pa.array([bucket] * (len(spans) + len(more)), pa.int32()),
                "block": pa.array([*rows.column("block").to_pylist(), *[-1 - bucket] * len(more)], pa.int64()),
                "crc": pa.array([*rows.column("crc").to_pylist(), *[0] * len(more)], pa.int64()),
                "payload": pa.array([*payload, *more], pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(answer, ASK_SCHEMA)


def crowded_contexts(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the hot contexts, ascending, and what each leaves to its suffix (or -1)."""
    rows = answers.where("block < 0").orderBy("bucket").select("payload").collect()
    shares = [unpack(bytes(r.payload)) for r in rows]
    if not shares:
        return np.zeros(0, np.int64), np.zeros(0)
    number, total, *sums = (np.concatenate(x) for x in zip(*shares, strict=True))
    contexts, at = np.unique(number, return_inverse=True)
    totals = np.zeros(len(contexts), np.int64)
    totals[at] = total
    rest, retained = _decide(totals, *[np.bincount(at, x, len(contexts)) for x in sums])
    return contexts, np.where(retained, rest, -1.0)


SUMS = ("tokens", "distinct")
RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def scores(
    docs: DataFrame,
    share: float = 0.0,
    rows_a_bucket: int = 2000,
    depth: int = DEPTH,
    hot: int = HOT,
) -> DataFrame:
    """Base and suffix-tree log10 probabilities of every document.

    Candidates are seen ``LEAST`` times; ``share`` of all training tokens asks for more.
    """
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    buckets = max(64, -(-size.rows // rows_a_bucket))
    homes = max(8, -(-(size.bytes or 0) // BLOCK))
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    found = stored(sequences(cut_blocks(docs, BLOCK, exchange=False), buckets), "sequences", folder)
    with BlockTable(spark, homes, "blocks") as kept, BlockTable(spark, homes, "answers") as answers:
        blocks = kept.add(found.select("block", "ids", "crc", "payload"))
        asked = word_counts(found.select("block", "crc", "words"), buckets, listed=False)
        known = answers.add(_answers(asked, -buckets))
        remove(spark, folder)
        return _scored(blocks, answers, known, share, buckets, depth, hot)


def _answers(table: DataFrame, first: int) -> DataFrame:
    """Buckets count from ``first``: those of words below 0, then level by level."""
    bucket = (F.col("bucket") + F.lit(first)).cast("int").alias("bucket")
    sums = [F.col(c) if c in table.columns else F.lit(None).cast("long").alias(c) for c in SUMS]
    return table.select(bucket, "block", "crc", "payload", *sums)


def _scored(
    blocks: DataFrame,
    answers: BlockTable,
    known: DataFrame,
    share: float,
    buckets: int,
    depth: int,
    hot: int,
) -> DataFrame:
    """Scores from the stored sequences; ``answers`` has those for words and takes those of all
    levels, each moved once."""
    tokens, distinct, least = _sizes(known, share)
    parts = max(64, -(-tokens // 1_000_000))

    def root(row: dict, given: dict[int, bytes]) -> tuple[Walk, np.ndarray]:
        pa.default_memory_pool().release_unused()  # kept from blocks and steps before
        ends, index = unpack(row["payload"])
        ends, index = ends.astype(np.int64), _numbers(index).astype(np.int64)
        answers = [unpack(given[b]) for b in sorted(given) if b < 0]
        count = np.concatenate([x[0].astype(np.int64) for x in answers])
        numbers = np.concatenate([_numbers(x[1]).astype(np.int64) for x in answers])
        chosen = np.array([not held_out(i) for i in row["ids"]], bool)
        trained = np.repeat(chosen, np.diff(np.concatenate([[0], ends])))
        base = (count[index] + 1) / (tokens + distinct + 1)
        return Walk(ends, trained, numbers, index, index, numbers, count, base), count[index]

    def walked(walk: Walk, given: dict[int, bytes], crowds: list[tuple]) -> Walk:
        for level, crowd in enumerate(crowds):
            asked = question(walk, least, parts, hot, again=True)
            blobs = [given[level * parts + b] for b, _ in asked.packed]
            walk = climb(walk, asked, blobs, crowd, parts, hot)
            del asked, blobs
        return walk

    def asking(crowds: list[tuple]):
        def ask_level(row: dict, given: dict[int, bytes]) -> pa.Table:
            walk = walked(root(row, given)[0], given, crowds)
            packed = question(walk, least, parts, hot).packed
            return pa.table(
                {
                    "bucket": pa.array([b for b, _ in packed], pa.int32()),
                    "block": pa.array([row["block"]] * len(packed), pa.int64()),
                    "crc": pa.array([row["crc"]] * len(packed), pa.int64()),
                    "payload": pa.array([x for _, x in packed], pa.binary()),
                }
            )

        return ask_level

    def to_blocks(table: DataFrame) -> DataFrame:
        return table.where("block >= 0").select("bucket", "block", "crc", "payload")

    crowds: list[tuple] = []
    for level in range(depth):
        asked = meet(blocks, to_blocks(known), asking(list(crowds)), ASK_SCHEMA)
        last = level + 1 == depth
        known = answers.add(_answers(level_answers(asked, least, hot, last), level * parts))
        crowds.append(crowded_contexts(known.where(F.col("bucket") >= level * parts)))

    def finish(row: dict, given: dict[int, bytes]) -> pa.Table:
        walk, count = root(row, given)
        base, both = walk.below, walked(walk, given, crowds).below
        ids, ends = row["ids"], walk.ends
        starts = np.concatenate([[0], ends])[:-1]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array([held_out(i) for i in ids], pa.bool_()),
                "n_tokens": pa.array(ends - starts, pa.int64()),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), starts), pa.int64()),
                "train_tokens": pa.array([tokens] * len(ids), pa.int64()),
                "base_score": pa.array(np.add.reduceat(np.log10(base), starts), pa.float64()),
                "score": pa.array(np.add.reduceat(np.log10(both), starts), pa.float64()),
            }
        )

    return meet(blocks, to_blocks(known), finish, RESULT)
