"""Token ids in binary files with Elias-Fano document boundaries.

A file holds the ids of consecutive documents end to end (16 bits each if the vocabulary fits) and
where each document ends as an Elias-Fano code: the low bits of every end packed, the high bits in
unary, and every 128th one's place as select samples. Finding a document's offsets is a select, so
no table of 64-bit offsets is kept: about ``2 + log2(ids / documents)`` bits a document.

Files are written by Spark in ascending doc_id order (range slices, each sorted), as binary rows of
a Parquet table, so that they reach any store Spark can write. A file starts at most ``FILE_IDS``
ids after it began; the ids before it come from the totals of the earlier files.

Ids are the tokenizer library's, called without special tokens of its own; a text that holds the
name of an added token, such as an end mark, gets that token there, as from the library. Equal space-delimited pieces are encoded once per worker and
remembered (a bounded memory, which only saves work): the pre-tokenizer never joins over the start
of a space followed by something else, so ids of pieces in a row are the ids of the text. Texts with
an added token's name are encoded whole.

Defined cases: null and empty texts have only the end id; null ids of documents come last; rows that
repeat an id stand in the order of their texts; an empty table gives no file.
"""

from __future__ import annotations

import re
import struct
import zlib
from codecs import charmap_decode
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.ranges import ROWS_EACH, slice_bounds, sliced
from tallyhouse.llm.shared import runs, stored

END_ID = 2
FILE_IDS = 4 * 1024**2
SAMPLE = 128
MAGIC = b"TLID"
HEAD = struct.Struct("<4sBBHQQQ")  # magic, bytes an id, low bits, unused, documents, ids, high bytes
REMEMBERED = 800_000  # pieces
ENCODED_BYTES = 4 * 1024**2  # of texts encoded together


# Elias-Fano


def elias_fano(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(low bits, packed low parts, unary high parts, select samples) of ascending numbers."""
    n = len(ends)
    top = int(ends[-1]) if n else 0
    low = max(0, int(np.log2(top / n))) if n and top > n else 0
    values = ends.astype(np.uint64)
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    unary[ones] = 1
    highs = np.packbits(unary, bitorder="little").tobytes()
    return low, lows, highs, ones[::SAMPLE].astype("<u4").tobytes()


class Boundaries:
    """Select over an Elias-Fano code."""

    def __init__(self, n: int, low: int, lows: bytes, highs: bytes, samples: bytes):
        self.n, self.low = n, low
        self.lows = np.frombuffer(lows, np.uint8)
        self.highs = np.frombuffer(highs, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def select(self, i: int) -> int:
        """The i-th number: from the sample before it, count ones up to the i-th."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        at = place >> 3
        while True:
            stop = at + 64
            bits = np.unpackbits(self.highs[at:stop], bitorder="little")
            if at == place >> 3:
                bits[: place & 7] = 0
            ones = np.flatnonzero(bits)
            if left < len(ones):
                one = at * 8 + int(ones[left])
                break
            left -= len(ones)
            at = stop
        return ((one - i) << self.low) | self._low(i)

    def _low(self, i: int) -> int:
        first, last = i * self.low, (i + 1) * self.low
        part = int.from_bytes(self.lows[first >> 3 : (last + 7) >> 3].tobytes(), "little")
        return (part >> (first & 7)) & ((1 << self.low) - 1)

    def selected(self, numbers: np.ndarray) -> np.ndarray:
        """The numbers at these places: one look at each sample's stretch that holds any of them."""
        numbers = np.asarray(numbers, np.int64)
        high = np.empty(len(numbers), np.int64)
        sample = numbers // SAMPLE
        order = np.argsort(sample, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(sample[order])) + 1) if len(order) else []:
            ones = self._ones(int(sample[group[0]]))
            high[group] = ones[numbers[group] % SAMPLE] - numbers[group]
        bits = numbers * self.low
        padded = np.concatenate([self.lows, np.zeros(8, np.uint8)])
        bytes_ = padded[(bits >> 3)[:, None] + np.arange(8)].astype(np.uint64)
        words = (bytes_ << (np.arange(8, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64)
        part = (words >> (bits & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)
        return (high << self.low) | part.astype(np.int64)

    def _ones(self, sample: int) -> np.ndarray:
        """Places of the ones from one sample up to the next."""
        first = int(self.samples[sample])
        last = int(self.samples[sample + 1]) if sample + 1 < len(self.samples) else 8 * len(self.highs)
        bits = np.unpackbits(self.highs[first >> 3 : (last + 7) >> 3], bitorder="little")
        ones = np.flatnonzero(bits) + (first >> 3 << 3)
        return ones[(ones >= first) & (ones < last)]


# Files


def write_file(ids: np.ndarray, ends: np.ndarray, id_bytes: int) -> bytes:
    low, lows, highs, samples = elias_fano(ends)
    head = HEAD.pack(MAGIC, id_bytes, low, 0, len(ends), len(ids), len(highs))
    return b"".join([head, ids.astype(f"<u{id_bytes}").tobytes(), lows, highs, samples])


def read_file(data: bytes) -> tuple[np.ndarray, Boundaries]:
    """(all ids, boundaries of the documents)."""
    magic, id_bytes, low, _, n, n_ids, n_high = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size
    ids = np.frombuffer(data, f"<u{id_bytes}", n_ids, at)
    at += n_ids * id_bytes
    n_low = (n * low + 7) // 8
    lows, highs = data[at : at + n_low], data[at + n_low : at + n_low + n_high]
    return ids, Boundaries(n, low, lows, highs, data[at + n_low + n_high :])


# Encoding


class _Known:
    """Ids of pieces by number, a bounded memory: when it is full, the pieces used most stay."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.starts = self.sizes = self.uses = np.zeros(0, np.int64)
        self.ids: np.ndarray | None = None

    def look_up(self, pieces: list[str]) -> tuple[np.ndarray, list[str]]:
        """The number of each piece, and the new pieces in the order of their numbers."""
        before = len(self.numbers)
        found = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        fresh = list(islice(reversed(self.numbers), len(self.numbers) - before))[::-1]
        more = np.zeros(len(fresh), np.int64)
        self.starts, self.sizes, self.uses = (
            np.concatenate([x, more]) for x in (self.starts, self.sizes, self.uses)
        )
        return found, fresh

    def learn(self, numbers: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Take the ids, end to end, of the pieces of these numbers."""
        held = ids[:0] if self.ids is None else self.ids
        self.starts[numbers] = len(held) + np.cumsum(sizes) - sizes
        self.sizes[numbers] = sizes
        self.ids = np.concatenate([held, ids])

    def taken(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the pieces of these numbers, end to end."""
        sizes = self.sizes[numbers]
        shift = self.starts[numbers] - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]

    def make_room(self) -> None:
        if len(self.numbers) <= REMEMBERED:
            return
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: REMEMBERED // 2])
        kept = kept[self.uses[kept] > 1]
        names = list(self.numbers)
        numbers = defaultdict(count(len(kept)).__next__)
        numbers.update((names[k], i) for i, k in enumerate(kept.tolist()))
        sizes, ids = self.sizes[kept], self.taken(kept)
        self.numbers, self.sizes, self.ids = numbers, sizes, ids
        self.starts, self.uses = np.cumsum(sizes) - sizes, self.uses[kept] // 2


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """(tokenizer, type of its ids, known pieces)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.uint32, _Known()


@lru_cache(maxsize=2)
def _added(path: str) -> re.Pattern | None:
    """Any name of an added token."""
    names = [t.content for t in _tokenizer(path)[0].get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, names))) if names else None


# Where a text may be cut: before a space that something else follows. Cheap tests first tell whether
# that is at every space, and whether every line break stands alone: then a line break is a pre-token
# of its own, and the text may be cut before it too.
CUT = regex.compile(r" (?=\P{White_Space})")
HEAD_MARK = "\n\n"  # goes before a text's first piece; all others stand after a space that is left out
# A Latin word, and marks (no apostrophe, which might belong to a word): two pre-tokens.
_WORD = re.compile(r"\n?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
# Of any form, but without a space inside: the space, or line break, before it starts it.
_PLAIN = re.compile(r"\n?\S+")
TOGETHER = 10_000  # pieces encoded by one call


def _evenly(text: str) -> bool:
    """Whether single spaces and line breaks, each with something after it, are all white space."""
    line = text.replace("\n", " ")
    return line.isprintable() and "  " not in line and not line.endswith(" ")


def _cut(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Pieces of texts end to end; where each text's pieces start there, and how many they are."""
    even = np.fromiter(map(_evenly, texts), bool, len(texts))
    marked = [HEAD_MARK + texts[i].replace("\n", " \n") for i in np.flatnonzero(even)]
    pieces = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
    others = [CUT.split(texts[i]) for i in np.flatnonzero(~even)]
    for parts in others:
        parts[0] = HEAD_MARK + parts[0]
    sizes = np.zeros(len(texts), np.int64)
    sizes[even] = pc.list_value_length(pieces).to_numpy()
    sizes[~even] = [len(parts) for parts in others]
    starts = np.empty(len(texts), np.int64)
    order = np.argsort(~even, kind="stable")
    starts[order] = np.cumsum(sizes[order]) - sizes[order]
    rest = pa.array(list(chain.from_iterable(others)), pa.large_string())
    return pa.concat_arrays([pieces.flatten(), rest]).dictionary_encode(), starts, sizes


def _letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others, in order, for the
    characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: 256 + i for i, b in enumerate(others)}


LETTERS = _letters()
ALPHABET = "".join(chr(LETTERS.get(b, b)) for b in range(256))


@lru_cache(maxsize=2)
def _openers(path: str) -> np.ndarray:
    """By id: whether the token starts with a space or a line break."""
    first = {ALPHABET[ord(" ")], ALPHABET[ord("\n")]}
    vocabulary = _tokenizer(path)[0].get_vocab()
    opens = np.zeros(max(vocabulary.values()) + 1, bool)
    opens[[i for token, i in vocabulary.items() if token[:1] in first]] = True
    return opens


def _words(words: list[str], path: str) -> tuple[list[int], list[int]]:
    """(sizes, ids end to end) of words: each is one pre-token, so the merges alone give its ids."""
    tokenize = _tokenizer(path)[0].model.tokenize
    line_break = ALPHABET[ord("\n")]
    text = "\0".join([w if w[0] == "\n" else " " + w for w in words])
    sizes, ids = [], []
    for letters in charmap_decode(text.encode(), "strict", ALPHABET)[0].split(ALPHABET[0]):
        if letters[0] == line_break:
            got = tokenize(line_break) + tokenize(letters[1:])
        else:
            got = tokenize(letters)
        sizes.append(len(got))
        ids += [t.id for t in got]
    return sizes, ids


def _alone(pieces: list[str], path: str) -> tuple[list[int], list[int]]:
    """(sizes, ids end to end) of pieces of any form, each encoded as a text."""
    texts = [
        p[len(HEAD_MARK) :] if p.startswith(HEAD_MARK) else p if p[:1] == "\n" else " " + p for p in pieces
    ]
    encoded = [x.ids for x in _tokenizer(path)[0].encode_batch(texts, add_special_tokens=False)]
    return [len(x) for x in encoded], list(chain.from_iterable(encoded))


def _together(pieces: list[str], path: str) -> tuple[list[int], list[int]]:
    """The same for pieces without spaces, encoded as one text: a space or a line break starts each."""
    text = "".join([p if p[0] == "\n" else " " + p for p in pieces])
    added = _added(path)
    if added is None or added.search(text) is None:  # a name may reach over several pieces
        ids = _tokenizer(path)[0].encode_batch_fast([text], add_special_tokens=False)[0].ids
        starts = np.flatnonzero(_openers(path)[ids])
        if len(starts) == len(pieces):
            return np.diff(starts, append=len(ids)).tolist(), ids
    return _alone(pieces, path)


def _learn(fresh: list[str], known: _Known, path: str) -> None:
    """Ids of new pieces, which have the last numbers: a word with marks takes those of its parts."""
    is_word, is_plain = _WORD.fullmatch, _PLAIN.fullmatch
    words, plain, others = ([], []), ([], []), ([], [])
    marked, parts = [], []
    for number, piece in enumerate(fresh, len(known.numbers) - len(fresh)):
        word = piece.rstrip(_MARKS)
        if is_word(word):
            if len(word) < len(piece):
                marked.append(number)
                parts += word, HEAD_MARK + piece[len(word) :]  # marks: as at the start of a text
                continue
            group = words
        else:
            group = plain if is_plain(piece) else others
        group[0].append(number)
        group[1].append(piece)
    pairs, more = known.look_up(parts)
    for number, piece in enumerate(more, len(known.numbers) - len(more)):
        group = others if piece.startswith(HEAD_MARK) else words
        group[0].append(number)
        group[1].append(piece)
    _, kind, _ = _tokenizer(path)
    for (numbers, pieces), ids_of in ((words, _words), (plain, _together), (others, _alone)):
        for at in range(0, len(pieces), TOGETHER):
            sizes, ids = ids_of(pieces[at : at + TOGETHER], path)
            known.learn(np.array(numbers[at : at + TOGETHER]), np.array(sizes), np.array(ids, kind))
    if marked:
        sizes = known.sizes[pairs].reshape(-1, 2).sum(axis=1)
        known.learn(np.array(marked), sizes, known.taken(pairs))


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of every text."""
    tokenizer, kind, _ = _tokenizer(path)
    added = _added(path)
    whole = [added is not None and added.search(text) is not None for text in texts]
    if not any(whole):
        return _encode_pieces(texts, path)
    named = tokenizer.encode_batch([t for t, w in zip(texts, whole, strict=True) if w], add_special_tokens=False)
    named = iter([np.array(x.ids, kind) for x in named])
    others = iter(_encode_pieces([t for t, w in zip(texts, whole, strict=True) if not w], path))
    return [next(named) if w else next(others) for w in whole]


def _encode_pieces(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of texts without names of added tokens."""
    if not texts:
        return []
    _, _, known = _tokenizer(path)
    known.make_room()
    pieces, starts, sizes = _cut(texts)
    numbers, fresh = known.look_up(pieces.dictionary.to_pylist())
    _learn(fresh, known, path)
    found = numbers[pieces.indices.to_numpy()]
    known.uses += np.bincount(found, minlength=len(known.uses))
    ids = known.taken(found)
    ends = np.concatenate([[0], np.cumsum(known.sizes[found])])
    spans = zip(ends[starts].tolist(), ends[starts + sizes].tolist(), strict=True)
    return [ids[a:b] for a, b in spans]


FILES = "slice int, part int, doc_ids array<long>, n_ids long, file binary"


def token_files(
    docs: DataFrame, path: str, end_id: int = END_ID, rows_each: int = ROWS_EACH,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Files of token ids: slice, part (their order), doc_ids, n_ids and the file's bytes."""
    bounds = slice_bounds(docs, rows_each)
    rows = sliced(docs, bounds)
    ordered = rows.repartition(len(bounds) + 2, "slice").sortWithinPartitions(
        "slice", F.col("doc_id").asc_nulls_last(), "text"
    )

    def sealed(number: int, part: int, names: list, ids: list) -> pa.RecordBatch:
        ends = np.cumsum([len(x) for x in ids])
        top = max(_tokenizer(path)[0].get_vocab_size(), end_id + 1)
        data = write_file(np.concatenate(ids), ends, 2 if top <= 1 << 16 else 4)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int32()),
                pa.array([part], pa.int32()),
                pa.array([names], pa.list_(pa.int64())),
                pa.array([int(ends[-1])], pa.int64()),
                pa.array([data], pa.binary()),
            ],
            names=["slice", "part", "doc_ids", "n_ids", "file"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, names, ids, held = None, 0, [], [], 0
        for places, texts in runs(batches, ENCODED_BYTES, keys=2):
            found = encode_texts([t.decode() for t in texts], path)
            for (n, key), got in zip(places, found, strict=True):
                if names and (n != number or held + len(got) >= file_ids):
                    yield sealed(number, part, names, ids)
                    part = part + 1 if n == number else 0
                    names, ids, held = [], [], 0
                number = n
                names.append(key)
                ids.append(np.append(got, got.dtype.type(end_id)))
                held += len(got) + 1
        if names:
            yield sealed(number, part, names, ids)

    return ordered.mapInArrow(run, FILES)


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32, from stored files."""
    totals = files.select("slice", "part", "n_ids")
    line = Window.orderBy("slice", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "slice", "part", F.coalesce(F.sum("n_ids").over(line), F.lit(0)).alias("before")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                ids, boundaries = read_file(row["file"].as_py())
                ends = boundaries.selected(np.arange(boundaries.n))
                starts = np.concatenate([[0], ends[:-1]])
                crc = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["slice"].as_py()] * n, pa.int32()),
                        pa.array([row["part"].as_py()] * n, pa.int32()),
                        pa.array(row["doc_ids"].as_py(), pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["slice", "part", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    found = files.select("slice", "part", "doc_ids", "file").mapInArrow(
        run, "slice int, part int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return found.join(before, ["slice", "part"]).select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def written(docs: DataFrame, path: str, **options) -> DataFrame:
    """Token files written to the shared folder and opened again."""
    return stored(token_files(docs, path, **options), "token_files")
