"""Byte-level BPE over distinct words: encode, and decode through the token-byte table.

Texts are split into pre-tokens with their positions. Each block of documents asks for its distinct
pre-tokens only; a bucket of pre-tokens (by hash) encodes each distinct one once, whatever the
number of blocks that ask; the ids go back to the block, which puts them in place by position.
A very frequent word is asked for once per block, so no bucket holds its occurrences.

Decoding looks ids up in the token-byte table, whose size is the vocabulary's.

Defined cases: null and empty texts have no ids; null and repeated ids of documents are rows of
their own; an empty table gives an empty result; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tallyhouse.llm.shared import (
    ASK_SCHEMA,
    ask,
    cut_blocks,
    meet,
    narrow,
    open_block,
    pack,
    unpack,
)

BUCKETS = 512  # at least
ROWS_A_BUCKET = 1000  # documents for each bucket of distinct words beyond that


def rank_pattern(pattern: str) -> str:
    """The pre-token pattern with white space as the tokenizer library defines it."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str):
    """(encoder of one pre-token, token bytes end to end, their offsets) of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
    top = max(ranks.values()) + 1
    tokens = [b""] * top
    for token, rank in ranks.items():
        tokens[rank] = token
    offsets = np.zeros(top + 1, np.int64)
    np.cumsum([len(t) for t in tokens], out=offsets[1:])
    return encoding, np.frombuffer(b"".join(tokens), np.uint8), offsets


# No pre-token reaches over the start of a space followed by something else than white space, so a
# text may be cut there first; equal pieces are then split once per block.
CUT = regex.compile(r" (?=\P{White_Space})")


def pretokens(texts: list[str], pattern: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct pre-tokens, their numbers by position, pre-tokens per text)."""
    find = regex.compile(rank_pattern(pattern)).findall
    words: dict[str, int] = {}
    pieces: dict[str, int] = {}
    lists: list[list[int]] = []
    order: list[int] = []
    pieces_per_text = []
    for text in texts:
        # A cheap split at every space is the same unless a space is followed by white space.
        parts = text.split(" ") if _plain(text) else CUT.split(text)
        first = True
        for part in parts:
            piece = part if first else " " + part
            first = False
            number = pieces.get(piece)
            if number is None:
                number = pieces[piece] = len(lists)
                lists.append([words.setdefault(w, len(words)) for w in find(piece)])
            order.append(number)
        pieces_per_text.append(len(parts))
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((w for ws in lists for w in ws), np.int64, int(lengths.sum()))
    order = np.asarray(order, np.int64)
    sequence = gather(flat, starts_of(lengths)[order], lengths[order])
    per_piece = np.concatenate([[0], np.cumsum(lengths[order])])
    ends = np.cumsum(pieces_per_text)
    counts = np.diff(np.concatenate([[0], per_piece[ends]]))
    return [w.encode() for w in words], sequence, counts


SPACES = regex.compile(r" (?:\p{White_Space}|$)")


def _plain(text: str) -> bool:
    return SPACES.search(text) is None


def starts_of(lengths: np.ndarray) -> np.ndarray:
    starts = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return starts


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[start:start + length]`` one after another."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    shift = starts - starts_of(lengths)
    return flat[np.repeat(shift, lengths) + np.arange(total)]


def _buckets(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))


def _asks(row: dict, pattern: str, buckets: int) -> Iterator[tuple[int, bytes]]:
    _, offsets, data = open_block(row)
    texts = [data[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    words, _, _ = pretokens(texts, pattern)
    bucket = _buckets(words, buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        chosen = [words[i] for i in order[edges[b] : edges[b + 1]]]
        lengths = np.fromiter(map(len, chosen), np.int64, len(chosen))
        yield int(b), pack(narrow(lengths), np.frombuffer(b"".join(chosen), np.uint8))


def _encode(asked: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids of every asked pre-token, in the order asked; each distinct one is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _, _ = vocabulary(path, pattern)
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            answers = []
            for blob in batch.column("payload"):
                lengths, data = unpack(blob.as_py())
                data = data.tobytes()
                ends = np.cumsum(lengths.astype(np.int64)).tolist()
                start, ids = 0, []
                for end in ends:
                    word = data[start:end]
                    got = known.get(word)
                    if got is None:
                        got = known[word] = encoding._encode_single_piece(word)
                    ids.append(got)
                    start = end
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((x for xs in ids for x in xs), np.int64, int(counts.sum()))
                answers.append(pack(narrow(counts), narrow(flat)))
            payload = batch.schema.get_field_index("payload")
            yield batch.set_column(payload, "payload", pa.array(answers, pa.binary()))

    return asked.mapInArrow(run, ASK_SCHEMA)


def decode(ids: np.ndarray, tokens: np.ndarray, offsets: np.ndarray) -> bytes:
    """The bytes of some ids, by the token-byte table."""
    return gather(tokens, offsets[ids], offsets[ids + 1] - offsets[ids]).tobytes()


RESULT = "doc_id long, n_tokens long, ids binary, decoded binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _assemble(row: dict, answers: dict[int, bytes], path: str, pattern: str, buckets: int):
    """(id, ids as little-endian unsigned 32-bit integers, decoded bytes) per document."""
    names, offsets, data = open_block(row)
    texts = [data[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    words, sequence, counts = pretokens(texts, pattern)
    order = np.argsort(_buckets(words, buckets), kind="stable")
    parts = [unpack(answers[b]) for b in sorted(answers)]
    n_ids = np.zeros(len(words), np.int64)
    starts = np.zeros(len(words), np.int64)
    flat = np.zeros(0, np.uint32)
    if parts:
        n_ids[order] = np.concatenate([p[0] for p in parts]).astype(np.int64)
        flat = np.concatenate([p[1] for p in parts]).astype(np.uint32)
        starts[order] = starts_of(n_ids[order])
    _, tokens, token_offsets = vocabulary(path, pattern)
    at = 0
    for name, count in zip(names, counts.tolist(), strict=True):
        chosen = sequence[at : at + count]
        at += count
        ids = gather(flat, starts[chosen], n_ids[chosen])
        yield name, ids.astype("<u4"), decode(ids.astype(np.int64), tokens, token_offsets)


def encode_decode(
    docs: DataFrame,
    path: str,
    pattern: str,
    digests: bool = False,
    buckets: int | None = None,
    block_bytes: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the bytes decoded from them.

    With ``digests`` the SHA-256 of both stand in their place, so no blob leaves the task.
    """
    buckets = buckets or max(BUCKETS, -(-docs.count() // ROWS_A_BUCKET))
    blocks = cut_blocks(docs, **({"block_bytes": block_bytes} if block_bytes else {}), parts=parts)
    asked = ask(blocks, lambda row: _asks(row, pattern, buckets), parts)
    answers = _encode(asked, path, pattern)

    def finish(row: dict, given: dict[int, bytes]) -> pa.Table:
        found = [
            (
                name,
                len(ids),
                *(
                    (hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest())
                    if digests
                    else (ids.tobytes(), text)
                ),
            )
            for name, ids, text in _assemble(row, given, path, pattern, buckets)
        ]
        kind = pa.string() if digests else pa.binary()
        names = [x.split()[0] for x in (DIGESTS if digests else RESULT).split(", ")]
        kinds = [pa.int64(), pa.int64(), kind, kind]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return meet(blocks, answers, finish, DIGESTS if digests else RESULT)
