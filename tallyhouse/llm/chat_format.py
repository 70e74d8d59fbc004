r"""Chat formatting by columnar byte assembly.

Rows of a conversation become one text: ``<|turn|>role``, a line break, the content and
``<|end|>`` with a line break, turn by turn. Per Arrow batch the lengths of all headers, contents
and ends are computed, summed to offsets, and the bytes are scattered into one preallocated buffer
from which the Arrow column is made; no text is concatenated one by one.

Control strings inside roles and contents are made harmless reversibly: a backslash is doubled and
one is put after the first character of every control string; in a role, before a line break too.
The loss mask lists the code-point spans of assistant contents.

Defined cases: null texts and roles are empty; rows are ordered by turn (null first), then role,
then text; null conv_ids form one conversation; repeated rows are turns of their own; an empty table
gives no conversations. A conversation is one output row, so it must fit one Arrow string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import batch_texts

MOST_BYTES = 2**31  # offsets of a string column have 32 bits
TURN, END = "<|turn|>", "<|end|>"
# Control strings of this template and of other well-known ones.
CONTROLS = (
    TURN,
    END,
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
_HARM = re.compile("|".join([r"\\", *map(re.escape, CONTROLS)]))
_HARM_ROLE = re.compile("|".join([r"\\", "\n", *map(re.escape, CONTROLS)]))
_BACK = re.compile(r"\\(.)", re.S)
_ROLE_END = re.compile(r"(?:[^\\\n]|\\.)*\n", re.S)
OUTPUT_BYTES = 32 * 1024**2
FORMATTED = "conv_id long, n_turns long, formatted string, mask array<struct<start:long,end:long>>"


def escape(text: str, role: bool = False) -> str:
    def harmless(m: re.Match) -> str:
        found = m[0]
        if found in ("\\", "\n"):
            return "\\" + found
        return found[0] + "\\" + found[1:]

    return (_HARM_ROLE if role else _HARM).sub(harmless, text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def _escaped(text: bytes) -> bytes:
    if b"\\" in text or b"<" in text or b"[" in text:
        return escape(text.decode()).encode()
    return text


def assemble(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(one buffer holding the pieces end to end, their offsets with the end).

    Equal pieces (headers, ends) are held once in the pool; offsets and scatter indices decide where
    each lands.
    """
    pool: dict[bytes, int] = {}
    which = np.fromiter((pool.setdefault(p, len(pool)) for p in pieces), np.int64, len(pieces))
    kinds = list(pool)
    sizes = np.fromiter(map(len, kinds), np.int64, len(kinds))
    source = np.frombuffer(b"".join(kinds), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1] if kinds else sizes
    lengths = sizes[which] if kinds else which
    offsets = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    buffer = np.empty(int(offsets[-1]), np.uint8)
    step = 4096  # pieces scattered at a time, so index arrays stay small
    for a in range(0, len(pieces), step):
        b = min(a + step, len(pieces))
        n = lengths[a:b]
        at = np.arange(offsets[a], offsets[b])
        buffer[at] = source[np.repeat(starts[which[a:b]] - offsets[a:b], n) + at]
    return buffer, offsets


def _formatted(conv: list, roles: list[bytes], texts: list[bytes]) -> pa.RecordBatch:
    """All conversations of some ordered rows; equal neighbours in ``conv`` belong together."""
    headers: dict[bytes, bytes] = {}
    for role in set(roles):
        headers[role] = f"{TURN}{escape(role.decode(), role=True)}\n".encode()
    end = f"{END}\n".encode()
    pieces = [p for r, t in zip(roles, texts, strict=True) for p in (headers[r], _escaped(t), end)]
    buffer, offsets = assemble(pieces)
    first = [i for i in range(len(conv)) if i == 0 or conv[i] != conv[i - 1]]
    edges = np.array([*first, len(conv)], np.int64)
    bounds = offsets[3 * edges]
    if bounds[-1] >= MOST_BYTES:
        raise OverflowError(f"{bounds[-1]} bytes do not fit one Arrow string column")
    # Code points before each byte: all bytes but continuation bytes.
    points = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
    spoken = np.array([r == b"assistant" for r in roles], bool)
    origin = points[np.repeat(bounds[:-1], np.diff(edges))]
    starts = (points[offsets[1::3]] - origin)[spoken]
    ends = (points[offsets[2::3]] - origin)[spoken]
    spans = pa.StructArray.from_arrays([pa.array(starts), pa.array(ends)], names=["start", "end"])
    per = np.concatenate([[0], np.cumsum(spoken)])[edges].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([conv[i] for i in first], pa.int64()),
            pa.array(np.diff(edges), pa.int64()),
            pa.StringArray.from_buffers(
                len(first), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(buffer)
            ),
            pa.ListArray.from_arrays(pa.array(per), spans),
        ],
        names=["conv_id", "n_turns", "formatted", "mask"],
    )


def chat_format(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted and mask, one row per conversation."""
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, roles, texts, size = [], [], [], 0
        for batch in batches:
            for key, role, text in zip(
                batch.column(0).to_pylist(),
                batch_texts(batch.column(2)),
                batch_texts(batch.column(3)),
                strict=True,
            ):
                if conv and key != conv[-1]:
                    if size > OUTPUT_BYTES:
                        yield _formatted(conv, roles, texts)
                        conv, roles, texts, size = [], [], [], 0
                conv.append(key)
                roles.append(role)
                texts.append(text)
                size += len(text) + len(role)
        if conv:
            yield _formatted(conv, roles, texts)

    return ordered.mapInArrow(run, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        head = _ROLE_END.match(part)
        content = part[head.end() : part.rindex(END)]
        turns.append((unescape(head[0][:-1]), unescape(content)))
    return turns


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the mask, from the formatted output alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = parse(text)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                under = "".join(unescape(text[s["start"] : s["end"]]) for s in row["mask"])
                out.append(
                    (
                        row["conv_id"],
                        len(turns),
                        hashlib.sha256(whole.encode()).hexdigest(),
                        len(under),
                        hashlib.sha256(under.encode()).hexdigest(),
                        len(text),
                    )
                )
            names = [x.split()[0] for x in READ.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return formatted.select("conv_id", "formatted", "mask").mapInArrow(run, READ)
