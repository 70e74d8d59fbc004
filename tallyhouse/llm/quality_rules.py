"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; versioned policies are masks over those bits, so a policy change or an ablation (what would be
kept without this rule?) reads only the ledger and never a text.

Defined cases: a null or empty text has no words, fails ``few_words`` and no ratio rule. Null and
repeated doc_ids stay rows of their own. Extra columns are not read. An empty table gives an empty
ledger.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.shared import batch_texts

WINDOW = 8
# Fixed by the contract.
SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper_words".split()
)

#: Rules by bit. Each is true where the document fails; the first two are the base rules.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines",
    "short_words": "n_words > 0 and word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "shouting": "n_words >= 20 and 100 * n_upper_words > 70 * n_words",
}
BASE = ("few_words", "repeated_words")
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    1: BASE,
    2: (*BASE, "many_symbols", "repeated_lines"),
    3: tuple(RULES),
}
CURRENT = 3


def mask(rules: tuple[str, ...]) -> int:
    """The bits of some rules."""
    return sum(1 << list(RULES).index(rule) for rule in rules)


def _repeated(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document, the words inside windows of eight that occur twice or more in it."""
    out = np.zeros(n_docs, np.int64)
    n = len(ids) - WINDOW + 1
    if n < 2:
        return out
    starts = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    if len(starts) < 2:
        return out
    key = doc[starts].astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(WINDOW):  # a 64-bit mix only proposes; equality is checked below
            key = (key ^ ids[starts + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    chosen = starts[np.sort(order[twice])]
    if not len(chosen):
        return out
    rows = np.column_stack([doc[chosen]] + [ids[chosen + j] for j in range(WINDOW)])
    _, back, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    chosen = chosen[count[back.ravel()] >= 2]
    inside = np.zeros(len(ids) + 1, np.int64)
    np.add.at(inside, chosen, 1)
    np.add.at(inside, chosen + WINDOW, -1)
    np.add.at(out, doc[np.flatnonzero(np.cumsum(inside[:-1]) > 0)], 1)
    return out


def _measure_slice(texts: list[bytes]) -> list[np.ndarray]:
    words = [t.split() for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    ids = np.fromiter(
        (numbers[w] for ws in words for w in ws), np.int64, int(n_words.sum())
    )
    doc = np.repeat(np.arange(len(texts)), n_words)
    # A word's characters are its bytes less the continuation bytes.
    chars = [sum(map(len, ws)) for ws in words]
    word_chars = np.array(
        [n if t.isascii() else len(b"".join(ws).decode()) for n, t, ws in zip(chars, texts, words, strict=True)],
        np.int64,
    )
    n_symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    n_lines = np.array([len(x) for x in lines], np.int64)
    n_dup = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    upper = np.zeros(len(numbers), np.int64)
    for w, i in numbers.items():
        upper[i] = w.decode("utf-8", "replace").isupper()
    n_upper = np.zeros(len(texts), np.int64)
    np.add.at(n_upper, doc, upper[ids])
    return [n_words, word_chars, n_symbols, n_dup, _repeated(ids, doc, len(texts)), n_lines, n_upper]


def measure_texts(texts: list[bytes], slice_bytes: int = 4 * 1024**2) -> list[np.ndarray]:
    """All measurements of some texts, worked through in slices of bounded size."""
    out, held, size = [], [], 0
    for text in texts:
        if held and size + len(text) > slice_bytes:
            out.append(_measure_slice(held))
            held, size = [], 0
        held.append(text)
        size += len(text)
    out.append(_measure_slice(held))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measures(text: pa.Array) -> pa.Array:
    found = measure_texts(batch_texts(text))
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=MEASURES)


def failed_bits() -> Column:
    """All rules over the measurements, as one bit each."""
    bits = [
        F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
        for i, rule in enumerate(RULES.values())
    ]
    whole = bits[0]
    for bit in bits[1:]:
        whole = whole.bitwiseOR(bit)
    return whole


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed``, the bits of the failed rules, per document."""
    return (
        docs.select("doc_id", measures("text").alias("m"))
        .select("doc_id", "m.*")
        .withColumn("failed", failed_bits())
    )


def passes(version: int = CURRENT, failed: str = "failed") -> Column:
    """True where no rule of the policy failed."""
    return F.col(failed).bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")) == 0


def keep(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """The rows of ``docs``, all columns, that a policy keeps."""
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    judged = held.withColumn("m", measures("row.text")).select("row", "m.*")
    return judged.withColumn("failed", failed_bits()).where(passes(version)).select("row.*")


def ablations(table: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, and documents that only it rejects.

    Counts per distinct bit pattern come first (at most 2 to the number of rules rows), so nothing
    but patterns is shuffled; dropping a rule is clearing its bit.
    """
    chosen = mask(POLICIES[version])
    patterns = table.groupBy(
        F.col("failed").bitwiseAND(F.lit(chosen).cast("long")).alias("bits")
    ).agg(F.count("*").alias("documents"))
    rules = [
        F.struct(F.lit(rule).alias("rule"), F.lit(mask((rule,))).cast("long").alias("bit"))
        for rule in POLICIES[version]
    ]
    each = patterns.select("*", F.inline(F.array(*rules)))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("documents")).otherwise(0)).alias("failing"),
        F.sum(F.when(alone, F.col("documents")).otherwise(0)).alias("only_this"),
    )
