"""What the operators of this subpackage share: stored tables, blocks of texts, word rules.

A *block* is one row holding the texts of many documents, compressed, cut along the scan up to a
byte bound. Operators that must look something up for every word, n-gram or window do it once per
distinct key of a block: a block asks (one packed row per bucket of keys), the bucket answers, and
the answers meet the block again in a co-group. So shuffles carry distinct keys, not occurrences,
no table is broadcast, and a task holds one block at a time.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the contracts: words are runs of anything but these six ASCII characters. bytes.split()
# without an argument splits at exactly the same characters.
WORD = r"[^\x20\x09-\x0D]+"

BLOCK_BYTES = 16 * 1024**2
BLOCK_SCHEMA = "block long, ids array<long>, sizes array<long>, data binary, crc long"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the session's JVM ends.

    Only where that setting is missing and all executors run in this process (tests, a laptop) a
    local temporary folder is used; on a cluster other machines could not read it, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "tallyhouse-scratch")
    folder = f"{base.rstrip('/')}/tallyhouse-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of tables that no later step reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str = "table", folder: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: cuts the lineage."""
    path = f"{folder or scratch_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MOST_BUCKETS = 100_000  # Spark's own bound; beyond it a bucket holds more blocks, still read one at a time


class BlockTable:
    """A table in the shared folder, dealt by ``block`` into ``parts`` as it is written, a set of rows
    after the other: co-groups on ``block`` read it without a shuffle.

    Within ``with``, the catalog knows it by a name of its own; after that the files stay as long as
    the session, and DataFrames that read them too. Shuffle files that only a finished write needed are
    freed when the driver's JVM finds them unreachable, so it is asked to look after each write:
    otherwise those of all steps pile up on the executors' disks.
    """

    def __init__(self, spark: SparkSession, parts: int, name: str):
        self.spark = spark
        self.parts = max(1, min(parts, MOST_BUCKETS))
        self.path = f"{scratch_folder(spark)}/{name}"
        self.entry = f"{name}_{uuid.uuid4().hex}"

    def __enter__(self) -> BlockTable:
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.entry}")

    def add(self, df: DataFrame) -> DataFrame:
        """Adds rows and returns the table as it now is."""
        (
            df.repartition(self.parts, "block")
            .write.mode("append")
            .format("parquet")
            .option("compression", "zstd")
            .option("path", self.path)
            .bucketBy(self.parts, "block")
            .saveAsTable(self.entry)
        )
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.table(self.entry)


def batch_texts(column: pa.Array, rows: int = 256) -> Iterator[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes, a few rows at a time; null becomes empty."""
    for at in range(0, len(column), rows):
        for text in column.slice(at, rows).cast(pa.binary()).to_pylist():
            yield text or b""


def runs(
    batches: Iterator[pa.RecordBatch], most_bytes: int, keys: int = 1
) -> Iterator[tuple[list, list[bytes]]]:
    """(keys, texts) of rows in a row, at most ``most_bytes`` of text or one row at a time.

    The first column is the key, or the first ``keys`` columns are; the next one is the text.
    """
    held, texts, size = [], [], 0
    for batch in batches:
        names = [batch.column(i).to_pylist() for i in range(keys)]
        rows = names[0] if keys == 1 else zip(*names, strict=True)
        for key, text in zip(rows, batch_texts(batch.column(keys)), strict=True):
            if texts and size + len(text) > most_bytes:
                yield held, texts
                held, texts, size = [], [], 0
            held.append(key)
            texts.append(text)
            size += len(text)
    if texts:
        yield held, texts


def _sealed(block: int, ids: list, texts: list[bytes]) -> dict:
    data = b"".join(texts)
    return {
        "block": block,
        "ids": ids,
        "sizes": [len(x) for x in texts],
        "data": zstandard.ZstdCompressor(level=3).compress(data),
        "crc": zlib.crc32(data),
    }


def cut_blocks(
    docs: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    parts: int | None = None,
    exchange: bool = True,
) -> DataFrame:
    """All documents (doc_id, text) as blocks of at most ``block_bytes`` or one text.

    One exchange by block follows, which both the asking and the answering side read, so texts
    move once, compressed; without ``exchange`` the asking side cuts its own, equal blocks where
    it reads the texts. Rows keep null and repeated ids; null texts are empty.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        for ids, texts in runs(batches, block_bytes):
            yield pa.RecordBatch.from_pylist([_sealed(block, ids, texts)], block_arrow_schema())
            block += 1

    blocks = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, BLOCK_SCHEMA)
    if not exchange:
        return blocks
    return blocks.repartition(parts, "block") if parts else blocks.repartition("block")


def block_arrow_schema() -> pa.Schema:
    return pa.schema(
        [
            ("block", pa.int64()),
            ("ids", pa.list_(pa.int64())),
            ("sizes", pa.list_(pa.int64())),
            ("data", pa.binary()),
            ("crc", pa.int64()),
        ]
    )


def open_block(row: dict) -> tuple[list, np.ndarray, bytes]:
    """(ids, offsets of the texts with the end, all bytes) of a block row."""
    data = zstandard.ZstdDecompressor().decompress(row["data"])
    offsets = np.zeros(len(row["ids"]) + 1, np.int64)
    np.cumsum(np.asarray(row["sizes"], np.int64), out=offsets[1:])
    return row["ids"], offsets, data


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed blob; :func:`unpack` gives them back."""
    parts = [len(arrays).to_bytes(1, "little")]
    for x in arrays:
        x = np.ascontiguousarray(x)
        parts += [x.dtype.str[1:].encode().ljust(4), len(x).to_bytes(8, "little"), x.tobytes()]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    arrays, at = [], 1
    for _ in range(data[0]):
        kind = np.dtype(data[at : at + 4].decode().strip())
        n = int.from_bytes(data[at + 4 : at + 12], "little")
        arrays.append(np.frombuffer(data, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return arrays


def narrow(x: np.ndarray) -> np.ndarray:
    """Non-negative integers in the smallest unsigned type that holds them."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.min_scalar_type(top))


ASK_SCHEMA = "bucket int, block long, crc long, payload binary"


def ask(
    blocks: DataFrame, request: Callable[[dict], Iterable[tuple[int, bytes]]], parts: int | None
) -> DataFrame:
    """One row per block and bucket from ``request(block row)``, dealt out by bucket."""
    schema = pa.schema(
        [("bucket", pa.int32()), ("block", pa.int64()), ("crc", pa.int64()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                out = [
                    {"bucket": b, "block": row["block"], "crc": row["crc"], "payload": p}
                    for b, p in request(row)
                ]
                for at in range(0, len(out), 64):
                    yield pa.RecordBatch.from_pylist(out[at : at + 64], schema)

    rows = blocks.mapInArrow(run, ASK_SCHEMA)
    return rows.repartition(parts, "bucket") if parts else rows.repartition("bucket")


def meet(
    blocks: DataFrame,
    answers: DataFrame,
    finish: Callable[[dict, dict[int, bytes]], pa.Table],
    schema: str,
) -> DataFrame:
    """``finish(block row, {bucket: payload})`` for every block with all its answers.

    An answer carries the checksum of the block that asked; if a block were ever cut anew in
    another order (a source that doesn't repeat its row order, read again after a loss), the job
    fails instead of mixing up answers.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        given = right.to_pylist()
        if any(x["crc"] != row["crc"] for x in given):
            raise ValueError("a block was cut again in another order; store the input first")
        return finish(row, {x["bucket"]: x["payload"] for x in given})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application, as an added zip.

    So workers need neither an installation nor the driver's working folder.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="tallyhouse-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
