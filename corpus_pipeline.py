"""The corpus pipeline: from raw documents to token ids, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import byte_bpe, mixing, pii, quality_rules, simhash
from tallyhouse.llm.shared import scratch_folder, ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps."""
    ship(spark)
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies."""
    ship(spark)
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix (little-endian unsigned 32-bit integers), with digests of
    them and of what they decode to."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = byte_bpe.encode_decode(docs, path, public_tokenizers.PATTERN)
    digests = [F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return found.select("doc_id", "n_tokens", "ids", *digests)


STAGES = [
    ("quality_rules", quality),
    ("simhash", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("byte_bpe", tokens),
]

#: Connected components and learned reliabilities are not expressible; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored as Parquet for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark)
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
