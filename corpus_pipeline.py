"""The corpus pipeline: five stages over ``documents``, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirestar.llm import exact_dedup, minhash, packing, secrets, toxicity
from wirestar.llm.queries import BYTE_BPE
from wirestar.sources.staging import Staging


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_toxic(docs, labels, Staging(spark))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs, Staging(spark))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of near copies. Rows without an id stay."""
    return minhash.drop_near_duplicates(docs, Staging(spark))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets that look live replaced by ``[SECRET]``; widely copied
    examples stay as they are."""
    return secrets.mask_live(docs, Staging(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every remaining document with its place in a sequence."""
    return packing.pack(docs, BYTE_BPE, Staging(spark))


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: Toxicity, near copies and packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, staging = spark.read.parquet(f"{sf_dir}/documents.parquet"), Staging(spark)
    for name, stage in STAGES:
        path = staging.path(name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
