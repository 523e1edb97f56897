"""From raw documents to packed training sequences, in five stages.

``run(spark, sf_dir)`` applies them to the documents table; each stage's
result is written to the session's shared folder and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from couponlens.llm import exact_dedup, lang_id, mixing, packing, simhash
from couponlens.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from their own labels."""
    return lang_id.drop_unidentified(docs, lang_id.learn_from_documents(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, capacity=1024).withColumnRenamed("__row", "copy_id")


STAGES = [("language_id", language_id), ("exact_dedup", exact_duplicates), ("simhash_near_dedup", near_duplicates),
          ("mixing", mix), ("packing", pack)]

#: SQL expresses neither the language model nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
