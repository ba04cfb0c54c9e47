"""A corpus pipeline in stages: each works on all rows that the one before it kept, written as Parquet in between.

A stage takes (spark, docs, sf_dir); all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordferry.llm import minhash, mixing, packing, rules, suffix
from recordferry.llm.common import scratch, table
from recordferry.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return rules.keep_clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays."""
    return minhash.one_per_class(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stretches that an earlier document holds, too, are cut out of the texts."""
    return suffix.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their targets."""
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences."""
    return packing.pack(docs, tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]
#: Suffix arrays and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs, folder = table(spark, sf_dir, "documents"), scratch(spark)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
