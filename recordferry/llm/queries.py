"""The registered query of each operator, over its whole table, and the rows each returns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordferry.llm import ann, chat, minhash, mixing, negatives, packing, quality, rules, scoring, suffix, tokens, trie, urls
from recordferry.llm.common import scratch, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.train(docs, labels.filter(~held_out()))
    return quality.score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(table(spark, sf_dir, "documents"))


def op3_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark's passages are the target domain, all documents the background."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scoring.score(docs, table(spark, sf_dir, "benchmark").select("text"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return entries.select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.verdict("base")).alias("base_failed"), rules.verdict().alias("kept"), "failed")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.valid(table(spark, sf_dir, "embeddings"))
    queries = vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "vector")
    return ann.search(ann.index(vectors), queries)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the labels of the document with the page's id; bad is low quality or toxic."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


PROBE = "</s>[INST] ok [/INST]"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    out = chat.format_chats(turns.union(probe))
    read = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    each = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(each, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = minhash.near_classes(table(spark, sf_dir, "documents"))
    return classes.select(suffix.original(F.col("doc")).alias("doc_id"), suffix.original(F.col("class_id")).alias("class_id"), "copies")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 are moved on by one, so that some rows disagree with their neighbourhood."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.blocks(negatives.prepared(vectors, label)), every=50)


def head_turns(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % 9


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation c starts with the first turns of conversation c - c % 5."""
    conv = F.col("conv_id").cast("long")
    nodes = trie.build(trie.paths(table(spark, sf_dir, "conversations"), conv - conv % 5, head_turns))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        trie.ends_text(F.col("ends")).alias("ends_sha256"))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is a new folder of this run, so the counts depend on the given table alone."""
    vocabulary = tokens.Vocabulary(tokenizer_path("word_bpe_49k.json"), drops_space=True, folds_case=True)
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary, scratch(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
