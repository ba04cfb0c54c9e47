"""What the operators share: word rules, checkpoints, hot-key joins, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`.  Where none is named, a temporary one serves a local master only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="recordferry-checkpoint-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession) -> str:
    """A new folder, by name, inside the checkpoint folder; Spark's writers create it."""
    return f"{checkpoint_folder(spark)}/recordferry-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """`df` computed once and cut off from its lineage by a checkpoint in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: for wide tables of which later steps need columns."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Stands for a null id where ids are keys.
NO_ID = -(1 << 63)


def own_ids(docs: DataFrame, doc_id: str = "doc_id") -> bool:
    """Whether no id is there twice, null included."""
    key = F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID))
    return docs.select(key.alias("doc")).groupBy("doc").count().filter("count > 1").isEmpty()


def numbered(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc, row): each row of `docs` as a struct, with a key of its own that rises with the id, null ids first.

    Where ids are unique, the key is the id (null: NO_ID).  Otherwise rows are sorted by id, hash of the text and occurrence,
    and written once with their number.
    """
    key = F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    if own_ids(docs, doc_id):
        return docs.select(key.alias("doc"), row)
    order = ["doc", "hash", "occurrence"]
    rows = docs.select(row, key.alias("doc"), F.xxhash64(docs[text]).alias("hash"), F.monotonically_increasing_id().alias("occurrence"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.select(F.monotonically_increasing_id().alias("doc"), "row"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def join_counted(rows: DataFrame, lookup: DataFrame, key: str, count: str, total: int, share: int = 1000) -> DataFrame:
    """Left join of `rows` to `lookup` (one row per non-null `key`, `count` rows each of `total`) without a hot task.

    A key with at least 1/`share` of all rows is hot; there are at most `share` such keys, so they are broadcast.
    The others meet in a shuffle, in which hot and null-key rows take spread keys.  All columns of `lookup` are added.
    """
    hot = lookup.filter(F.col(count) * share >= F.lit(total))
    added = [c for c in lookup.columns if c != key]
    first = rows.join(F.broadcast(hot.select(key, *[F.col(c).alias(f"hot_{c}") for c in added])), key, "left")
    is_hot = F.col(f"hot_{count}").isNotNull()
    kind = rows.schema[key].dataType.simpleString()
    spread = F.when(~is_hot, F.col(key))
    first = first.withColumn("join_key", spread).withColumn(
        "join_salt", F.when(spread.isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(share)).cast("int") + 1).otherwise(0))
    rest = lookup.filter(F.col(count) * share < F.lit(total)).select(
        F.col(key).cast(kind).alias("join_key"), F.lit(0).alias("join_salt"), *[F.col(c).alias(f"rest_{c}") for c in added])
    both = first.join(rest, ["join_key", "join_salt"], "left")
    return both.select(*rows.columns, *[F.coalesce(f"hot_{c}", f"rest_{c}").alias(c) for c in added])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): connected components of `edges` (a, b), label = least node; nodes without an edge are absent.

    Alternating large-star and small-star steps: each is one shuffle by node, rows never exceed the edges of the start,
    and a hub costs its edges once per step.  The steps end when the edge set stands still.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every node hands its smaller neighbours, and itself, to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        now = saved(small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
                    .union(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, now.agg(F.count("*"), F.sum("b"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                now.select("b", "b")).distinct()
