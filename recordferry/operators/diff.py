"""The difference between a table and its replacement, as a change set: what a dry run shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED, UPDATED, DELETED = "inserted", "updated", "deleted"


def row_digest(columns: list[str]) -> Column:
    """64-bit digest of a row; NULL and an absent value differ from every other value."""
    return F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns])


def change_set(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, change, column, before, after, copies: how `after` differs from `before`, columns by name.

    Rows are compared by key and digest first, so equal rows move as two numbers and only rows that differ are read
    whole.  A key that differs by one row on each side is `updated`, one row per column with the value before and
    after as text.  Any other row that one side has more often is `deleted` or `inserted`, with the row as JSON and
    how many copies; so are all rows of a repeated key that differ, for it cannot be told which became which.  A NULL
    key is a key like any other.
    """
    columns = before.columns
    if sorted(columns) != sorted(after.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(after.columns))}")
    marked = [df.select(F.col(key).alias("_key"), row_digest(columns).alias("_digest"), F.struct(*columns).alias("_row"))
              for df in (before, after)]
    marks = marked[0].select("_key", "_digest", F.lit(-1).alias("_n")).unionByName(
        marked[1].select("_key", "_digest", F.lit(1).alias("_n")))
    differ = (marks.groupBy("_key", "_digest").agg(F.sum("_n").alias("_n")).where("_n != 0")
              .withColumn("_copies", F.abs("_n")))

    def side(rows: DataFrame, more: str) -> DataFrame:
        wanted = differ.where(more).select(F.col("_key").alias("_k"), F.col("_digest").alias("_d"), "_copies")
        same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_digest") == F.col("_d"))
        return rows.join(wanted, same).groupBy("_key", "_digest").agg(F.first("_row").alias("_row"), F.first("_copies").alias("_copies"))

    both = (side(marked[0], "_n < 0").withColumn("_gone", F.lit(True))
            .unionByName(side(marked[1], "_n > 0").withColumn("_gone", F.lit(False))))
    # of a key, at most one row of each kind is needed whole to tell an update; all others stand for themselves
    kinds = both.groupBy("_key").agg(
        F.sum(F.when(F.col("_gone"), F.col("_copies"))).alias("_old_rows"), F.sum(F.when(~F.col("_gone"), F.col("_copies"))).alias("_new_rows"))
    updated_key = (F.col("_old_rows") == 1) & (F.col("_new_rows") == 1)
    pairs = kinds.where(updated_key).select(F.col("_key").alias("_k"))
    old, new = both.where("_gone").alias("o"), both.where("not _gone").alias("n")
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"o._row.`{c}`").cast("string").alias("before"),
                              F.col(f"n._row.`{c}`").cast("string").alias("after"),
                              F.col(f"o._row.`{c}`").eqNullSafe(F.col(f"n._row.`{c}`")).alias("same")) for c in columns])
    updates = (pairs.join(old, F.col("_k").eqNullSafe(F.col("o._key"))).join(new, F.col("_k").eqNullSafe(F.col("n._key")))
               .select(F.col("_k").alias(key), F.inline(each)).where("not same")
               .select(key, F.lit(UPDATED).alias("change"), "column", "before", "after", F.lit(1).cast("bigint").alias("copies")))
    single = kinds.where(~F.coalesce(updated_key, F.lit(False))).select(F.col("_key").alias("_k"))
    row = F.to_json("_row")
    others = both.join(single, F.col("_key").eqNullSafe(F.col("_k"))).select(
        F.col("_key").alias(key), F.when(F.col("_gone"), DELETED).otherwise(INSERTED).alias("change"),
        F.lit(None).cast("string").alias("column"), F.when(F.col("_gone"), row).alias("before"),
        F.when(~F.col("_gone"), row).alias("after"), F.col("_copies").alias("copies"))
    return updates.unionByName(others)
