"""Small relational building blocks shared by the jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.functions.text import fold


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """NOT IN with its null rules, without broadcasting the right side.

    A NULL on the right empties the result; a NULL on the left is dropped
    unless the right side is empty.  The right side's counts are a scalar
    subquery, the rest is a shuffled anti-join.
    """
    found = right.select(F.col(key))
    all_rows = found.agg(F.count("*").alias("n")).scalar()
    null_rows = found.agg(F.count_if(F.col(key).isNull()).alias("n")).scalar()
    kept = left.where((null_rows == 0) & (F.col(key).isNotNull() | (all_rows == 0)))
    return kept.join(found.where(F.col(key).isNotNull()), key, "left_anti").select(*left.columns)


def in_set(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_semi")


def explode_delimited(df: DataFrame, column: str, delimiter: str = ",", position: str | None = None,
                      lost_columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per token of a delimited column; rows without delimiter stay.

    Tokens are trimmed and empty ones kept.  `position` names a column for the
    token's place (0 for rows that are not split).  `lost_columns` become NULL
    on split rows, as they did where only listed columns were put back.
    No shuffle.
    """
    split = F.coalesce(F.col(column).contains(delimiter), F.lit(False))
    tokens = F.when(split, F.split(F.col(column), delimiter)).otherwise(F.array(F.col(column)))
    others = [c for c in df.columns if c != column]
    lost = {c: F.when(~split, F.col(c)) for c in lost_columns}
    kept = [lost.get(c, F.col(c)).alias(c) for c in others]
    out = df.select(*kept, split.alias("_split"), F.posexplode(tokens).alias("_at", "_token"))
    token = F.when(F.col("_split"), F.trim("_token")).otherwise(F.col("_token"))
    columns = [token.alias(column) if c == column else F.col(c) for c in df.columns]
    if position:
        columns.append(F.col("_at").alias(position))
    return out.select(*columns)


def union_distinct(*frames: DataFrame, text_columns: tuple[str, ...] = ()) -> DataFrame:
    """Distinct union in which `text_columns` compare without case.

    Of rows that differ in case only, the least one is kept.
    """
    rows = reduce(DataFrame.unionByName, frames)
    if not text_columns:
        return rows.distinct()
    keys = [(fold(F.col(c)) if c in text_columns else F.col(c)).alias(f"_k{i}")
            for i, c in enumerate(rows.columns)]
    least = F.min(F.struct(*text_columns)).alias("_row")
    picked = rows.groupBy(*keys).agg(least)
    return picked.select(*[F.col(f"_row.{c}") if c in text_columns else F.col(f"_k{i}").alias(c)
                           for i, c in enumerate(rows.columns)])


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns with a prefix, so that two sides can be kept whole in a join."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def all_blank(columns: tuple[str, ...], null_is_blank: bool = True) -> Column:
    """Every column blank; without `null_is_blank` a NULL makes it unknown."""
    return reduce(Column.__and__, [_blank(c, null_is_blank) for c in columns])


def any_filled(columns: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.coalesce(F.rtrim(c) != "", F.lit(False)) for c in columns])


def _blank(column: str, null_is_blank: bool) -> Column:
    blank = F.rtrim(column) == ""
    return F.coalesce(blank, F.lit(True)) if null_is_blank else blank


def labelled_counts(df: DataFrame, counts: dict[str, Column], label: str, value: str = "record_count") -> DataFrame:
    """Several aggregates of one pass over `df`, one labelled row each."""
    one_row = df.agg(*[c.cast("bigint").alias(f"_{i}") for i, c in enumerate(counts.values())])
    rows = F.array(*[F.struct(F.lit(name).alias(label), F.col(f"_{i}").alias(value))
                     for i, name in enumerate(counts)])
    return one_row.select(F.inline(rows))


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First `n` rows by `order`; the caller ends the order with a key."""
    return df.orderBy(*order).limit(n)
