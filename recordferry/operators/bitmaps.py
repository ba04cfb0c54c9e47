"""Exact distinct counts of dense numeric ids as bitmaps that can be merged.

The state of a group is one bitmap per 32,768 ids.  Bitmaps are built before the shuffle, so what moves is bitmaps and
not ids, once; states of days, counties or batches are merged by `or` and counted at any level.  Ids must be dense: a
bitmap takes 4 KB however few of its ids occur.  NULL ids do not count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "id_bucket", "id_bitmap"


def state(df: DataFrame, by: list[str], id_column: str) -> DataFrame:
    """by, id_bucket, id_bitmap: the ids of each group."""
    number = F.col(id_column).cast("bigint")
    return (df.where(number.isNotNull()).groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITMAP)))


def merged(states: DataFrame, by: list[str]) -> DataFrame:
    """The state of coarser groups, or of several states in one frame."""
    return states.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(F.col(BITMAP)).alias(BITMAP))


def counted(states: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct ids of each group of a merged state."""
    return states.groupBy(*by).agg(F.sum(F.bitmap_count(F.col(BITMAP))).alias(name))


def distinct_count(df: DataFrame, by: list[str], id_column: str, name: str) -> DataFrame:
    """Distinct ids per group; groups without an id have no row."""
    return counted(state(df, by, id_column), by, name)


def rollup_counts(df: DataFrame, levels: list[str], id_column: str, name: str) -> DataFrame:
    """Distinct ids at every level of a hierarchy, finest first, from one state of the finest level.

    `levels` is ordered from the coarsest; columns below a row's level are NULL, `level` says how many are set.
    """
    now = state(df, levels, id_column)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = None
    for depth in range(len(levels), -1, -1):
        by = levels[:depth]
        if depth < len(levels):
            now = merged(now, by)
        absent = {c: F.lit(None).cast(kinds[c]) for c in levels[depth:]}
        rows = counted(now, by, name).withColumns({**absent, "level": F.lit(depth)}).select("level", *levels, name)
        out = rows if out is None else out.unionByName(rows)
    return out

