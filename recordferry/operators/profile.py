"""Profiles that can be merged: a state per batch, the state of any union, and what changed between two.

A state has one row per column: rows, values, blanks and a sketch of the different values.  Counts of a merged state
equal those of a profile over all rows; the number of different values is an estimate (about one in a hundred off).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTS = ("row_count", "value_count", "filler_count")


def _fillers(field: T.StructField, zero_is_missing: tuple[str, ...]) -> Column | None:
    if isinstance(field.dataType, T.StringType):
        return F.rtrim(F.col(field.name)) == ""
    return F.col(field.name) == 0 if field.name in zero_is_missing else None


def state(df: DataFrame, by: list[str] | None = None, zero_is_missing: tuple[str, ...] = ()) -> DataFrame:
    """by, column_name, row_count, value_count, filler_count, sketch: one aggregate over one scan.

    Blank text is filler, and so is zero in the `zero_is_missing` columns.
    """
    by = by or []
    fields = [f for f in df.schema.fields if f.name not in by]
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        value, filler = F.col(f.name), _fillers(f, zero_is_missing)
        measures += [F.count(value).alias(f"_n{i}"),
                     (F.lit(0).cast("bigint") if filler is None else F.count_if(filler)).alias(f"_f{i}"),
                     F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value))).alias(f"_s{i}")]
    wide = df.groupBy(*by).agg(*measures)
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"_n{i}").alias("value_count"),
                     F.col(f"_f{i}").alias("filler_count"), F.col(f"_s{i}").alias("sketch")) for i, f in enumerate(fields)]
    return wide.select(*by, F.inline(F.array(*rows)))


def merged(*states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The state of the union of the rows behind the states; of several batches in one state, too."""
    together = reduce(lambda a, b: a.unionByName(b), states)
    return together.groupBy(*(by or []), "column_name").agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.hll_union_agg("sketch").alias("sketch"))


def counts(of: DataFrame, by: list[str] | None = None) -> DataFrame:
    """column_name, value_count, null_count and distinct_estimate, as `quality.profile_rows` counts them."""
    null = F.col("row_count") - F.col("value_count") + F.col("filler_count")
    return of.select(*(by or []), "column_name", "value_count", null.alias("null_count"),
                     F.hll_sketch_estimate("sketch").alias("distinct_estimate"))


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Column by column, two states side by side.

    Shares of missing values before and after, their difference, the different values of both, and `new_values`, how
    many of those after were not there before; a column that only one state has is NULL on the other side.
    """
    sides = []
    for frame, side in ((before, "before"), (after, "after")):
        share = (F.col("row_count") - F.col("value_count") + F.col("filler_count")) / F.col("row_count")
        sides.append(frame.select("column_name", F.col("row_count").alias(f"rows_{side}"), share.alias(f"missing_{side}"),
                                  F.hll_sketch_estimate("sketch").alias(f"values_{side}"), F.col("sketch").alias(f"_{side}")))
    both = sides[0].join(sides[1], "column_name", "full")
    union = F.hll_sketch_estimate(F.hll_union("_before", "_after"))
    return both.withColumns({
        "missing_change": F.col("missing_after") - F.col("missing_before"),
        "new_values": F.greatest(union - F.col("values_before"), F.lit(0).cast("bigint"))}).drop("_before", "_after")
