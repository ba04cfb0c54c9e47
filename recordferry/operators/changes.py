"""Updates, deletes and appends as replacement DataFrames.

Without a table format, a change job returns the whole table as it should be;
looking at the result before writing it is the dry run.  `sources.sinks` writes
it to a new path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.functions.text import shifted


def update_from(base: DataFrame, updates: DataFrame, key: str, assignments: dict[str, str]) -> DataFrame:
    """Replace `base` columns by `updates` columns where the key matches.

    `assignments` maps a column of `base` to a column of `updates`.  Matched
    rows take the new value even if it is NULL.  If several updates share a key
    the least one is used, so a base row never multiplies.
    """
    new = F.struct(*[F.col(u).alias(f"_{i}") for i, u in enumerate(assignments.values())])
    picked = updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(new).alias("_new"))
    joined = base.join(picked, key, "left")
    matched = F.col("_new").isNotNull()
    changed = {column: F.when(matched, F.col(f"_new._{i}")).otherwise(F.col(column))
               for i, column in enumerate(assignments)}
    return joined.withColumns(changed).select(*base.columns)


def update_conflicts(updates: DataFrame, key: str, value: str) -> DataFrame:
    """Keys for which the updates disagree."""
    spread = updates.groupBy(key).agg(F.count_distinct(value).alias("candidates"))
    return spread.where("candidates > 1")


def fill_log_leases(log: DataFrame, choices: DataFrame, tag: str, run_at: str) -> DataFrame:
    """Write the matched lease into log rows that nobody has touched.

    Touched means: has a lease, or carries an author stamp.  `choices` has one
    `source_lease_id` per `target_record_id` (`match.log_fill_choices`).  All other
    columns of the log stay as they are.
    """
    picked = choices.select(F.col("target_record_id").alias("record_id"),
                            F.col("source_lease_id").alias("new_lease"))
    if "modified_ts" not in log.columns:
        log = log.withColumn("modified_ts", F.lit(None).cast("timestamp_ntz"))
    joined = log.join(picked, "record_id", "left")
    fill = (F.col("new_lease").isNotNull() & F.col("lease_id").isNull()
            & F.col("created_by").isNull() & F.col("modified_by").isNull())
    new = {"lease_id": F.col("new_lease"), "zip_name": F.lit(tag), "created_by": F.lit(tag),
           "modified_ts": F.lit(run_at).cast("timestamp_ntz"), "modified_by": F.lit(tag)}
    return joined.select(*[F.when(fill, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
                           for c in log.columns])


def _rekeyed(tag_rows: str, since: str, outsource_ids: tuple[int, ...], offset_minutes: int) -> Column:
    late = shifted(F.col("keyed_ts"), offset_minutes) >= F.lit(since).cast("timestamp_ntz")
    return F.col(tag_rows).isNotNull() & late & F.col("outsource_id").isin(*outsource_ids)


def _with_batch_flag(records: DataFrame, log: DataFrame, tag: str) -> DataFrame:
    batch = log.where(F.col("batch_tag").ilike(f"%{tag}%")).select("record_id").distinct()
    return records.join(batch.withColumn("_in_batch", F.lit(True)), "record_id", "left")


def rekeyed(records: DataFrame, log: DataFrame, tag: str, since: str, outsource_ids: tuple[int, ...],
            offset_minutes: int = 630) -> DataFrame:
    """Records of a batch that an outside keyer has finished since a moment.

    The keyed time is shifted by `offset_minutes` before the comparison; 600
    repeats the whole-hour shift of the migrated script.
    """
    flagged = _with_batch_flag(records, log, tag)
    return flagged.where(_rekeyed("_in_batch", since, outsource_ids, offset_minutes)).select(*records.columns)


def move_status(records: DataFrame, log: DataFrame, tag: str, since: str, outsource_ids: tuple[int, ...],
                new_status: int = 4, offset_minutes: int = 630) -> DataFrame:
    """All records, with the re-keyed ones in their new status."""
    moved = _rekeyed("_in_batch", since, outsource_ids, offset_minutes)
    status = F.when(moved, F.lit(new_status)).otherwise(F.col("status_id"))
    return _with_batch_flag(records, log, tag).withColumn("status_id", status).select(*records.columns)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """What is left after a delete: rows for which the test is false or unknown."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def delete_matching(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """What is left after deleting rows that exist in `other`."""
    return df.join(other.select(*keys), keys, "left_anti")


def append_rows(table: DataFrame, rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The table with rows added; columns the rows lack become typed NULLs."""
    named = rows if columns is None else rows.select(*columns)
    types = {f.name: f.dataType for f in table.schema.fields}
    extra = [c for c in named.columns if c not in types]
    if extra:
        raise ValueError(f"columns not in the table: {extra}")
    fitted = [(F.col(n) if n in named.columns else F.lit(None)).cast(t).alias(n) for n, t in types.items()]
    return table.unionByName(named.select(*fitted))


def retype(df: DataFrame, **types: str) -> DataFrame:
    """Change column types on the way to a write."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def duplicate_keys(df: DataFrame, keys: list[str], more_than: int = 1) -> DataFrame:
    """Keys held by more than `more_than` rows; empty if the keys are unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > more_than)
