"""Checks and reports on what was migrated."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.functions.text import fold, is_filled, on_day
from recordferry.operators import bitmaps
from recordferry.operators.relational import all_blank, any_filled, labelled_counts


# ---- profiles ----------------------------------------------------------------------

def null_profile(df: DataFrame, zero_is_missing: tuple[str, ...] = (), blank_tested: tuple[str, ...] | None = None,
                 ) -> DataFrame:
    """One row, two measures per column: values that are there, values that are missing.

    Blank text counts as missing, and so does zero in the `zero_is_missing`
    columns; both also count as "there", so the measures may overlap.  One
    aggregate over one scan.  `blank_tested` limits the blank test to some
    text columns.  NULLs are not counted but derived from the row count, which
    keeps the aggregate half as wide.
    """
    fillers = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            if blank_tested is None or field.name in blank_tested:
                fillers[field.name] = f"rtrim(`{field.name}`) = ''"
        elif field.name in zero_is_missing:
            fillers[field.name] = f"`{field.name}` = 0"
    names = df.columns
    counted = df.selectExpr(
        "count(*) as _rows",
        *[f"count(`{n}`) as _n{i}" for i, n in enumerate(names)],
        *[f"count_if({fillers[n]}) as _f{i}" for i, n in enumerate(names) if n in fillers])
    measures = []
    for i, n in enumerate(names):
        fill = f" + _f{i}" if n in fillers else ""
        measures += [f"_n{i} as `{n}_count`", f"_rows - _n{i}{fill} as `{n}_null_count`"]
    return counted.selectExpr(*measures)


def profile_rows(profile: DataFrame) -> DataFrame:
    """A one-row profile turned into one row per column."""
    names = [c.removesuffix("_null_count") for c in profile.columns if c.endswith("_null_count")]
    rows = [F.struct(F.lit(n).alias("column_name"), F.col(f"{n}_count").alias("value_count"),
                     F.col(f"{n}_null_count").alias("null_count")) for n in names]
    return profile.select(F.inline(F.array(*rows)))


def blank_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Blank but not NULL values per column."""
    return labelled_counts(df, {c: F.count_if(F.rtrim(c) == "") for c in columns}, "column_name", "blank_count")


def null_split(df: DataFrame, by: str, columns: tuple[str, ...]) -> DataFrame:
    """NULL and non-NULL counts of some columns for each value of `by`."""
    measures = [m for c in columns for m in (
        F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_null_count"),
        F.count(c).alias(f"{c}_not_null_count"))]
    return df.groupBy(by).agg(*measures)


def value_frequency(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """How often each value of each column occurs: one scan, combined before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs)).groupBy("column_name", "value")
            .agg(F.count("*").alias("occurrences")))


def group_frequency(df: DataFrame, *columns: str, count: str = "occurrences") -> DataFrame:
    """Count per combination of columns, most frequent first."""
    return df.groupBy(*columns).agg(F.count("*").alias(count)).orderBy(F.desc(count), *columns)


# ---- relations ---------------------------------------------------------------------

def orphans(child: DataFrame, parent: DataFrame, key: str = "record_id") -> DataFrame:
    """Child keys without a parent, with their rows counted first."""
    counted = child.groupBy(key).agg(F.count("*").alias("entries"))
    return (counted.join(parent.select(key), key, "left_anti")
            .select(F.col(key).alias("missing_record_id"), "entries")
            .orderBy(F.desc("entries"), "missing_record_id"))


def missing_relations(records: DataFrame, children: dict[str, DataFrame], key: str = "record_id") -> DataFrame:
    """For each kind of child row, how many records have none: one pass over the records."""
    flagged = records.select(key)
    for i, child in enumerate(children.values()):
        present = child.select(key).where(F.col(key).isNotNull()).distinct().withColumn(f"_has{i}", F.lit(True))
        flagged = flagged.join(present, key, "left")
    counts = {f"without {name}": F.count_if(F.col(f"_has{i}").isNull())
              for i, name in enumerate(children)}
    return labelled_counts(flagged, counts, "absent_relation")


def county_reconcile(leases: DataFrame, records: DataFrame, log: DataFrame, crosswalk: DataFrame,
                     record_county_key: str = "tgt_county_id") -> DataFrame:
    """Counties in which source and migrated lease counts differ.

    `records` are those of the batch; `record_county_key` is the crosswalk column that their county id refers to.
    Both sides are counted per record county on their own (several source counties may share one) and joined as
    counts from both ends, so a county that only one side has is reported too.  Leases whose county the crosswalk
    does not know form one row without a county.
    """
    names = (crosswalk.where(F.col(record_county_key).isNotNull()).groupBy(record_county_key)
             .agg(F.min("county_name").alias("county_name"), F.min_by("state_id", "county_name").alias("state_id")))
    known = crosswalk.select(F.col("src_county_id").alias("county_id"), F.col(record_county_key).alias("_place")).distinct()
    # Lease ids are dense numbers: bitmaps per county cross the network, not ids.
    from_source = bitmaps.distinct_count(leases.join(known, "county_id", "left"), ["_place"], "lease_id", "source_leases")
    migrated = (records.select("record_id", F.col("county_id").alias("_at"))
                .join(log.where("lease_id is not null").select("record_id", "lease_id"), "record_id"))
    migrated = bitmaps.distinct_count(migrated, ["_at"], "lease_id", "target_leases")
    nothing = F.lit(0).cast("bigint")
    both = (from_source.join(migrated, F.col("_place") == F.col("_at"), "full")
            .withColumn(record_county_key, F.coalesce("_place", "_at"))
            .join(names, record_county_key, "left")
            .withColumn("source_leases", F.coalesce("source_leases", nothing))
            .withColumn("target_leases", F.coalesce("target_leases", nothing))
            .withColumn("difference", F.col("source_leases") - F.col("target_leases")))
    return (both.where("difference != 0")
            .select("county_name", "state_id", "source_leases", "target_leases", "difference")
            .orderBy(F.desc("difference"), "county_name"))


def county_reconcile_global(leases: DataFrame, records: DataFrame, log: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """The same report in its original form: each county against the whole batch.

    The batch count is one number, so it enters as a scalar subquery and not as
    a product of the two sides.
    """
    batch = (records.select("record_id").join(log.select("record_id", "lease_id"), "record_id", "left")
             .agg(F.count_distinct("lease_id").alias("n")).scalar())
    per_county = (leases.groupBy("county_id").agg(F.count_distinct("lease_id").alias("source_leases"))
                  .join(crosswalk.select(F.col("src_county_id").alias("county_id"), "county_name", "state_id"),
                        "county_id", "left")
                  .withColumn("target_leases", batch)
                  .withColumn("difference", F.col("source_leases") - F.col("target_leases")))
    return per_county.where("difference != 0").select(
        "county_name", "state_id", "source_leases", "target_leases", "difference")


def target_counts(records: DataFrame, statuses: tuple[int, ...], tag: str) -> DataFrame:
    """Lease records of some statuses, batch records, and the different ids of all and of the batch.

    Rows are counted per id first, so both distinct counts come from one shuffle of ids and no row is expanded.
    """
    in_batch = F.col("remarks").ilike(f"%{tag}%")
    per_id = records.groupBy("record_id").agg(
        F.count_if((F.col("record_is_lease") == 1) & F.col("status_id").isin(*statuses)).alias("leases"),
        F.count_if(in_batch).alias("batch"))
    known, nothing = F.col("record_id").isNotNull(), F.lit(0).cast("bigint")
    return labelled_counts(per_id, {
        "lease records": F.coalesce(F.sum("leases"), nothing), "batch records": F.coalesce(F.sum("batch"), nothing),
        "distinct records": F.count("record_id"), "distinct batch records": F.count_if(known & (F.col("batch") > 0))}, "measure")


def funnel(df: DataFrame, steps: dict[str, Column], key: str = "record_id") -> DataFrame:
    """Distinct keys that reach each step, in step order.

    `df` has the outer-joined inputs and `steps` the test of each step.  Rows
    are reduced to one per key first, so all steps cost one pass.
    """
    reached = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[
        F.bool_or(F.coalesce(test, F.lit(False))).alias(f"_{i}") for i, test in enumerate(steps.values())])
    counts = reached.agg(*[F.count_if(F.col(f"_{i}")).alias(f"_{i}") for i in range(len(steps))])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("step_name"),
                              F.col(f"_{i}").alias("distinct_keys")) for i, name in enumerate(steps)])
    return counts.select(F.inline(rows))


def name_coverage(staged: DataFrame, *sources: DataFrame, name: str = "gName") -> DataFrame:
    """Staged names that no source list has, compared without case.

    Names are counted before the anti-join, so a frequent name moves once.
    """
    counted = (staged.groupBy(fold(F.col(name)).alias("name_key"))
               .agg(F.count("*").alias("occurrences"), F.min(name).alias(name)))
    valid = reduce(DataFrame.unionByName, [
        s.where(is_filled(F.col("name"))).select(fold(F.col("name")).alias("name_key")) for s in sources])
    return (counted.join(valid.distinct(), "name_key", "left_anti").select(name, "occurrences")
            .orderBy(F.desc("occurrences"), name))


# ---- rules and audits ----------------------------------------------------------------

def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """How many rows break each rule: one pass."""
    return labelled_counts(df, {n: F.count_if(r) for n, r in rules.items()}, "rule", "violations")


def batch_rules(tag: str, run_ts: Column, staged_status: int = 90) -> dict[str, Column]:
    """Rules for records of a batch; expects `known_county` from `with_known_county`."""
    batch = F.col("remarks").ilike(f"%{tag}%")
    incomplete = (F.col("record_number").isNull() | (F.col("status_id") != staged_status)
                  | (F.col("record_is_lease") != 1) | F.col("county_id").isNull())
    return {
        "null essentials": batch & incomplete,
        "county not in crosswalk": batch & F.col("known_county").isNull(),
        "future dated": batch & (F.col("instrument_date") > run_ts),
        "wrong lease flags": batch & ((F.col("record_is_lease") != 1) | (F.col("record_is_courthouse") != 0)),
    }


def with_known_county(records: DataFrame, crosswalk: DataFrame, county_key: str = "tgt_county_id") -> DataFrame:
    known = (crosswalk.where(F.col(county_key).isNotNull()).select(F.col(county_key).alias("county_id"))
             .distinct().withColumn("known_county", F.col("county_id")))
    return records.join(known, "county_id", "left")


def monthly_volume(df: DataFrame, counties: DataFrame, created: str, county_names: tuple[str, ...] | None = None,
                   log: DataFrame | None = None) -> DataFrame:
    """Rows per county, year and month.

    With `log` the rows are counted once per log row of the record, as the
    original report did; the log is counted per record first and the counts
    are added up, so the join does not multiply rows.
    """
    rows = df.join(counties.select("county_id", "county_name"), "county_id", "left")
    if county_names is not None:
        rows = rows.where(F.col("county_name").isin(*county_names))
    weight = F.lit(1)
    if log is not None:
        rows = rows.join(log.groupBy("record_id").agg(F.count("*").alias("log_rows")), "record_id", "left")
        weight = F.coalesce("log_rows", F.lit(1))
    return (rows.groupBy("county_name", F.year(created).alias("year"), F.month(created).alias("month"))
            .agg(F.sum(weight.cast("bigint")).alias("record_count"))
            .orderBy("county_name", "year", "month"))


def hash_sample(df: DataFrame, by: list[str], ids: list[str], per_group: int, seed: str = "") -> DataFrame:
    """The `per_group` rows of each group with the least hash of their ids: uniform, and the same in every run.

    Unlike the rows with the least ids, these do not favour old records.  Each task keeps `per_group` rows of a group
    at most before the shuffle, and samples of parts of the data can be sampled again to the sample of the whole.
    """
    mark = F.md5(F.concat_ws("/", F.lit(seed), *[F.col(c).cast("string") for c in ids]))
    order = Window.partitionBy(*by).orderBy("_mark", *ids)
    return (df.withColumn("_mark", mark).withColumn("rn", F.row_number().over(order))
            .where(F.col("rn") <= per_group).drop("_mark"))


def stratified_sample(results: DataFrame, records: DataFrame, strata: range = range(1, 11), per_stratum: int = 5,
                      ) -> DataFrame:
    """Up to `per_stratum` results of each page count, with the record's number.

    The rank limit lets Spark trim each partition before the shuffle.
    """
    by_pages = Window.partitionBy("page_count").orderBy("record_id", "lease_id")
    picked = (results.where(F.col("page_count").isin(*strata))
              .withColumn("rn", F.row_number().over(by_pages)).where(F.col("rn") <= per_stratum))
    return (picked.join(records.select("record_id", "record_number"), "record_id")
            .orderBy("page_count", "rn"))


LEGAL_FIELDS = ("Subdivision", "Survey", "Lot", "Block", "Section", "Township", "Suffix", "QuarterCalls")


def unparsed_legal(land: DataFrame, fields: tuple[str, ...] = LEGAL_FIELDS, mode: str = "intended") -> DataFrame:
    """Land rows from whose text no field was extracted.

    Reference mode wants blanks: a NULL field makes the test unknown.
    """
    return land.where(all_blank(fields, null_is_blank=mode == "intended"))


def parsed_legal(land: DataFrame, fields: tuple[str, ...] = LEGAL_FIELDS) -> DataFrame:
    """The complement: rows with at least one field."""
    return land.where(any_filled(fields))


def unparsed_texts(land: DataFrame, text: str = "BriefLegal", fields: tuple[str, ...] = LEGAL_FIELDS,
                   mode: str = "intended") -> DataFrame:
    """How often each unparsed text occurs."""
    return group_frequency(unparsed_legal(land, fields, mode).where(F.col(text).isNotNull()), text)


def batch_audit(records: DataFrame, log: DataFrame, tag: str, day: str, other_tags: tuple[str, ...] = ()) -> DataFrame:
    """Suspicious rows after a load, labelled; a record may carry several labels.

    Not modified on the load day though in the batch; modified that day though
    in no batch; without county; and logged with a lease outside lease batches.
    """
    joined = records.join(log.select("record_id", "lease_id", "batch_tag"), "record_id", "left")
    in_batch = F.col("remarks").ilike(f"%{tag}%")
    today = on_day(F.col("keyed_ts"), day)
    labels = {
        "batch record not modified on the day": in_batch & ~today,
        "foreign record modified on the day": ~in_batch & today,
        "record without county": F.col("county_id").isNull(),
        "lease logged outside lease batches": F.col("lease_id").isNotNull()
        & ~F.col("batch_tag").ilike("%lease%") & ~fold(F.col("batch_tag")).isin(*[t.lower() for t in other_tags]),
    }
    found = F.array(*[F.when(test, F.lit(label)) for label, test in labels.items()])
    return (joined.select("record_id", "lease_id", "batch_tag", F.explode(found).alias("audit"))
            .where("audit is not null"))


def day_counts(records: DataFrame, log: DataFrame, day: str, received: str = "received_ts", modified: str = "modified_ts",
               ) -> DataFrame:
    """How many records were received, and how many log rows modified, on a day: one aggregate over both tables."""
    events = records.select(F.lit(True).alias("_received"), F.col(received).alias("_at")).unionByName(
        log.select(F.lit(False).alias("_received"), F.col(modified).alias("_at")))
    hits = events.where(on_day(F.col("_at"), day))
    return labelled_counts(hits, {"records received": F.count_if("_received"),
                                  "log rows modified": F.count_if(~F.col("_received"))}, "measure")
