"""Key slices of both sides: the columns by which records are matched."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.functions.rules import file_extension, source_path
from recordferry.functions.text import (
    digits_number, digits_text, fold, iso_date, positive_key, stable_id)
from recordferry.operators.counted import UNSEEN, Steps


@dataclass(frozen=True)
class TargetFilter:
    """Which target records enter a slice; None leaves a test out."""

    leases_only: bool = False
    status_ids: tuple[int, ...] | None = None
    min_file_date: str | None = None
    excluded_counties: tuple[int, ...] | None = None
    # state id -> county ids of that state; the states are alternatives
    areas: dict[int, tuple[int, ...]] | None = None
    instrument_types: tuple[str, ...] | None = None

    def condition(self) -> Column:
        tests = []
        if self.leases_only:
            tests.append(F.col("record_is_lease") == 1)
        if self.status_ids is not None:
            tests.append(F.col("status_id").isin(*self.status_ids))
        if self.min_file_date is not None:
            tests.append(F.col("file_date") >= F.lit(self.min_file_date).cast("date"))
        if self.excluded_counties is not None:
            tests.append(~F.col("county_id").isin(*self.excluded_counties))
        if self.areas is not None:
            tests.append(reduce(Column.__or__, [
                (F.col("state_id") == state) & F.col("county_id").isin(*counties)
                for state, counties in self.areas.items()]))
        if self.instrument_types is not None:
            tests.append(F.col("instrument_type_id").isin(*self.instrument_types))
        return reduce(Column.__and__, tests, F.lit(True))


def normalize_target(records: DataFrame, counties: DataFrame, crosswalk: DataFrame | None = None,
                     only: TargetFilter = TargetFilter(), county_keys: tuple[str, ...] = ("county_id",),
                     ) -> DataFrame:
    """Target slice: id, number, date, volume, page, county.

    `counties` has `county_keys` and `county_name`.  With a `crosswalk` (column
    `src_county_id`) only records of counties it knows are kept.  Lookups carry
    no broadcast hint: the planner broadcasts them by measured size and shuffles
    them when they are too large.
    """
    kept = records.where(only.condition())
    if crosswalk is not None:
        known = crosswalk.select(F.col("src_county_id").alias("county_id"))
        kept = kept.join(known, "county_id", "left_semi")
    names = counties.select(*county_keys, "county_name")
    return kept.join(names, list(county_keys)).select(
        F.lower("record_id").alias("record_id"),
        "record_number",
        "file_date",
        positive_key(F.col("volume")).alias("volume"),
        positive_key(F.col("page")).alias("page"),
        "county_name",
        "county_id",
    )


def source_keys(leases: DataFrame, counties: DataFrame, county_ids: tuple[int, ...] | None = None,
                ) -> DataFrame:
    """Narrow source slice, enough for matching; no file or id lookups."""
    kept = leases if county_ids is None else leases.where(F.col("county_id").isin(*county_ids))
    return kept.join(counties.select("county_id", "county_name"), "county_id", "left").select(
        "lease_id",
        "record_number",
        "record_date",
        positive_key(F.col("vol")).alias("volume"),
        positive_key(F.col("pg")).alias("page"),
        "county_name",
        "county_id",
    )


def lease_files(mappings: DataFrame, documents: DataFrame, files: DataFrame, steps: Steps = UNSEEN) -> DataFrame:
    """Files of each lease through lease -> document -> file, both 1:n.

    With `steps` the rows of each hop are counted; a mapping that finds its document twice is a `FanOut`.
    """
    mapped = steps.see(mappings, "mappings")
    with_document = steps.see(mapped.join(documents.select("document_id"), "document_id", "left"),
                              "with document", "mappings", keeps=True)
    return steps.see(with_document.join(files, "document_id", "left").select("lease_id", "path", "filename"),
                     "with files", "with document")


def first_file(files: DataFrame) -> DataFrame:
    """One file per lease, the first by name; partial aggregation before the shuffle.

    `extra_files` has the others.
    """
    first = F.min(F.struct("filename", "path")).alias("first")
    return (files.where(F.col("filename").isNotNull()).groupBy("lease_id").agg(first)
            .select("lease_id", "first.path", "first.filename"))


def extra_files(source: DataFrame, files: DataFrame, share_root: str) -> DataFrame:
    """The named files of each lease beyond the one that its record carries: lease, record id, path, name.

    `source` is the normalized slice of one row per lease.  A file listed twice is left over once, so files in =
    files carried + files left over.
    """
    name, path = F.col("filename"), F.col("path")
    carried = source.select("lease_id", F.col("generated_record_id").alias("record_id"),
                            F.col("source_file_path").alias("_carried"))
    each = (files.where(name.isNotNull()).groupBy("lease_id", "filename", "path").agg(F.count("*").alias("_n"))
            .join(carried, "lease_id", "left"))
    here = F.coalesce(source_path(share_root, path, name) == F.col("_carried"), F.lit(False))
    left = F.col("_n") - F.when(here, 1).otherwise(0)
    return each.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), left.cast("int")))).select(
        "lease_id", "record_id", "path", "filename")


def normalize_source(leases: DataFrame, issued_ids: DataFrame, counties: DataFrame, files: DataFrame,
                     *, share_root: str, mode: str = "intended", steps: Steps = UNSEEN) -> DataFrame:
    """Source slice with file columns and record ids, 28 columns.

    A lease keeps the record id issued to it earlier, else gets a stable one.
    Intended mode gives one row per lease, with its first file by name; the
    lease's further files are the rows of `extra_files`.
    Reference mode gives one row per file, each with an id of its own unless
    one was issued.

    With `steps` the rows of each join are counted.  Issued ids and counties must find a lease once, and so must
    files in intended mode: a lookup with a repeated key is a `FanOut`.
    """
    per_lease = first_file(files) if mode == "intended" else files
    new_id = [F.lit("lease"), F.col("lease_id")]
    if mode == "reference":
        new_id += [F.col("path"), F.col("filename")]
    name = F.col("filename")
    all_leases = steps.see(leases, "leases")
    issued = steps.see(all_leases.join(issued_ids.select("lease_id", F.col("record_id").alias("issued_id")), "lease_id", "left"),
                       "with issued id", "leases", keeps=True)
    placed = steps.see(issued.join(counties.select("county_id", "county_name", "state_id"), "county_id", "left"),
                       "with county", "with issued id", keeps=True)
    return (
        steps.see(placed.join(per_lease, "lease_id", "left"), "with file", "with county", keeps=mode == "intended")
        .select(
            "lease_id",
            F.coalesce("issued_id", stable_id(*new_id)).alias("generated_record_id"),
            "instrument",
            "record_number",
            "record_date",
            positive_key(F.col("vol")).alias("volume"),
            positive_key(F.col("pg")).alias("page"),
            source_path(share_root, F.col("path"), name).alias("source_file_path"),
            name.alias("original_file_name"),
            file_extension(name).alias("file_type"),
            file_extension(name).alias("file_extension"),
            "county_name", "county_id", "state_id", "effective_date", "instrument_date",
            "acres", "depth_code", "depth_min", "depth_max",
            "extension_term_months", "extension_bonus", "is_blm", "is_state",
            "term_months", "royalty", "delay_rental", "delay_rental_value",
        )
    )


def digits_slice(df: DataFrame, mode: str = "intended") -> DataFrame:
    """Add the digits-only number, as a number and as text, to a slice."""
    cut = 30 if mode == "reference" else None
    number = F.col("record_number")
    return (df.withColumn("digits_number", digits_number(number))
            .withColumn("digits_text", digits_text(number, cut)))


def with_match_keys(df: DataFrame) -> DataFrame:
    """Add the comparison key of the record number."""
    return df.withColumn("number_key", fold(F.col("record_number")))


def render_dates(df: DataFrame, *names: str) -> DataFrame:
    """Dates as `yyyy-mm-dd` text, for output only."""
    return df.withColumns({n: iso_date(F.col(n)) for n in names})
