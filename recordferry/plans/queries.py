"""Registered queries: each job bound to the views of `sources.bindings`.

Timestamps leave a query as text and decimals as doubles, so that both engines
render them alike; the jobs themselves keep the real types.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.functions import rules as R
from recordferry.operators import bitmaps, changes, counted, diff, images, land, match, normalize, profile, quality, relational, stage
from recordferry.operators import parties as people
from recordferry.operators import prior_refs as prior
from recordferry.operators.stage import Run
from recordferry.session import configure
from recordferry.sources import sinks, tables
from recordferry.sources.bindings import Bindings

RUN = Run(at="2025-07-17 00:00:00", tag="BATCH(2)", user="migration")
LAND_RUN = Run(at="2025-07-17 00:00:00", tag="LAND", user="migration")
PRIOR_RUN = Run(at="2025-07-17 00:00:00", tag="PRIOR", user="migration")
BUCKET = "plant-images"
SHARE = "\\\\share\\leases"
LAND_COLUMNS = ("section", "quarter_calls", "lot")
ZERO_IS_MISSING = ("ExtensionLength", "ExtensionBonus", "TermLength", "RoyaltyAmount", "RentalAmount")
SLICE = normalize.TargetFilter(leases_only=True, status_ids=(4, 16), min_file_date="1996-01-01",
                               excluded_counties=(3, 7))
AREAS = normalize.TargetFilter(areas={1: (1, 6, 11), 3: (8,)}, status_ids=(4, 10, 16, 18, 90))

QUERIES: dict[str, Callable[[Bindings], DataFrame]] = {}


def query(fn: Callable[[Bindings], DataFrame]) -> Callable[[Bindings], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text, decimals as doubles."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            changed[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            changed[f.name] = F.col(f.name).cast("double")
    return df.withColumns(changed) if changed else df


# ---- inputs shared by several queries ------------------------------------------------

def counties(b: Bindings) -> DataFrame:
    return b.county_xwalk.select(F.col("src_county_id").alias("county_id"), "county_name", "state_id")


def target_slice(b: Bindings) -> DataFrame:
    return normalize.normalize_target(b.tgt_record, counties(b))


def source_slice(b: Bindings) -> DataFrame:
    return normalize.source_keys(b.src_lease, counties(b))


def full_source(b: Bindings, mode: str = "intended") -> DataFrame:
    return normalize.normalize_source(b.src_lease_terms, b.issued_ids, counties(b), b.lease_file,
                                      share_root=SHARE, mode=mode)


def candidates(b: Bindings, mode: str = "intended") -> DataFrame:
    return match.stage_candidates(full_source(b), b.export_log, b.county_xwalk, target_slice(b), mode)


def staged_parties(b: Bindings) -> DataFrame:
    return people.parties(b.src_lease, b.grantor, b.grantee, b.tgt_record, b.export_log, b.state_lookup, RUN)


def staged_prior_refs(b: Bindings) -> DataFrame:
    return prior.prior_refs(b.lease_deed, b.tgt_record, b.export_log, PRIOR_RUN, RUN.tag)


def resolved_images(b: Bindings) -> DataFrame:
    return images.resolve(b.image_work, b.object_manifest, BUCKET)


def batch(b: Bindings) -> DataFrame:
    return b.tgt_record.where("remarks = 'BATCH(2)'")


# ---- slices ---------------------------------------------------------------------------

@query
def normalize_target(b):
    sliced = normalize.normalize_target(b.tgt_record, counties(b), b.county_xwalk, SLICE)
    return normalize.render_dates(sliced, "file_date")


@query
def normalize_target_areas(b):
    sliced = normalize.normalize_target(b.tgt_record_state, counties(b), only=AREAS,
                                        county_keys=("county_id", "state_id"))
    return normalize.render_dates(sliced, "file_date")


@query
def normalize_source(b):
    return plain(normalize.render_dates(full_source(b), "record_date"))


@query
def normalize_source_per_file(b):
    return plain(normalize.render_dates(full_source(b, "reference"), "record_date"))


@query
def normalize_target_types(b):
    kind = F.when(F.col("outsource_id") % 3 == 0, "OGL").when(F.col("outsource_id") % 3 == 1, "ASN")
    only = normalize.TargetFilter(instrument_types=("OGL", "MOGL"))
    sliced = normalize.normalize_target(b.tgt_record.withColumn("instrument_type_id", kind), counties(b), only=only)
    return normalize.render_dates(sliced, "file_date")


@query
def extra_files(b):
    return normalize.extra_files(full_source(b), b.lease_file, SHARE)


@query
def digits_key_cut(b):
    long = F.concat(F.repeat("record_number", 6), F.lit("-7"))
    return normalize.digits_slice(b.tgt_record.select("record_id", long.alias("record_number")), "reference").select(
        "record_id", "digits_number", "digits_text")


@query
def lease_file_chain(b):
    mappings = b.document_mapping.select("lease_id", F.col("mapping_id").alias("document_id"))
    files = b.lease_file.select(F.md5(F.col("lease_id").cast("string")).alias("document_id"), "path", "filename")
    return normalize.lease_files(mappings, mappings.select("document_id"), files)


@query
def normalize_source_steps(b):
    """Rows in and out of each join; a lookup that multiplied leases would stop the job."""
    steps = counted.Steps()
    counted.run(normalize.normalize_source(b.src_lease_terms, b.issued_ids, counties(b), b.lease_file, share_root=SHARE, steps=steps))
    steps.check()
    return steps.report(b.spark)


@query
def normalize_per_file_steps(b):
    steps = counted.Steps()
    counted.run(normalize.normalize_source(b.src_lease_terms, b.issued_ids, counties(b), b.lease_file, share_root=SHARE,
                                           mode="reference", steps=steps))
    return steps.report(b.spark)


@query
def lease_file_steps(b):
    mappings = b.document_mapping.select("lease_id", F.col("mapping_id").alias("document_id"))
    files = b.lease_file.select(F.md5(F.col("lease_id").cast("string")).alias("document_id"), "path", "filename")
    steps = counted.Steps()
    counted.run(normalize.lease_files(mappings, mappings.select("document_id"), files, steps))
    steps.check()
    return steps.report(b.spark)


@query
def digits_key(b):
    target = normalize.digits_slice(b.tgt_record).select(
        F.lit("target").alias("side"), F.col("record_id").alias("id"), "digits_number", "digits_text")
    source = normalize.digits_slice(b.src_lease).select(
        F.lit("source").alias("side"), F.col("lease_id").cast("string").alias("id"), "digits_number", "digits_text")
    return target.unionByName(source)


# ---- matching ---------------------------------------------------------------------------

@query
def match_exact(b):
    return match.not_logged(match.match_exact(target_slice(b), source_slice(b)), b.export_log)


@query
def match_exact_left(b):
    pairs = match.match_exact(target_slice(b), source_slice(b), keep_unmatched=True)
    return match.not_logged(pairs, b.export_log)


@query
def match_volpage(b):
    return match.not_logged(match.match_volume_page(target_slice(b), source_slice(b)), b.export_log)


@query
def match_substring(b):
    return match.unexported(match.match_contained(target_slice(b), source_slice(b)), b.export_log, "reference")


@query
def match_or_legacy(b):
    return match.match_any_legacy(normalize.digits_slice(target_slice(b)),
                                  normalize.digits_slice(source_slice(b)), b.export_log)


@query
def match_exact_by_log_status(b):
    return match.unexported(match.match_exact(target_slice(b), source_slice(b)), b.export_log, "reference")


@query
def source_only(b):
    return match.source_only(target_slice(b), source_slice(b), b.export_log)


@query
def match_report(b):
    return match.match_report(target_slice(b), source_slice(b), b.export_log)


@query
def match_report_per_log_row(b):
    return match.match_report(target_slice(b), source_slice(b), b.export_log, mode="reference")


@query
def match_key_report(b):
    return normalize.render_dates(match.key_report(target_slice(b), source_slice(b)), "day")


@query
def match_index_rows(b):
    return match.index_report(target_slice(b), source_slice(b))


@query
def match_union_distinct(b):
    return match.match_distinct(target_slice(b), source_slice(b), b.export_log)


@query
def missing_in_target(b):
    missing = match.missing_in_target(b.src_lease, b.tgt_record, b.export_log)
    return plain(missing.select("lease_id", "county_id", "record_number", "created"))


@query
def unlogged_leases(b):
    return match.not_logged(source_slice(b), b.export_log, "lease_id").select("lease_id", "county_name")


# ---- staging ------------------------------------------------------------------------------

@query
def log_fill_candidates(b):
    return match.log_fill_candidates(b.export_log, target_slice(b), source_slice(b))


@query
def log_fill_apply(b):
    choices = match.log_fill_choices(b.export_log, target_slice(b), source_slice(b))
    return plain(changes.fill_log_leases(b.stamped_log, choices, "BATCH(1)", RUN.at))


@query
def log_fill_full_log(b):
    choices = match.log_fill_choices(b.export_log, target_slice(b), source_slice(b))
    return plain(changes.fill_log_leases(b.full_log, choices, "BATCH(1)", RUN.at))


@query
def narrowing_losses(b):
    lease = F.col("lease_id")
    wide = candidates(b, "reference").withColumns({
        "royalty": F.when(lease % 50 == 0, F.lit(12.5)).otherwise(F.lit(0.125)).cast("decimal(9,6)"),
        "extension_bonus": F.when(lease % 60 == 1, F.lit(9_000_000_000_000)).otherwise(F.lit(5)),
        "county_name": F.lit("kept")})
    return stage.narrowing_losses(wide, RUN)


@query
def stage_candidates(b):
    return candidates(b).select("lease_id", "generated_record_id", "county_id", "tgt_county_id")


@query
def stage_candidates_by_log(b):
    return candidates(b, "reference").select("lease_id", "generated_record_id", "county_id", "tgt_county_id")


@query
def stage_records(b):
    return plain(stage.stage_records(candidates(b, "reference"), RUN))


@query
def stage_log(b):
    return plain(stage.stage_log(candidates(b, "reference"), RUN))


@query
def status_row(b):
    statuses = b.tgt_record.select("status_id").distinct()
    known = statuses.withColumn("data_entry_description", F.lit("in use"))
    return stage.register_status(known, 91, "Leases mapped from source", "unused")


@query
def map_term(b):
    return b.src_lease.select("lease_id", "term_months", R.term_years(F.col("term_months")).alias("term_years"))


@query
def map_instrument(b):
    return b.src_lease.select("lease_id", R.instrument_code(F.col("instrument")).alias("instrument_type"))


@query
def map_depth(b):
    return b.src_lease.select("lease_id", R.depth_type(F.col("depth_code")).alias("depth_type"))


@query
def map_state(b):
    return b.src_lease.select("lease_id", R.state_code(F.col("lease_id") % 110).alias("state_code"))


@query
def map_flags(b):
    months = F.col("extension_term_months")
    return b.src_lease.select(
        "lease_id", R.area_missing_flag(F.col("acres")).alias("area_flag"),
        R.extension_flag(months).alias("extension_flag"), R.extension_unit(months).alias("extension_unit"))


@query
def map_file_type(b):
    return b.lease_file.select(
        "lease_id", "filename", R.file_extension(F.col("filename")).alias("extension"),
        R.source_path(SHARE, F.col("path"), F.col("filename")).alias("source_file_path"))


# ---- children -----------------------------------------------------------------------------

def land_rows(b: Bindings, mode: str = "intended") -> DataFrame:
    texts = land.legal_texts(b.src_lease, b.document_mapping, b.abstract_mapping, b.abstract)
    return land.land_base(texts, b.export_log, b.tgt_record_state, b.state_lookup, counties(b), LAND_RUN,
                          excluded_states=("EUROPE",), mode=mode)


def applied_land(b: Bindings) -> DataFrame:
    base = b.land_desc.withColumns({"survey": F.lit(None).cast("string"), "subdivision": F.lit("old")})
    fields = {"section": "parsed_section", "quarter_calls": "parsed_quarter_calls", "lot": "parsed_lot",
              "survey": "survey", "subdivision": "subdivision"}
    return land.apply_parsed(base, b.parsed_legal, "land_description_id", fields)


@query
def land_base(b):
    return plain(land_rows(b))


@query
def land_base_steps(b):
    texts = land.legal_texts(b.src_lease, b.document_mapping, b.abstract_mapping, b.abstract)
    steps = counted.Steps()
    counted.run(land.land_base(texts, b.export_log, b.tgt_record_state, b.state_lookup, counties(b), LAND_RUN,
                               excluded_states=("EUROPE",), steps=steps))
    return steps.report(b.spark)


@query
def parser_extract(b):
    return land.parser_extract(land_rows(b))


@query
def land_base_reference(b):
    return plain(land_rows(b, "reference"))


@query
def land_apply_parsed(b):
    return applied_land(b)


@query
def land_explode(b):
    return land.explode_legal(b.land_desc, LAND_COLUMNS)


@query
def land_explode_reference(b):
    return land.explode_legal(b.land_desc, LAND_COLUMNS, "reference", ("survey_block", "range_no"))


@query
def land_load(b):
    exploded = land.explode_legal(applied_land(b), LAND_COLUMNS, positions=True)
    return land.load_land(exploded, "land_description_id", LAND_COLUMNS, ("county_id",))


@query
def land_delete_lists(b):
    return changes.delete_where(b.land_desc, F.col("section").contains(","))


@query
def parties(b):
    return plain(staged_parties(b))


@query
def parties_load(b):
    staged = staged_parties(b)
    present = staged.where("recordType = 'grantee'").withColumn("note", F.lit("keyed by hand"))
    return plain(changes.append_rows(present, staged))


@query
def prior_refs(b):
    return plain(staged_prior_refs(b))


@query
def prior_refs_load(b):
    staged = staged_prior_refs(b)
    return plain(changes.append_rows(staged.where("drVolume is null"), staged))


# ---- images -------------------------------------------------------------------------------

@query
def image_worklist(b):
    return images.worklist(b.tgt_record_state, b.export_log, b.image_work, counties(b), b.state_lookup,
                           b.image_registry)


@query
def image_resolve(b):
    return resolved_images(b)


@query
def image_resolve_prefix(b):
    return images.resolve(b.image_work, b.object_manifest, BUCKET, "reference")


@query
def image_copy_plan(b):
    return images.copy_plan(resolved_images(b), b.image_registry, BUCKET, RUN)


@query
def image_copy_plan_reference(b):
    return images.copy_plan(resolved_images(b), b.image_registry, BUCKET, RUN, "reference")


@query
def image_copy_outcome(b):
    return images.copy_outcome(images.copy_plan(resolved_images(b), b.image_registry, BUCKET, RUN), b.copy_call,
                               Run("2025-07-18 01:02:03", RUN.tag, RUN.user))


@query
def image_delete_plan(b):
    bare = F.regexp_replace("destination_path", "^s3://", "")
    cleanup = resolved_images(b).where("status = 'processed'").select(
        "record_id", "lease_id",
        F.when(F.col("page_count") > 5, bare).otherwise(F.col("destination_path")).alias("destination_path"))
    return images.delete_plan(cleanup, b.delete_outcome, BUCKET, RUN)


@query
def image_requeue(b):
    work = b.image_work.withColumns({
        "source_path": F.lit(""), "destination_path": F.lit(""), "page_count": F.lit(0),
        "file_size": F.lit(0).cast("bigint"), "status": F.lit("")})
    results = images.resolve(work.where("package_id is not null"), b.object_manifest, BUCKET)
    return images.requeue(work, results)


@query
def image_register(b):
    return plain(images.register(resolved_images(b), b.export_log, "LEGACY", RUN))


@query
def map_rows_hook(b):
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(file_name=rows["source_path"].str.rsplit("/", n=1).str[-1])

    return images.map_rows(resolved_images(b), add, "file_name string")


# ---- changes ------------------------------------------------------------------------------

@query
def status_move(b):
    return plain(changes.move_status(b.tgt_record, b.export_log, "BATCH", "1997-07-01", (24, 25)))


@query
def status_preview(b):
    """The rows that `status_move` moves: same shift."""
    return plain(changes.rekeyed(b.tgt_record, b.export_log, "BATCH", "1997-07-01", (24, 25)))


@query
def status_preview_hours(b):
    """The preview with the whole-hour shift."""
    return plain(changes.rekeyed(b.tgt_record, b.export_log, "BATCH", "1997-07-01", (24, 25), offset_minutes=600))


@query
def retype_columns(b):
    return changes.retype(b.src_lease.select("lease_id", "county_id", "pg"), lease_id="string", county_id="bigint")


@query
def promote_table(b):
    folder = sinks.shared_folder(b.spark)
    return sinks.promote_table(b.spark, sinks.write_table(b.tgt_record, f"{folder}/work"), f"{folder}/live")


@query
def promoted_records(b):
    """What readers of the live table see after two promotions."""
    folder = sinks.shared_folder(b.spark)
    moved = changes.move_status(b.tgt_record, b.export_log, "BATCH", "1997-07-01", (24, 25))
    for work in (b.tgt_record, moved):
        sinks.promote_table(b.spark, sinks.write_table(work, f"{folder}/work"), f"{folder}/live")
    return plain(sinks.read_published(b.spark, f"{folder}/live"))


def parted(b: Bindings, df: DataFrame, key: str) -> tuple[str, str]:
    folder = sinks.shared_folder(b.spark)
    sinks.write_parted(df, f"{folder}/table", key, bits=4)
    return f"{folder}/table", f"{folder}/work"


@query
def status_move_parts(b):
    """The status move, applied to the ranges of ids that hold a record to be moved."""
    table, work = parted(b, b.tgt_record, "record_id")
    moved = changes.rekeyed(b.tgt_record, b.export_log, "BATCH", "1997-07-01", (24, 25))
    sinks.rewrite_parts(b.spark, table, moved.select("record_id"), lambda rows: changes.move_status(
        rows, b.export_log, "BATCH", "1997-07-01", (24, 25)), work)
    return plain(sinks.read_parted(b.spark, table))


@query
def delete_existing_parts(b):
    table, work = parted(b, b.image_work, "record_id")
    sinks.rewrite_parts(b.spark, table, b.image_registry.select("record_id"),
                        lambda rows: changes.delete_matching(rows, b.image_registry, ["record_id"]), work)
    return sinks.read_parted(b.spark, table)


@query
def log_fill_parts(b):
    table, work = parted(b, b.full_log, "record_id")
    choices = sinks.staged(match.log_fill_choices(b.export_log, target_slice(b), source_slice(b)), work)
    sinks.rewrite_parts(b.spark, table, choices.select(F.col("target_record_id").alias("record_id")),
                        lambda rows: changes.fill_log_leases(rows, choices, "BATCH(1)", RUN.at), work)
    return plain(sinks.read_parted(b.spark, table))


@query
def append_counts(b):
    """Rows before, appended (counted while they are written) and after."""
    folder = sinks.shared_folder(b.spark)
    steps = counted.Steps()
    log = sinks.write_table(steps.see(b.export_log, "before"), f"{folder}/log")
    added = sinks.append_table(b.tgt_record.withColumn("batch_tag", F.col("remarks")), log, ["record_id", "batch_tag"])
    before = steps.counts()["before"]
    return b.spark.read.parquet(log).agg(F.lit(before).cast("bigint").alias("before"), F.lit(added).cast("bigint").alias("appended"),
                                         F.count("*").alias("after"))


@query
def status_move_diff(b):
    """What `status_move` would change: one row per record and column."""
    return diff.change_set(b.tgt_record, changes.move_status(b.tgt_record, b.export_log, "BATCH", "1997-07-01", (24, 25)), "record_id")


@query
def delete_diff(b):
    left = changes.delete_matching(b.image_work, b.image_registry, ["record_id"])
    gone = diff.change_set(b.image_work, left, "record_id")
    return gone.select("record_id", "change", F.get_json_object("before", "$.lease_id").cast("bigint").alias("lease_id"), "after", "copies")


@query
def csv_rejects(b):
    """Lines of which some have too many fields, too few, or text where a number belongs."""
    folder = sinks.shared_folder(b.spark)
    row, county = F.col("land_description_id"), F.col("county_id").cast("string")
    line = (F.when(F.col("county_id") % 4 == 0, F.concat_ws(",", row, county)).when(F.col("county_id") % 4 == 1, F.concat_ws(",", row, F.lit("x")))
            .when(F.col("county_id") % 4 == 2, row).otherwise(F.concat_ws(",", row, county, F.lit("more"))))
    b.land_desc.select(line.alias("value")).write.text(f"{folder}/lines", lineSep="\n")
    options = dict(tables.CSV_OPTIONS, header="false")
    checked = sinks.staged(tables.csv_checked(b.spark, f"{folder}/lines", "land_description_id string, county_id int", options=options),
                           f"{folder}/checked")
    return tables.accepted(checked).select("land_description_id", "county_id", F.lit(None).cast("string").alias("line")).unionByName(
        tables.rejected(checked).select(F.lit(None).cast("string").alias("land_description_id"), F.lit(None).cast("int").alias("county_id"), "line"))


@query
def append_load(b):
    folder = sinks.shared_folder(b.spark)
    log = sinks.write_table(b.export_log, f"{folder}/log")
    sinks.append_table(b.tgt_record.withColumn("batch_tag", F.col("remarks")), log, ["record_id", "batch_tag"])
    return b.spark.read.parquet(log)


@query
def csv_roundtrip(b):
    folder = sinks.shared_folder(b.spark)
    rows = b.land_desc.select("land_description_id", "survey_block", "section", "brief_legal")
    sinks.write_csv(rows.orderBy("survey_block", "land_description_id"), f"{folder}/legal_csv")
    return tables.csv_table(b.spark, f"{folder}/legal_csv", rows.schema.simpleString()[7:-1].replace(":", " "))


@query
def csv_roundtrip_hard(b):
    folder = sinks.shared_folder(b.spark)
    sinks.write_csv(b.hard_text, f"{folder}/hard_csv")
    return tables.csv_table(b.spark, f"{folder}/hard_csv", "land_description_id string, hard string")


@query
def profile_csv(b):
    folder = sinks.shared_folder(b.spark)
    profile = quality.null_profile(b.tgt_record)
    sinks.write_csv(profile, f"{folder}/profile_csv")
    schema = ", ".join(f"`{c}` bigint" for c in profile.columns)
    return tables.csv_table(b.spark, f"{folder}/profile_csv", schema)


# ---- quality ------------------------------------------------------------------------------

@query
def null_profile(b):
    return quality.null_profile(stage.stage_records(candidates(b, "reference"), RUN), ZERO_IS_MISSING)


@query
def null_profile_rows(b):
    return quality.profile_rows(quality.null_profile(b.src_lease))


@query
def profile_merged(b):
    """The profile of all records, from states of the batches."""
    batches = profile.state(b.tgt_record, ["remarks"])
    return profile.counts(profile.merged(batches)).select("column_name", "value_count", "null_count")


@query
def profile_drift(b):
    """The batch against all other records."""
    parts = profile.state(b.tgt_record.withColumn("batch", F.col("remarks") == "BATCH(2)"), ["batch"])
    found = profile.drift(parts.where("not batch").drop("batch"), parts.where("batch").drop("batch"))
    return found.select("column_name", "rows_before", "rows_after", "missing_before", "missing_after")


@query
def missing_relations_staged(b):
    """As `missing_relations`, over tables staged by record id: nothing but the final counts is shuffled."""
    folder = sinks.shared_folder(b.spark)

    def by_record(df: DataFrame) -> DataFrame:
        return sinks.bucketed(df, folder, "record_id", 8)

    return quality.missing_relations(by_record(batch(b).where("record_is_lease = 1").select("record_id")), {
        "land descriptions": by_record(b.land_desc.select("record_id")),
        "grantor/grantee entries": by_record(staged_parties(b).select(F.col("recordID").alias("record_id"))),
        "volume/page references": by_record(staged_prior_refs(b).select(F.col("recordID").alias("record_id"))),
        "export log": by_record(b.export_log.select("record_id"))})


@query
def object_folders(b):
    """The folders of a stored table, from a listing of its files."""
    folder = sinks.shared_folder(b.spark)
    b.tgt_record.select("record_id", "outsource_id", "status_id").repartition("outsource_id").write.partitionBy("outsource_id", "status_id").parquet(folder)
    files = tables.object_walk(b.spark, folder).where(F.col("object_key").endswith(".parquet") & (F.col("size_bytes") > 0))
    return files.select(F.regexp_replace("object_key", "/[^/]*$", "").alias("folder")).distinct()


@query
def image_register_table(b):
    """The registry rows as a checked table: no NULL where the declaration forbids it, ids unique."""
    rows = images.register(resolved_images(b), b.export_log, "LEGACY", RUN).withColumn("status", F.lit("registered"))
    return plain(b.spark.read.parquet(sinks.write_table(rows, f"{sinks.shared_folder(b.spark)}/registry", sinks.IMAGE_REGISTRY_SCHEMA,
                                                        unique=["recordID"])))


@query
def staged_and_removed(b):
    """A result outlives the work tables that it was made from."""
    folder = sinks.shared_folder(b.spark)
    work = sinks.staged(b.export_log.where("lease_id is not null"), f"{folder}/work")
    kept = sinks.write_table(work.groupBy("batch_tag").agg(F.count("*").alias("log_rows")), f"{folder}/kept")
    sinks.remove_folder(b.spark, f"{folder}/work")
    return b.spark.read.parquet(kept)


@query
def record_sample(b):
    """Five records of each outsource id, drawn by hash."""
    drawn = quality.hash_sample(b.tgt_record, ["outsource_id"], ["record_id"], 5, "qa")
    return drawn.select("outsource_id", "record_id", "record_number", "rn")


@query
def blank_counts(b):
    return quality.blank_counts(b.src_lease, ("record_number", "vol", "deed_vol", "deed_pg"))


@query
def party_null_split(b):
    return quality.null_split(staged_parties(b), "recordType", ("recordID", "gName", "gAddress", "gZip", "gCity", "StateID"))


@query
def orphans(b):
    return quality.orphans(b.land_desc, b.tgt_record)


@query
def orphans_parties(b):
    """Records with parties and no registered image."""
    return quality.orphans(staged_parties(b).select(F.col("recordID").alias("record_id")), b.image_registry)


@query
def orphans_prior_refs(b):
    return quality.orphans(staged_prior_refs(b).select(F.col("recordID").alias("record_id")), b.image_registry)


@query
def orphans_log(b):
    """Log rows of records that the target does not have."""
    return quality.orphans(b.export_log, b.tgt_record)


@query
def missing_relations(b):
    records = batch(b).where("record_is_lease = 1")
    return quality.missing_relations(records, {
        "land descriptions": b.land_desc,
        "grantor/grantee entries": staged_parties(b).select(F.col("recordID").alias("record_id")),
        "volume/page references": staged_prior_refs(b).select(F.col("recordID").alias("record_id")),
        "export log": b.export_log})


@query
def county_reconcile(b):
    return quality.county_reconcile(b.src_lease, batch(b), b.export_log, b.county_xwalk, "src_county_id")


@query
def county_reconcile_shared(b):
    """Target county ids, several source counties to one, and a county that only the target has."""
    at = F.when(F.col("outsource_id") == 29, 2999).otherwise(2000 + F.col("county_id") % 10)
    return quality.county_reconcile(b.src_lease, batch(b).withColumn("county_id", at), b.export_log, b.shared_xwalk)


@query
def county_reconcile_global(b):
    return quality.county_reconcile_global(b.src_lease, batch(b), b.export_log, b.county_xwalk)


@query
def funnel(b):
    log = b.export_log.withColumn("logged", F.lit(True))
    deeds = b.lease_deed.withColumn("leased", F.lit(True))
    # Most records have no lease: those rows would all meet in one task, so they stay out of the second join.
    logged = b.tgt_record.join(log, "record_id", "left")
    leased = logged.where("lease_id is not null").join(deeds, "lease_id", "left")
    joined = leased.unionByName(logged.where("lease_id is null"), allowMissingColumns=True)
    return quality.funnel(joined, {
        "batch records": F.col("remarks") == "BATCH(2)",
        "with log row": F.col("logged"),
        "with lease": F.col("leased"),
        "with deed reference": (F.rtrim("deed_vol") != "") & (F.rtrim("deed_pg") != "")})


@query
def name_coverage(b):
    return quality.name_coverage(staged_parties(b), b.grantor, b.grantee)


@query
def name_coverage_partial(b):
    """Against one of the two lists."""
    return quality.name_coverage(staged_parties(b), b.grantee)


@query
def lease_counts_rollup(b):
    """Distinct leases by state, county and year, each level merged from the one below."""
    placed = b.src_lease.join(counties(b), "county_id", "left").withColumn("year", F.year("record_date"))
    return bitmaps.rollup_counts(placed, ["state_id", "county_name", "year"], "lease_id", "leases")


@query
def instrument_volume(b):
    return quality.group_frequency(b.src_lease.select(R.instrument_code(F.col("instrument")).alias("instrument_type")), "instrument_type")


@query
def day_counts(b):
    return quality.day_counts(b.tgt_record, b.full_log, "1997-03-05", received="keyed_ts")


@query
def name_coverage_grantors(b):
    return quality.name_coverage(staged_parties(b), b.grantor)


@query
def value_freq(b):
    return quality.value_frequency(b.land_desc, ("section", "quarter_calls", "lot", "range_dir", "survey_block"))


@query
def section_freq(b):
    return quality.group_frequency(b.land_desc.where(F.col("section").contains(",")), "section", "brief_legal")


@query
def status_freq(b):
    return quality.group_frequency(batch(b), "status_id", "outsource_id")


@query
def rule_violations(b):
    records = b.tgt_record.withColumn("instrument_date", F.col("file_date"))
    checked = quality.with_known_county(
        records, b.county_xwalk.where("tgt_county_id is not null"), "src_county_id")
    return quality.rule_violations(checked, quality.batch_rules("BATCH", F.lit("1999-01-01").cast("date")))


@query
def monthly_volume(b):
    return quality.monthly_volume(b.tgt_record.where("record_is_lease = 1"), counties(b), "keyed_ts")


@query
def monthly_volume_per_log_row(b):
    return quality.monthly_volume(b.tgt_record.where("record_is_lease = 1"), counties(b), "keyed_ts",
                                  ("NATION_1", "NATION_5", "NATION_9"), b.export_log)


@query
def monthly_volume_source(b):
    return quality.monthly_volume(b.src_lease, counties(b), "created")


@query
def stratified_sample(b):
    return quality.stratified_sample(resolved_images(b), b.tgt_record)


@query
def unparsed_legal(b):
    return quality.unparsed_legal(b.land_desc, LAND_COLUMNS)


@query
def unparsed_legal_reference(b):
    return quality.unparsed_legal(b.land_desc, ("section", "lot"), "reference")


@query
def parsed_legal(b):
    return quality.parsed_legal(b.land_desc, LAND_COLUMNS)


@query
def unparsed_texts(b):
    return quality.unparsed_texts(b.land_desc, "brief_legal", LAND_COLUMNS)


@query
def batch_audit(b):
    return quality.batch_audit(b.tgt_record, b.export_log, "BATCH", "1997-03-05", ("LEGACY",))


@query
def target_counts(b):
    return quality.target_counts(b.tgt_record, (4, 10, 16, 18, 90), "BATCH")


@query
def log_counts(b):
    return relational.labelled_counts(b.export_log, {
        "log rows": F.count("*"), "log rows with lease": F.count("lease_id"),
        "logged records": F.count_distinct("record_id")}, "measure")


@query
def party_counts(b):
    return staged_parties(b).groupBy("recordType").agg(
        F.count("*").alias("party_rows"), F.count_distinct("recordID").alias("records"))


@query
def null_aware_exclusion(b):
    return relational.not_in(b.export_log.select("lease_id"), b.issued_ids, "lease_id")


@query
def null_aware_exclusion_with_null(b):
    return relational.not_in(b.issued_ids, b.export_log, "lease_id")


@query
def semi_exists(b):
    return plain(relational.in_set(b.tgt_record, b.image_registry, "record_id"))


@query
def delete_existing(b):
    return changes.delete_matching(b.image_work, b.image_registry, ["record_id"])


@query
def author_exclusion(b):
    return b.stamped_log.where(~F.col("zip_name").isin("LEGACY", "RETRY"))


@query
def dup_keys(b):
    return changes.duplicate_keys(b.export_log, ["record_id"])


@query
def log_fill_conflicts(b):
    choices = match.log_fill_choices(b.export_log, target_slice(b), source_slice(b))
    return choices.where("candidates > 1").select("target_record_id", "candidates")


@query
def log_fill_conflicts_shared(b):
    """Where two leases share each number of the even leases."""
    source = source_slice(b)
    twins = source.where("lease_id % 2 = 0").withColumn("lease_id", F.col("lease_id") + 1_000_000_000)
    choices = match.log_fill_choices(b.export_log, target_slice(b), source.unionByName(twins))
    return choices.where("candidates > 1").select("target_record_id", "candidates")


@query
def dup_keys_images(b):
    results = resolved_images(b)
    return changes.duplicate_keys(results.unionByName(results.where("page_count = 3")), ["lease_id"])


@query
def top_n(b):
    joined = b.tgt_record.join(b.export_log.where(F.col("batch_tag").ilike("%legacy%")), "record_id")
    return plain(relational.top_n(joined.select("record_id", "record_number", "lease_id", "keyed_ts"), 100,
                                  "lease_id", "record_id"))


@query
def both_sides(b):
    pairs = relational.prefixed(b.tgt_record, "tr_").join(
        relational.prefixed(b.export_log, "log_"), F.col("tr_record_id") == F.col("log_record_id"), "left")
    return plain(pairs.where(F.col("tr_remarks").ilike("%batch%")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn):
        return lambda spark, sf_dir: fn(Bindings(configure(spark), sf_dir))

    return {name: bound(fn) for name, fn in QUERIES.items()}
