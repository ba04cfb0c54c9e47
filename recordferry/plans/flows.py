"""The three end-to-end flows.

A flow strings jobs together and writes at its commit points.  What several
jobs read is written once to the shared folder first (`sinks.staged`), so a
lost executor costs its tasks and not the whole lineage.  Each flow writes new
paths under `out` and leaves its inputs alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordferry.operators import images, land, match, normalize, stage
from recordferry.operators import parties as people
from recordferry.operators import prior_refs as prior
from recordferry.operators.changes import append_rows, update_conflicts
from recordferry.operators.stage import Run
from recordferry.sources import sinks, tables


def migrate_records(target: DataFrame, source: DataFrame, log: DataFrame, crosswalk: DataFrame, run: Run,
                    out: str, mode: str = "intended", files: DataFrame | None = None, share_root: str = "",
                    ) -> dict[str, DataFrame]:
    """Stage records and log rows of leases that the target does not have.

    `target` and `source` are normalized slices.  Beside `records` and `export_log` it gives `losses`, the values that
    did not fit their column, and, with the leases' `files`, `extra_files`, those that no record carries.  Running it
    again with its own log added stages nothing.
    """
    spark = source.sparkSession
    work = sinks.shared_folder(spark)
    fresh = sinks.staged(match.stage_candidates(source, log, crosswalk, target, mode), work)
    written = {
        "records": sinks.write_table(stage.stage_records(fresh, run), f"{out}/records", unique=["recordID"]),
        "export_log": sinks.write_table(stage.stage_log(fresh, run), f"{out}/export_log", unique=["recordID", "LeaseID"]),
        "losses": sinks.write_table(stage.narrowing_losses(fresh, run), f"{out}/losses")}
    if files is not None:
        left = normalize.extra_files(fresh, files, share_root).where("record_id is not null")
        written["extra_files"] = sinks.write_table(left, f"{out}/extra_files")
    sinks.remove_folder(spark, work)
    return {name: spark.read.parquet(path) for name, path in written.items()}


def extract_legal(base: DataFrame, out: str) -> DataFrame:
    """Write the land base and the file for the outside legal-text parser."""
    spark = base.sparkSession
    written = spark.read.parquet(sinks.write_table(base, f"{out}/land_base", unique=["landDescriptionID"]))
    sinks.write_csv(land.parser_extract(written), f"{out}/brief_legal_csv")
    return written


def load_legal(spark: SparkSession, base: DataFrame, out: str, parsed_csv: str, mode: str = "intended",
               ) -> tuple[DataFrame, DataFrame]:
    """Take the parsed file back, explode the lists and stage the final rows.

    `base` is what `extract_legal` gave.  The second frame lists ids that the parsed file holds more than once with
    different values: the least of them was used.
    """
    parsed = tables.csv_table(spark, parsed_csv, tables.PARSED_LEGAL_SCHEMA, encoded=False)
    whole = F.to_json(F.struct(*parsed.columns))
    disputed = update_conflicts(parsed.withColumn("row", whole), "landDescriptionID", "row")
    conflicts = sinks.write_table(disputed, f"{out}/land_conflicts")
    exploded = land.explode_legal(land.apply_parsed(base, parsed), mode=mode, positions=True)
    final = sinks.write_table(land.load_land(exploded), f"{out}/land", unique=["landDescriptionID"])
    return spark.read.parquet(final), spark.read.parquet(conflicts)


def load_children(leases: DataFrame, grantors: DataFrame, grantees: DataFrame, records: DataFrame, log: DataFrame,
                  states: DataFrame, run: Run, prior_run: Run, out: str) -> tuple[DataFrame, DataFrame]:
    """Stage parties and prior references of the batch `run.tag`."""
    spark = leases.sparkSession
    parties = sinks.write_table(people.parties(leases, grantors, grantees, records, log, states, run), f"{out}/parties")
    refs = sinks.write_table(prior.prior_refs(leases, records, log, prior_run, run.tag), f"{out}/prior_refs",
                             unique=["priorrefid"])
    return spark.read.parquet(parties), spark.read.parquet(refs)


def image_pass(work: DataFrame, manifest: DataFrame, log: DataFrame, registry: DataFrame, bucket: str, tag: str,
               run: Run, out: str) -> dict[str, DataFrame]:
    """Resolve a worklist, plan its copies, and give the registry rows and the next worklist.

    `registry` has `record_id` and `status`.
    """
    spark = work.sparkSession
    written = {"results": sinks.write_table(images.resolve(work, manifest, bucket), f"{out}/results",
                                            sinks.IMAGE_RESULT_SCHEMA, unique=["lease_id"])}
    results = spark.read.parquet(written["results"])
    registered = images.register(results, log, tag, run).withColumn("status", F.lit(None).cast("string"))
    written["copy_plan"] = sinks.write_table(images.copy_plan(results, registry, bucket, run), f"{out}/copy_plan")
    written["registry_rows"] = sinks.write_table(registered, f"{out}/registry_rows", sinks.IMAGE_REGISTRY_SCHEMA)
    written["next_work"] = sinks.write_table(images.requeue(work, results), f"{out}/next_work")
    return {name: spark.read.parquet(path) for name, path in written.items()}


def extended_log(log: DataFrame, staged_log: DataFrame) -> DataFrame:
    """The export log with staged rows added, in the log's own columns."""
    renamed = staged_log.withColumnsRenamed({"recordID": "record_id", "LeaseID": "lease_id", "zipName": "batch_tag"})
    return append_rows(log, renamed, ["record_id", "lease_id", "batch_tag"])
