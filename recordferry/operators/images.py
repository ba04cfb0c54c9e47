"""Document images: worklist, resolution against an object listing, registry.

Objects are described by a manifest DataFrame (key, size, page count); copies
and deletes are planned as rows, never carried out here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.functions.rules import URI_SCHEME, destination_key, state_county_label, storage_uri
from recordferry.functions.text import fold, millis_text, strip_prefix
from recordferry.operators.changes import delete_matching
from recordferry.operators.stage import Run

# ---- fixed values: status words of the ledgers, and the success code of a delete ----
PROCESSED, FAILED = "processed", "s3 query failed"
PLANNED, COPIED, DELETED, ERROR = "planned", "copied", "deleted", "error"
COPY_OK, DELETE_OK = 200, 204
# ---------------------------------------------------------------------------------------


def worklist(records: DataFrame, log: DataFrame, packages: DataFrame, counties: DataFrame, states: DataFrame,
             registry: DataFrame) -> DataFrame:
    """Leases with an image package whose record has no registered image yet."""
    packaged = packages.where("package_id is not null").select("lease_id", "package_id")
    open_log = (log.where("lease_id is not null").select("record_id", "lease_id")
                .join(registry.select("record_id"), "record_id", "left_anti"))
    return (records.select("record_id", "county_id", "state_id")
            .join(open_log, "record_id")
            .join(packaged, "lease_id")
            .join(counties.select("county_id", "county_name"), "county_id", "left")
            .join(states.select("state_id", "state_abbr"), "state_id", "left")
            .select("lease_id", "record_id",
                    state_county_label(F.col("state_abbr"), F.col("county_name")).alias("state_county"),
                    "package_id",
                    F.lit("").alias("source_path"), F.lit("").alias("destination_path"),
                    F.lit(0).alias("page_count"), F.lit(0).cast("bigint").alias("file_size"),
                    F.lit("").alias("status")))


def first_objects(manifest: DataFrame, package: Column) -> DataFrame:
    """First object of each package in listing order."""
    first = F.min(F.struct("object_key", "size_bytes", "page_count")).alias("first")
    return (manifest.groupBy(package.alias("package_id")).agg(first)
            .select("package_id", "first.object_key", "first.size_bytes",
                    F.col("first.page_count").alias("pages")))


def first_objects_by_prefix(manifest: DataFrame, work: DataFrame) -> DataFrame:
    """First object whose key merely starts with the package id.

    Keys are cut at the lengths that package ids have, so the prefix test is an
    equality; the lengths are a scalar subquery over the worklist.
    """
    sizes = work.where("package_id is not null").agg(
        F.collect_set(F.length("package_id")).alias("sizes")).scalar()
    cut = (manifest.withColumn("_size", F.explode(sizes))
           .where(F.length("object_key") >= F.col("_size")))
    return first_objects(cut, F.col("object_key").substr(F.lit(1), F.col("_size")))


def resolve(work: DataFrame, manifest: DataFrame, bucket: str, mode: str = "intended") -> DataFrame:
    """Object, size, pages, destination and status of each worklist row.

    Intended mode takes the objects under the package's own directory;
    reference mode takes the first key that begins with the package id, which
    may belong to a longer id.
    """
    if mode == "reference":
        found = first_objects_by_prefix(manifest, work)
    else:
        found = first_objects(manifest, F.split_part(F.col("object_key"), F.lit("/"), F.lit(1)))
    hit = F.col("object_key").isNotNull()
    place = F.concat(F.lit(f"{URI_SCHEME}{bucket}/"),
                     destination_key(F.col("state_county"), F.col("record_id"), F.col("object_key")))
    # Rows without a package find nothing; a key of their own keeps them out of one task.
    apart = F.concat(F.lit("no package/"), F.coalesce(F.col("lease_id").cast("string"), F.lit("")),
                     F.lit("/"), F.coalesce("record_id", F.lit("")))
    keyed = work.select("lease_id", "record_id", "state_county", "package_id",
                        F.coalesce("package_id", apart).alias("_package"))
    return keyed.join(found.withColumnRenamed("package_id", "_package"), "_package", "left").select(
        "lease_id", "record_id", "state_county", "package_id",
        F.coalesce("object_key", F.lit("")).alias("source_path"),
        F.when(hit, place).otherwise("").alias("destination_path"),
        F.when(hit, F.coalesce("pages", F.lit(0))).otherwise(0).alias("page_count"),
        F.when(hit, F.col("size_bytes")).otherwise(0).cast("bigint").alias("file_size"),
        F.when(hit, PROCESSED).otherwise(FAILED).alias("status"))


def copy_plan(resolved: DataFrame, registry: DataFrame, bucket: str, run: Run, mode: str = "intended") -> DataFrame:
    """Copies to make and the registry rows they give.

    Rows already registered are left out.  Intended mode counts a registry row
    only if its copy succeeded, so failures come back; in reference mode any
    registry row, failed or not, ends the matter.
    """
    done = registry if mode == "reference" else registry.where(F.col("status") == COPIED)
    fresh = resolved.where(F.col("status") == PROCESSED).join(done.select("record_id"), "record_id", "left_anti")
    target = destination_key(F.col("state_county"), F.col("record_id"), F.col("source_path"))
    return fresh.select(
        F.col("source_path").alias("source_key"),
        target.alias("destination_key"),
        F.col("record_id").alias("recordID"),
        F.concat(F.lit(f"{URI_SCHEME}{bucket}/"), target).alias("s3FilePath"),
        F.col("page_count").alias("pageCount"),
        F.col("file_size").alias("fileSizeBytes"),
        millis_text(run.time).alias("_ModifiedDateTime"),
        F.lit(run.user).alias("_ModifiedBy"),
        F.lit(PLANNED).alias("status"))


def copy_outcome(plan: DataFrame, outcomes: DataFrame, run: Run) -> DataFrame:
    """Registry rows of a copy plan after its calls: each row's status from its own outcome.

    `outcomes` has `record_id` and `http_status`; of several calls for a record a good one counts.  Rows without an
    outcome stay planned, so they, and those in error, come back in the next plan.
    """
    good = F.bool_or(F.coalesce(F.col("http_status") == COPY_OK, F.lit(False))).alias("_good")
    called = outcomes.where("record_id is not null").groupBy(F.col("record_id").alias("recordID")).agg(good)
    status = F.when(F.col("_good"), COPIED).when(~F.col("_good"), ERROR).otherwise(F.col("status"))
    return plan.join(called, "recordID", "left").withColumns({
        "status": status,
        "_ModifiedDateTime": F.when(F.col("_good").isNotNull(), millis_text(run.time))
        .otherwise(F.col("_ModifiedDateTime"))}).select(*plan.columns)


def delete_plan(cleanup: DataFrame, outcomes: DataFrame, bucket: str, run: Run) -> DataFrame:
    """Keys to delete, and what became of each call.

    `outcomes` holds the response code by record; the status of a row depends
    on its own outcome only, and a missing or failed call is a failure.
    """
    uri = storage_uri(F.col("destination_path"))
    codes = outcomes.groupBy("record_id").agg(F.min("http_status").alias("http_status"))
    ok = F.coalesce(F.col("http_status") == DELETE_OK, F.lit(False))
    return cleanup.join(codes, "record_id", "left").select(
        F.col("record_id").alias("recordID"), F.col("lease_id").alias("leaseid"),
        uri.alias("s3FilePath"),
        strip_prefix(uri, f"{URI_SCHEME}{bucket}/").alias("object_key"),
        F.when(ok, millis_text(run.time)).alias("_ModifiedDateTime"),
        F.when(ok, DELETED).otherwise(FAILED).alias("status"))


def requeue(work: DataFrame, results: DataFrame) -> DataFrame:
    """Next worklist: rows without a result, and failed results with an empty status."""
    waiting = delete_matching(work, results, ["record_id"])
    failed = results.where(F.col("status") != PROCESSED).withColumn("status", F.lit(""))
    return waiting.unionByName(failed.select(*waiting.columns))


def register(resolved: DataFrame, log: DataFrame, tag: str, run: Run) -> DataFrame:
    """Registry rows of one batch; images without a readable page stay out."""
    batch = log.where((fold(F.col("batch_tag")) == tag.lower()) & F.col("lease_id").isNotNull()).select(
        F.col("record_id").alias("log_record"), "lease_id")
    return (resolved.where("page_count != 0")
            .join(batch, "lease_id")
            .select(F.col("log_record").alias("recordID"),
                    storage_uri(F.col("destination_path")).alias("s3FilePath"),
                    F.col("page_count").alias("pageCount"),
                    F.col("file_size").alias("fileSizeBytes"),
                    run.time.alias("_ModifiedDateTime"),
                    F.lit(run.tag).alias("_ModifiedBy")))


def map_rows(plan: DataFrame, add: Callable[[pd.DataFrame], pd.DataFrame], extra: str) -> DataFrame:
    """Hook for a lookup per file that needs Python, in Arrow batches.

    `add` gets a batch and returns one row for each of its rows, in their order,
    with the columns of `extra` (a schema text) added.  If a batch raises, or
    comes back with other rows, its rows are tried one by one; a row that fails
    keeps its values and gets the error as its status, so no row is lost.  Rows
    of a failed batch are given to `add` twice: it must bear that.
    """
    base = plan.drop("status").schema
    schema = T.StructType([*base.fields, *T.StructType.fromDDL(extra).fields, T.StructField("status", T.StringType())])
    names, added = base.names, T.StructType.fromDDL(extra).names

    def checked(batch: pd.DataFrame) -> pd.DataFrame:
        out = add(batch.copy()).reset_index(drop=True)
        if len(out) != len(batch) or not out[names].equals(batch[names].reset_index(drop=True)):
            raise ValueError(f"{len(out)} rows, or changed ones, for {len(batch)}")
        return out[[*names, *added]].assign(status=PROCESSED)

    def one_row(row: pd.DataFrame) -> pd.DataFrame:
        try:
            return checked(row)
        except Exception as error:  # a failed row is a result, not a failed task
            return row.assign(**{name: None for name in added}, status=f"error: {error}")

    def run_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                yield checked(batch)
            except Exception:
                for i in range(len(batch)):
                    yield one_row(batch.iloc[i:i + 1].reset_index(drop=True))

    return plan.drop("status").mapInPandas(run_batches, schema)


