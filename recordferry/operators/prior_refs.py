"""Prior references: the deed volume and page a lease points back to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordferry.functions.text import is_filled, stable_id, word_to_null
from recordferry.operators.parties import batch_records
from recordferry.operators.stage import Run


def prior_refs(leases: DataFrame, records: DataFrame, log: DataFrame, run: Run, batch_tag: str) -> DataFrame:
    """One row per record and lease with both parts filled.

    The parts are tested before cleaning, so a stored 'null' passes the test and
    becomes NULL afterwards.
    """
    filled = leases.where(is_filled(F.col("deed_vol")) & is_filled(F.col("deed_pg"))).select(
        "lease_id", "deed_vol", "deed_pg")
    pairs = batch_records(records, log, batch_tag).distinct()
    return filled.join(pairs, "lease_id").select(
        F.col("record_id").alias("recordID"),
        word_to_null(F.trim("deed_vol"), "null").alias("drVolume"),
        word_to_null(F.trim("deed_pg"), "null").alias("drPage"),
        F.lit(None).cast("string").alias("drbookType"),
        run.time.alias("_CreatedDateTime"),
        F.lit(run.tag).alias("_CreatedBy"),
        run.time.alias("_ModifiedDateTime"),
        F.lit(run.tag).alias("_ModifiedBy"),
        F.lit(None).cast("string").alias("Consideration"),
        stable_id(F.lit("prior"), F.col("record_id"), F.col("lease_id")).alias("priorrefid"),
        F.lit(0).alias("IsDeleted"))
