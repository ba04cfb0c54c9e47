"""Parties: grantors and grantees of the batch's records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordferry.functions.text import blank_to_null, fold, is_filled
from recordferry.operators.relational import union_distinct
from recordferry.operators.stage import Run

TEXT_COLUMNS = ("gName", "gAddress", "gZip", "gCity")
SPREAD = 8


def batch_records(records: DataFrame, log: DataFrame, tag: str) -> DataFrame:
    """Records of a batch with the leases they were made from."""
    tagged = records.where(fold(F.col("remarks")) == tag.lower()).select(F.lower("record_id").alias("record_id"))
    return tagged.join(log.where("lease_id is not null").select(F.lower("record_id").alias("record_id"), "lease_id"),
                       "record_id")


KINDS = {"grantor": "grantor_id", "grantee": "grantee_id"}


def _people(states: DataFrame, **lists: DataFrame) -> DataFrame:
    """Both name lists in one frame, keyed by kind and id, with their states."""
    both = reduce(DataFrame.unionByName, [
        people.where(is_filled(F.col("name"))).select(
            F.lit(kind).alias("kind"), F.col(KINDS[kind]).alias("party_id"), "name", "address", "zip", "city",
            fold(F.col("state_abbr")).alias("state_key")) for kind, people in lists.items()])
    codes = states.select(fold(F.col("state_abbr")).alias("state_key"), "state_id")
    return both.join(codes, "state_key", "left")


def _party_rows(lease_records: DataFrame, people: DataFrame) -> DataFrame:
    """Each lease's two parties as rows, in one join.

    A party may hold a third of all leases, so the different (record, kind, party) rows are spread: a party's leases
    go to `SPREAD` keys by record, and its own row is repeated for each.
    """
    wanted = lease_records.select("record_id", F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(key).alias("party_id")) for kind, key in KINDS.items()])))
    wanted = wanted.where("party_id is not null").distinct().withColumn("_salt", F.pmod(F.xxhash64("record_id"), F.lit(SPREAD)))
    repeated = people.withColumn("_salt", F.explode(F.sequence(*[F.lit(n).cast("bigint") for n in (0, SPREAD - 1)])))
    return wanted.join(repeated, ["kind", "party_id", "_salt"]).select(
        F.col("record_id").alias("recordID"),
        F.col("kind").alias("recordType"),
        blank_to_null(F.col("name")).alias("gName"),
        blank_to_null(F.col("address")).alias("gAddress"),
        blank_to_null(F.col("zip")).alias("gZip"),
        blank_to_null(F.col("city")).alias("gCity"),
        F.col("state_id").cast("int").alias("StateID"))


def parties(leases: DataFrame, grantors: DataFrame, grantees: DataFrame, records: DataFrame, log: DataFrame,
            states: DataFrame, run: Run) -> DataFrame:
    """Distinct grantor and grantee rows of the batch `run.tag`.

    Leases meet the batch by their own id, once; one join then serves both kinds
    of people.  Constant columns are added after the deduplication, so they are
    not shuffled.
    """
    lease_records = batch_records(records, log, run.tag).join(
        leases.select("lease_id", "grantor_id", "grantee_id"), "lease_id")
    rows = union_distinct(_party_rows(lease_records, _people(states, grantor=grantors, grantee=grantees)),
                          text_columns=TEXT_COLUMNS)
    return rows.withColumns({
        "_CreatedDateTime": run.time, "_CreatedBy": F.lit(run.user),
        "_ModifiedDateTime": run.time, "_ModifiedBy": F.lit(run.user),
        "interestAssigned": F.lit(None).cast("string"), "IsDeleted": F.lit(0)})
