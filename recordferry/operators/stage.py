"""Staging of new target records and of their export-log rows.

The staged record is one select built from `RECORD_RULES`; the same list names
the columns that the null profile covers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.functions import rules as R
from recordferry.functions.text import iso_date, null_to_blank


@dataclass(frozen=True)
class Run:
    """Constants of one run: its time, its tag and who runs it."""

    at: str         # 'yyyy-mm-dd hh:mm:ss'
    tag: str
    user: str

    @property
    def time(self) -> Column:
        return F.lit(self.at).cast("timestamp_ntz")


def default(value):
    return lambda run: F.lit(value)


def missing(run: Run) -> Column:
    return F.lit(None)


def source(name: str):
    return lambda run: F.col(name)


def filled(name: str):
    return lambda run: null_to_blank(F.col(name))


def mapped(rule, name: str):
    return lambda run: rule(F.col(name))


def run_time(run: Run) -> Column:
    return run.time


# ---- fixed values: names, order, types and defaults of the target's record table ----
RECORD_RULES = [
    ("recordID", "string", source("generated_record_id")),
    ("sourceFilePath", "string", filled("source_file_path")),
    ("storageFilePath", "string", default("")),
    ("originalFileName", "string", filled("original_file_name")),
    ("fileType", "string", filled("file_type")),
    ("fileExtension", "string", filled("file_extension")),
    ("gathererID", "int", default(0)),
    ("receivedDate", "timestamp_ntz", run_time),
    ("bookTypeID", "int", default(17)),
    ("countyID", "int", source("tgt_county_id")),
    ("stateID", "int", mapped(R.state_code, "state_id")),
    ("volume", "int", source("volume")),
    ("page", "int", source("page")),
    ("outsourceID", "int", default(0)),
    ("outsourcedDate", "timestamp_ntz", missing),
    ("stapled", "int", default(1)),
    ("stapleInspectorNumber", "int", missing),
    ("stapleQcDate", "timestamp_ntz", missing),
    ("statusID", "int", default(90)),
    ("keyerNumber", "int", missing),
    ("reassignedTo", "int", missing),
    ("keyedDate", "timestamp_ntz", missing),
    ("modifiedDate", "timestamp_ntz", missing),
    ("inspectorNumber", "int", missing),
    ("qcDate", "timestamp_ntz", missing),
    ("manualAccept", "int", default(0)),
    ("manualReject", "int", default(0)),
    ("qaReserved", "int", default(0)),
    ("holding", "int", default(0)),
    ("keyerComments", "string", missing),
    ("supervisorComments", "string", missing),
    ("pendingDate", "timestamp_ntz", missing),
    ("exported", "int", default(0)),
    ("exportDate", "timestamp_ntz", missing),
    ("recordDate", "string", mapped(iso_date, "record_date")),
    ("effectiveDate", "timestamp_ntz", source("effective_date")),
    ("instrumentTypeID", "string", mapped(R.instrument_code, "instrument")),
    ("recordNumber", "string", source("record_number")),
    ("instrumentDate", "timestamp_ntz", source("instrument_date")),
    ("fileDate", "string", mapped(iso_date, "record_date")),
    ("remarks", "string", lambda run: F.lit(run.tag)),
    ("MultipleLeasesForTract", "int", default(0)),
    ("AreaAmount", "double", source("acres")),
    ("AreaNotAvailable", "int", mapped(R.area_missing_flag, "acres")),
    ("landDescriptionNotAvailable", "int", default(0)),
    ("DepthsCoveredType", "string", mapped(R.depth_type, "depth_code")),
    ("DepthsCoveredFrom", "double", source("depth_min")),
    ("DepthsCoveredTo", "double", source("depth_max")),
    ("Extension", "int", mapped(R.extension_flag, "extension_term_months")),
    ("ExtensionLength", "int", source("extension_term_months")),
    ("ExtensionType", "string", mapped(R.extension_unit, "extension_term_months")),
    ("ExtensionBonus", "int", source("extension_bonus")),
    ("extensionBLM", "boolean", source("is_blm")),
    ("ExtensionState", "boolean", source("is_state")),
    ("TermLength", "int", mapped(R.term_years, "term_months")),
    ("TermType", "int", default(0)),
    ("TermAvailable", "int", default(0)),
    ("RoyaltyAmount", "decimal(5,4)", source("royalty")),
    ("DelayRental", "int", source("delay_rental")),
    ("RentalAmount", "double", source("delay_rental_value")),
    ("RentalBonus", "double", missing),
    ("DRVolumePage", "string", missing),
    ("DRRecordNumber", "string", missing),
    ("needsRedaction", "int", default(0)),
    ("ExportedToWeb2", "int", missing),
    ("ExportedToWeb2Date", "timestamp_ntz", missing),
    ("ExportedToWeb", "int", missing),
    ("ExportedToWebDate", "timestamp_ntz", missing),
    ("FAQDate", "timestamp_ntz", missing),
    ("FAQAnsweredDate", "timestamp_ntz", missing),
    ("FAQAnsweredBy", "string", missing),
    ("PoorImage", "int", missing),
    ("NoPriorReference", "int", default(0)),
    ("MIP", "int", missing),
    ("HandWritten", "int", missing),
    ("_CreatedDateTime", "timestamp_ntz", run_time),
    ("_CreatedBy", "string", lambda run: F.lit(run.user)),
    ("_ModifiedDateTime", "timestamp_ntz", run_time),
    ("_ModifiedBy", "string", lambda run: F.lit(run.user)),
    ("causeNumber", "string", missing),
    ("qcBatchID", "int", missing),
    ("auditBatchID", "int", missing),
    ("IsWebDoc", "int", default(0)),
    ("SiteId", "int", missing),
    ("Url", "string", missing),
    ("recordIsLease", "int", default(1)),
    ("recordIsCourthouse", "int", default(0)),
    ("recordIsAssignment", "int", default(0)),
    ("prevQCBID", "int", missing),
    ("ParcelNumber", "string", missing),
    ("InstrumentTypeFull", "string", missing),
    ("TotalPages", "int", missing),
    ("Consideration", "string", missing),
    ("InstrumentTypeFullId", "int", missing),
]

LOG_RULES = [
    ("recordID", "string", source("generated_record_id")),
    ("LeaseID", "bigint", source("lease_id")),
    ("exportDate", "timestamp_ntz", run_time),
    ("sentToAudit", "int", default(0)),
    ("zipName", "string", lambda run: F.lit(run.tag)),
    ("zipCopied", "int", default(0)),
    ("imageCopied", "int", default(0)),
    ("_CreatedDateTime", "timestamp_ntz", run_time),
    ("_CreatedBy", "string", lambda run: F.lit(run.tag)),
    ("_ModifiedDateTime", "timestamp_ntz", missing),
    ("_ModifiedBy", "string", missing),
    ("CountOfLastAttempt", "int", missing),
]
# ---------------------------------------------------------------------------------------


def apply_rules(candidates: DataFrame, rules, run: Run) -> DataFrame:
    """One select; values that do not fit the target type become NULL and are listed by `narrowing_losses`."""
    return candidates.select(*[rule(run).try_cast(kind).alias(name) for name, kind, rule in rules])


def stage_records(candidates: DataFrame, run: Run) -> DataFrame:
    return apply_rules(candidates, RECORD_RULES, run)


def stage_log(candidates: DataFrame, run: Run) -> DataFrame:
    return apply_rules(candidates, LOG_RULES, run)


WIDER = {"tinyint": ("smallint", "int", "bigint", "float", "double"), "smallint": ("int", "bigint", "float", "double"),
         "int": ("bigint", "double"), "bigint": (), "float": ("double",), "date": ("timestamp", "timestamp_ntz")}


def can_lose(given: T.DataType, kind: str) -> bool:
    """Whether a cast from a type can turn a value into NULL: not to the same type, to text, or to a type that holds all."""
    name = given.simpleString()
    return not (name in (kind, "void") or kind == "string" or kind in WIDER.get(name, ()))


def narrowing_losses(candidates: DataFrame, run: Run) -> DataFrame:
    """Every value that staging drops because it does not fit its column: one row per lease, table and column.

    All rules of both tables are tested that can lose a value: those whose cast is to another type that does not hold
    all values of the given one.  No shuffle.
    """
    losses = []
    for table, rules in (("records", RECORD_RULES), ("export_log", LOG_RULES)):
        given = candidates.select(*[rule(run).alias(name) for name, _, rule in rules]).schema
        for name, kind, rule in rules:
            if not can_lose(given[name].dataType, kind):
                continue
            value = rule(run)
            gone = value.isNotNull() & value.try_cast(kind).isNull()
            losses.append(F.when(gone, F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
                                                value.cast("string").alias("value"))))
    each = candidates.select("lease_id", F.col("generated_record_id").alias("record_id"),
                             F.explode(F.array_compact(F.array(*losses))).alias("loss"))
    return each.select("lease_id", "record_id", "loss.*")


def register_status(statuses: DataFrame, status_id: int, data_entry: str, unused: str) -> DataFrame:
    """The status table with a new code, unless the code is there already."""
    row = statuses.sparkSession.range(1).select(
        F.lit(status_id).alias("status_id"),
        F.lit(None).cast("string").alias("staple_description"),
        F.lit(data_entry).alias("data_entry_description"),
        F.lit(unused).alias("incoming_inspection_description"),
        F.lit(unused).alias("assignment_description"))
    new = row.join(statuses.select("status_id"), "status_id", "left_anti")
    return statuses.unionByName(new, allowMissingColumns=True)
