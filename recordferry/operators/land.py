"""Land descriptions: build, apply parsed fields, explode, load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordferry.functions.rules import range_or_block
from recordferry.functions.text import contains_word, is_filled, stable_id
from recordferry.operators.changes import update_from
from recordferry.operators.counted import UNSEEN, Steps
from recordferry.operators.relational import explode_delimited
from recordferry.operators.stage import Run, default, missing, run_time, source

# ---- fixed values: names, order, types and defaults of the land-description table ----
LAND_RULES = [
    ("landDescriptionID", "string", source("land_description_id")),
    ("recordID", "string", source("record_id")),
    ("CountyID", "int", source("county_id")),
    ("Subdivision", "string", missing),
    ("Survey", "string", missing),
    ("Lot", "string", missing),
    ("Block", "string", missing),
    ("Section", "string", missing),
    ("Township", "string", missing),
    ("RangeOrBlock", "string", source("range_or_block")),
    ("AbstractName", "int", source("abstract_no")),
    ("Suffix", "string", missing),
    ("QuarterCalls", "string", missing),
    ("AcreageByTract", "string", missing),
    ("TractDRRecordNumber", "string", missing),
    ("TractDRVolumePage", "string", missing),
    ("PlatVolumePage", "string", missing),
    ("PlatRecordNumber", "string", missing),
    ("BriefLegal", "string", source("descriptions")),
    ("EntryDate", "timestamp_ntz", run_time),
    ("oldLandID", "int", missing),
    ("_CreatedDateTime", "timestamp_ntz", run_time),
    ("_CreatedBy", "string", lambda run: F.lit(run.tag)),
    ("_ModifiedDateTime", "timestamp_ntz", run_time),
    ("_ModifiedBy", "string", lambda run: F.lit(run.tag)),
    ("AutoGenDate", "timestamp_ntz", run_time),
    ("PatentNumber", "string", missing),
    ("PatentVolume", "string", missing),
    ("CertificateNumber", "string", missing),
    ("FileNumber", "string", missing),
    ("PlatVolumeCabinet", "string", missing),
    ("PlatPageSlide", "string", missing),
    ("PlatBookType", "string", missing),
    ("QuarterCallsFull", "string", missing),
    ("NewCityBlock", "string", missing),
    ("SubdivisionNameId", "int", missing),
    ("IsDeleted", "boolean", default(False)),
    ("CountyName", "string", source("county_name")),
    ("StateName", "string", source("state_name")),
]
EXCLUDED_WORDS = ("ALL", "BELOW", "REMARKS")
PARSED_FIELDS = {  # land column -> column of the parsed text file
    "Survey": "Survey", "Subdivision": "Subdivision", "Lot": "Lot", "Block": "Block",
    "Section": "Section", "Township": "Township", "RangeOrBlock": "Range",
    "QuarterCalls": "Quartercall", "NewCityBlock": "NewCityBlock",
}
MULTI_VALUED = ("Section", "QuarterCalls", "Lot")
# Columns that the split-and-replace of the migrated script did not put back.
LOST_ON_SPLIT = (
    "AcreageByTract", "TractDRRecordNumber", "TractDRVolumePage", "PlatVolumePage", "PlatRecordNumber",
    "PatentNumber", "PatentVolume", "CertificateNumber", "FileNumber", "PlatVolumeCabinet",
    "PlatPageSlide", "PlatBookType", "QuarterCallsFull", "NewCityBlock", "CountyName", "StateName",
)
# -----------------------------------------------------------------------------------------


def legal_texts(leases: DataFrame, document_mapping: DataFrame, abstract_mapping: DataFrame,
                abstracts: DataFrame) -> DataFrame:
    """Legal texts of each lease with the abstract they cite."""
    return (leases.select("lease_id")
            .join(document_mapping, "lease_id")
            .join(abstract_mapping.where(is_filled(F.col("descriptions"))), "mapping_id")
            .join(abstracts, "abstract_id")
            .select("lease_id", "abstract_id", "descriptions", "range_no", "range_dir", "survey_block",
                    "abstract_no"))


def land_base(texts: DataFrame, log: DataFrame, records: DataFrame, states: DataFrame, counties: DataFrame,
              run: Run, excluded_states: tuple[str, ...] = (), whole_words: bool = False,
              mode: str = "intended", steps: Steps = UNSEEN) -> DataFrame:
    """Base rows, 39 columns; the parsed columns are still empty.

    Reference mode never falls back to the survey block and keeps repeated
    rows, because each had a fresh id; intended mode keeps one of them.

    With `steps` the rows of each join are counted; a log row that finds its record, or a record that finds its
    state or county, more than once shows as more rows out than in.
    """
    keeps = is_filled(F.col("descriptions")) & ~contains_word(F.col("descriptions"), EXCLUDED_WORDS, whole_words)
    named_states = states.where(~F.col("state_name").isin(*excluded_states)) if excluded_states else states
    wanted = steps.see(steps.see(texts, "texts").where(keeps), "usable texts", "texts")
    logged = steps.see(wanted.join(log.where("lease_id is not null").select("record_id", "lease_id"), "lease_id"),
                       "with log row", "usable texts")
    recorded = steps.see(logged.join(records.select("record_id", "county_id", "state_id"), "record_id"),
                         "with record", "with log row")
    stated = steps.see(recorded.join(named_states.select("state_id", "state_name"), "state_id"), "with state", "with record")
    joined = steps.see(stated.join(counties.select("county_id", "county_name"), "county_id"), "with county", "with state")
    rows = joined.select(F.lower("record_id").alias("record_id"), "county_id", "county_name", "state_name",
                         "abstract_id", "abstract_no", "descriptions", "range_no", "range_dir", "survey_block")
    if mode != "reference":
        rows = steps.see(rows.distinct(), "different rows", "with county")
    shaped = rows.withColumns({
        "range_or_block": range_or_block(F.col("range_no"), F.col("range_dir"), F.col("survey_block"), mode),
        "land_description_id": stable_id(F.lit("land"), F.col("record_id"), F.col("abstract_id"),
                                         F.col("descriptions"))})
    return shaped.select(*[rule(run).cast(kind).alias(name) for name, kind, rule in LAND_RULES])


def apply_parsed(base: DataFrame, parsed: DataFrame, key: str = "landDescriptionID",
                 fields: dict[str, str] = PARSED_FIELDS) -> DataFrame:
    """Put the fields parsed from the legal text into the base, by id."""
    return update_from(base, parsed, key, fields)


def explode_legal(land: DataFrame, columns: tuple[str, ...] = MULTI_VALUED, mode: str = "intended",
                  lost_columns: tuple[str, ...] = LOST_ON_SPLIT, positions: bool = False) -> DataFrame:
    """One row per combination of section, quarter call and lot."""
    lost = lost_columns if mode == "reference" else ()
    for column in columns:
        at = f"{column}_pos" if positions else None
        land = explode_delimited(land, column, position=at, lost_columns=lost)
    return land


def load_land(exploded: DataFrame, key: str = "landDescriptionID", columns: tuple[str, ...] = MULTI_VALUED,
              dropped: tuple[str, ...] = ("CountyName", "StateName")) -> DataFrame:
    """Rows for the target table, each with an id of its own.

    The id comes from the parent id and the token places that
    `explode_legal(positions=True)` recorded, so equal tokens stay apart.
    """
    places = [f"{c}_pos" for c in columns]
    new_id = stable_id(F.col(key), *[F.col(p) for p in places])
    return exploded.withColumn(key, new_id).drop(*places, *dropped)


def parser_extract(land: DataFrame, ordered: bool = True) -> DataFrame:
    """The file that the outside legal-text parser reads."""
    out = land.select("landDescriptionID", F.col("CountyName").alias("County"),
                      F.col("StateName").alias("State"), "BriefLegal")
    return out.orderBy("County", "landDescriptionID") if ordered else out
