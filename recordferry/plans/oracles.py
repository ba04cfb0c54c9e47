"""Independent SQL for the registered queries, in DuckDB's dialect."""

from __future__ import annotations

from recordferry.operators.land import LAND_RULES
from recordferry.operators.stage import RECORD_RULES
from recordferry.sources.bindings import oracle_with

TS = "'2025-07-17 00:00:00'"
INT = "nullif(try_cast(trim({0}) as integer), 0)"
PAIR = """t.record_id as target_record_id, t.record_number as target_record_number, s.lease_id as source_lease_id,
 s.record_number as source_record_number, t.volume as target_volume, t.page as target_page,
 s.volume as source_volume, s.page as source_page, s.county_name as source_county_name"""
SLICES = f""", tgt as (
 select r.record_id, r.record_number, r.file_date, {INT.format('volume')} as volume, {INT.format('page')} as page,
  x.county_name, r.county_id from tgt_record r join county_xwalk x on x.src_county_id = r.county_id),
src as (
 select l.lease_id, l.record_number, l.record_date, {INT.format('vol')} as volume, {INT.format('pg')} as page,
  x.county_name, l.county_id from src_lease l left join county_xwalk x on x.src_county_id = l.county_id),
logged as (select lease_id from export_log where lease_id is not null)"""
MATCH_VIEWS = ("src_lease", "tgt_record", "export_log", "county_xwalk")
EXACT = """t.record_number = s.record_number and t.file_date = s.record_date and t.county_name = s.county_name"""
PART = """length(t.record_number) <> length(s.record_number) and length(t.record_number) >= 5
 and length(s.record_number) >= 5 and t.file_date = s.record_date and t.county_name = s.county_name
 and (instr(t.record_number, lower(s.record_number)) > 0 or instr(lower(s.record_number), t.record_number) > 0)"""
UNIQUE = """(select record_date, county_name, record_number from src group by all having count(*) = 1)"""


def matching(body: str, *more: str) -> str:
    return oracle_with(*MATCH_VIEWS, *more) + SLICES + "\n" + body


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


_exact = f"select {PAIR} from src s join tgt t on {EXACT}"
_volpage = f"""select {PAIR} from src s join tgt t on t.volume = s.volume and t.page = s.page
 and t.file_date = s.record_date and t.county_name = s.county_name and t.record_number <> s.record_number"""
_partial = f"""select {PAIR} from src s join {UNIQUE} u on u.record_date = s.record_date
 and u.county_name = s.county_name and u.record_number = s.record_number join tgt t on {PART}"""
_source_only = f"""select cast(null as varchar) as target_record_id, cast(null as varchar) as target_record_number,
 s.lease_id as source_lease_id, s.record_number as source_record_number, cast(null as integer) as target_volume,
 cast(null as integer) as target_page, s.volume as source_volume, s.page as source_page,
 s.county_name as source_county_name from src s
 where s.lease_id not in (select lease_id from logged)
 and not exists (select 1 from tgt t where {EXACT}) and not exists (select 1 from tgt t where {PART})"""
_unlogged_pairs = "where p.source_lease_id not in (select lease_id from logged)"
_per_row = """left join export_log e on e.record_id = p.target_record_id where e.lease_id is null"""
_per_record = """where p.target_record_id not in (select record_id from export_log where lease_id is not null)"""


def report(status: str) -> str:
    return f"""select p.*, 'equal number' as match_condition from ({_exact}) p {status}
union all select p.*, 'contained number' from ({_partial}) p {status}
union all select p.*, 'no target record' from ({_source_only}) p"""


def _case_map(column: str, pairs: str) -> str:
    """`1:48 2:22` as a CASE; text values are written with quotes."""
    arms = " ".join(f"when {k} then {v}" for k, v in (p.split(":") for p in pairs.split(";")))
    return f"case {column} {arms} end"


STATES = ("1:48;2:22;3:55;4:35;5:40;60:1;62:5;63:7;64:8;66:10;74:20;79:26;81:28;83:30;85:32;90:38;91:39;"
          "92:41;93:43;96:46;98:49;101:52;102:53")
INSTRUMENTS = ("0:'OGL';1:'MOGL';2:'OP';3:'SOP';4:'SMEM';5:'REOGL';6:'OGL';7:'OGLEXT';8:'SPER';9:'ROGL';"
               "10:'OGLAMD';11:'ASN';12:'MD';13:'RD'")
DEPTHS = "0:'All';1:'FromTo';2:'SurfaceTo';3:'DeeperThan';255:'No Data'"
TERM = """case when term_months = 0 then 0 when term_months >= 12 and term_months <= 371 then term_months // 12
 when term_months = 600 then 50 when term_months = 1188 then 99 end"""
EXTENSION = """case when {0} ilike '%.pdf%' then '.pdf' when {0} ilike '%.jpg%' then '.jpg'
 when {0} ilike '%.tif%' then '.tif' end"""
SOURCE_PATH = r"case when filename is not null then '\\share\leases\' || coalesce(path, '') || '\' || filename end"

FULL_VIEWS = ("src_lease_terms", "issued_ids", "county_xwalk", "lease_file", "export_log", "src_lease", "tgt_record")


def full_source(files: str, new_id: str) -> str:
    return f"""full_src as (select l.lease_id, coalesce(i.record_id, {new_id}) as generated_record_id, l.instrument,
 l.record_number, l.record_date, {INT.format('l.vol')} as volume, {INT.format('l.pg')} as page,
 {SOURCE_PATH} as source_file_path, f.filename as original_file_name,
 {EXTENSION.format('f.filename')} as file_type, {EXTENSION.format('f.filename')} as file_extension,
 x.county_name, l.county_id, x.state_id, l.effective_date, l.instrument_date, l.acres, l.depth_code, l.depth_min,
 l.depth_max, l.extension_term_months, l.extension_bonus, l.is_blm, l.is_state, l.term_months, l.royalty,
 l.delay_rental, l.delay_rental_value
 from src_lease_terms l left join issued_ids i on i.lease_id = l.lease_id
 left join county_xwalk x on x.src_county_id = l.county_id left join {files} f on f.lease_id = l.lease_id)"""


ONE_FILE = """(select lease_id, min(filename) as filename, arg_min(path, filename) as path from lease_file
 where filename is not null group by lease_id)"""
FULL = full_source(ONE_FILE, "md5('lease|' || l.lease_id)")
FULL_PER_FILE = full_source(
    "lease_file", "md5('lease|' || l.lease_id || '|' || coalesce(path, '') || '|' || coalesce(filename, ''))")
FULL_TEXT = f"""* replace (strftime(record_date, '%Y-%m-%d') as record_date, {text('effective_date')} as effective_date,
 {text('instrument_date')} as instrument_date, cast(royalty as double) as royalty)"""
CANDIDATES = f""", {FULL}, cand as (select s.*, x.tgt_county_id from full_src s join county_xwalk x
 on x.src_county_id = s.county_id and x.tgt_county_id is not null
 where s.lease_id not in (select lease_id from logged))"""


def candidates(body: str) -> str:
    return matching("", *FULL_VIEWS).rstrip() + CANDIDATES + "\n" + body


def typed_null(kind: str) -> str:
    return {"int": "integer", "string": "varchar", "timestamp_ntz": "varchar", "double": "double",
            "boolean": "boolean"}[kind]


def select_list(rules, given: dict[str, str]) -> str:
    """The given expressions; every other column of the table is NULL."""
    return ", ".join(f"{given[name]} as \"{name}\"" if name in given
                     else f"cast(null as {typed_null(kind)}) as \"{name}\"" for name, kind, _ in rules)


STAGED = {
    "recordID": "generated_record_id", "sourceFilePath": "coalesce(source_file_path, '')", "storageFilePath": "''",
    "originalFileName": "coalesce(original_file_name, '')", "fileType": "coalesce(file_type, '')",
    "fileExtension": "coalesce(file_extension, '')", "receivedDate": TS, "bookTypeID": "17",
    "countyID": "tgt_county_id", "stateID": _case_map("state_id", STATES), "volume": "volume", "page": "page",
    "stapled": "1", "statusID": "90", "recordDate": "strftime(record_date, '%Y-%m-%d')",
    "effectiveDate": text("effective_date"), "instrumentTypeID": _case_map("instrument", INSTRUMENTS),
    "recordNumber": "record_number", "instrumentDate": text("instrument_date"),
    "fileDate": "strftime(record_date, '%Y-%m-%d')", "remarks": "'BATCH(2)'", "AreaAmount": "acres",
    "AreaNotAvailable": "case when acres is null then -1 else 0 end",
    "DepthsCoveredType": _case_map("depth_code", DEPTHS), "DepthsCoveredFrom": "depth_min",
    "DepthsCoveredTo": "depth_max", "Extension": "case when extension_term_months = 0 then 0 else 1 end",
    "ExtensionLength": "extension_term_months",
    "ExtensionType": "case when extension_term_months >= 1 then 'Months' end",
    "ExtensionBonus": "cast(trunc(extension_bonus) as integer)", "extensionBLM": "is_blm",
    "ExtensionState": "is_state", "TermLength": TERM,
    "RoyaltyAmount": "cast(cast(royalty as decimal(5,4)) as double)",
    "DelayRental": "cast(trunc(delay_rental) as integer)", "RentalAmount": "delay_rental_value",
    "_CreatedDateTime": TS, "_CreatedBy": "'migration'", "_ModifiedDateTime": TS, "_ModifiedBy": "'migration'",
    "recordIsLease": "1",
}
STAGED.update({name: "0" for name in (
    "gathererID", "outsourceID", "manualAccept", "manualReject", "qaReserved", "holding", "exported",
    "MultipleLeasesForTract", "landDescriptionNotAvailable", "TermType", "TermAvailable", "needsRedaction",
    "NoPriorReference", "IsWebDoc", "recordIsCourthouse", "recordIsAssignment")})
STAGED_RECORDS = f"staged as (select {select_list(RECORD_RULES, STAGED)} from cand)"
ZERO_TESTED = ("ExtensionLength", "ExtensionBonus", "TermLength", "RoyaltyAmount", "RentalAmount")
TEXT_OR_TIME = {name: kind for name, kind, _ in RECORD_RULES}


def profile(columns: dict[str, str], table: str, zero: tuple[str, ...] = ()) -> str:
    parts = []
    for name, kind in columns.items():
        gone = f'"{name}" is null'
        if kind == "string":
            gone += f" or rtrim(\"{name}\") = ''"
        elif name in zero:
            gone += f' or "{name}" = 0'
        parts += [f'count("{name}") as "{name}_count"', f'count(*) filter (where {gone}) as "{name}_null_count"']
    return f"select {', '.join(parts)} from {table}"


LEASE_COLUMNS = {
    "lease_id": "bigint", "county_id": "int", "grantor_id": "bigint", "grantee_id": "bigint",
    "record_number": "string", "record_date": "date", "vol": "string", "pg": "string", "instrument": "int",
    "term_months": "int", "extension_term_months": "int", "depth_code": "int", "acres": "double",
    "royalty": "decimal", "deed_vol": "string", "deed_pg": "string", "created": "timestamp"}
RECORD_COLUMNS = {
    "record_id": "string", "record_number": "string", "file_date": "date", "volume": "string", "page": "string",
    "county_id": "int", "remarks": "string", "status_id": "int", "outsource_id": "int", "keyed_ts": "timestamp",
    "record_is_lease": "int", "record_is_courthouse": "int"}

# ---- land -----------------------------------------------------------------------------
LAND_VIEWS = ("src_lease", "document_mapping", "abstract_mapping", "abstract", "export_log", "tgt_record_state",
              "state_lookup", "county_xwalk")


def land_base(block: str) -> str:
    given = {
        "landDescriptionID": "md5(concat_ws('|', 'land', r.record_id, a.abstract_id, m.descriptions))",
        "recordID": "r.record_id", "CountyID": "r.county_id", "RangeOrBlock": block, "AbstractName": "a.abstract_no",
        "BriefLegal": "m.descriptions", "EntryDate": TS, "_CreatedDateTime": TS, "_CreatedBy": "'LAND'",
        "_ModifiedDateTime": TS, "_ModifiedBy": "'LAND'", "AutoGenDate": TS, "IsDeleted": "false",
        "CountyName": "x.county_name", "StateName": "st.state_name"}
    return oracle_with(*LAND_VIEWS) + f"""select {select_list(LAND_RULES, given)}
from src_lease l join document_mapping d on d.lease_id = l.lease_id
join abstract_mapping m on m.mapping_id = d.mapping_id join abstract a on a.abstract_id = m.abstract_id
join export_log e on e.lease_id = l.lease_id join tgt_record_state r on r.record_id = e.record_id
join state_lookup st on st.state_id = r.state_id join county_xwalk x on x.src_county_id = r.county_id
where rtrim(m.descriptions) <> '' and m.descriptions not ilike '%all%' and m.descriptions not ilike '%below%'
 and m.descriptions not ilike '%remarks%' and st.state_name <> 'EUROPE'"""


RANGE = "nullif(coalesce(cast(cast(trunc(a.range_no) as integer) as varchar), '') || coalesce(a.range_dir, ''), '')"
APPLIED = """applied as (select b.land_description_id, b.record_id, b.county_id,
 case when p.land_description_id is null then b.section else p.parsed_section end as section,
 case when p.land_description_id is null then b.quarter_calls else p.parsed_quarter_calls end as quarter_calls,
 case when p.land_description_id is null then b.lot else p.parsed_lot end as lot,
 b.range_no, b.range_dir, b.survey_block, b.brief_legal,
 case when p.land_description_id is not null then p.survey end as survey,
 case when p.land_description_id is null then 'old' else p.subdivision end as subdivision
 from land_desc b left join parsed_legal p on p.land_description_id = b.land_description_id)"""


def exploded(table: str, lost: tuple[str, ...] = ()) -> str:
    """Three lateral splits; `<column>_pos` is the place of the token."""
    steps, previous = [], table
    for column in ("section", "quarter_calls", "lot"):
        kept = f"* exclude ({', '.join((column, *lost))})" if lost else f"* exclude ({column})"
        dropped = "".join(f", case when {column} like '%,%' then null else {c} end as {c}" for c in lost)
        tokens = (f"case when {column} like '%,%' then list_transform(string_split({column}, ','), lambda t: trim(t))"
                  f" else [{column}] end")
        name = f"x_{column}"
        steps.append(f"{name} as (select {kept}{dropped}, unnest({tokens}) as {column}, "
                     f"generate_subscripts({tokens}, 1) - 1 as {column}_pos from {previous})")
        previous = name
    return ", ".join(steps)


NO_POS = "select * exclude (section_pos, quarter_calls_pos, lot_pos) from x_lot"

# ---- parties and references -----------------------------------------------------------
PARTY_VIEWS = ("src_lease", "grantor", "grantee", "tgt_record", "export_log", "state_lookup")


def party(kind: str) -> str:
    return f"""select b.record_id as "recordID", '{kind}' as "recordType", nullif(g.name, '') as "gName",
 nullif(g.address, '') as "gAddress", nullif(g.zip, '') as "gZip", nullif(g.city, '') as "gCity",
 st.state_id as "StateID", {TS} as "_CreatedDateTime", 'migration' as "_CreatedBy", {TS} as "_ModifiedDateTime",
 'migration' as "_ModifiedBy", cast(null as varchar) as "interestAssigned", 0 as "IsDeleted"
 from {kind} g join src_lease l on l.{kind}_id = g.{kind}_id join batch b on b.lease_id = l.lease_id
 left join state_lookup st on lower(st.state_abbr) = lower(g.state_abbr) where g.name <> ''"""


BATCH = """batch as (select r.record_id, e.lease_id from tgt_record r left join export_log e
 on e.record_id = r.record_id where r.remarks = 'BATCH(2)')"""
PARTIES = oracle_with(*PARTY_VIEWS) + f", {BATCH}, party as ({party('grantor')} union {party('grantee')})\n"
PRIOR = f"""prior as (select b.record_id as "recordID",
 case when lower(trim(d.deed_vol)) = 'null' then null else trim(d.deed_vol) end as "drVolume",
 case when lower(trim(d.deed_pg)) = 'null' then null else trim(d.deed_pg) end as "drPage",
 cast(null as varchar) as "drbookType", {TS} as "_CreatedDateTime", 'PRIOR' as "_CreatedBy",
 {TS} as "_ModifiedDateTime", 'PRIOR' as "_ModifiedBy", cast(null as varchar) as "Consideration",
 md5('prior|' || b.record_id || '|' || b.lease_id) as "priorrefid", 0 as "IsDeleted"
 from (select distinct * from batch) b join lease_deed d on d.lease_id = b.lease_id
 where rtrim(d.deed_vol) <> '' and rtrim(d.deed_pg) <> '')"""
PRIOR_REFS = oracle_with("tgt_record", "export_log", "lease_deed") + f", {BATCH}, {PRIOR}\n"

# ---- images ---------------------------------------------------------------------------
IMAGE_VIEWS = ("image_work", "object_manifest")
EXT = r"regexp_extract(m.object_key, '(\.[^./]+)$', 1)"


def resolved(first: str) -> str:
    return f"""resolved as (select w.lease_id, w.record_id, w.state_county, w.package_id,
 coalesce(m.object_key, '') as source_path,
 case when m.object_key is null then '' else 's3://plant-images/' || w.state_county || '/' ||
  substr(w.record_id, 1, 4) || '/' || w.record_id || {EXT} end as destination_path,
 coalesce(m.page_count, 0) as page_count, coalesce(m.size_bytes, 0) as file_size,
 case when m.object_key is null then 's3 query failed' else 'processed' end as status
 from image_work w left join ({first}) m on m.package_id = w.package_id)"""


FIRST_OBJECT = """select split_part(object_key, '/', 1) as package_id, min(object_key) as object_key,
 arg_min(size_bytes, object_key) as size_bytes, arg_min(page_count, object_key) as page_count
 from object_manifest group by 1"""
FIRST_BY_PREFIX = """select p.package_id, min(object_key) as object_key, arg_min(size_bytes, object_key) as size_bytes,
 arg_min(page_count, object_key) as page_count from (select distinct package_id from image_work) p
 join object_manifest o on starts_with(o.object_key, p.package_id) group by 1"""
RESOLVED = resolved(FIRST_OBJECT)


def imaging(body: str, *more: str) -> str:
    return oracle_with(*IMAGE_VIEWS, *more) + f", {RESOLVED}\n{body}"


def copy_plan(done: str, body: str = "select * from plan", *more: str) -> str:
    target = r"""state_county || '/' || substr(record_id, 1, 4) || '/' || record_id ||
 regexp_extract(source_path, '(\.[^./]+)$', 1)"""
    return imaging(f""", plan as (select source_path as source_key, {target} as destination_key, record_id as "recordID",
 's3://plant-images/' || {target} as "s3FilePath", page_count as "pageCount", file_size as "fileSizeBytes",
 '2025-07-17 00:00:00.000' as "_ModifiedDateTime", 'migration' as "_ModifiedBy", 'planned' as status
 from resolved where status = 'processed' and record_id not in (select record_id from image_registry {done})) {body}""",
                   "image_registry", *more)


LOG_FILL = f"""cand1 as (select distinct {PAIR},
 'Category 1: in the target, log row without lease' as category from export_log e
 join tgt t on t.record_id = e.record_id join src s on {EXACT} where e.lease_id is null)"""
MOVED = """remarks is not null and outsource_id in (24, 25) and record_id in
 (select record_id from export_log where batch_tag ilike '%batch%') and keyed_ts + interval {0} minute
 >= timestamp '1997-07-01 00:00:00'"""
RECORD_TEXT = f"* replace ({text('keyed_ts')} as keyed_ts)"


def volume_by_month(table: str, day: str, where: str = "", weight: str = "count(*)", more: str = "") -> str:
    return f"""select x.county_name, cast(year({day}) as integer) as year, cast(month({day}) as integer) as month,
 {weight} as record_count from {table} r left join county_xwalk x on x.src_county_id = r.county_id {more}
 {where} group by all"""


def violations(rules: dict[str, str], table: str, label: str, value: str) -> str:
    return " union all ".join(f"select '{n}' as {label}, {agg} as {value} from {table}" for n, agg in rules.items())


def count_if(test: str) -> str:
    return f"count(*) filter (where {test})"


ORACLES = {
    "normalize_target": oracle_with("tgt_record", "county_xwalk") + f"""select r.record_id, r.record_number,
 strftime(r.file_date, '%Y-%m-%d') as file_date, {INT.format('volume')} as volume, {INT.format('page')} as page,
 x.county_name, r.county_id from tgt_record r join county_xwalk x on x.src_county_id = r.county_id
 where record_is_lease = 1 and status_id in (4, 16) and file_date >= date '1996-01-01' and county_id not in (3, 7)""",
    "normalize_target_areas": oracle_with("tgt_record_state", "county_xwalk") + f"""select r.record_id,
 r.record_number, strftime(r.file_date, '%Y-%m-%d') as file_date, {INT.format('volume')} as volume,
 {INT.format('page')} as page, x.county_name, r.county_id from tgt_record_state r
 join county_xwalk x on x.src_county_id = r.county_id and x.state_id = r.state_id
 where ((r.state_id = 1 and county_id in (1, 6, 11)) or (r.state_id = 3 and county_id = 8))
 and status_id in (4, 10, 16, 18, 90)""",
    "normalize_source": oracle_with(*FULL_VIEWS) + f", {FULL} select {FULL_TEXT} from full_src",
    "normalize_source_per_file": oracle_with(*FULL_VIEWS) + f", {FULL_PER_FILE} select {FULL_TEXT} from full_src",
    "lease_file_chain": oracle_with("document_mapping", "lease_file") + """select d.lease_id, f.path, f.filename
 from document_mapping d left join lease_file f on f.lease_id = d.lease_id""",
    "digits_key": oracle_with("tgt_record", "src_lease") + r"""select side, id,
 nullif(try_cast(digits as bigint), 0) as digits_number, digits as digits_text from (
 select 'target' as side, record_id as id, regexp_replace(record_number, '[A-Za-z -]', '', 'g') as digits from tgt_record
 union all select 'source', cast(lease_id as varchar), regexp_replace(record_number, '[A-Za-z -]', '', 'g') from src_lease)""",
    "match_exact": matching(f"select p.* from ({_exact}) p {_unlogged_pairs}"),
    "match_exact_left": matching(f"""select {PAIR} from src s left join tgt t on {EXACT}
 where s.lease_id not in (select lease_id from logged)"""),
    "match_volpage": matching(f"select p.* from ({_volpage}) p {_unlogged_pairs}"),
    "match_substring": matching(f"select p.* from ({_partial}) p {_per_row}"),
    "match_or_legacy": matching(r""", t as (select *, regexp_replace(record_number, '[A-Za-z -]', '', 'g') as digits,
  nullif(try_cast(regexp_replace(record_number, '[A-Za-z -]', '', 'g') as bigint), 0) as num from tgt),
 s as (select *, regexp_replace(record_number, '[A-Za-z -]', '', 'g') as digits,
  nullif(try_cast(regexp_replace(record_number, '[A-Za-z -]', '', 'g') as bigint), 0) as num from src)
select t.record_id as target_record_id, t.num as target_number, s.lease_id as source_lease_id, s.num as source_number,
 t.volume as target_volume, t.page as target_page, s.volume as source_volume, s.page as source_page,
 t.county_id as target_county_id from t join s on t.file_date = s.record_date and (t.num = s.num or t.volume = s.num
 or (length(cast(t.num as varchar)) <> length(cast(s.num as varchar)) and length(cast(t.num as varchar)) >= 5
  and length(cast(s.num as varchar)) >= 5 and (instr(s.digits, t.digits) > 0 or instr(t.digits, s.digits) > 0)))
where t.record_id not in (select record_id from export_log where lease_id is not null)"""),
    "match_exact_by_log_status": matching(f"select p.* from ({_exact}) p {_per_row}"),
    "source_only": matching(_source_only),
    "match_report": matching(report(_per_record)),
    "match_report_per_log_row": matching(report(_per_row)),
    "match_index_rows": matching(""", keys as (
 select distinct 'source' as side, record_date as day, county_name, lower(rtrim(record_number)) as number from src
 union select distinct 'target', file_date, county_name, lower(rtrim(record_number)) from tgt)
select side, count(*) as numbers, cast(sum(case when length(number) > 5 then len(list_distinct(list_transform(
  range(1, length(number) - 3), lambda i: substr(number, i, 5)))) else 0 end) as bigint) as grams,
 count(*) filter (where length(number) >= 5) as findable from keys where number is not null group by side"""),
    "match_union_distinct": matching(f"""select distinct p.* from ({_exact} union all {_volpage}) p
 {_unlogged_pairs}"""),
    "missing_in_target": oracle_with("src_lease", "tgt_record", "export_log") + f"""select lease_id, county_id,
 record_number, {text('created')} as created from src_lease where lease_id not in (select e.lease_id
 from tgt_record r join export_log e on e.record_id = r.record_id where e.lease_id is not null)""",
    "unlogged_leases": matching("select lease_id, county_name from src where lease_id not in (select lease_id from logged)"),
    "log_fill_candidates": matching(f", {LOG_FILL} select * from cand1"),
    "log_fill_apply": matching(f""", {LOG_FILL}, pick as (select target_record_id, min(source_lease_id) as new_lease
 from cand1 group by 1), flagged as (select l.*, p.new_lease, p.new_lease is not null and l.lease_id is null
 and l.created_by is null and l.modified_by is null as hit from stamped_log l
 left join pick p on p.target_record_id = l.record_id)
select record_id, case when hit then new_lease else lease_id end as lease_id,
 case when hit then 'BATCH(1)' else zip_name end as zip_name,
 case when hit then 'BATCH(1)' else created_by end as created_by, case when hit then {TS} end as modified_ts,
 case when hit then 'BATCH(1)' else modified_by end as modified_by from flagged""", "stamped_log"),
    "stage_candidates": candidates(f"""select s.lease_id, s.generated_record_id, s.county_id, s.tgt_county_id
 from cand s where not exists (select 1 from tgt t where {EXACT})"""),
    "stage_candidates_by_log": candidates("select lease_id, generated_record_id, county_id, tgt_county_id from cand"),
    "stage_records": candidates(f", {STAGED_RECORDS} select * from staged"),
    "stage_log": candidates(f"""select generated_record_id as "recordID", lease_id as "LeaseID", {TS} as "exportDate",
 0 as "sentToAudit", 'BATCH(2)' as "zipName", 0 as "zipCopied", 0 as "imageCopied", {TS} as "_CreatedDateTime",
 'BATCH(2)' as "_CreatedBy", cast(null as varchar) as "_ModifiedDateTime", cast(null as varchar) as "_ModifiedBy",
 cast(null as integer) as "CountOfLastAttempt" from cand"""),
    "status_row": oracle_with("tgt_record") + """select distinct status_id, 'in use' as data_entry_description,
 cast(null as varchar) as staple_description, cast(null as varchar) as incoming_inspection_description,
 cast(null as varchar) as assignment_description from tgt_record
 union all select 91, 'Leases mapped from source', null, 'unused', 'unused'""",
    "map_term": oracle_with("src_lease") + f"select lease_id, term_months, {TERM} as term_years from src_lease",
    "map_instrument": oracle_with("src_lease") +
    f"select lease_id, {_case_map('instrument', INSTRUMENTS)} as instrument_type from src_lease",
    "map_depth": oracle_with("src_lease") +
    f"select lease_id, {_case_map('depth_code', DEPTHS)} as depth_type from src_lease",
    "map_state": oracle_with("src_lease") +
    f"select lease_id, {_case_map('lease_id % 110', STATES)} as state_code from src_lease",
    "map_flags": oracle_with("src_lease") + """select lease_id,
 case when acres is null then -1 else 0 end as area_flag,
 case when extension_term_months = 0 then 0 else 1 end as extension_flag,
 case when extension_term_months >= 1 then 'Months' end as extension_unit from src_lease""",
    "map_file_type": oracle_with("lease_file") + f"""select lease_id, filename,
 {EXTENSION.format('filename')} as extension, {SOURCE_PATH} as source_file_path from lease_file""",
    "land_base": land_base(f"coalesce({RANGE}, nullif(a.survey_block, ''))"),
    "land_base_reference": land_base(RANGE),
    "land_apply_parsed": oracle_with("land_desc", "parsed_legal") + f", {APPLIED} select * from applied",
    "land_explode": oracle_with("land_desc") + f", {exploded('land_desc')} {NO_POS}",
    "land_explode_reference": oracle_with("land_desc") +
    f", {exploded('land_desc', ('survey_block', 'range_no'))} {NO_POS}",
    "land_load": oracle_with("land_desc", "parsed_legal") + f""", {APPLIED}, {exploded('applied')}
select * exclude (section_pos, quarter_calls_pos, lot_pos, county_id) replace (
 md5(concat_ws('|', land_description_id, section_pos, quarter_calls_pos, lot_pos)) as land_description_id)
from x_lot""",
    "land_delete_lists": oracle_with("land_desc") + "select * from land_desc where section is null or section not like '%,%'",
    "parties": PARTIES + "select * from party",
    "parties_load": PARTIES + """select *, 'keyed by hand' as note from party where "recordType" = 'grantee'
 union all select *, null from party""",
    "prior_refs": PRIOR_REFS + "select * from prior",
    "prior_refs_load": PRIOR_REFS + """select * from prior where "drVolume" is null union all select * from prior""",
    "image_worklist": oracle_with("tgt_record_state", "export_log", "image_work", "county_xwalk", "state_lookup",
                                  "image_registry") + """select e.lease_id, r.record_id,
 lower(coalesce(st.state_abbr, '')) || '/' || lower(x.county_name) as state_county, w.package_id, '' as source_path,
 '' as destination_path, 0 as page_count, cast(0 as bigint) as file_size, '' as status
 from tgt_record_state r left join export_log e on e.record_id = r.record_id
 left join image_work w on w.lease_id = e.lease_id left join county_xwalk x on x.src_county_id = r.county_id
 left join state_lookup st on st.state_id = r.state_id left join image_registry g on g.record_id = e.record_id
 where w.package_id is not null and g.record_id is null""",
    "image_resolve": imaging("select * from resolved"),
    "image_resolve_prefix": oracle_with(*IMAGE_VIEWS) + f", {resolved(FIRST_BY_PREFIX)} select * from resolved",
    "image_copy_plan": copy_plan("where status = 'copied'"),
    "image_copy_plan_reference": copy_plan(""),
    "image_copy_outcome": copy_plan("where status = 'copied'", """select p.* replace (
 case when c.ok is null then p._ModifiedDateTime else '2025-07-18 01:02:03.000' end as "_ModifiedDateTime",
 case when c.ok then 'copied' when not c.ok then 'error' else p.status end as status) from plan p left join
 (select record_id, bool_or(http_status = 200) as ok from copy_call group by 1) c on c.record_id = p."recordID\"""", "copy_call"),
    "image_delete_plan": imaging("""select r.record_id as "recordID", r.lease_id as leaseid,
 r.destination_path as "s3FilePath", substr(r.destination_path, 19) as object_key,
 case when o.http_status = 204 then '2025-07-17 00:00:00.000' end as "_ModifiedDateTime",
 case when o.http_status = 204 then 'deleted' else 's3 query failed' end as status
 from resolved r left join delete_outcome o on o.record_id = r.record_id where r.status = 'processed'""",
                                 "delete_outcome"),
    "image_requeue": imaging("""select lease_id, record_id, state_county, package_id, source_path, destination_path,
 page_count, file_size, '' as status from resolved where status <> 'processed'"""),
    "image_register": imaging(f"""select e.record_id as "recordID", r.destination_path as "s3FilePath",
 r.page_count as "pageCount", r.file_size as "fileSizeBytes", {TS} as "_ModifiedDateTime",
 'BATCH(2)' as "_ModifiedBy" from resolved r join export_log e on e.lease_id = r.lease_id
 where e.batch_tag = 'LEGACY' and r.page_count <> 0""", "export_log"),
    "map_rows_hook": imaging("""select lease_id, record_id, state_county, package_id, source_path, destination_path,
 page_count, file_size, list_extract(string_split(source_path, '/'), -1) as file_name, 'processed' as status
 from resolved"""),
    "status_move": oracle_with("tgt_record", "export_log") + f"""select * replace ({text('keyed_ts')} as keyed_ts,
 case when {MOVED.format(630)} then 4 else status_id end as status_id) from tgt_record""",
    "status_preview": oracle_with("tgt_record", "export_log") +
    f"select {RECORD_TEXT} from tgt_record where {MOVED.format(630)}",
    "status_preview_hours": oracle_with("tgt_record", "export_log") +
    f"select {RECORD_TEXT} from tgt_record where {MOVED.format(600)}",
    "retype_columns": oracle_with("src_lease") + """select cast(lease_id as varchar) as lease_id,
 cast(county_id as bigint) as county_id, pg from src_lease""",
    "csv_roundtrip_hard": oracle_with("hard_text") + """select land_description_id,
 case when rtrim(hard, ' ') <> '' then hard end as hard from hard_text""",
    "normalize_target_types": oracle_with("tgt_record", "county_xwalk") + f"""select r.record_id, r.record_number,
 strftime(r.file_date, '%Y-%m-%d') as file_date, {INT.format('volume')} as volume, {INT.format('page')} as page,
 x.county_name, r.county_id from tgt_record r join county_xwalk x on x.src_county_id = r.county_id
 where outsource_id % 3 = 0""",
    "extra_files": oracle_with(*FULL_VIEWS) + f""", {FULL} select f.lease_id, s.generated_record_id as record_id, f.path,
 f.filename from (select *, row_number() over (partition by lease_id order by filename, path) as place from lease_file
 where filename is not null) f left join full_src s on s.lease_id = f.lease_id where place > 1""",
    "digits_key_cut": oracle_with("tgt_record") + r"""select record_id,
 nullif(try_cast(regexp_replace(repeat(record_number, 6) || '-7', '[A-Za-z -]', '', 'g') as bigint), 0) as digits_number,
 substr(regexp_replace(repeat(record_number, 6) || '-7', '[A-Za-z -]', '', 'g'), 1, 30) as digits_text from tgt_record""",
    "match_key_report": matching(""", a as (select county_name, file_date as day, record_number as k, count(*) as records
 from tgt where record_number is not null group by all), z as (select county_name, record_date as day,
 lower(record_number) as k, count(*) as leases from src where record_number is not null group by all)
select strftime(a.day, '%Y-%m-%d') as day, lower(a.county_name) as county_key, z.k as source_key, a.k as target_key, leases,
 records, case when a.k = z.k then 'equal number' when leases = 1 then 'contained number' end as match_condition
 from a join z on a.day = z.day and a.county_name = z.county_name and (a.k = z.k or (length(a.k) <> length(z.k)
 and length(a.k) >= 5 and length(z.k) >= 5 and (instr(a.k, z.k) > 0 or instr(z.k, a.k) > 0)))"""),
    "log_fill_full_log": matching(f""", {LOG_FILL}, pick as (select target_record_id, min(source_lease_id) as new_lease
 from cand1 group by 1), flagged as (select l.*, p.new_lease, p.new_lease is not null and l.lease_id is null
 and l.created_by is null and l.modified_by is null as hit from full_log l
 left join pick p on p.target_record_id = l.record_id)
select * exclude (new_lease, hit) replace (case when hit then new_lease else lease_id end as lease_id,
 case when hit then 'BATCH(1)' else zip_name end as zip_name, case when hit then 'BATCH(1)' else created_by end as created_by,
 {text('"exportDate"')} as "exportDate", {text('"_CreatedDateTime"')} as "_CreatedDateTime",
 case when hit then {TS} else {text('modified_ts')} end as modified_ts,
 case when hit then 'BATCH(1)' else modified_by end as modified_by) from flagged""", "full_log"),
    "narrowing_losses": candidates("""select lease_id, generated_record_id as record_id, 'records' as table_name,
 'RoyaltyAmount' as column_name, '12.500000' as value from cand where lease_id % 50 = 0
 union all select lease_id, generated_record_id, 'records', 'ExtensionBonus', '9000000000000' from cand where lease_id % 60 = 1"""),
    "orphans_parties": oracle_with(*PARTY_VIEWS, "image_registry") + f""", {BATCH},
 party as ({party('grantor')} union {party('grantee')}) select "recordID" as missing_record_id, count(*) as entries from party
 where "recordID" not in (select record_id from image_registry) group by 1""",
    "orphans_prior_refs": oracle_with("tgt_record", "export_log", "lease_deed", "image_registry") + f""", {BATCH}, {PRIOR}
select "recordID" as missing_record_id, count(*) as entries from prior
 where "recordID" not in (select record_id from image_registry) group by 1""",
    "orphans_log": oracle_with("export_log", "tgt_record") + """select record_id as missing_record_id, count(*) as entries
 from export_log where record_id not in (select record_id from tgt_record) group by 1""",
    "county_reconcile_shared": oracle_with(*MATCH_VIEWS, "shared_xwalk") + """, a as (select x.tgt_county_id as id,
 count(distinct lease_id) as n from src_lease l left join shared_xwalk x on x.src_county_id = l.county_id group by 1),
 b as (select case when outsource_id = 29 then 2999 else 2000 + r.county_id % 10 end as id, count(distinct e.lease_id) as n
 from tgt_record r join export_log e on e.record_id = r.record_id where r.remarks = 'BATCH(2)' and e.lease_id is not null group by 1),
 x as (select tgt_county_id as id, min(county_name) as county_name, arg_min(state_id, county_name) as state_id
 from shared_xwalk where tgt_county_id is not null group by 1)
select county_name, state_id, coalesce(a.n, 0) as source_leases, coalesce(b.n, 0) as target_leases,
 coalesce(a.n, 0) - coalesce(b.n, 0) as difference from a full join b on b.id = a.id
 left join x on x.id = coalesce(a.id, b.id) where coalesce(a.n, 0) <> coalesce(b.n, 0)""",
    "name_coverage_partial": PARTIES + """select min("gName") as "gName", count(*) as occurrences from party
 where lower("gName") not in (select lower(name) from grantee) group by lower("gName")""",
    "instrument_volume": oracle_with("src_lease") +
    f"select {_case_map('instrument', INSTRUMENTS)} as instrument_type, count(*) as occurrences from src_lease group by 1",
    "day_counts": oracle_with("tgt_record", "full_log") + """select 'records received' as measure, count(*) as record_count
 from tgt_record where cast(keyed_ts as date) = date '1997-03-05' union all select 'log rows modified', count(*)
 from full_log where cast(modified_ts as date) = date '1997-03-05'""",
    "log_fill_conflicts_shared": matching(""", twin as (select * from src union all select * replace (lease_id + 1000000000 as lease_id)
 from src where lease_id % 2 = 0), hits as (select distinct t.record_id, s.lease_id from export_log e
 join tgt t on t.record_id = e.record_id join twin s on """ + EXACT + """ where e.lease_id is null)
select record_id as target_record_id, count(*) as candidates from hits group by 1 having count(*) > 1"""),
    "dup_keys_images": imaging("""select lease_id, cast(2 as bigint) as copies from resolved where page_count = 3"""),
    "promote_table": oracle_with("tgt_record") + "select count(*) as source_rows, count(*) as promoted_rows from tgt_record",
    "append_load": oracle_with("tgt_record", "export_log") + """select * from export_log
 union all select record_id, null, remarks from tgt_record""",
    "csv_roundtrip": oracle_with("land_desc") + """select land_description_id, nullif(survey_block, '') as survey_block,
 nullif(section, '') as section, nullif(brief_legal, '') as brief_legal from land_desc""",
    "profile_csv": oracle_with("tgt_record") + profile(RECORD_COLUMNS, "tgt_record"),
    "null_profile": candidates(f", {STAGED_RECORDS} " + profile(TEXT_OR_TIME, "staged", ZERO_TESTED)),
    "null_profile_rows": oracle_with("src_lease") + " union all ".join(
        f"""select '{c}' as column_name, count({c}) as value_count,
 {count_if(f"{c} is null" + (f" or rtrim({c}) = ''" if k == "string" else ""))} as null_count from src_lease"""
        for c, k in LEASE_COLUMNS.items()),
    "blank_counts": oracle_with("src_lease") + violations(
        {c: count_if(f"rtrim({c}) = ''") for c in ("record_number", "vol", "deed_vol", "deed_pg")},
        "src_lease", "column_name", "blank_count"),
    "party_null_split": PARTIES + """select "recordType", """ + ", ".join(
        f"""count(*) - count("{c}") as "{c}_null_count", count("{c}") as "{c}_not_null_count" """
        for c in ("recordID", "gName", "gAddress", "gZip", "gCity", "StateID")) + " from party group by 1",
    "orphans": oracle_with("land_desc", "tgt_record") + """select record_id as missing_record_id, count(*) as entries
 from land_desc where record_id not in (select record_id from tgt_record) group by 1""",
    "missing_relations": oracle_with(*PARTY_VIEWS, "land_desc", "lease_deed") + f""", {BATCH},
 party as ({party('grantor')} union {party('grantee')}), {PRIOR},
 leases as (select record_id from tgt_record where remarks = 'BATCH(2)' and record_is_lease = 1) """ + violations({
        f"without {name}": count_if(f"record_id not in (select {c} from {t})") for name, c, t in (
            ("land descriptions", "record_id", "land_desc"), ("grantor/grantee entries", '"recordID"', "party"),
            ("volume/page references", '"recordID"', "prior"), ("export log", "record_id", "export_log"))},
        "leases", "absent_relation", "record_count"),
    "county_reconcile": oracle_with(*MATCH_VIEWS) + """, a as (select county_id, count(distinct lease_id) as n
 from src_lease group by 1), b as (select r.county_id, count(distinct e.lease_id) as n from tgt_record r
 join export_log e on e.record_id = r.record_id where r.remarks = 'BATCH(2)' group by 1)
select x.county_name, x.state_id, a.n as source_leases, coalesce(b.n, 0) as target_leases,
 a.n - coalesce(b.n, 0) as difference from a left join county_xwalk x on x.src_county_id = a.county_id
 left join b on b.county_id = a.county_id where a.n <> coalesce(b.n, 0)""",
    "county_reconcile_global": oracle_with(*MATCH_VIEWS) + """select x.county_name, x.state_id,
 count(distinct l.lease_id) as source_leases, any_value(g.n) as target_leases,
 count(distinct l.lease_id) - any_value(g.n) as difference from src_lease l
 left join county_xwalk x on x.src_county_id = l.county_id, (select count(distinct e.lease_id) as n
 from tgt_record r left join export_log e on e.record_id = r.record_id where r.remarks = 'BATCH(2)') g
 group by x.county_name, x.state_id having count(distinct l.lease_id) <> any_value(g.n)""",
    "funnel": oracle_with("tgt_record", "export_log", "lease_deed") + """
select 1 as step, 'batch records' as step_name, count(distinct record_id) as distinct_keys from tgt_record
 where remarks = 'BATCH(2)'
union all select 2, 'with log row', count(distinct r.record_id) from tgt_record r join export_log e using (record_id)
union all select 3, 'with lease', count(distinct r.record_id) from tgt_record r join export_log e using (record_id)
 join lease_deed d on d.lease_id = e.lease_id
union all select 4, 'with deed reference', count(distinct r.record_id) from tgt_record r
 join export_log e using (record_id) join lease_deed d on d.lease_id = e.lease_id
 where rtrim(d.deed_vol) <> '' and rtrim(d.deed_pg) <> ''""",
    "name_coverage": PARTIES + """select min("gName") as "gName", count(*) as occurrences from party
 where lower("gName") not in (select lower(name) from grantor union all select lower(name) from grantee)
 group by lower("gName")""",
    "name_coverage_grantors": PARTIES + """select min("gName") as "gName", count(*) as occurrences from party
 where lower("gName") not in (select lower(name) from grantor) group by lower("gName")""",
    "value_freq": oracle_with("land_desc") + " union all ".join(
        f"select '{c}' as column_name, {c} as value, count(*) as occurrences from land_desc group by 2"
        for c in ("section", "quarter_calls", "lot", "range_dir", "survey_block")),
    "section_freq": oracle_with("land_desc") + """select section, brief_legal, count(*) as occurrences
 from land_desc where section like '%,%' group by all""",
    "status_freq": oracle_with("tgt_record") + """select status_id, outsource_id, count(*) as occurrences
 from tgt_record where remarks = 'BATCH(2)' group by all""",
    "rule_violations": oracle_with("tgt_record", "county_xwalk") + ", r as (select * from tgt_record where remarks ilike '%batch%') " + violations({
        "null essentials": count_if("record_number is null or status_id <> 90 or record_is_lease <> 1 or county_id is null"),
        "county not in crosswalk": count_if(
            "county_id not in (select src_county_id from county_xwalk where tgt_county_id is not null)"),
        "future dated": count_if("file_date > date '1999-01-01'"),
        "wrong lease flags": count_if("record_is_lease <> 1 or record_is_courthouse <> 0")},
        "r", "rule", "violations"),
    "monthly_volume": oracle_with("tgt_record", "county_xwalk") +
    volume_by_month("tgt_record", "r.keyed_ts", "where record_is_lease = 1"),
    "monthly_volume_per_log_row": oracle_with("tgt_record", "county_xwalk", "export_log") + volume_by_month(
        "tgt_record", "r.keyed_ts", "where record_is_lease = 1 and county_name in ('NATION_1', 'NATION_5', 'NATION_9')",
        more="left join export_log e on e.record_id = r.record_id"),
    "monthly_volume_source": oracle_with("src_lease", "county_xwalk") + volume_by_month("src_lease", "r.created"),
    "stratified_sample": imaging("""select s.*, r.record_number from (select *, row_number() over (
 partition by page_count order by record_id, lease_id) as rn from resolved where page_count between 1 and 10) s
 join tgt_record r on r.record_id = s.record_id where s.rn <= 5""", "tgt_record"),
    "unparsed_legal": oracle_with("land_desc") + """select * from land_desc where coalesce(section, '') = ''
 and coalesce(quarter_calls, '') = '' and coalesce(lot, '') = ''""",
    "unparsed_legal_reference": oracle_with("land_desc") + "select * from land_desc where section = '' and lot = ''",
    "parsed_legal": oracle_with("land_desc") + """select * from land_desc where section <> '' or quarter_calls <> ''
 or lot <> ''""",
    "unparsed_texts": oracle_with("land_desc") + """select brief_legal, count(*) as occurrences from land_desc
 where coalesce(section, '') = '' and coalesce(quarter_calls, '') = '' and coalesce(lot, '') = ''
 and brief_legal is not null group by 1""",
    "batch_audit": oracle_with("tgt_record", "export_log") + """, j as (select r.*, e.lease_id, e.batch_tag,
 cast(keyed_ts as date) = date '1997-03-05' as today from tgt_record r
 left join export_log e on e.record_id = r.record_id) """ + " union all ".join(
        f"select record_id, lease_id, batch_tag, '{label}' as audit from j where {test}" for label, test in (
            ("batch record not modified on the day", "remarks ilike '%batch%' and not today"),
            ("foreign record modified on the day", "remarks not ilike '%batch%' and today"),
            ("record without county", "county_id is null"),
            ("lease logged outside lease batches",
             "lease_id is not null and batch_tag not ilike '%lease%' and batch_tag <> 'LEGACY'"))),
    "target_counts": oracle_with("tgt_record") + violations({
        "lease records": count_if("record_is_lease = 1 and status_id in (4, 10, 16, 18, 90)"),
        "batch records": count_if("remarks ilike '%batch%'"), "distinct records": "count(distinct record_id)",
        "distinct batch records": "count(distinct record_id) filter (where remarks ilike '%batch%')"},
        "tgt_record", "measure", "record_count"),
    "log_counts": oracle_with("export_log") + violations({
        "log rows": "count(*)", "log rows with lease": "count(lease_id)",
        "logged records": "count(distinct record_id)"}, "export_log", "measure", "record_count"),
    "party_counts": PARTIES + """select "recordType", count(*) as party_rows, count(distinct "recordID") as records
 from party group by 1""",
    "null_aware_exclusion": oracle_with("export_log", "issued_ids") + """select lease_id from export_log
 where lease_id not in (select lease_id from issued_ids)""",
    "null_aware_exclusion_with_null": oracle_with("export_log", "issued_ids") + """select * from issued_ids
 where lease_id not in (select lease_id from export_log)""",
    "semi_exists": oracle_with("tgt_record", "image_registry") + f"""select {RECORD_TEXT} from tgt_record
 where record_id in (select record_id from image_registry)""",
    "delete_existing": oracle_with("image_work", "image_registry") + """select * from image_work w
 where not exists (select 1 from image_registry g where g.record_id = w.record_id)""",
    "author_exclusion": oracle_with("stamped_log") + """select * from stamped_log where zip_name <> 'LEGACY'
 and zip_name <> 'RETRY'""",
    "dup_keys": oracle_with("export_log") + """select record_id, count(*) as copies from export_log group by 1
 having count(*) > 1""",
    "log_fill_conflicts": matching(f""", {LOG_FILL} select target_record_id, count(distinct source_lease_id)
 as candidates from cand1 group by 1 having count(distinct source_lease_id) > 1"""),
    "top_n": oracle_with("tgt_record", "export_log") + f"""select r.record_id, r.record_number, e.lease_id,
 {text('r.keyed_ts')} as keyed_ts from tgt_record r join export_log e on e.record_id = r.record_id
 where e.batch_tag ilike '%legacy%' order by e.lease_id nulls first, r.record_id limit 100""",
    "both_sides": oracle_with("tgt_record", "export_log") + f"""select """ + ", ".join(
        f"{text('r.keyed_ts')} as tr_keyed_ts" if c == "keyed_ts" else f"r.{c} as tr_{c}" for c in RECORD_COLUMNS) + """,
 e.record_id as log_record_id, e.lease_id as log_lease_id, e.batch_tag as log_batch_tag
 from tgt_record r left join export_log e on e.record_id = r.record_id where r.remarks ilike '%batch%'""",
}


def step_counts(*steps: tuple[str, int | None, str, bool]) -> str:
    """Rows of the observed steps: name, number of the step before, what is counted, whether rows must be kept."""
    counted = ", ".join(f"(select count(*) from {frame}) as n{i + 1}" for i, (_, _, frame, _) in enumerate(steps))
    return f""", n as (select {counted}) """ + " union all ".join(
        f"""select {i + 1} as step, '{name}' as step_name, {f'n{of}' if of else 'cast(null as bigint)'} as rows_in,
 n{i + 1} as rows_out, {f'n{i + 1} = n{of}' if kept else 'cast(null as boolean)'} as kept from n"""
        for i, (name, of, _, kept) in enumerate(steps))


_ISSUED = "src_lease_terms l left join issued_ids i on i.lease_id = l.lease_id"
_PLACED = f"{_ISSUED} left join county_xwalk x on x.src_county_id = l.county_id"
_LEGAL = """(select l.lease_id, m.descriptions, a.abstract_id, a.abstract_no, a.range_no, a.range_dir, a.survey_block from src_lease l
 join document_mapping d on d.lease_id = l.lease_id join abstract_mapping m on m.mapping_id = d.mapping_id
 and rtrim(m.descriptions) <> '' join abstract a on a.abstract_id = m.abstract_id)"""
_USABLE = f"""(select * from {_LEGAL} where descriptions not ilike '%all%' and descriptions not ilike '%below%'
 and descriptions not ilike '%remarks%') u"""
_LOGGED = f"{_USABLE} join export_log e on e.lease_id = u.lease_id"
_RECORDED = f"{_LOGGED} join tgt_record_state r on r.record_id = e.record_id"
_STATED = f"{_RECORDED} join (select * from state_lookup where state_name <> 'EUROPE') st on st.state_id = r.state_id"
_COUNTIED = f"{_STATED} join county_xwalk x on x.src_county_id = r.county_id"
_MOVED_ROWS = oracle_with("tgt_record", "export_log") + f"""select record_id, 'updated' as change, 'status_id' as column,
 cast(status_id as varchar) as before, '4' as after, cast(1 as bigint) as copies
 from tgt_record where {MOVED.format(630)} and status_id <> 4"""

ORACLES.update({
    "normalize_source_steps": oracle_with(*FULL_VIEWS) + step_counts(
        ("leases", None, "src_lease_terms", False), ("with issued id", 1, _ISSUED, True), ("with county", 2, _PLACED, True),
        ("with file", 3, f"{_PLACED} left join {ONE_FILE} f on f.lease_id = l.lease_id", True)),
    "normalize_per_file_steps": oracle_with(*FULL_VIEWS) + step_counts(
        ("leases", None, "src_lease_terms", False), ("with issued id", 1, _ISSUED, True), ("with county", 2, _PLACED, True),
        ("with file", 3, f"{_PLACED} left join lease_file f on f.lease_id = l.lease_id", False)),
    "lease_file_steps": oracle_with("document_mapping", "lease_file") + step_counts(
        ("mappings", None, "document_mapping", False), ("with document", 1, "document_mapping", True),
        ("with files", 2, "document_mapping d left join lease_file f on f.lease_id = d.lease_id", False)),
    "land_base_steps": oracle_with(*LAND_VIEWS) + step_counts(
        ("texts", None, _LEGAL, False), ("usable texts", 1, _USABLE, False), ("with log row", 2, _LOGGED, False),
        ("with record", 3, _RECORDED, False), ("with state", 4, _STATED, False), ("with county", 5, _COUNTIED, False),
        ("different rows", 6, f"""(select distinct r.record_id, r.county_id, x.county_name, st.state_name, u.abstract_id,
 u.abstract_no, u.descriptions, u.range_no, u.range_dir, u.survey_block from {_COUNTIED})""", False)),
    "parser_extract": f"""select "landDescriptionID", "CountyName" as "County", "StateName" as "State", "BriefLegal"
 from ({ORACLES['land_base']})""",
    "promoted_records": ORACLES["status_move"],
    "status_move_parts": ORACLES["status_move"],
    "delete_existing_parts": ORACLES["delete_existing"],
    "log_fill_parts": ORACLES["log_fill_full_log"],
    "append_counts": oracle_with("export_log", "tgt_record") + """select (select count(*) from export_log) as before,
 (select count(*) from tgt_record) as appended,
 (select count(*) from export_log) + (select count(*) from tgt_record) as after""",
    "status_move_diff": _MOVED_ROWS,
    "delete_diff": oracle_with("image_work", "image_registry") + """select record_id, 'deleted' as change, lease_id,
 cast(null as varchar) as after, cast(1 as bigint) as copies from image_work
 where record_id in (select record_id from image_registry)""",
    "profile_merged": oracle_with("tgt_record") + " union all ".join(
        f"""select '{c}' as column_name, count({c}) as value_count, count(*) filter (where {c} is null{f" or rtrim({c}) = ''" if k == "string" else ""})
 as null_count from tgt_record""" for c, k in RECORD_COLUMNS.items() if c != "remarks"),
    "profile_drift": oracle_with("tgt_record") + " union all ".join(
        f"""select '{c}' as column_name, count(*) filter (where not batch) as rows_before, count(*) filter (where batch) as rows_after,
 count(*) filter (where not batch and gone)::double / count(*) filter (where not batch) as missing_before,
 count(*) filter (where batch and gone)::double / count(*) filter (where batch) as missing_after
 from (select remarks = 'BATCH(2)' as batch, {c} is null{f" or rtrim({c}) = ''" if k == "string" else ""} as gone from tgt_record)"""
        for c, k in RECORD_COLUMNS.items()),
    "missing_relations_staged": ORACLES["missing_relations"],
    "object_folders": oracle_with("tgt_record") + """select distinct 'outsource_id=' || outsource_id || '/status_id=' || status_id as folder
 from tgt_record""",
    "image_register_table": f"select *, 'registered' as status from ({ORACLES['image_register']})",
    "staged_and_removed": oracle_with("export_log") + """select batch_tag, count(*) as log_rows from export_log
 where lease_id is not null group by 1""",
    "record_sample": oracle_with("tgt_record") + """select outsource_id, record_id, record_number, row_number() over (
 partition by outsource_id order by md5('qa/' || record_id), record_id) as rn from tgt_record qualify rn <= 5""",
    "csv_rejects": oracle_with("land_desc") + """select case when county_id % 4 = 0 then land_description_id end as land_description_id,
 case when county_id % 4 = 0 then county_id end as county_id, case county_id % 4 when 1 then land_description_id || ',x'
 when 2 then land_description_id when 3 then land_description_id || ',' || cast(county_id as varchar) || ',more' end as line
 from land_desc""",
    "lease_counts_rollup": oracle_with("src_lease", "county_xwalk") + """, p as (select l.lease_id, x.state_id, x.county_name,
 cast(year(record_date) as integer) as year from src_lease l left join county_xwalk x on x.src_county_id = l.county_id)
select 3 as level, state_id, county_name, year, count(distinct lease_id) as leases from p group by all
union all select 2, state_id, county_name, null, count(distinct lease_id) from p group by all
union all select 1, state_id, null, null, count(distinct lease_id) from p group by all
union all select 0, null, null, null, count(distinct lease_id) from p""",
})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
