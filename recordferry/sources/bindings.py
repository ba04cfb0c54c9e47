"""Views that give the driver tables the shapes of the migrated tables.

Each view is one SELECT that means the same in Spark SQL and in DuckDB apart
from the name of the string type (`{S}`).  Spark evaluates it lazily over the
parquet scans, so every query grows with the given tables; the same text heads
the oracle SQL as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "pages")

VIEWS = {
    "src_lease": """
select o_orderkey as lease_id, cast(o_custkey % 25 as int) as county_id,
  o_custkey as grantor_id, o_orderkey % 100 as grantee_id,
  case when o_orderkey % 7 = 0 then 'AB' || cast(100000 + o_orderkey as {S}) || '-X'
       when o_orderkey % 7 = 1 then 'Z' || cast(o_orderkey % 900 as {S})
       when o_orderkey % 7 = 2 then null
       else cast(100000 + o_orderkey as {S}) end as record_number,
  cast(o_orderdate as date) as record_date,
  case when o_orderkey % 11 = 0 then 'BK' when o_orderkey % 13 = 0 then '' else cast(o_orderkey % 500 as {S}) end as vol,
  cast(o_orderkey % 97 as {S}) as pg,
  cast(o_orderkey % 15 as int) as instrument,
  cast((o_orderkey % 33) * 12 + (o_orderkey % 12) as int) as term_months,
  case when o_orderkey % 10 = 0 then null else cast(o_orderkey % 4 as int) end as extension_term_months,
  case when o_orderkey % 6 = 5 then 255 else cast(o_orderkey % 6 as int) end as depth_code,
  case when o_orderkey % 8 = 0 then null else o_totalprice end as acres,
  cast((o_orderkey % 2000) / 10000.0 as decimal(9,6)) as royalty,
  case when o_orderkey % 4 = 0 then 'null' when o_orderkey % 4 = 1 then '' when o_orderkey % 4 = 2 then ' ' || cast(o_orderkey % 300 as {S}) || ' ' else null end as deed_vol,
  case when o_orderkey % 5 = 0 then '' else cast(o_orderkey % 50 as {S}) end as deed_pg,
  o_orderdate as created
from orders""",
    "tgt_record": """
select md5(cast(o_orderkey as {S})) as record_id,
  cast(100000 + o_orderkey as {S}) as record_number, cast(o_orderdate as date) as file_date,
  case when o_orderkey % 11 = 0 then 'BK' else cast(o_orderkey % 500 as {S}) end as volume,
  cast(o_orderkey % 97 as {S}) as page, cast(o_custkey % 25 as int) as county_id,
  case when o_orderkey % 3 = 0 then 'BATCH(2)' else 'keyed' end as remarks,
  case when o_orderkey % 3 = 0 then 90 else 4 end as status_id,
  cast(o_orderkey % 30 as int) as outsource_id, o_orderdate as keyed_ts,
  1 as record_is_lease, case when o_orderkey % 401 = 0 then 1 else 0 end as record_is_courthouse
from orders where o_orderkey % 5 <> 0""",
    "export_log": """
select md5(cast(o_orderkey as {S})) as record_id,
  case when o_orderkey % 6 = 0 then null else o_orderkey end as lease_id,
  case when o_orderkey % 2 = 0 then 'BATCH(2)' else 'LEGACY' end as batch_tag
from orders where o_orderkey % 3 = 0
union all select md5(cast(o_orderkey as {S})), cast(null as bigint), 'RETRY'
from orders where o_orderkey % 12 = 3""",
    "county_xwalk": """
select n_nationkey as src_county_id,
  case when n_nationkey % 8 = 7 then null else 1000 + n_nationkey end as tgt_county_id,
  n_name as county_name, n_regionkey as state_id from nation""",
    "state_lookup": """
select r_regionkey as state_id, r_name as state_name,
  'S' || cast(r_regionkey as {S}) as state_abbr from region where r_regionkey < 4""",
    "grantor": """
select c_custkey as grantor_id,
  case when c_custkey % 17 = 0 then '' else c_name end as name,
  case when c_custkey % 9 = 0 then '' else cast(c_custkey as {S}) || ' Main St' end as address,
  case when c_custkey % 5 = 0 then '' else cast(70000 + c_custkey as {S}) end as zip,
  c_mktsegment as city, 's' || cast(c_nationkey % 5 as {S}) as state_abbr from customer""",
    "grantee": """
select s_suppkey as grantee_id,
  case when s_suppkey % 17 = 0 then '' else s_name end as name,
  case when s_suppkey % 9 = 0 then '' else cast(s_suppkey as {S}) || ' Oak Ave' end as address,
  case when s_suppkey % 5 = 0 then '' else cast(80000 + s_suppkey as {S}) end as zip,
  'City' || cast(s_suppkey % 7 as {S}) as city, 'S' || cast(s_nationkey % 5 as {S}) as state_abbr from supplier""",
    "land_desc": """
select md5('L' || cast(p_partkey as {S})) as land_description_id,
  md5(cast(p_partkey as {S})) as record_id, cast(p_partkey % 25 as int) as county_id,
  case when p_partkey % 5 = 0 then null when p_partkey % 5 = 1 then '' when p_partkey % 5 = 2 then '1, 2,,3' when p_partkey % 5 = 3 then cast(p_size as {S}) || ',' || cast(p_size + 1 as {S}) else cast(p_size as {S}) end as section,
  case when p_partkey % 3 = 0 then 'NE4, SW4' when p_partkey % 3 = 1 then 'N2' else null end as quarter_calls,
  case when p_partkey % 4 = 0 then '7,8 ,9' when p_partkey % 4 = 1 then '7' else '' end as lot,
  case when p_partkey % 6 = 0 then null else cast(p_size as double) + 0.5 end as range_no,
  case when p_partkey % 4 = 0 then null else 'E' end as range_dir, p_brand as survey_block,
  case when p_partkey % 7 = 0 then 'ALL of ' || p_name when p_partkey % 7 = 1 then 'see remarks' when p_partkey % 7 = 2 then '' else p_name end as brief_legal
from part""",
    "lease_file": """
select o_orderkey as lease_id, 'dir' || cast(o_orderkey % 10 as {S}) as path,
  case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then 'l' || cast(o_orderkey as {S}) || '.pdf' when o_orderkey % 5 = 2 then 'l' || cast(o_orderkey as {S}) || '.JPG' when o_orderkey % 5 = 3 then 'l' || cast(o_orderkey as {S}) || '.tif.pdf' else 'l' || cast(o_orderkey as {S}) || '.doc' end as filename
from orders
union all select o_orderkey, 'extra', 'second' || cast(o_orderkey as {S}) || '.pdf' from orders where o_orderkey % 40 = 1""",
    "issued_ids": """
select o_orderkey as lease_id, md5('issued' || cast(o_orderkey as {S})) as record_id
from orders where o_orderkey % 50 = 0""",
    "parsed_legal": """
select land_description_id, section as parsed_section, quarter_calls as parsed_quarter_calls,
  lot as parsed_lot, 'Survey ' || survey_block as survey, cast(null as {S}) as subdivision
from land_desc where county_id < 20""",
    "image_work": """
select o_orderkey as lease_id, md5(cast(o_orderkey as {S})) as record_id,
  's' || cast(o_custkey % 5 as {S}) || '/county' || cast(o_custkey % 25 as {S}) as state_county,
  case when o_orderkey % 9 = 0 then null else 'pkg' || cast(1000 + o_orderkey % 300 as {S}) end as package_id
from orders""",
    "object_manifest": """
select 'pkg' || cast(1000 + page_id as {S}) || '/part' || cast(page_id % 3 as {S}) || case when page_id % 2 = 0 then '.pdf' else '.tif' end as object_key,
  length(html) as size_bytes, cast(page_id % 12 as int) as page_count from pages""",
    # Lease columns the base shape lacks; the staged record needs them.
    "src_lease_terms": """
select l.*, created as effective_date, created as instrument_date,
  cast(term_months as double) * 10 as depth_min, cast(term_months as double) * 20 + 0.5 as depth_max,
  acres / 3 as extension_bonus, lease_id % 2 = 0 as is_blm, lease_id % 3 = 0 as is_state,
  acres / 7 as delay_rental, acres / 9 as delay_rental_value
from src_lease l""",
    # Leases whose deed columns take every shape for logged leases too.
    "lease_deed": """
select o_orderkey as lease_id,
  case when o_orderkey % 16 < 4 then 'null' when o_orderkey % 16 < 8 then '  ' when o_orderkey % 16 < 13 then ' ' || cast(o_orderkey % 300 as {S}) || ' ' else null end as deed_vol,
  case when o_orderkey % 5 = 0 then '' when o_orderkey % 13 = 0 then 'NULL' else cast(o_orderkey % 50 as {S}) end as deed_pg
from orders""",
    # One document per lease, its legal texts, and the abstracts they cite.
    "document_mapping": """
select lease_id, md5(cast(lease_id as {S})) as mapping_id from src_lease""",
    "abstract_mapping": """
select record_id as mapping_id, land_description_id as abstract_id, brief_legal as descriptions from land_desc""",
    "abstract": """
select land_description_id as abstract_id, range_no, range_dir, survey_block, county_id as abstract_no from land_desc""",
    # Target records with the state their county lies in.
    "tgt_record_state": """
select r.*, x.state_id from tgt_record r join county_xwalk x on x.src_county_id = r.county_id""",
    # Log rows with the author stamps a guarded update looks at.
    "stamped_log": """
select record_id, lease_id, batch_tag as zip_name,
  case when batch_tag = 'RETRY' and lease_id is null then 'importer' else null end as created_by,
  cast(null as {S}) as modified_by from export_log""",
    # Records whose images were put in the registry, with or without success.
    "image_registry": """
select record_id, case when outsource_id < 5 then 'error' else 'copied' end as status
from tgt_record where remarks = 'BATCH(2)' and outsource_id < 15""",
    # The log with all its columns; some rows were modified by a later pass.
    "full_log": """
select record_id, lease_id, cast('2025-01-02 03:04:05' as timestamp) as exportDate,
  cast(length(zip_name) as int) as sentToAudit, zip_name, 0 as zipCopied,
  case when lease_id is null then 0 else 1 end as imageCopied, cast('2025-01-01 00:00:00' as timestamp) as _CreatedDateTime,
  created_by, case when lease_id % 4 = 1 then cast('1997-03-05 07:08:09' as timestamp) else null end as modified_ts,
  modified_by, cast(3 as int) as CountOfLastAttempt from stamped_log""",
    # A crosswalk in which several source counties share one target county.
    "shared_xwalk": """
select src_county_id, case when tgt_county_id is null then null else 2000 + src_county_id % 10 end as tgt_county_id,
  county_name, state_id from county_xwalk""",
    # Texts that CSV finds hard.
    "hard_text": """
select land_description_id, case length(coalesce(brief_legal, '')) % 7
  when 0 then brief_legal || chr(10) || 'second line' when 1 then '  ' || brief_legal || '  '
  when 2 then 'say "' || brief_legal || '", twice' when 3 then brief_legal || chr(92)
  when 4 then chr(13) || chr(92) || 'n' || brief_legal || chr(92) || chr(92) || '"' when 5 then chr(9) || brief_legal || ',,'
  else brief_legal end as hard from land_desc""",
    # Outcome of each copy call; some calls were not made.
    "copy_call": """
select record_id, case when lease_id % 7 = 0 then 500 else 200 end as http_status
from image_work where lease_id % 5 <> 0""",
    # Outcome of each delete call.
    "delete_outcome": """
select record_id, case when package_id is null then 500 else 204 end as http_status
from image_work""",
}


def dependencies(name: str) -> list[str]:
    """Views that `name` reads, itself last, in creation order."""
    order: list[str] = []
    for other in VIEWS:
        if other != name and re.search(rf"\bfrom {other}\b|\bjoin {other}\b", VIEWS[name]):
            order += [d for d in dependencies(other) if d not in order]
    return order + [name]


class Bindings:
    """Attribute access to driver tables and views: `b.orders`, `b.src_lease`."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BASE_TABLES and name not in VIEWS:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        text = VIEWS[name].format(S="string")
        inputs = [t for t in (*BASE_TABLES, *VIEWS)
                  if re.search(rf"\b(from|join) {t}\b", text)]
        text = re.sub(rf"\b(from|join) ({'|'.join(inputs)})\b", r"\1 {\2}", text)
        return self.spark.sql(text, **{t: getattr(self, t) for t in inputs})


def oracle_with(*names: str) -> str:
    """`with a as (…), b as (…)` heading for an oracle that reads these views."""
    order: list[str] = []
    for name in names:
        order += [d for d in dependencies(name) if d not in order]
    return "with " + ",\n".join(f"{n} as ({VIEWS[n].format(S='varchar')})" for n in order) + "\n"
