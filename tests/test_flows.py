"""The end-to-end flows, with their writes."""

from pyspark.sql import functions as F

from recordferry.operators import land
from recordferry.operators.stage import Run
from recordferry.plans import flows
from recordferry.plans import queries as Q
from recordferry.sources import sinks, tables

RUN = Q.RUN


def test_records_flow_is_incremental(small, tmp_path):
    target, source = Q.target_slice(small), Q.full_source(small)
    # one lease's royalty does not fit its column
    source = source.withColumn("royalty", F.when(F.col("lease_id") % 10 == 1, 12.5).otherwise(F.col("royalty")).cast("decimal(9,6)"))
    out = flows.migrate_records(target, source, small.export_log, small.county_xwalk, RUN, f"{tmp_path}/one",
                                files=small.lease_file, share_root=Q.SHARE)
    records, log, losses, extra = (out[n] for n in ("records", "export_log", "losses", "extra_files"))
    lost = records.where("RoyaltyAmount is null").select("recordID")
    assert losses.count() == lost.count() > 0 and losses.join(lost, F.col("record_id") == F.col("recordID"), "left_anti").isEmpty()
    carried = records.where("originalFileName != ''").count()
    files = small.lease_file.where("filename is not null").join(log.select(F.col("LeaseID").alias("lease_id")), "lease_id", "left_semi")
    assert carried + extra.count() == files.count() and not extra.isEmpty()
    assert records.count() == log.count() > 0
    assert records.join(log, "recordID", "left_anti").isEmpty()
    extended = flows.extended_log(small.export_log, log)
    again = flows.migrate_records(target, source, extended, small.county_xwalk, RUN, f"{tmp_path}/two")
    assert again["records"].isEmpty() and "extra_files" not in again


def test_land_round_trip(spark, bindings, tmp_path):
    base = flows.extract_legal(Q.land_rows(bindings), f"{tmp_path}/land")
    extract = tables.csv_table(spark, f"{tmp_path}/land/brief_legal_csv",
                               "landDescriptionID string, County string, State string, BriefLegal string")
    assert extract.count() == base.count() > 0
    # stands in for the outside parser
    parsed = extract.select(
        "landDescriptionID", F.lit("A-1").alias("Survey"), F.lit(None).cast("string").alias("Subdivision"),
        F.lit("1, 2").alias("Lot"), F.lit("").alias("Block"), F.lit("3,4,5").alias("Section"),
        F.lit("T1").alias("Township"), F.lit("7E").alias("Range"), F.lit("N2").alias("Quartercall"),
        F.lit(None).cast("string").alias("NewCityBlock"))
    sinks.write_csv(parsed.unionByName(parsed.limit(1).withColumn("Block", F.lit("other"))), f"{tmp_path}/parsed")
    final, conflicts = flows.load_legal(spark, base, f"{tmp_path}/land", f"{tmp_path}/parsed")
    assert conflicts.count() == 1
    assert final.count() == 6 * base.count()
    assert final.columns == [n for n, _, _ in land.LAND_RULES if n not in ("CountyName", "StateName")]
    assert {(r.Section, r.Lot, r.RangeOrBlock) for r in final.collect()} == {(s, l, "7E") for s in "345" for l in "12"}
    assert final.where("Section like '%,%' or Lot like '%,%'").isEmpty()


def test_children_flow(small, tmp_path):
    parties, refs = flows.load_children(
        small.src_lease.drop("deed_vol", "deed_pg").join(small.lease_deed, "lease_id"), small.grantor, small.grantee,
        small.tgt_record, small.export_log, small.state_lookup, RUN, Run(RUN.at, "PRIOR", "me"), f"{tmp_path}/c")
    assert parties.count() > 0 and refs.count() > 0


def test_image_flow_works_off_its_list(small, tmp_path):
    work = small.image_work.withColumns({
        "source_path": F.lit(""), "destination_path": F.lit(""), "page_count": F.lit(0),
        "file_size": F.lit(0).cast("bigint"), "status": F.lit("")})
    out = flows.image_pass(work, small.object_manifest, small.export_log, small.image_registry, "b", "LEGACY", RUN,
                           f"{tmp_path}/i")
    done = out["results"].where("status = 'processed'").count()
    assert out["results"].count() == work.count() and out["next_work"].count() == work.count() - done
    assert out["registry_rows"].where("pageCount = 0").isEmpty()
