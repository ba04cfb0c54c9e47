"""Staging, changes, children, images and quality on small rows."""

import datetime as dt
import os
import random
from decimal import Decimal
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.errors import PySparkValueError
from pyspark.sql import functions as F

from recordferry.operators import changes, images, land, match, parties, prior_refs, quality, relational, stage
from recordferry.operators.stage import Run
from recordferry.plans import queries as Q
from recordferry.sources import sinks, tables

RUN = Run(at="2025-07-17 08:09:10", tag="BATCH(2)", user="me")


def values(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


# ---- staging ---------------------------------------------------------------------------

def test_record_table_shape():
    names = [name for name, _, _ in stage.RECORD_RULES]
    assert len(names) == len(set(names)) == 94
    assert names[:3] == ["recordID", "sourceFilePath", "storageFilePath"]
    assert names[-2:] == ["Consideration", "InstrumentTypeFullId"]
    assert len(stage.LOG_RULES) == 12 and len(land.LAND_RULES) == 39


def test_staged_types_are_the_declared_ones(small):
    staged = stage.stage_records(Q.candidates(small), RUN)
    assert [(n, k) for n, k, _ in stage.RECORD_RULES] == staged.dtypes


def test_narrowing_losses_are_reported(small):
    source = Q.candidates(small, "reference")
    assert stage.narrowing_losses(source, RUN).isEmpty()
    wide = source.withColumn("royalty", F.lit(12.5).cast("decimal(9,6)"))
    losses = stage.narrowing_losses(wide, RUN)
    assert losses.count() == source.count()
    assert values(losses.select("table_name", "column_name", "value").distinct(), "table_name", "column_name", "value") == [
        ("records", "RoyaltyAmount", "12.500000")]
    big = source.limit(3).withColumns({"extension_bonus": F.lit(9e12), "is_blm": F.lit("maybe")})
    assert {(r.column_name, r.value) for r in stage.narrowing_losses(big, RUN).collect()} == {
        ("ExtensionBonus", "9.0E12"), ("extensionBLM", "maybe")}


def test_status_code_is_added_once(rows):
    statuses = rows("status_id int, data_entry_description string", (4, "keyed"))
    once = stage.register_status(statuses, 90, "mapped", "unused")
    assert values(once, "status_id") == [(4,), (90,)]
    assert values(stage.register_status(once, 90, "mapped", "unused"), "status_id") == [(4,), (90,)]


# ---- changes ---------------------------------------------------------------------------

def test_update_from_keeps_rows_and_takes_nulls(rows):
    base = rows("id string, a string, b int", ("x", "old", 1), ("x", "old", 2), ("y", "old", 3), (None, "old", 4))
    new = rows("id string, v string", ("x", "m"), ("x", "k"), ("z", "q"), (None, "n"))
    assert values(changes.update_from(base, new, "id", {"a": "v"}), "b", "a") == [(1, "k"), (2, "k"), (3, "old"), (4, "old")]
    assert values(changes.update_conflicts(new, "id", "v"), "id", "candidates") == [("x", 2)]
    empty = rows("id string, v string", ("y", None))
    assert values(changes.update_from(base.where("id = 'y'"), empty, "id", {"a": "v"}), "a") == [(None,)]


def test_fill_touches_only_untouched_rows(rows):
    log = rows("record_id string, lease_id bigint, zip_name string, created_by string, modified_by string",
               ("a", None, "z", None, None), ("b", 9, "z", None, None), ("c", None, "z", "me", None), ("d", None, "z", None, None))
    choices = rows("target_record_id string, source_lease_id bigint", ("a", 1), ("b", 2), ("c", 3))
    got = changes.fill_log_leases(log, choices, "T", RUN.at)
    assert {r.record_id: (r.lease_id, r.zip_name, r.created_by, r.modified_ts, r.modified_by) for r in got.collect()} == {
        "a": (1, "T", "T", dt.datetime(2025, 7, 17, 8, 9, 10), "T"), "b": (9, "z", None, None, None),
        "c": (None, "z", "me", None, None), "d": (None, "z", None, None, None)}
    wide = changes.fill_log_leases(log.withColumns({"sentToAudit": F.lit(7), "modified_ts": F.lit("2020-01-01").cast("timestamp_ntz")}),
                                   choices, "T", RUN.at)
    assert wide.columns == [*log.columns, "sentToAudit", "modified_ts"] and wide.where("sentToAudit = 7").count() == 4
    assert values(wide.where("year(modified_ts) = 2020"), "record_id") == [("b",), ("c",), ("d",)]


def test_delete_keeps_unknown_rows(rows):
    df = rows("s string", (None,), ("",), ("1,2",))
    assert {r.s for r in changes.delete_where(df, F.col("s").contains(",")).collect()} == {None, ""}


def test_append_fills_missing_columns_and_rejects_unknown(rows):
    table = rows("a int, b string", (1, "x"))
    assert {(r.a, r.b) for r in changes.append_rows(table, rows("a bigint", (2,))).collect()} == {(1, "x"), (2, None)}
    with pytest.raises(ValueError):
        changes.append_rows(table, rows("c int", (2,)))


def test_status_move_and_preview_agree(bindings):
    args = (bindings.tgt_record, bindings.export_log, "BATCH", "1997-07-01", (24, 25))
    preview = changes.rekeyed(*args)
    moved = changes.move_status(*args, new_status=77)
    assert moved.count() == bindings.tgt_record.count()
    assert moved.where("status_id = 77").count() == preview.count() > 0


def test_half_hour_of_the_shift(rows):
    records = rows("record_id string, keyed string, outsource_id int, status_id int", ("a", "2025-06-30 13:45:00", 24, 90)) \
        .withColumn("keyed_ts", F.col("keyed").cast("timestamp_ntz"))
    log = rows("record_id string, batch_tag string", ("a", "BATCH(2)"), ("a", "BATCH(2)"))
    for minutes, hits in ((630, 1), (600, 0)):
        assert changes.rekeyed(records, log, "batch", "2025-07-01", (24,), minutes).count() == hits


# ---- relational -------------------------------------------------------------------------

def test_not_in_rules(rows):
    left = rows("k int", (1,), (2,), (None,))
    assert values(relational.not_in(left, rows("k int", (2,)), "k"), "k") == [(1,)]
    assert values(relational.not_in(left, rows("k int", (2,), (None,)), "k"), "k") == []
    assert relational.not_in(left, rows("k int", (2,)).where("k = 3"), "k").count() == 3


def test_explode_keeps_every_token(rows):
    df = rows("id int, section string, lot string, other string", (1, "1, 2,,3", "7,8 ,9", "o"), (2, None, "", "o"))
    got = land.explode_legal(df, ("section", "lot"))
    assert values(got.where("id = 1"), "section", "lot") == sorted((s, l) for s in ("1", "2", "", "3") for l in "789")
    assert [(r.section, r.lot) for r in got.where("id = 2").collect()] == [(None, "")]
    lost = land.explode_legal(df, ("section", "lot"), "reference", ("other",))
    assert {(r.id, r.other) for r in lost.collect()} == {(1, None), (2, "o")}


def test_exploded_ids_are_unique_even_for_equal_tokens(rows):
    df = rows("landDescriptionID string, section string, lot string", ("p", "7,7", "1,1"))
    loaded = land.load_land(land.explode_legal(df, ("section", "lot"), positions=True), columns=("section", "lot"), dropped=())
    assert loaded.select("landDescriptionID").distinct().count() == loaded.count() == 4


def test_case_blind_union_keeps_one_whole_row(rows):
    a = rows("id int, n string, c string", (1, "Smith", "x"), (1, "SMITH ", "X"), (1, None, "x"), (2, "Smith", "x"))
    got = relational.union_distinct(a, a, text_columns=("n", "c"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "SMITH ", "X"), (1, None, "x"), (2, "Smith", "x")], key=str)
    assert relational.union_distinct(a, a).count() == 4


# ---- children ---------------------------------------------------------------------------

def test_parties_of_a_batch(rows):
    leases = rows("lease_id bigint, grantor_id int, grantee_id int", (1, 10, 20), (2, 10, 21), (3, 10, 20))
    grantors = rows("grantor_id int, name string, address string, zip string, city string, state_abbr string",
                    (10, "Ann", " ", "1", "C", "tx"))
    grantees = rows("grantee_id int, name string, address string, zip string, city string, state_abbr string",
                    (20, "Bob", "A", None, "C", "zz"), (21, "  ", "A", "1", "C", "tx"))
    records = rows("record_id string, remarks string", ("R1", "batch(2)"), ("R2", "BATCH(2)"), ("R3", "keyed"))
    log = rows("record_id string, lease_id bigint", ("R1", 1), ("R1", 1), ("R2", 2), ("R3", 3), ("R2", None))
    states = rows("state_id int, state_abbr string", (48, "TX"))
    got = parties.parties(leases, grantors, grantees, records, log, states, RUN)
    assert sorted((r.recordID, r.recordType, r.gName, r.gAddress, r.StateID) for r in got.collect()) == [
        ("r1", "grantee", "Bob", "A", None), ("r1", "grantor", "Ann", None, 48), ("r2", "grantor", "Ann", None, 48)]


def test_prior_reference_parts(rows):
    leases = rows("lease_id bigint, deed_vol string, deed_pg string",
                  (1, " 12 ", "NULL"), (2, "  ", "3"), (3, None, "3"), (4, "5", "6"))
    records = rows("record_id string, remarks string", *[(f"r{i}", "BATCH(2)") for i in range(1, 5)])
    log = rows("record_id string, lease_id bigint", *[(f"r{i}", i) for i in (1, 1, 2, 3, 4)])
    got = prior_refs.prior_refs(leases, records, log, RUN, "BATCH(2)")
    assert sorted((r.recordID, r.drVolume, r.drPage) for r in got.collect()) == [("r1", "12", None), ("r4", "5", "6")]


def test_land_base_modes(small):
    one, two = Q.land_rows(small), Q.land_rows(small, "reference")
    assert one.columns == [n for n, _, _ in land.LAND_RULES] == two.columns


# ---- images -------------------------------------------------------------------------------

WORK = "lease_id bigint, record_id string, state_county string, package_id string"


def test_prefix_lookup_finds_longer_packages(rows):
    work = rows(WORK, (1, "ABCDEF", "tx/jack", "pkg10"), (2, "b", "tx/jack", "pkg100"), (3, "c", "tx/jack", None),
                (4, "d", "tx/jack", "pkg100/z"))
    manifest = rows("object_key string, size_bytes bigint, page_count int",
                    ("pkg100/b.pdf", 5, 1), ("pkg100/a.tif", 6, 2), ("pkg100/z/q.pdf", 7, 3))
    own = {r.lease_id: (r.source_path, r.status) for r in images.resolve(work, manifest, "b").collect()}
    assert own == {1: ("", "s3 query failed"), 2: ("pkg100/a.tif", "processed"), 3: ("", "s3 query failed"),
                   4: ("", "s3 query failed")}
    found = {r.lease_id: (r.source_path, r.destination_path) for r in images.resolve(work, manifest, "b", "reference").collect()}
    assert found == {1: ("pkg100/a.tif", "s3://b/tx/jack/abcd/abcdef.tif"), 2: ("pkg100/a.tif", "s3://b/tx/jack/b/b.tif"),
                     3: ("", ""), 4: ("pkg100/z/q.pdf", "s3://b/tx/jack/d/d.pdf")}


def test_failed_copies_come_back(rows):
    resolved = rows("record_id string, state_county string, source_path string, page_count int, file_size bigint, status string",
                    ("a", "s/c", "p/a.pdf", 1, 1, "processed"), ("b", "s/c", "p/b.pdf", 1, 1, "processed"),
                    ("c", "s/c", "", 0, 0, "s3 query failed"))
    registry = rows("record_id string, status string", ("a", "copied"), ("b", "error"))
    assert values(images.copy_plan(resolved, registry, "k", RUN), "recordID") == [("b",)]
    assert values(images.copy_plan(resolved, registry, "k", RUN, "reference"), "recordID") == []
    plan = images.copy_plan(resolved, registry.limit(0), "k", RUN)
    assert values(plan, "recordID", "status") == [("a", "planned"), ("b", "planned")]
    calls = rows("record_id string, http_status int", ("a", 500), ("a", 200), ("b", None), ("z", 200))
    after = images.copy_outcome(plan, calls, RUN)
    assert values(after, "recordID", "status") == [("a", "copied"), ("b", "error")]
    assert values(images.copy_outcome(plan, calls.where("record_id = 'a'"), RUN), "status") == [("copied",), ("planned",)]
    again = images.copy_plan(resolved, after.select(F.col("recordID").alias("record_id"), "status"), "k", RUN)
    assert values(again, "recordID") == [("b",)]


def test_delete_status_is_its_own(rows):
    cleanup = rows("record_id string, lease_id bigint, destination_path string",
                   ("a", 1, "s3://k/x/a.pdf"), ("b", 2, "k/x/b.pdf"), ("c", 3, "k/x/c.pdf"))
    outcomes = rows("record_id string, http_status int", ("a", 204), ("b", 500))
    got = images.delete_plan(cleanup, outcomes, "k", RUN)
    assert values(got, "recordID", "object_key", "status") == [
        ("a", "x/a.pdf", "deleted"), ("b", "x/b.pdf", "s3 query failed"), ("c", "x/c.pdf", "s3 query failed")]


def test_hook_turns_errors_into_statuses(small):
    def add(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["lease_id"] % 7 == 0).any():
            raise ValueError("unreadable")
        return batch.assign(checksum=batch["lease_id"] * 2)

    plan = Q.resolved_images(small)
    got = images.map_rows(plan, add, "checksum bigint")
    counts = {r.status: r["count"] for r in got.groupBy("status").count().collect()}
    failed = plan.where("lease_id % 7 = 0").count()
    assert counts == {"error: unreadable": failed, "processed": plan.count() - failed}
    assert got.where("status = 'processed' and checksum != lease_id * 2").isEmpty()


def test_hook_holds_its_row_promise(rows):
    plan = rows("id int, status string", *[(i, "") for i in range(10)])

    def drops(batch: pd.DataFrame) -> pd.DataFrame:
        out = batch.assign(price=pd.Series([Decimal("1.50")] * len(batch)), note="a,b")
        return out[out["id"] % 2 == 0]

    got = images.map_rows(plan.repartition(1), drops, "price decimal(10,2), note string").collect()
    assert {r.id: (r.price, r.status.split(",")[0]) for r in got} == {
        i: (Decimal("1.50"), "processed") if i % 2 == 0 else (None, "error: 0 rows") for i in range(10)}


def test_requeue_has_each_open_row_once(bindings):
    work = bindings.image_work.withColumns({
        "source_path": F.lit(""), "destination_path": F.lit(""), "page_count": F.lit(0),
        "file_size": F.lit(0).cast("bigint"), "status": F.lit("")})
    results = images.resolve(work, bindings.object_manifest, "b")
    again = images.requeue(work, results)
    assert again.count() == again.select("record_id").distinct().count() == results.where("status != 'processed'").count()


# ---- quality ------------------------------------------------------------------------------

def test_profile_measures_overlap_on_blanks_and_zeros(rows):
    df = rows("s string, n int, m int", (None, 0, 0), ("", 5, 0), ("x", None, 1))
    got = quality.null_profile(df, zero_is_missing=("n",)).first().asDict()
    assert got == {"s_count": 2, "s_null_count": 2, "n_count": 2, "n_null_count": 2, "m_count": 3, "m_null_count": 0}
    assert quality.null_profile(df, blank_tested=()).first()["s_null_count"] == 1


def test_profile_totals(small):
    df = small.src_lease
    profile, n = quality.null_profile(df).first().asDict(), df.count()
    blanks = {r.column_name: r.blank_count for r in quality.blank_counts(df, ("vol", "deed_vol", "deed_pg")).collect()}
    for column, blank in blanks.items():
        assert profile[f"{column}_count"] + profile[f"{column}_null_count"] == n + blank


def test_sample_is_capped_per_stratum_only(bindings):
    results = Q.resolved_images(bindings)
    got = {r.page_count: r["count"] for r in quality.stratified_sample(results, bindings.image_work.withColumn(
        "record_number", F.lit("n"))).groupBy("page_count").count().collect()}
    have = {r.page_count: r["count"] for r in results.where("page_count between 1 and 10").groupBy("page_count").count().collect()}
    assert got == {p: min(5, n) for p, n in have.items()}


def test_names_compare_without_case(rows):
    staged = rows("gName string", ("ANN",), ("Ann",), ("Zed",), (None,), ("zed ",))
    valid = rows("name string", ("ann ",), ("",))
    got = quality.name_coverage(staged, valid).collect()
    assert [(r.gName, r.occurrences) for r in got] == [("Zed", 2), (None, 1)]


def test_reference_blank_test_skips_nulls(rows):
    df = rows("BriefLegal string, a string, b string", ("t", "", ""), ("u", None, ""), ("v", "x", None))
    assert values(quality.unparsed_legal(df, ("a", "b")), "BriefLegal") == [("t",), ("u",)]
    assert values(quality.unparsed_legal(df, ("a", "b"), "reference"), "BriefLegal") == [("t",)]
    assert values(quality.parsed_legal(df, ("a", "b")), "BriefLegal") == [("v",)]


# ---- sources and sinks ----------------------------------------------------------------------

def test_declared_tables_are_checked(rows, tmp_path):
    good = rows(WORK, (1, "r", "s/c", "p")).withColumns({
        "source_path": F.lit(""), "destination_path": F.lit(""), "page_count": F.lit(0), "file_size": F.lit(0),
        "status": F.lit("")})
    sinks.write_table(good, f"{tmp_path}/a", sinks.IMAGE_RESULT_SCHEMA, unique=["lease_id"])
    for bad in (good.withColumn("status", F.lit(None).cast("string")), good.drop("status"), good.unionByName(good)):
        with pytest.raises(PySparkValueError):
            sinks.write_table(bad, f"{tmp_path}/b", sinks.IMAGE_RESULT_SCHEMA, unique=["lease_id"])


def test_failing_load_leaves_the_old_table(spark, rows, tmp_path):
    old = sinks.write_table(rows("a int", (1,), (2,)), f"{tmp_path}/t", unique=["a"])
    with pytest.raises(PySparkValueError):
        sinks.write_table(rows("a int", (3,), (3,)), f"{tmp_path}/t", unique=["a"])
    assert values(spark.read.parquet(old), "a") == [(1,), (2,)]
    new = sinks.write_table(rows("a int", (4,)), f"{tmp_path}/t", unique=["a"])
    assert values(spark.read.parquet(new), "a") == [(4,)] and values(spark.read.parquet(old), "a") == [(1,), (2,)]
    sinks.remove_folder(spark, new)
    assert not os.path.exists(new) and os.path.exists(old)


def test_csv_text_survives(spark, rows, tmp_path):
    data = [("a", 'say "hi", ok', "back\\slash"), ("b", "", None), ("c", "1, 2", "it's")]
    df = rows("id string, x string, y string", *data)
    sinks.write_csv(df, f"{tmp_path}/csv")
    got = tables.csv_table(spark, f"{tmp_path}/csv", "id string, x string, y string")
    assert sorted(map(tuple, got.collect())) == [data[0], ("b", None, None), data[2]]


def test_csv_keeps_hard_text(spark, rows, tmp_path):
    rng = random.Random(4)
    texts = ["line1\nline2", "  outer  ", "tail\\", 'q"', '\\"', '"\\', "\\n", "\\\\n\r\n", "a,b", "\t", "\\0x", "a\0b", "ends \\\\"]
    texts += ["".join(rng.choices('\\"\n\r\0n0r, a', k=rng.randint(1, 12))) + "x" for _ in range(300)]
    df = rows("id int, x string, y string", *[(i, t, t[::-1]) for i, t in enumerate(texts)])
    sinks.write_csv(df, f"{tmp_path}/csv")
    got = tables.csv_table(spark, f"{tmp_path}/csv", "id int, x string, y string")
    assert {r.id: r.x for r in got.collect()} == dict(enumerate(texts))


def test_broken_csv_stops(spark, tmp_path):
    (tmp_path / "foreign.csv").write_text('id,x\n1,"line1\nline2"\n')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        tables.csv_table(spark, f"{tmp_path}/foreign.csv", "id int, x string", encoded=False).collect()
    whole = tables.csv_table(spark, f"{tmp_path}/foreign.csv", "id int, x string", multi_line=True, encoded=False)
    assert values(whole, "id", "x") == [(1, "line1\nline2")]


def test_append_table_and_promotion(spark, rows, tmp_path):
    table = sinks.write_table(rows("a int, b string", (1, "x")), f"{tmp_path}/t")
    sinks.append_table(rows("a int, c int", (2, 3)), table, ["a"])
    counts = sinks.promote_table(spark, table, f"{tmp_path}/live").first()
    assert (counts.source_rows, counts.promoted_rows) == (2, 2)
    with pytest.raises(PySparkValueError):
        sinks.append_table(rows("z int", (2,)), table, ["z"])


def test_object_listing(spark, tmp_path):
    (tmp_path / "store" / "pkg1").mkdir(parents=True)
    (tmp_path / "store" / "pkg1" / "a.pdf").write_bytes(b"12345")
    got = tables.object_listing(spark, f"{tmp_path}/store", "*.pdf").collect()
    assert [(r.object_key, r.size_bytes) for r in got] == [("pkg1/a.pdf", 5)]
    for odd in ("pkg1/store/a.pdf", "pkg 2/b+c.pdf", "pkg3/d%20e.pdf", "store/store/f.pdf"):
        place = tmp_path / "store" / odd
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(b"1")
    keys = {r.object_key for r in tables.object_listing(spark, f"{tmp_path}/store/").collect()}
    assert keys == {"pkg1/a.pdf", "pkg1/store/a.pdf", "pkg 2/b+c.pdf", "pkg3/d%20e.pdf", "store/store/f.pdf"}


def test_object_inventory(spark, rows, tmp_path):
    rows("name string, bytes bigint, pages int", ("p/a.pdf", 5, 2)).write.parquet(f"{tmp_path}/inventory")
    got = tables.object_inventory(spark, f"{tmp_path}/inventory", "name", "bytes", "pages")
    assert values(got, "object_key", "size_bytes", "page_count") == [("p/a.pdf", 5, 2)]
    assert tables.object_inventory(spark, f"{tmp_path}/inventory", "name", "bytes").first().page_count is None


def test_files_in_are_files_carried_and_left(bindings):
    source = Q.full_source(bindings)
    named = bindings.lease_file.where("filename is not null")
    twice = named.unionByName(named.where("lease_id % 80 = 1"))
    left = Q.normalize.extra_files(source, twice, Q.SHARE)
    assert source.where("original_file_name is not null").count() + left.count() == twice.count()
    assert left.where("record_id is null").isEmpty() and not left.isEmpty()


def test_counties_that_share_a_target_county(rows):
    leases = rows("lease_id bigint, county_id int", (1, 10), (2, 11), (3, 12), (4, 99))
    crosswalk = rows("src_county_id int, tgt_county_id int, county_name string, state_id int", (10, 7, "A", 1), (11, 7, "B", 1), (12, 8, "C", 2), (13, 9, "D", 2))
    records = rows("record_id string, county_id int", ("r1", 7), ("r2", 7), ("r4", 9))
    log = rows("record_id string, lease_id bigint", ("r1", 1), ("r2", 2), ("r4", 4))
    got = quality.county_reconcile(leases, records, log, crosswalk)
    assert {tuple(r) for r in got.collect()} == {("C", 2, 1, 0, 1), ("D", 2, 0, 1, -1), (None, None, 1, 0, 1)}


def test_crosswalk_with_repeated_counties_multiplies_nothing(rows):
    records = rows("record_id string, record_number string, file_date date, volume string, page string, county_id int", ("R", "1", None, "1", "2", 5))
    counties = rows("county_id int, county_name string", (5, "Eddy"))
    crosswalk = rows("src_county_id int, tgt_county_id int", (5, 1), (5, 2))
    assert Q.normalize.normalize_target(records, counties, crosswalk).count() == 1


def test_settings_reach_the_callers_session(spark):
    spark.conf.set("spark.sql.codegen.maxFields", "100")
    Q.queries()["map_term"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.codegen.maxFields") == "400"


def test_padded_text_is_trimmed(rows):
    assert tables.fixed_width_text(rows("a string, n int", ("x   ", 1))).first().a == "x"


def session_with(settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


def test_shared_folder_is_the_clusters():
    cluster = session_with({"spark.checkpoint.dir": "hdfs://shared/ckpt/", "spark.master": "yarn"})
    assert sinks.shared_folder(cluster).startswith("hdfs://shared/ckpt/")
    with pytest.raises(PySparkValueError):
        sinks.shared_folder(session_with({"spark.master": "yarn"}))


def test_rerun_with_own_log_stages_nothing(small):
    source = Q.full_source(small)
    fresh = match.stage_candidates(source, small.export_log, small.county_xwalk)
    log = small.export_log.unionByName(fresh.select(
        F.col("generated_record_id").alias("record_id"), "lease_id", F.lit("BATCH(3)").alias("batch_tag")))
    assert fresh.count() > 0 and match.stage_candidates(source, log, small.county_xwalk).isEmpty()
