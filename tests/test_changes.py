"""Counted steps, publishing, changes by range, change sets, bitmaps and rejected lines."""

import os
from collections import Counter

import pytest
from pyspark.errors import PySparkValueError
from pyspark.sql import functions as F

from recordferry.operators import bitmaps, counted, diff, normalize
from recordferry.plans import queries as Q
from recordferry.sources import sinks, tables


# ---- counted steps ---------------------------------------------------------------------

def test_a_lookup_that_repeats_a_key_is_a_fan_out(small):
    twice = small.issued_ids.unionByName(small.issued_ids.limit(1))
    steps = counted.Steps()
    counted.run(normalize.normalize_source(small.src_lease_terms, twice, Q.counties(small), small.lease_file, share_root=Q.SHARE, steps=steps))
    with pytest.raises(counted.FanOut) as found:
        steps.check()
    assert (found.value.step, found.value.of, found.value.rows - found.value.of_rows) == ("with issued id", "leases", 1)
    assert [r.kept for r in steps.report(small.spark).orderBy("step").collect()] == [None, False, True, True]


def test_counted_job_gives_the_same_rows(small):
    steps = counted.Steps()
    args = (small.src_lease_terms, small.issued_ids, Q.counties(small), small.lease_file)
    seen = normalize.normalize_source(*args, share_root=Q.SHARE, steps=steps)
    assert seen.exceptAll(normalize.normalize_source(*args, share_root=Q.SHARE)).isEmpty()
    with pytest.raises(ValueError):
        steps.see(small.orders, "leases")
    with pytest.raises(ValueError):
        steps.see(small.orders, "new", "unknown", keeps=True)


def test_append_counts_what_it_writes(rows, tmp_path, spark):
    path = sinks.write_table(rows("a int, b string", (1, "x")), f"{tmp_path}/t")
    assert sinks.append_table(rows("a int, c int", (2, 3), (4, 5), (None, 6)), path, ["a"]) == 3
    assert spark.read.parquet(path).count() == 4
    assert sinks.append_table(rows("a int"), path, ["a"]) == 0


# ---- publishing ------------------------------------------------------------------------

def test_promotion_swaps_whole_versions(rows, tmp_path, spark):
    live = f"{tmp_path}/live"
    assert sinks.current(spark, live) is None
    with pytest.raises(PySparkValueError):
        sinks.read_published(spark, live)
    for n in (3, 5, 0):
        work = sinks.write_table(rows("a int", *[(i,) for i in range(n)]), f"{tmp_path}/work")
        report = sinks.promote_table(spark, work, live).first()
        assert (report.source_rows, report.promoted_rows) == (n, n)
        assert sorted(r.a for r in sinks.read_published(spark, live).collect()) == list(range(n))


def test_a_copy_that_fails_or_differs_leaves_the_live_table(rows, tmp_path, spark, monkeypatch):
    live = f"{tmp_path}/live"
    sinks.promote_table(spark, sinks.write_table(rows("a int", (1,)), f"{tmp_path}/work"), live)
    before = sinks.current(spark, live)
    new = sinks.write_table(rows("a int", (1,), (2,)), f"{tmp_path}/work")
    monkeypatch.setattr(sinks, "content_of", lambda df: (2, 7))  # as many rows, other content
    with pytest.raises(PySparkValueError, match="not whole"):
        sinks.promote_table(spark, new, live)
    monkeypatch.undo()
    monkeypatch.setattr(sinks, "write_table", lambda *a, **k: (_ for _ in ()).throw(OSError("disk full")))
    with pytest.raises(OSError):
        sinks.promote_table(spark, new, live)
    monkeypatch.undo()
    assert sinks.current(spark, live) == before and sinks.read_published(spark, live).count() == 1
    with pytest.raises(PySparkValueError, match="does not lie"):
        sinks.publish(spark, live, f"{tmp_path}/elsewhere")


def test_content_tells_nulls_copies_and_columns_apart(rows):
    frames = [[(None, 1)], [(1, None)], [(1, 1)], [(1, 1), (1, 1)], [], [(0, 0)]]
    assert len({counted.content_of(rows("a int, b int", *f)) for f in frames}) == len(frames)
    assert counted.content_of(rows("a int", (1,), (2,))) == counted.content_of(rows("a int", (2,), (1,)))


# ---- ranges of the key -------------------------------------------------------------------

def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_untouched_ranges_keep_their_files(rows, tmp_path, spark):
    data = [(f"k{i}", i) for i in range(200)] + [(None, -1), ("k7", 700)]
    path = f"{tmp_path}/t"
    sinks.write_parted(rows("k string, v int", *data), path, "k", bits=5)
    before = files(path)
    keys = rows("k string", ("k7",), ("k8",), ("new",))
    hit = F.col("k").isin("k7", "k8")
    parts = sinks.rewrite_parts(spark, path, keys, lambda t: t.withColumn("v", F.when(hit, 0).otherwise(F.col("v"))).unionByName(
        rows("k string, v int", ("new", 5))), f"{tmp_path}/w1")
    after = files(path)
    assert 1 <= len(parts) <= 3
    changed = {f.split("/")[0] for f in before.keys() ^ after.keys()}
    assert changed == {f"key_part={p}" for p in parts} and all(after[f] == before[f] for f in before.keys() & after.keys())
    want = Counter((k, 0 if k in ("k7", "k8") else v) for k, v in data) + Counter([("new", 5)])
    assert Counter(tuple(r) for r in sinks.read_parted(spark, path).collect()) == want
    # a second change finds key and ranges in the schema; ranges that become empty go
    gone = sinks.read_parted(spark, path).select("k").distinct()
    sinks.rewrite_parts(spark, path, gone, lambda t: t.where("k is null"), f"{tmp_path}/w2")
    assert [tuple(r) for r in sinks.read_parted(spark, path).collect()] == [(None, -1)]
    assert len({f.split("/")[0] for f in files(path)}) == 1


def test_a_change_reads_its_ranges_only_and_may_not_leave_them(rows, tmp_path, spark):
    path = f"{tmp_path}/t"
    sinks.write_parted(rows("k bigint, v int", *[(i, i) for i in range(100)]), path, "k", bits=4)
    read = []

    def change(t):
        read.append(t.count())
        return t

    assert sinks.rewrite_parts(spark, path, rows("k bigint"), change, f"{tmp_path}/w") == [] and not read
    sinks.rewrite_parts(spark, path, rows("k int", (5,)), change, f"{tmp_path}/w")
    assert 0 < read[0] < 40
    before = files(path)
    with pytest.raises(PySparkValueError, match="other ranges"):
        sinks.rewrite_parts(spark, path, rows("k bigint", (5,)), lambda t: t.withColumn("k", F.col("k") + 1), f"{tmp_path}/w")
    assert files(path) == before


# ---- change sets -------------------------------------------------------------------------

def changes_of(df):
    return Counter((r.k, r.change, r.column, r.before, r.after, r.copies) for r in df.collect())


def test_change_set(rows):
    schema = "k string, a int, b string"
    same = [("s", 1, "x"), ("s", 1, "x"), (None, 9, None)]
    before = rows(schema, *same, ("u", 1, "x"), ("d", 2, None), ("m", 1, "p"), ("m", 2, "q"), ("c", 5, "z"), ("c", 5, "z"), ("n", None, "x"))
    after = rows(schema, *same, ("u", 3, None), ("i", 4, "y"), ("m", 1, "p"), ("m", 3, "q"), ("m", 4, "r"), ("c", 5, "z"), ("n", 0, "x"), (None, 8, "new"))
    got = changes_of(diff.change_set(before, after.select("b", "k", "a"), "k"))
    assert got == Counter({
        ("u", "updated", "a", "1", "3", 1): 1, ("u", "updated", "b", "x", None, 1): 1, ("n", "updated", "a", None, "0", 1): 1,
        ("d", "deleted", None, '{"k":"d","a":2}', None, 1): 1, ("i", "inserted", None, None, '{"k":"i","a":4,"b":"y"}', 1): 1,
        ("m", "deleted", None, '{"k":"m","a":2,"b":"q"}', None, 1): 1, ("m", "inserted", None, None, '{"k":"m","a":3,"b":"q"}', 1): 1,
        ("m", "inserted", None, None, '{"k":"m","a":4,"b":"r"}', 1): 1, ("c", "deleted", None, '{"k":"c","a":5,"b":"z"}', None, 1): 1,
        (None, "inserted", None, None, '{"a":8,"b":"new"}', 1): 1})
    assert diff.change_set(before, before, "k").isEmpty()
    with pytest.raises(ValueError):
        diff.change_set(before, after.drop("b"), "k")


def test_dry_run_equals_the_preview(small):
    moved = {r.record_id for r in Q.QUERIES["status_preview"](small).where("status_id != 4").collect()}
    shown = Q.QUERIES["status_move_diff"](small).collect()
    assert {r.record_id for r in shown} == moved and len(shown) == len(moved) and {r.column for r in shown} == {"status_id"}


# ---- bitmaps -----------------------------------------------------------------------------

def test_bitmaps_of_days_merge_to_the_whole(rows):
    data = [("a", d, i) for d in range(4) for i in (0, 1, 32767, 32768, -1, -32768, -40000, 10**9, d, 2 * d)] + [("b", 0, None), ("b", 1, 5)]
    df = rows("g string, d int, id bigint", *data)
    days = [bitmaps.state(df.where(F.col("d") == d), ["g"], "id") for d in range(4)]
    together = days[0].unionByName(days[1]).unionByName(days[2]).unionByName(days[3])
    got = {r.g: r.n for r in bitmaps.counted(bitmaps.merged(together, ["g"]), ["g"], "n").collect()}
    assert got == {"a": len({i for g, _, i in data if g == "a"}), "b": 1}
    assert bitmaps.distinct_count(df.limit(0), ["g"], "id", "n").isEmpty()


def test_counts_without_expand_or_a_second_shuffle_of_ids(small):
    from test_plans import plan_text
    for name in ("target_counts", "county_reconcile"):
        assert "Expand" not in plan_text(Q.QUERIES[name](small)), name
    text = plan_text(bitmaps.distinct_count(small.src_lease, ["county_id"], "lease_id", "n"))
    assert text.count("Exchange") == 2 and "partial_bitmap_construct_agg" in text


# ---- rejected lines ----------------------------------------------------------------------

def test_accepted_and_rejected_are_all_lines(spark, tmp_path):
    lines = ["id,n,name", "a,1,x", "b,two,x", "c,3", "d,4,x,more", 'e,5,"q, r"', "", "f,,", "g,99999999999,x", '"h,7,x']
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    checked = sinks.staged(tables.csv_checked(spark, str(tmp_path / "f.csv"), "id string, n int, name string"), str(tmp_path / "work"))
    good = sorted((r.id, r.n, r.name) for r in tables.accepted(checked).collect())
    bad = tables.rejected(checked).collect()
    assert good == [("a", 1, "x"), ("e", 5, "q, r"), ("f", None, None)]
    assert sorted(r.line for r in bad) == sorted(["b,two,x", "c,3", "d,4,x,more", "g,99999999999,x", '"h,7,x'])
    assert all(r.file.endswith("f.csv") for r in bad)
