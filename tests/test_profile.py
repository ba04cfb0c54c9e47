"""Mergeable profiles, samples by hash and the listing of folders."""

import os

from pyspark.sql import functions as F

from recordferry.operators import profile, quality
from recordferry.sources import tables


def test_merged_states_equal_the_profile_of_all_rows(small):
    df = small.tgt_record
    halves = [profile.state(df.where(F.col("outsource_id") % 2 == i), zero_is_missing=("outsource_id",)) for i in (0, 1)]
    got = {r.column_name: r for r in profile.counts(profile.merged(*halves)).collect()}
    want = quality.null_profile(df, ("outsource_id",)).first()
    assert set(got) == set(df.columns)
    for c, r in got.items():
        assert (r.value_count, r.null_count) == (want[f"{c}_count"], want[f"{c}_null_count"]), c
        assert abs(r.distinct_estimate - df.select(c).distinct().count()) <= 0.05 * r.distinct_estimate + 1, c


def test_drift_finds_new_values_and_columns(rows):
    before = profile.state(rows("a int, b string, gone int", *[(i, "x", 1) for i in range(100)]))
    after = profile.state(rows("a int, b string, more int", *[(i + 50, None if i % 2 else " ", 1) for i in range(100)]))
    got = {r.column_name: r for r in profile.drift(before, after).collect()}
    assert abs(got["a"].new_values - 50) <= 2 and got["a"].missing_change == 0
    assert (got["b"].missing_before, got["b"].missing_after) == (0, 1)
    assert got["gone"].rows_after is None and got["more"].rows_before is None
    assert profile.counts(profile.state(rows("a int"))).first().value_count == 0


def test_samples_of_parts_make_the_sample_of_the_whole(small):
    df = small.tgt_record
    def draw(d):
        return quality.hash_sample(d, ["outsource_id"], ["record_id"], 4, "s")
    whole = {(r.record_id, r.rn) for r in draw(df).collect()}
    parts = [draw(df.where(F.col("status_id") == s)).drop("rn") for s in (4, 90)]
    assert {(r.record_id, r.rn) for r in draw(parts[0].unionByName(parts[1])).collect()} == whole
    assert {r.record_id for r in quality.hash_sample(df, ["outsource_id"], ["record_id"], 4, "t").collect()} != {i for i, _ in whole}


def test_walk_equals_the_tree(spark, tmp_path):
    want = {}
    for i in range(30):
        path = tmp_path / "tree" / f"a{i % 3}" / f"b {i % 5}" / ("c%20" if i % 2 else ".") / f"f{i}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" * i)
        want[os.path.relpath(path, tmp_path / "tree")] = i
    (tmp_path / "tree" / "empty" / "folder").mkdir(parents=True)
    for root in (str(tmp_path / "tree"), f"file://{tmp_path}/tree/"):
        got = {r.object_key: r.size_bytes for r in tables.object_walk(spark, root).collect()}
        assert got == want
