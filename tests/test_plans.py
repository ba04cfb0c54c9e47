"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from recordferry.functions.text import on_day
from recordferry.operators import quality
from recordferry.plans import queries as Q
from recordferry.sources.bindings import Bindings

SF_DIR = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pushed_filters(df) -> str:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", text))


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_no_cross_product_in_any_plan(spark, name, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        text = plan_text(Q.QUERIES[name](Bindings(spark, SF_DIR)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if broadcast == "-1":
        assert "BroadcastExchange" not in text
    if name not in ("map_rows_hook", "object_folders"):  # user's code; listing of folders
        assert not re.search("Python|Pandas", text)


def test_profile_is_one_scan_in_generated_code(spark, small):
    text = plan_text(quality.null_profile(spark.read.parquet(f"{SF_DIR}/lineitem.parquet")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_scans_read_only_needed_columns(small):
    text = plan_text(Q.QUERIES["image_resolve"](small))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "o_totalprice" not in plan_text(Q.QUERIES["match_exact"](small))


def test_filters_reach_the_scan(spark):
    records = spark.read.parquet(f"{SF_DIR}/orders.parquet").selectExpr(
        "cast(o_orderkey as string) record_id", "o_orderdate file_date", "o_orderstatus status_id", "1 county_id")
    kept = records.where(Q.normalize.TargetFilter(min_file_date="2001-01-01").condition())
    assert "GreaterThanOrEqual(o_orderdate" in pushed_filters(kept)


def test_day_filter_is_a_range_on_the_scan(spark):
    df = spark.read.parquet(f"{SF_DIR}/orders.parquet").where(on_day(F.col("o_orderdate"), "1997-03-05"))
    pushed = pushed_filters(df)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_splitting_lists_needs_no_shuffle(small):
    assert "Exchange" not in plan_text(Q.QUERIES["land_explode"](small))


def test_sample_is_trimmed_before_the_shuffle(small):
    text = plan_text(Q.QUERIES["stratified_sample"](small))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_uniqueness_is_an_aggregate_not_a_window(small):
    assert "Window" not in plan_text(Q.QUERIES["match_substring"](small))


def test_numbers_are_indexed_once_and_at_key_level(small):
    """One index per side, one count of grams for both; the rarest gram is chosen without a shuffle."""
    report = Q.QUERIES["match_report"](small)
    assert len(re.findall(r"Generate explode\(sequence\(-1", plan_text(report))) == 2
    index = Q.match.distinct_keys(Q.match._target_side(Q.target_slice(small)), "target_key", Q.match.PLACE)
    assert index.columns == ["day", "county_key", "target_key", "copies"]
    rarest = Q.match.with_rarest_gram(index, "target_key", F.array(*[F.lit(1)] * Q.match.GRAM_BUCKETS))
    assert plan_text(rarest).count("Exchange") == plan_text(index).count("Exchange")


def test_report_sort_does_not_repeat_the_join(small):
    for name in ("missing_in_target", "match_report"):
        text = plan_text(Q.QUERIES[name](small))
        assert re.search(r"REPARTITION_BY_COL", text), name


def test_parties_join_the_batch_once(small):
    text = plan_text(Q.QUERIES["parties"](small))
    assert len(re.findall(r"FileScan[^\n]*customer", text)) == 1 and text.count("FileScan") <= 8


def test_staged_tables_are_joined_without_a_shuffle(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(Q.QUERIES["missing_relations_staged"](small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 4 and text.count("Exchange") == 1  # the final counts
    Q.sinks.drop_bucketed(spark)


def test_losses_are_tested_where_a_cast_can_lose(small):
    from recordferry.operators import stage
    assert [stage.can_lose(stage.T.StructType.fromDDL(f"x {a}")["x"].dataType, b) for a, b in (
        ("int", "int"), ("int", "bigint"), ("bigint", "int"), ("double", "string"), ("string", "int"), ("decimal(9,6)", "decimal(5,4)"),
        ("date", "timestamp_ntz"), ("double", "int"))] == [False, False, True, False, True, True, False, True]
