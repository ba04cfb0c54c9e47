"""The registered queries against their SQL, and the pipeline stage by stage."""

import os

import pytest

import corpus_pipeline
from compare import difference, oracle_connection
from recordferry.llm import queries, rules, sql, suffix
from recordferry.llm.common import components, join_counted
from test_minhash import brute as near_brute
from test_suffix import brute as suffix_brute

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert difference(queries.queries()[name](spark, SF_DIR), oracle_connection(SF_DIR), sql.oracle_sql()[name]) is None


def test_each_query_covers_its_table(spark):
    for name, source, key in (("op1_quality", "documents", "doc_id"), ("op2_suffix", "documents", "doc_id"), ("op3_scoring", "documents", "doc_id"),
                              ("op8_urls", "pages", "page_id"), ("op10_minhash", "documents", "doc_id")):
        out = queries.queries()[name](spark, SF_DIR)
        have = spark.read.parquet(f"{SF_DIR}/{source}.parquet")
        assert sorted(r[0] for r in out.select(key).collect()) == sorted(r[0] for r in have.select(key).collect()), name


def test_near_classes_of_a_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in queries.op10_minhash(spark, SF_DIR).collect()}
    assert got == near_brute(docs)


def test_suffix_query_of_a_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op2_suffix(spark, SF_DIR).collect()}
    assert got == suffix_brute(docs)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    clean = stages["quality_rules"](spark, docs, SF_DIR)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in clean.collect()}
    masked = rules.POLICIES[rules.CURRENT]
    assert kept == {r.doc.doc_id for r in rules.ledger(docs).collect() if not r.failed & masked} and clean.columns == columns
    single = stages["near_dedup"](spark, clean, SF_DIR)
    label = near_brute({k: texts[k] for k in kept})
    assert {r.doc_id for r in single.collect()} == set(label.values()) and single.columns == columns
    cut = stages["suffix_dedup"](spark, single, SF_DIR)
    want = suffix_brute({k: texts[k] for k in set(label.values())})
    assert cut.columns == columns and cut.count() == len(want)
    for r in cut.collect():
        assert len(texts[r.doc_id].encode()) - len(r.text.encode()) >= want[r.doc_id][1]
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.columns[:3] == ["doc_id", "start", "length"] and {r.doc_id for r in packed.select("doc_id").collect()} <= set(want)


def test_components(rows):
    edges = rows("a bigint, b bigint", (5, 4), (4, 3), (3, 2), (9, 8), (7, 9), (2, 2), (5, 4), *[(100, 100 + i) for i in range(1, 30)], (120, 8))
    label = {r.node: r.label for r in components(edges).collect()}
    assert label == {**dict.fromkeys((2, 3, 4, 5), 2), **dict.fromkeys((7, 8, 9, *range(100, 130)), 7)}
    assert components(edges.limit(0)).count() == 0


def test_counted_join(rows):
    data = rows("k string, v int", *[("hot", i) for i in range(50)], ("cold", 1), (None, 2), ("none", 3))
    lookup = rows("k string, n bigint, x int", ("hot", 50, 7), ("cold", 1, 8))
    got = join_counted(data, lookup, "k", "n", 53, share=10)
    assert sorted(((r.k, r.x) for r in got.filter("v < 4").collect()), key=str) == sorted(
        [("hot", 7)] * 4 + [("cold", 8), (None, None), ("none", None)], key=str) and got.count() == 53
    assert suffix.original is not None and got.columns == ["k", "v", "n", "x"]
