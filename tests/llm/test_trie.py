"""The prefix trie against one built node by node."""

import hashlib
import random
from collections import defaultdict

import pytest

from recordferry.llm import queries, trie

TURNS = "conv_id bigint, turn int, role string, text string"


def brute(rows, graft=False):
    """Nodes as tuples of the query's columns, from tuples (conv_id, turn, role, text)."""
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            mark = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            original[conv].append(((turn is not None, turn or 0, mark), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(own)] for c, own in original.items()}
    if graft:
        head = {c: queries.head_turns(c) for c in turns}
        turns = {c: turns.get(c - c % 5, [])[:head[c]] + own[head[c]:] for c, own in turns.items()}
    members = defaultdict(list)
    for conv, own in turns.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(conv)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        parents = {p[:-1] for p in members if p}
        ends = sorted(c for c in convs if len(turns[c]) == len(prefix))
        out.append((min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs),
                    sum(len(p) == len(prefix) + 1 for p in below), sum(p not in parents for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(turns, *graft):
    out = trie.build(trie.paths(turns, *graft))
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.e)
                   for r in out.withColumn("e", trie.ends_text(out.ends)).collect()), key=str)


def random_turns(n, seed, words=3, longest=6):
    rng = random.Random(seed)
    return [(c, t, rng.choice("ua"), rng.choice("xyzäö"[:words]) * rng.randint(0, 2)) for c in range(n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_any_block_size(spark, rows, monkeypatch, block):
    data = random_turns(150, 5)
    want = brute(data)
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "IDS", 2)
    assert nodes(rows(TURNS, *data)) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # each range in a task of its own
    try:
        assert nodes(rows(TURNS, *data)) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_grafted_query(spark, rows, tmp_path):
    data = [r for r in random_turns(60, 6, words=1, longest=12) if r[0] % 15]  # some families' givers are absent
    rows(TURNS, *data).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((tuple(r) for r in queries.op12_trie(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(data, graft=True)


def test_nulls_ties_repeats_and_other_columns(rows):
    data = [(1, None, None, None), (1, None, "u", "ä"), (1, 0, "u", "b"), (1, 0, "u", "a"), (1, 0, "u", "a"), (2, 5, "", ""),
            (2, 6, "u", "ä"), (None, 0, "u", "x"), (-7, 0, "u", "y"), (-3, 0, None, ""), (9, 0, "u", "z" * 100_000)]
    frame = rows(TURNS, *data).selectExpr("*", "'k' as path", "'k' as mark", "1 as depth", "2 as family", "3 as leaf")
    assert nodes(frame) == brute(data)
    assert nodes(frame.limit(0)) == []


def test_hot_prefix_one_path_and_a_long_conversation(rows):
    hot = [(c, t, "u", "same") for c in range(300) for t in range(3)] + [(c, 3, "u", str(c)) for c in range(0, 300, 2)]
    assert nodes(rows(TURNS, *hot)) == brute(hot)
    long = [(c, t, "u", "w") for c in (1, 2) for t in range(3000)] + [(2, 3000, "u", "tail")]
    got = nodes(rows(TURNS, *long))
    assert len(got) == 3002 and sorted(g[1] for g in got) == list(range(3002))
    assert max(g[6] for g in got) == 3000 and {g[3] for g in got} == {1, 2} and all(g[5] == 1 for g in got)
