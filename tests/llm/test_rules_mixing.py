"""The rule ledger and the mix, on small rows."""

from recordferry.llm import mixing, rules

LONG = " ".join(f"word{i}" for i in range(60))


def test_measures_by_hand():
    assert rules.measure("a b a b a b") == (6, 6, 0, 1, 0, 6, 0, 6)
    assert rules.measure("x\n\n \nx\ny x") == (4, 4, 0, 3, 1, 0, 0, 4)
    assert rules.measure("Ä#\u00a0B|<>") == (1, 7, 4, 1, 0, 0, 1, 1)
    assert rules.measure("a b c d a b c") [5] == 6 and rules.measure(None) == rules.measure("") == (0,) * 8
    assert rules.measure("z z z z")[5] == 4


def test_bits_policies_and_ablation(documents):
    docs = documents((1, LONG), (2, "few"), (3, None), (4, LONG.upper()), (5, LONG.replace(" ", " # ")), (6, "la " * 80), (None, LONG))
    entries = rules.ledger(docs)
    bits = {r.doc.doc_id: r.failed for r in entries.collect()}
    assert bits == {1: 0, 2: rules.mask("few_words"), 3: rules.mask("few_words"), 4: rules.mask("capitals"),
                    5: rules.mask("symbols"), 6: rules.mask("repeated_words"), None: 0}
    assert {r[0]: tuple(r)[1:] for r in rules.ablation(entries).collect()} == {
        "few_words": (2, 2), "capitals": (1, 1), "symbols": (1, 1), "repeated_words": (1, 1), "duplicate_lines": (0, 0)}
    kept = rules.keep_clean(docs.selectExpr("*", "1 as failed", "2 as doc", "3 as n_words"))
    assert {r.doc_id for r in kept.collect()} == {1, None} and kept.columns[-3:] == ["failed", "doc", "n_words"]
    assert rules.keep_clean(docs.limit(0)).count() == 0


def filled(sizes):
    """Targets by raising the level in small exact steps of capping."""
    places = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(places)}
    capped = set()
    while True:
        free = [s for s in sizes if s not in capped]
        if not free:
            return {s: 3.0 * sizes[s] for s in sizes}
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if 3 * sizes[s] <= level * weight[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else level * weight[s] for s in sizes}
        capped |= over


def test_targets_are_capped_and_shared_again(documents):
    counts = {"a": 500, "b": 2, "c": 5, None: 3, "é": 40, "z": 60, "": 7}
    docs = documents(*[(i, "w " * 10, s) for s, n in counts.items() for i in range(n)])
    rows = mixing.mix(docs).collect()
    want = filled({s: 10 * n for s, n in counts.items()})
    for r in rows:
        assert r.source_size == 10 * counts[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.copies <= 3
    for s in counts:
        assert abs(sum(r.copies * r.size for r in rows if r.source == s) - want[s]) <= 10
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_every_document_of_a_capped_source_comes_three_times(documents):
    docs = documents((1, "a b", "small"), (2, None, "small"), (None, "c", "small"), *[(10 + i, "w " * 50, "large") for i in range(20)])
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).filter("source = 'small'").collect()}
    assert copies == {1: 3, 2: 3, None: 3}
    out = mixing.emit(docs.selectExpr("*", "1 as copies", "2 as rank"))
    assert out.filter("source = 'small'").count() == 9 and out.columns[-2:] == ["copies", "rank"]


def test_no_words_and_no_rows(documents):
    assert {(r.target, r.copies) for r in mixing.mix(documents((1, ""), (2, None))).collect()} == {(0.0, 0)}
    assert mixing.mix(documents().limit(0)).count() == 0
