"""Near-duplicate classes against all pairs of a small corpus."""

import random
from collections import Counter

import numpy as np
import pytest

from recordferry.llm import minhash


def bag(text, n=5):
    w = (text or "").split()
    return Counter(tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1 if w else 0)))


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(docs):
    label = {k: k for k in docs}
    bags = {k: bag(t) for k, t in docs.items()}
    for a in sorted(docs):
        for b in sorted(docs):
            if a < b and label[a] != label[b] and (bags[a] == bags[b] or similarity(bags[a], bags[b]) >= .8):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed):
    rng, docs = random.Random(seed), {}
    for group in range(12):
        base = words(rng, rng.choice((8, 40, 120, 400)))
        for _ in range(rng.choice((1, 2, 6))):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = "new%d" % rng.randrange(10**6)
            docs[rng.randrange(10**6)] = rng.choice((" ", "\n", "  ")).join(copy)
    chain = words(rng, 300)
    for step in range(8):  # neighbours are near, the ends are not
        docs[step] = " ".join(chain)
        chain = chain[6:] + words(rng, 6)
    docs |= {2000001: "", 2000002: None, 2000003: "one two", 2000004: "one  two", 2000005: "one two three four five",
             2000006: "la " * 500, 2000007: "la " * 450, 2000008: "la " * 200, 2000009: "one"}
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(documents, seed):
    docs = corpus(seed)
    rows = minhash.near_classes(documents(*docs.items())).collect()
    assert {r.doc: r.class_id for r in rows} == brute(docs) and len(rows) == len(docs)


def test_registers_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(1)
    elements = np.sort(rng.integers(2**63, size=300).astype(np.uint64))
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    m = 4096
    agree = (minhash.signature(elements, a, m) == minhash.signature(elements, b, m)).mean()
    assert abs(agree - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < .03
    part = slice(0, 150)
    agree = (minhash.signature(elements[part], a[part], m) == minhash.signature(elements, a, m)).mean()
    assert abs(agree - a[part].sum() / a.sum()) < .03


def test_one_row_of_each_class_stays(documents):
    base = words(random.Random(3), 100)
    near = " ".join(base[:-1] + ["other"])
    docs = documents((4, " ".join(base)), (2, near), (2, near), (9, "alone in here with more than five"), (None, "null id of its own kind"))
    out = minhash.one_per_class(docs.selectExpr("*", "1 as row", "2 as doc"))
    assert sorted((r.doc_id for r in out.collect()), key=str) == [2, 9, None] and out.columns[-2:] == ["row", "doc"]
    assert minhash.near_classes(documents().limit(0)).count() == 0


def test_rows_outside_the_main_component_are_compared():
    import pyarrow as pa

    def row(band, main, doc, text):
        signed = next(minhash.sign(iter([pa.RecordBatch.from_arrays([pa.array([doc]), pa.array([text])], names=["doc", "text"])]))).to_pylist()[0]
        return signed["bands"][band], 0, main, doc, doc, signed["sketch"], signed["bands"], text

    base = words(random.Random(1), 400, 10**6)
    same, near, other = " ".join(base), " ".join(base[:-3]), " ".join(words(random.Random(2), 50))
    rows = [row(0, False, 5, same), row(0, False, 6, near), row(0, True, 1, same), row(0, True, 2, same), row(1, True, 7, other)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=list("abcdefgh"))
    pairs = [tuple(r.values()) for b in minhash.across(iter([batch])) for r in b.to_pylist()]
    shared = rows[0][0] == rows[1][0]
    assert pairs == ([(5, 6)] if shared else []) + [(5, 1), (5, 2)]


def test_copies_around_an_original_that_is_not_the_least(documents):
    """Copies are near the original and not near each other, so every link goes through it."""
    rng = random.Random(9)
    base = words(rng, 300, 100000)
    docs = {500: " ".join(base)}
    for i in range(40):
        copy = list(base)
        for _ in range(5):
            copy[rng.randrange(300)] = f"e{rng.randrange(10**9)}"
        docs[i * 20] = " ".join(copy)
    docs[500] = " ".join(base)
    got = {r.doc: r.class_id for r in minhash.near_classes(documents(*docs.items())).collect()}
    assert got == brute(docs)


def test_rows_without_an_id_of_their_own_are_documents(documents):
    """Null and repeated ids with different texts: only rows with an earlier near copy go."""
    a, b, c = (" ".join(words(random.Random(seed), 60, 10**6)) for seed in (31, 32, 33))
    docs = documents((None, a), (None, b), (None, b), (7, c), (7, a), (7, "short"), (8, c))
    kept = minhash.one_per_class(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(None, a), (None, b), (7, c), (7, "short")], key=str)
    rows = sorted(tuple(r) for r in minhash.near_classes(docs).collect())
    null = minhash.NO_ID
    assert rows == sorted([(null, null, 2), (null, null, 2), (null, null, 2), (7, 7, 2), (7, null, 2), (7, 7, 1), (8, 7, 2)])
