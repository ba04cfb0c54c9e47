"""Suffix dedup against a byte-by-byte brute force."""

import hashlib
import random

import pytest

from recordferry.llm import suffix


def brute(texts):
    """{key: (n_bytes, n_removed, n_spans, sha256)}: windows are seen in (id, start) order."""
    seen, out = set(), {}
    for key, text in sorted(texts.items()):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - suffix.MIN + 1):
            window = data[s:s + suffix.MIN]
            if window in seen:
                gone[s:s + suffix.MIN] = b"\1" * suffix.MIN
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[key] = len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()
    return out


def text(rng, n, alphabet="abcdé \n"):
    return "".join(rng.choices(alphabet, k=n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [text(rng, n) for n in (90, 99, 100, 101, 130, 400)]
    docs = {}
    for i in range(60):
        parts = [text(rng, rng.randint(0, 150))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 2)
            parts += [p[cut:] if rng.random() < .5 else p, text(rng, rng.randint(0, 60))]
        docs[i] = "".join(parts)
    docs |= {100: docs[3], 101: docs[3], 102: "x" * 700, 103: "y" + "x" * 350, 104: "ab" * 260, 105: "", 106: None, 107: "k" * 99,
             108: passages[-1] * 3, 109: passages[-1][:-1] + "z", 110: docs[5][:60] + "!" + docs[5][60:], 111: "ab" * 50, 112: "ba" * 50}
    return docs


@pytest.mark.parametrize("seed, hot, bucket", [(1, 40, 50_000), (2, 2, 50_000), (3, 4, 50_000), (4, 40, 1), (5, 40, 3)])
def test_equals_brute_force(documents, monkeypatch, seed, hot, bucket):
    """Also with every anchor that a few documents share taken as hot, by the sample or by its size."""
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "BUCKET", bucket)
    monkeypatch.setattr(suffix, "SALTS", 3)
    docs = corpus(seed)
    rows = suffix.digests(documents(*docs.items())).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == brute(docs) and len(rows) == len(docs)


def test_blocks_of_a_long_text(documents):
    rng = random.Random(5)
    long = text(rng, 3 * suffix.BLOCK, "abcdefgh")
    docs = {1: long, 2: text(rng, 50) + long[suffix.BLOCK - 150:suffix.BLOCK + 150] + text(rng, 50), 3: long[1000:] + long[:500], 4: "z" * 70000}
    rows = suffix.digests(documents(*docs.items())).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == brute(docs)


def test_groups_name_the_earliest_occurrence(documents):
    rng = random.Random(6)
    p = text(rng, 120, "abcdefghijklmnop")
    docs = documents((5, "1" + p + "2"), (3, "34" + p), (9, p + "5"))
    rows = {tuple(r) for r in suffix.repeats(suffix.keyed(docs)).collect()}
    assert {r[0] for r in rows} == {5, 9} and {r[3] for r in rows} == {3}
    assert min(r[1] for r in rows if r[0] == 5) == 1 and max(r[2] for r in rows if r[0] == 5) == 121
    assert all(r[1] - r[4] == -1 for r in rows if r[0] == 5)


def test_nulls_repeated_rows_and_empty(documents, spark):
    p = text(random.Random(7), 150, "abcdefgh")
    docs = documents((None, p), (1, p), (1, p), (2, None))
    rows = sorted((tuple(r)[:4] for r in suffix.digests(docs).collect()), key=str)
    assert rows == [(1, 150, 150, 1), (1, 150, 150, 1), (2, 0, 0, 0), (None, 150, 0, 0)]
    assert suffix.digests(documents().limit(0)).count() == 0


def test_removal_keeps_rows_and_columns(documents):
    p = text(random.Random(8), 150, "abcdéfgh")
    out = suffix.remove_repeats(documents((1, p), (2, "é" + p + "tail"), (3, None)).selectExpr("*", "1 as doc", "2 as spans"))
    rows = {r.doc_id: r.text for r in out.collect()}
    assert rows == {1: p, 2: "étail", 3: None} and out.columns[-2:] == ["doc", "spans"]


def test_bucket_intervals():
    assert sorted(suffix.intervals([2, 1, 1])) == [(1, 0, 3), (2, 0, 1)]
    assert suffix.common(b"abcd", b"abxd") == 2 and suffix.common(b"ab", b"abc") == 2 and suffix.common(b"", b"a") == 0


def test_rows_without_an_id_of_their_own_are_documents(documents):
    """Null and repeated ids: each text is cut at its own offsets, and only what an earlier row holds."""
    rng = random.Random(11)
    p, q, r = (text(rng, 150, "abcdefgh") for _ in range(3))
    docs = documents((None, p), (None, q), (5, r), (5, "x" * 60 + p), (6, q + "tail" + r))
    out = {(d.doc_id, d.text) for d in suffix.remove_repeats(docs).collect()}
    assert out == {(None, p), (None, q), (5, r), (5, "x" * 60), (6, "tail")}
    found = sorted((tuple(d)[:4] for d in suffix.digests(docs).collect()), key=str)
    assert found == sorted([(None, 150, 0, 0), (None, 150, 0, 0), (5, 150, 0, 0), (5, 210, 150, 1), (6, 304, 300, 2)], key=str)
    twice = suffix.remove_repeats(documents((None, p), (None, p))).collect()
    assert sorted(d.text for d in twice) == ["", p]


def test_different_contexts_of_a_hot_anchor_are_not_held_in_one_bucket(documents, monkeypatch):
    """A short line in every document with other text around it; some share a whole window."""
    rng = random.Random(12)
    line, longer = text(rng, 80, "abcdefgh"), text(rng, 30, "abcdefgh")
    docs = {i: text(rng, 80) + line + (longer if i % 5 == 0 else "") + text(rng, 80) for i in range(60)}
    whole = suffix.bucket_repeats

    def scanned(batches):
        def counted(contexts, *rest):
            assert len(contexts) < 30, "a hot anchor's contexts met in one bucket"
            return whole(contexts, *rest)
        suffix.bucket_repeats = counted
        try:
            yield from original(batches)
        finally:
            suffix.bucket_repeats = whole

    original = suffix.find_repeats
    monkeypatch.setattr(suffix, "find_repeats", scanned)
    rows = suffix.digests(documents(*docs.items())).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == brute(docs)
    assert sum(r.n_removed for r in rows) > 0


def test_repeated_rows_are_kept_over_any_batches():
    import numpy as np
    import pyarrow as pa
    rng = random.Random(8)
    for _ in range(200):
        h = sorted(rng.choices(range(12), k=rng.randint(0, 30)))
        info = [suffix.HOT_BIT | i if rng.random() < .1 else i for i in range(len(h))]
        cuts = sorted(rng.choices(range(len(h) + 1), k=3))
        parts = [pa.record_batch({"hash": pa.array(h[a:b], pa.int64()), "doc": pa.array(h[a:b], pa.int64()), "info": pa.array(info[a:b], pa.int64())})
                 for a, b in zip([0, *cuts], [*cuts, len(h)])]
        suffix.BUCKET, before = 4, suffix.BUCKET
        try:
            got = sorted((r["hash"], r["info"]) for b in suffix.keep_repeated(iter(parts)) for r in b.to_pylist())
        finally:
            suffix.BUCKET = before
        want = sorted((x, i | suffix.HOT_BIT if h.count(x) > 4 else i) for x, i in zip(h, info) if h.count(x) > 1 or i >= suffix.HOT_BIT)
        assert got == want


def test_a_short_line_that_all_share_makes_no_windows(documents, monkeypatch):
    """80 equal bytes in different surroundings are no repeat, and cost six rows a record."""
    monkeypatch.setattr(suffix, "HOT", 2)
    rng = random.Random(9)
    line = text(rng, 80, "abcdefgh")
    rows = [(i, text(rng, 120, "ijklmnop") + line + text(rng, 120, "ijklmnop")) for i in range(150)]
    made = []
    real = suffix.stored
    monkeypatch.setattr(suffix, "stored", lambda df: made.append((df.columns[0], real(df))) or made[-1][1])
    assert suffix.repeats(suffix.keyed(documents(*rows))).count() == 0
    counts = {name: df.count() for name, df in made}
    assert counts["split"] > 0 and [df.count() for _, df in made if "window" in df.columns] == [0]
