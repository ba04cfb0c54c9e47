"""Quality score, LM scoring and neighbour search against plain Python, brute force and held-out labels."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordferry.llm import ann, quality, queries, scoring


def test_held_out_quality(spark):
    out = queries.op1_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = out.filter("held_out").select("quality", "predicted", "score").collect()
    assert len(rows) > 50 and np.mean([r.quality == r.predicted for r in rows]) > .97
    assert all(0 <= r.score <= 1 for r in rows)


def test_scores_of_odd_rows(documents, rows):
    docs = documents((1, "good words in here"), (2, "BAD BAD BAD BAD ###"), (3, ""), (4, None), (None, "x"))
    labels = rows("doc_id bigint, label int", (1, 1), (2, 0), (None, 1), (3, None))
    model = quality.train(docs, labels)
    got = {r.doc_id: (r.score, r.predicted) for r in quality.score(docs, model).collect()}
    assert got[1][1] == 1 and got[2][1] == 0 and got[3] == got[4] and len(got) == 5
    one = quality.score(docs, quality.train(docs, labels.filter("label = 1"))).collect()
    assert {(r.score, r.predicted) for r in one} == {(1.0, 1)}
    assert quality.score(docs.limit(0), quality.train(docs, labels.limit(0))).count() == 0


def test_repeated_rows_train_once(documents, rows):
    once = [(1, "good words in here"), (2, "BAD BAD BAD BAD ###"), (3, "more of good words"), (4, "BAD ### and words")]
    labels = rows("doc_id bigint, label int", (1, 1), (2, 0), (3, 1), (4, 0))
    one = quality.train(documents(*once), labels)
    many = quality.train(documents(*once, *[once[0]] * 50, *[once[3]] * 30), labels)
    assert np.allclose(one["weights"], many["weights"], atol=1e-12) and one["at"] == many["at"]


def brute_losses(docs, target, least):
    c = {"b": Counter(), "t": Counter()}
    p = {"b": Counter(), "t": Counter()}
    for name, texts in (("b", docs), ("t", target)):
        for t in texts:
            w = (t or "").split()
            c[name].update(w)
            p[name].update(zip(w, w[1:]))
    vocabulary = {w for w in c["b"] | c["t"] if c["b"][w] + c["t"][w] >= least}
    pairs = {q for q in p["b"] | p["t"] if set(q) <= vocabulary and p["b"][q] + p["t"][q] >= least}

    def loss(name, text):
        total, words = sum(c[name].values()), text.split()
        known = sum(c[name][w] for w in vocabulary)
        single = lambda w: ((c[name][w] if w in vocabulary else total - known) + 1) / (total + len(vocabulary) + 1)
        out = -math.log(single(words[0]))
        for v, w in zip(words, words[1:]):
            if v in vocabulary:
                n = p[name][v, w] if (v, w) in pairs else 0
                after = sum(p[name][q] for q in pairs if q[0] == v)
                out -= math.log((n + scoring.STRENGTH * single(w)) / (after + scoring.STRENGTH))
            else:
                out -= math.log(single(w))
        return out / len(words)
    return loss


def test_losses_equal_brute_force(spark, documents):
    texts = {1: "a b a b c d", 2: "c d c d e", 3: "", 4: None, 5: "z", 6: "a b q r a b a b", None: "d d d"}
    target = ["c d e c d", "c d", None]
    docs = documents(*texts.items()).selectExpr("*", "1 as n_tokens", "2 as gram")
    got = {r.doc_id: r for r in scoring.score(docs, spark.createDataFrame([(t,) for t in target], "text string")).collect()}
    loss = brute_losses(texts.values(), target, 2)
    assert got.keys() == texts.keys()
    for key, text in texts.items():
        if text:
            assert abs(got[key].target_loss - loss("t", text)) < 1e-9 and abs(got[key].background_loss - loss("b", text)) < 1e-9
            assert got[key].n_tokens == len(text.split())
        else:
            assert got[key].difference is None and got[key].n_tokens == 0
    assert got[2].difference < got[1].difference
    assert scoring.score(docs.limit(0), spark.createDataFrame([], "text string")).count() == 0
    empty = scoring.score(docs, spark.createDataFrame([], "text string")).collect()
    assert len(empty) == len(texts)


def test_every_target_gram_is_in_the_model_of_a_large_background(documents, spark, monkeypatch):
    """A million and a half other tokens change no target gram to 'unknown'; texts fall into several chunks."""
    monkeypatch.setattr(scoring, "CHUNK", 1 << 18)
    filler = ["the of and in " * 8000] * 50
    texts = dict(enumerate([*filler, "rare phrase of words", "words of phrase rare", "rare rare once", "of the rare phrase"]))
    target = ["rare phrase of words here", "only once"]
    got = {r.doc_id: r for r in scoring.score(documents(*texts.items()), spark.createDataFrame([(t,) for t in target], "text string")).collect()}
    words, pairs = Counter(), Counter()
    for name in (*texts.values(), *target):
        words.update(name.split())
        pairs.update(zip(name.split(), name.split()[1:]))
    wanted = {w for t in target for w in t.split()} | {w for w, n in words.items() if n >= 2}
    bigrams = {q for t in target for q in zip(t.split(), t.split()[1:])} | {q for q, n in pairs.items() if n >= 2}
    aim, heads, c, size = Counter(w for t in target for w in t.split()), Counter(), Counter(), len(wanted)
    for t in target:
        c.update(zip(t.split(), t.split()[1:]))
    for q in bigrams:
        heads[q[0]] += c[q]
    for key in (50, 51, 53):
        w = texts[key].split()
        p = [(aim[x] + 1) / (7 + size + 1) for x in w]
        loss = -math.log(p[0]) - sum(math.log((c[q] + scoring.STRENGTH * p[i + 1]) / (heads[q[0]] + scoring.STRENGTH)) for i, q in enumerate(zip(w, w[1:])))
        assert abs(got[key].target_loss - loss / len(w)) < 1e-9
    assert got[50].target_loss < got[51].target_loss and len(got) == len(texts)


def nearest(rows, k=10):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], float)
    out = {}
    for q, v in zip(ids, vectors):
        if q % 100 == 0:
            far = np.sqrt(((vectors - v) ** 2).sum(1))
            out[int(q)] = [(int(ids[i]), far[i]) for i in np.lexsort((ids, far)) if ids[i] != q][:k]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_index(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = nearest(rows)
    got = {}
    for r in queries.op6_neighbours(spark, f"/root/testdata/{sf}").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= .95


def test_several_shards_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(size=8).tolist()) for i in range(600)] + [(1000 + i, [1.0] * 8) for i in range(40)]
    odd = [(700, None), (800, [0.0] * 8), (900, [1.0, None] + [0.0] * 6), (901, [float("nan")] * 8), (902, [float("inf")] * 8), (None, [1.0] * 8), (1100, [1.0, 2.0]),
           (1200, [1.0, 2.5]), (1000, [1.0] * 8)]
    frame = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("vector", F.lit(2))
    vectors = ann.valid(frame)
    wanted = vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "vector").distinct()
    got = {}
    for r in ann.search(ann.index(vectors, shard_rows=100), wanted).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    want = {q: [(i, round(float(s), 9)) for i, s in v] for q, v in nearest(data).items()}
    assert got.pop(1100) == [(1200, .5)] and got.pop(1200) == [(1100, .5)]
    assert got[1000] == want[1000] == [(1000 + i, 0.0) for i in range(1, 11)]
    assert got.keys() == want.keys() and np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= .95
    assert ann.search(ann.index(vectors.limit(0)), wanted.limit(0)).count() == 0


def test_query_over_repeated_rows_and_ids(spark, tmp_path):
    """Rows that are there three times are one; of one id with two vectors the least vector counts."""
    rng = random.Random(12)
    data = [(i, [rng.gauss(0, 1) for _ in range(6)], 0) for i in range(260)]
    data += [data[100], data[100], data[101], (200, [-9.0] * 6, 0), (7, [9.0] * 6, 0), (None, [1.0] * 6, 0), (300, None, 0), (400, [0.0] * 6, 0)]
    spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op6_neighbours(spark, str(tmp_path)).collect()
    stored = {}
    for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect():
        if r.vec_id is not None and r.embedding and any(r.embedding):
            stored[r.vec_id] = min(stored.get(r.vec_id, list(r.embedding)), list(r.embedding))
    assert {r.query_id for r in got} == {0, 100, 200}
    for q in (0, 100, 200):
        want = sorted((math.dist(stored[q], v), i) for i, v in stored.items() if i != q)[:10]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and len({m[1] for m in mine}) == 10
        assert [m[1] for m in mine] == [i for _, i in want]


def test_documents_in_other_partitions_stop_the_job(documents, spark, monkeypatch):
    """As many grams, other words: the count alone would not tell."""
    monkeypatch.setattr(scoring, "CHUNK", 64)
    docs = documents(*[(i, f"a{i} b{i} c{i}") for i in range(40)])
    target = spark.createDataFrame([("a1 b1",)], "text string")
    want = {r.doc_id: r.difference for r in scoring.score(docs, target).collect()}
    assert len(want) == 40
    grams = scoring.Grams(["a b c", "d e"], 3)
    other = scoring.Grams(["a b x", "d e"], 3)
    assert len(grams.gram) == len(other.gram) and grams.checksums() != other.checksums()
    checksums = scoring.Grams.checksums
    monkeypatch.setattr(scoring.Grams, "checksums", lambda self: [(b, b"other") for b, _ in checksums(self)])
    with pytest.raises(Exception, match="same partitions"):
        scoring.score(docs, target).collect()


def plain_features(text):
    """The features of a text, word by word."""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]
    out = [0.0] * (quality.FEATURES + quality.HASHED)
    if not words:
        return out
    n, letters = len(words), [c for c in text if c.isascii() and c.isalpha()]
    lines = [line for line in text.split("\n") if re.search("[^ \t\n\x0b\x0c\r]", line)]
    threes = [tuple(words[i:i + 3]) for i in range(n - 2)]
    repeated = {i + k for i, t in enumerate(threes) if threes.count(t) > 1 for k in range(3)}
    data = [w.encode() for w in words]
    out[:quality.FEATURES] = [
        1, math.log1p(n) / 10, sum(map(len, words)) / n / 10, min(sum(c in "#*$%&|<>" for c in text) / n, 3),
        (len(lines) - len(set(lines))) / max(len(lines), 1), len(repeated) / n, sum(c.isupper() for c in letters) / max(len(letters), 1),
        len(set(words)) / n, max(words.count(w) for w in set(words)) / n, min(sum(c in ".!?" for c in text) / n, 2),
        len(letters) / len(text.encode()), sum(a == b for a, b in zip(words, words[1:])) / n]
    for w in dict.fromkeys(data):
        h = int.from_bytes(w[:3], "little") * 0x9E3779B1 >> 7
        out[quality.FEATURES + h % quality.HASHED] += (1 if h >> 13 & 1 else -1) * (data.count(w) / n)
    return out


def test_fit_and_scores_equal_plain_gradient_steps(documents, rows):
    """The same pairs, features from plain Python, and the loss brought down by small steps instead of Newton's."""
    rng = random.Random(21)
    good = [" ".join(rng.choices(["the", "of", "and", "House", "river", "walks", "quietly."], k=rng.randint(20, 60))) for _ in range(60)]
    bad = [" ".join(rng.choices(["BUY", "###", "now", "now", "now", "$$", "click!"], k=rng.randint(5, 60))) for _ in range(50)]
    texts = {i: t for i, t in enumerate(good + bad + ["", None, "one\ntwo\none\ntwo"])}
    labels = {i: int(i < 60) if rng.random() > .15 else int(i >= 60) for i in range(110)}  # some are wrong, so the classes overlap
    frame = documents(*texts.items())
    pairs = 400
    model = quality.train(frame, rows("doc_id bigint, label int", *labels.items()), pairs=pairs)
    got = {r.doc_id: r.score for r in quality.score(frame.selectExpr("*", "9 as score", "'x' as predicted"), model).collect()}

    x = {i: np.array(plain_features(t)) for i, t in texts.items()}
    order = sorted(labels, key=lambda i: (labels[i], *reversed(x[i])))
    ones, zeros = ([x[i] for i in order if labels[i] == k] for k in (1, 0))
    draw = np.random.default_rng(1)
    first, second = draw.integers(len(ones), size=pairs), draw.integers(len(zeros), size=pairs)
    d = np.array([ones[a] - zeros[b] for a, b in zip(first, second)])
    w = np.zeros(d.shape[1])
    for _ in range(60_000):
        w += 2.0 * (d.T @ (1 / (1 + np.exp(d @ w))) / pairs - 1e-3 * w)
    ranks = sorted(float(x[i] @ w) for i in labels)
    place = sum(v == 0 for v in labels.values()) / len(labels) * (len(ranks) - 1)
    at = (ranks[math.floor(place)] + ranks[math.ceil(place)]) / 2
    for i, t in texts.items():
        want = 1 / (1 + math.exp(-(float(x[i] @ w) - at + math.log(.3 / .7))))
        assert abs(got[i] - want) < 1e-4, (i, got[i], want)
