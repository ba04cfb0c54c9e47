"""What op3_scoring sends between chunks and buckets: its size, its exactness, and losses over many of both."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_models import brute_losses

from recordferry.llm import scoring


def zipf_texts(seed, texts, words, vocabulary):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rng.choices(names, weights, k=words)) for _ in range(texts)]


@pytest.mark.parametrize("buckets, most", [(1, 9.2), (64, 12), (700, 13.5)])
def test_blocks_cost_few_bytes_a_gram_and_lose_nothing(buckets, most):
    """Plain hashes of grams and heads, as sent before, took 9.7, 14.1 and 15.9 bytes a gram here."""
    grams = scoring.Grams(zipf_texts(4, 400, 500, 30_000), buckets)
    blocks = list(grams.blocks(7))
    assert len(blocks) == buckets and {b[1] for b in blocks} == {7}
    assert sum(len(part) for b in blocks for part in b[2:]) < most * len(grams.gram)
    back = [scoring.unspaced(b[4]) for b in blocks]
    assert np.array_equal(np.concatenate(back), grams.gram)
    assert np.array_equal(np.concatenate([scoring.heads_of(g, b[2], b[3]) for g, b in zip(back, blocks)]), grams.head)
    assert np.array_equal(np.concatenate([scoring.unpacked(b[5]) for b in blocks]), grams.n)


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [1], [255, 256], [0, 1 << 62, 3], list(range(70_000)), [1] * 9,
                                    [0] * 1000, [0] * 1001, [3, 1 << 40] * 500, [3, 1 << 40] * 501])
def test_packed_numbers_come_back(values):
    for noise in (0, 1, 5):
        assert scoring.unpacked(scoring.packed(np.array(values, np.int64), noise)).tolist() == values


@pytest.mark.parametrize("values", [[], [0], [(1 << 64) - 1], [0, (1 << 64) - 1], [5, 5, 6], [1 << 63, (1 << 63) + 1, (1 << 64) - 2]])
def test_spaced_hashes_come_back(values):
    assert scoring.unspaced(scoring.spaced(np.array(values, np.uint64))).tolist() == values


def test_losses_over_many_chunks_and_buckets_equal_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(scoring, "CHUNK", 400)
    target = [*zipf_texts(6, 5, 30, 200), None, "only here"]
    texts = dict(enumerate([*zipf_texts(5, 60, 40, 120), "", None, "the " * 300, *(f"the x{i} the" for i in range(50)), *target]))
    got = {r.doc_id: r for r in scoring.score(documents(*texts.items()), spark.createDataFrame([(t,) for t in target], "text string")).collect()}
    loss = brute_losses(texts.values(), target, 2)  # every gram of the target is in a document too, so twice in all
    assert got.keys() == texts.keys()
    for key, text in texts.items():
        if text:
            assert abs(got[key].target_loss - loss("t", text)) < 1e-9 and abs(got[key].background_loss - loss("b", text)) < 1e-9
        else:
            assert got[key].difference is None and got[key].n_tokens == 0


def test_each_bucket_has_a_partition_of_its_own(spark, documents):
    """Dealt by the hash of the bucket, as before, some partitions got several buckets and others none."""
    docs = documents(*enumerate(zipf_texts(7, 40, 100, 3000))).select("doc_id", "text")
    answers = scoring.merged(scoring.counted(docs, 16), 16)
    rows = answers.filter(F.col("kind") == scoring.SUMS).select("key", F.spark_partition_id().alias("part")).collect()
    assert sorted((r.key, r.part) for r in rows) == [(i, i) for i in range(16)]
