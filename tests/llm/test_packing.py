"""Packing: an exact round trip against the tokenizer itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from recordferry.llm import packing
from recordferry.llm.queries import tokenizer_path

TEXTS = {1: "Hello world, it's here.  Two  spaces\n\n\tand tabs ", 2: "", 3: None, 4: "word " * 3000, 5: "Ünïcödé 12345 ½ ² ٣ 中文字 😀😀 a\u00a0b\u2028c",
         6: "x" * 5000, 7: "a <|endoftext|> b", 8: "don't I'LL we've  \r\n \x0b ' 's ''s !!'s", 9: "   ", 10: "\u0301combining e\u0301 \u200d zwj"}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_encoder_equals_the_tokenizer(tokenizer, spark):
    encoders = [packing.Encoder(tokenizer_path()), packing.Encoder(tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))]
    texts = list(TEXTS.values()) + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in texts:
        for encoder in encoders:
            assert encoder.encode(text or "") + bytes(4) == ids_of(tokenizer, text).tobytes()


def test_long_runs_of_white_space(tokenizer):
    encoder = packing.Encoder(tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))
    for text in ("a" + " " * 2_000_000 + "b", "\n" * 2_000_000):
        assert encoder.encode(text) + bytes(4) == ids_of(tokenizer, text).tobytes()
    assert encoder.encode("a b") + bytes(4) == ids_of(tokenizer, "a b").tobytes()


def check(rows, docs, tokenizer):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for key, text in docs.items():
        ids, at = ids_of(tokenizer, text), 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    groups = defaultdict(int)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == members[0].window <= 1024 and at & at - 1 == 0  # full, so without padding
        groups[members[0].step_group, members[0].window] += at
    assert len({g for g, _ in groups}) == len(groups) and max(groups.values()) <= packing.STEP_TOKENS
    return groups


def test_round_trip(documents, tokenizer):
    check(packing.pack(documents(*TEXTS.items()).repartition(3), tokenizer_path()).collect(), TEXTS, tokenizer)


def test_round_trip_of_a_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    groups = check(packing.pack(docs, tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken")).collect(), {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    for tier in packing.TIERS:
        assert sorted(v for (_, w), v in groups.items() if w == tier)[1:-1].count(packing.STEP_TOKENS) >= len([1 for _, w in groups if w == tier]) - 3


def test_small_buffers_pack_all():
    packer = packing.Packer(0, (16, 8, 4), 32, 5)
    for key in range(200):
        packer.add(key, bytes(4 * (key * 7 % 23 + 1)))
    packer.finish()
    assert sum(r[2] for r in packer.rows) == sum(k * 7 % 23 + 1 for k in range(200)) and packer.held == 0


def test_null_id_extra_columns_and_empty(documents):
    docs = documents((None, "a b")).selectExpr("*", "1 as start", "2 as length")
    assert [r.doc_id for r in packing.pack(docs, tokenizer_path()).collect()] == [None] * 2
    assert packing.pack(documents().limit(0), tokenizer_path()).count() == 0
