"""Token counts against the library, text by text, and what the cache does."""

import public_tokenizers
import pytest

from recordferry.llm import queries, tokens

SF_DIR = "/root/testdata/sf0.001"
WORDS = tokens.Vocabulary(public_tokenizers.path("word_bpe_49k.json"), drops_space=True, folds_case=True)
HARD = [None, "", " ", "a", "A  b\tc\r\nd", "a b c d", "<|endoftext|>", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>", "<|endoftext|> " * 3,
        "it's IT'S o'clock 're", "H̱ ẖ ẖ", "İstanbul ΑΣ ας", "K Å Å", "a\x1cb\x85c\xa0d e​f", " ̈x ́", "日本語テキスト 한국어 각",
        "x" * 5000, "1234 567,8.9!?", "👍🏽👨‍👩‍👧", "ﬁ ﬀ ß ẞ", "᠎﻿", "don’t", "A" * 70 + " " + "A" * 70]


def library(texts):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(WORDS.path)
    return [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]


def run(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()), key=str)


def want(rows, limit=2048):
    counts = library([t for _, t in rows])
    return sorted(((i, len((t or "").encode()), n, n > limit) for (i, t), n in zip(rows, counts)), key=str)


def test_query_equals_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert run(queries.op13_tokens(spark, SF_DIR)) == want(rows)


def test_hard_texts_null_and_repeated_ids(documents, tmp_path):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "a b"), (None, "A  B"), (3, "A"), (3, "A"), (-1, "word " * 60000)]
    docs = documents(*rows).selectExpr("*", "'x' as digest", "1 as n_tokens", "2 as rows", "3 as join_key")
    assert run(tokens.count_tokens(docs, WORDS, f"{tmp_path}/c", limit=10)) == want(rows, 10)


def test_only_misses_are_encoded_and_appended(documents, spark, tmp_path, monkeypatch):
    cache, asked = f"{tmp_path}/c", []
    encode = tokens.encode_missing
    monkeypatch.setattr(tokens, "encode_missing", lambda t, v: asked.append(sorted(r.text for r in t.collect())) or encode(t, v))
    first = documents((1, "One  two"), (2, "one two"), (3, "other"), (4, None))
    assert len(run(tokens.count_tokens(first, WORDS, cache))) == 4
    assert [len(a) for a in asked] == [3]
    tokens.count_tokens(first, WORDS, cache).collect()
    assert len(asked) == 1  # all known
    more = documents((5, "OTHER"), (6, "new words"), (7, "new words"))
    assert run(tokens.count_tokens(more, WORDS, cache)) == want([(5, "OTHER"), (6, "new words"), (7, "new words")])
    assert asked[1:] == [["new words"]]
    monkeypatch.setattr(tokens, "FEW", 0)  # the other way to leave known texts out
    again = [(8, "one two"), (9, "newer words"), (10, "newer  words")]
    assert run(tokens.count_tokens(documents(*again), WORDS, cache)) == want(again)
    assert len(asked[2]) == 1 and tokens.cached(spark, cache, WORDS.version()).count() == 5


def test_entries_appended_twice_and_other_versions(documents, spark, tmp_path):
    cache, rows = f"{tmp_path}/c", [(1, "a b"), (2, "c")]
    tokens.count_tokens(documents(*rows), WORDS, cache).collect()
    entries = spark.read.parquet(f"{cache}/version={WORDS.version()}")
    entries.collect()
    spark.createDataFrame(entries.collect(), entries.schema).write.mode("append").parquet(f"{cache}/version={WORDS.version()}")
    assert run(tokens.count_tokens(documents(*rows), WORDS, cache)) == want(rows)
    raw = tokens.Vocabulary(WORDS.path)
    assert raw.version() != WORDS.version()
    assert run(tokens.count_tokens(documents(*rows), raw, cache)) == want(rows)
    pieces = tokens.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.path)
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(documents((1, "A  b"), (2, "a b"), (3, None)), pieces, cache).collect()}
    assert got == {1: len(model.encode("A  b")), 2: len(model.encode("a b")), 3: 0}


def test_empty_table(documents, tmp_path):
    out = tokens.count_tokens(documents((1, "a")).limit(0), WORDS, f"{tmp_path}/c")
    assert out.collect() == [] and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


@pytest.mark.parametrize("memo", [1, 3, 400_000])
def test_memo_stays_bounded(monkeypatch, memo):
    monkeypatch.setattr(tokens, "MEMO", memo)
    counter = tokens.TokenCounter(WORDS)
    assert [counter.count(t or "") for t in HARD] == library(HARD) and len(counter.memo) <= memo
