"""Token counts through a digest cache.

The cache is a Parquet folder of (digest, n_tokens), one partition folder per tokenizer version.  The version is the digest of
the vocabulary file, the library with its version, and the rule below; the digest of a text is SHA-256 of its normalised content.
A run digests every text on the JVM, joins the different digests to the version's stored counts, encodes one text of each
digest that is missing, appends those counts, and joins all documents to their counts by digest.

Normalising only drops what cannot change the count.  Where the vocabulary drops white space (`Vocabulary.drops_space`), runs of
ASCII white space become one space and outer ones go.  Where it also lower-cases (`Vocabulary.folds_case`), texts of ASCII alone
are lower-cased, unless they hold a special token's first two characters: `<|ENDOFTEXT|>` is not the special `<|endoftext|>`.

Entries never change, so a lost task, a job that fails while it appends, or two runs that append the same misses leave a right
cache: repeated entries are equal and are read as one.  Null text is empty and counts 0; null or repeated ids and repeated rows
are documents of their own; other columns of the input do not matter; an empty table gives no rows and adds nothing.  A long
text is held whole by one task, its tokens are not: its words are counted one by one where white space parts them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.llm.common import join_counted, stored

LIMIT = 2048
#: Up to so many missing digests (32 bytes each) are broadcast, so that texts with a stored count are not shuffled.
FEW = 65536
#: Words whose counts a task remembers, and the longest remembered.
MEMO, MEMO_BYTES = 400_000, 64
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary file: `.json` for tokenizers, `.model` for sentencepiece."""

    path: str
    drops_space: bool = False
    folds_case: bool = False

    @property
    def library(self) -> str:
        return "sentencepiece" if self.path.endswith(".model") else "tokenizers"

    def version(self) -> str:
        """Hexadecimal digest of everything that a count depends on besides the text."""
        from importlib.metadata import version
        with open(self.path, "rb") as file:
            content = hashlib.sha256(file.read()).hexdigest()
        rule = f"{content} {self.library} {version(self.library)} {self.drops_space} {self.folds_case}"
        return hashlib.sha256(rule.encode()).hexdigest()

    def normalised(self, text: Column) -> Column:
        out = F.coalesce(text, F.lit(""))
        if self.drops_space:
            out = F.trim(F.regexp_replace(out, SPACE, " "))
        if self.folds_case:
            plain = (F.octet_length(out) == F.char_length(out)) & ~F.contains(out, F.lit("<|"))
            out = F.when(plain, F.lower(out)).otherwise(out)
        return out

    def digest(self, text: Column) -> Column:
        return F.unhex(F.sha2(self.normalised(text).cast("binary"), 256))


class TokenCounter:
    """Counts of whole texts as the library gives them, without begin, end or added special tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.drops_space, self.folds_case, self.memo = vocabulary.drops_space, vocabulary.folds_case, {}
        if vocabulary.library == "sentencepiece":
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=vocabulary.path)
            self.counts = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(vocabulary.path)
            model.no_truncation()
            model.no_padding()
            self.model = model
            self.counts = lambda texts: [len(model.encode(t, add_special_tokens=False)) for t in texts]

    def word_counts(self, words: list[str]) -> list[int]:
        """Counts of words without white space, of a vocabulary that drops it: read off one encoding of all of them."""
        starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        tokens = self.model.encode(" ".join(words), add_special_tokens=False).offsets
        of = np.searchsorted(starts, [start for start, _ in tokens], side="right") - 1
        return np.bincount(of, minlength=len(words)).tolist()

    def count(self, text: str) -> int:
        if not self.drops_space:
            return self.counts([text])[0]
        data, memo = text.encode(), self.memo
        if self.folds_case and text.isascii() and "<|" not in text:
            data = data.lower()
        words = data.split()  # bytes part at ASCII white space only
        new = [w for w in set(words) if w not in memo]
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list(set(words))
        memo.update(zip(new, self.word_counts([w.decode() for w in new]) if new else ()))
        total = sum(map(memo.__getitem__, words))
        for w in new:
            if len(w) > MEMO_BYTES:
                del memo[w]
        if len(memo) > MEMO:
            memo.clear()
        return total


def encode_missing(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(vocabulary)
        for batch in batches:
            counts = [counter.count(t.as_py() or "") for t in batch["text"]]
            yield pa.record_batch({"digest": batch["digest"], "n_tokens": pa.array(counts, pa.int64())})

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens bigint")


def cached(spark, cache: str, version: str) -> DataFrame | None:
    """The stored counts of a version, one row per digest; None where it has none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/version={version}")
    if not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return None
    rows = spark.read.schema("digest binary, n_tokens bigint").parquet(f"{cache}/version={version}")
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, cache: str, limit: int = LIMIT,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of `docs`; missing counts are added to the folder `cache`."""
    spark, version = docs.sparkSession, vocabulary.version()
    whole = F.coalesce(docs[text], F.lit(""))
    keyed = docs.select(docs[doc_id].alias("doc_id"), F.octet_length(whole).cast("long").alias("n_bytes"),
                        vocabulary.digest(docs[text]).alias("digest"))
    seen = stored(keyed.groupBy("digest").agg(F.count("*").alias("rows")))
    texts = docs.select(vocabulary.digest(docs[text]).alias("digest"), whole.alias("text"))
    known = cached(spark, cache, version)
    if known is None:
        missing, n_missing = None, seen.count()
    else:
        missing = stored(seen.select("digest").join(known, "digest", "left_anti"))
        n_missing = missing.count()
        if n_missing <= FEW:
            texts = texts.join(F.broadcast(missing), "digest", "left_semi")
    if n_missing:
        # one text per digest; equal texts of a task meet before the shuffle
        texts = texts.dropDuplicates(["digest"])
        if missing is not None and n_missing > FEW:
            texts = texts.join(missing, "digest", "left_semi")
        encode_missing(texts, vocabulary).write.mode("append").parquet(f"{cache}/version={version}")
    counts = cached(spark, cache, version)
    if counts is None:  # nothing was ever counted
        counts = spark.createDataFrame([], "digest binary, n_tokens bigint")
    total = seen.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    out = join_counted(keyed, seen.join(counts, "digest"), "digest", "rows", total)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
