"""Cross-entropy difference: how much better a target model predicts a document than a background model does.

Both models are interpolated bigram models over one vocabulary and one list of bigrams, counted over all words of both
corpora.  They hold every word and every bigram of the target, and every one that occurs twice or more in both corpora
together, however large these are.  What is left, background words seen a single time, is one unknown word.

    P(w)     = (c(w) + 1) / (N + V + 1)
    P(w | v) = (c(v, w) + STRENGTH * P(w)) / (sum over w of c(v, w) + STRENGTH)

The loss of a token is -log P(w | v); of a first token, or after an unknown word, -log P(w).  A document's score is its mean
target loss minus its mean background loss: the lower, the closer to the target.

Scale: the models grow with the corpus and are never in one place.  Documents are dealt into chunks of about CHUNK bytes; a
chunk counts its different grams once and sends them to buckets by gram hash, sorted and packed: the distances of the hashes,
not the hashes (11 to 13 bytes for a gram with its head and count).  A bucket adds up all chunks and answers each with the
counts of its own grams only; what follows a word is summed in a second round in the same way.  So a chunk or a bucket is all
that a task holds, and a gram that is everywhere is one number per chunk.  Documents are read twice and must come in the same
partitions both times, as files do; a chunk whose grams differ, by their checksum, stops the job.

Null and empty texts have 0 tokens and null losses.  Repeated rows count as often as they occur.  Empty corpora give uniform
models over the unknown word.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordferry.llm.common import stored
from recordferry.llm.minhash import GOLDEN, mixed

STRENGTH = 32.0
CHUNK = 1 << 23
NOISE, FEW, CUT = 5, 1000, 255
SHAPE = "<IBB"
BLOCKS = "bucket bigint, chunk bigint, heads binary, places binary, grams binary, counts binary"
ANSWERS = "kind int, key bigint, at bigint, keys binary, b binary, t binary"
COUNTS, AFTER, WORDS, SUMS = range(4)


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each word with its predecessor, from the second word on."""
    u = h.view(np.uint64)
    return mixed(u[:-1] * GOLDEN + mixed(u[1:])).view(np.int64)


def found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def packed(x: np.ndarray, noise: int = 0) -> bytes:
    """Numbers from 0 on, byte by byte, up to the highest byte that is not 0 everywhere.

    The lowest `noise` bytes are kept as they are, and each of the others is compressed as a column of its own.  Where there is
    noise, FEW numbers or less are cut to the bits of the largest instead: at scale there are many such arrays, and a compressor
    costs more time than it saves room.
    """
    bits, columns = int(x.max(initial=0)).bit_length(), x.astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8)
    if noise and len(x) <= FEW:
        return struct.pack(SHAPE, len(x), bits, CUT) + np.packbits(np.unpackbits(columns, 1, bits, "little"), bitorder="little").tobytes()
    used = (bits + 7) // 8
    kept = min(noise, used)
    out = [struct.pack(SHAPE, len(x), used, kept), columns[:, :kept].tobytes()]
    for i in range(kept, used):
        stream = zlib.compressobj(1, zlib.DEFLATED, -zlib.MAX_WBITS, 8, zlib.Z_RLE)
        out += [stream.compress(columns[:, i].tobytes()), stream.flush()]
    return b"".join(out)


def unpacked(x: bytes) -> np.ndarray:
    size, used, kept = struct.unpack_from(SHAPE, x)
    out, rest = np.zeros((size, 8), np.uint8), x[struct.calcsize(SHAPE):]
    if kept == CUT:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=size * used, bitorder="little").reshape(size, used)
        out[:, :(used + 7) // 8] = np.packbits(bits, 1, "little")
        return out.view(np.int64).ravel()
    out[:, :kept] = np.frombuffer(rest[:size * kept], np.uint8).reshape(size, kept)
    rest = rest[size * kept:]
    for i in range(kept, used):
        stream = zlib.decompressobj(-zlib.MAX_WBITS)
        out[:, i] = np.frombuffer(stream.decompress(rest), np.uint8)
        rest = stream.unused_data
    return out.view(np.int64).ravel()


def spaced(x: np.ndarray) -> bytes:
    """Sorted hashes as the first one and the distances, whose NOISE lowest bytes cannot be compressed."""
    return x[:1].tobytes() + packed(x[1:] - x[:-1], NOISE) if len(x) else b""


def unspaced(x: bytes) -> np.ndarray:
    if not x:
        return np.zeros(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(x, np.uint64, 1), unpacked(x[8:]).view(np.uint64)]), dtype=np.uint64)


def checksum(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_64_digest(grams.tobytes())


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hash, so that sorted grams are sorted by bucket."""
    return ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def in_chunks(batches: Iterator[pa.RecordBatch], sign: int = 1) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (chunk, doc_id, text); chunks of the target have negative numbers."""
    first, held = (TaskContext.get().partitionId() << 32) + 1, 0
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = held + np.cumsum(size)
        chunk = sign * (first + (ends - size) // CHUNK)
        held = int(ends[-1]) if len(ends) else held
        yield pa.RecordBatch.from_arrays([pa.array(chunk), *batch.columns], names=["chunk", "doc_id", "text"])


def chunked(texts: DataFrame) -> DataFrame:
    return texts.mapInArrow(in_chunks, "chunk bigint, doc_id bigint, text string")


class Grams:
    """The different words and bigrams of a chunk's texts, sorted; a word is its own head.

    `word` and `pair` are the places of each token's word and of the bigram that ends in it (-1: none).
    """

    def __init__(self, texts: list[str | None], buckets: int):
        hashes = [word_hashes(t) for t in texts]
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        words = np.concatenate([*hashes, np.zeros(0, np.int64)])
        first = np.zeros(len(words) + 1, bool)
        first[np.concatenate([[0], np.cumsum(self.sizes)])] = True
        inside = np.flatnonzero(~first[:-1])
        both = np.concatenate([words, pair_hashes(words)[inside - 1] if len(words) else words]).view(np.uint64)
        del hashes, first
        # one stable sort, its parts freed as soon as they are used: a chunk is what a task's memory holds
        order = np.argsort(both, kind="stable")
        both = both[order]
        new = np.concatenate([[True], both[1:] != both[:-1]])[:len(both)]
        self.gram = both[new]
        del both
        self.n = np.diff(np.flatnonzero(new), append=len(new))
        place = np.empty(len(order), np.int32)
        place[order] = np.cumsum(new, dtype=np.int32) - 1
        at = order[new]
        del order, new
        pair = at >= len(words)
        self.head = self.gram.copy()
        self.head[pair] = words.view(np.uint64)[inside[at[pair] - len(words)] - 1]
        self.bucket = bucket_of(self.gram, buckets)
        self.word, self.pair = place[:len(words)], np.full(len(words), -1, np.int32)
        self.pair[inside] = place[len(words):]

    def starts(self) -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1]])) if len(self.bucket) else np.zeros(0, np.int64)

    def checksums(self) -> list[tuple[int, bytes]]:
        """Bucket and checksum of its grams, in order."""
        starts = self.starts().tolist()
        return [(int(self.bucket[lo]), checksum(self.gram[lo:hi])) for lo, hi in zip(starts, [*starts[1:], len(self.bucket)])]

    def blocks(self, chunk: int) -> Iterator[tuple]:
        """Rows of BLOCKS: the heads of bigrams once each, and the place of each gram's head among them, from 1 on (0: a word)."""
        starts = self.starts()
        for lo, hi in zip(starts, [*starts[1:], len(self.bucket)]):
            gram, head = self.gram[lo:hi], self.head[lo:hi]
            pair, places = head != gram, np.zeros(hi - lo, np.int64)
            heads, at = np.unique(head[pair], return_inverse=True)
            places[pair] = at.ravel() + 1
            yield (int(self.bucket[lo]), chunk, spaced(heads), packed(places, 1), spaced(gram), packed(self.n[lo:hi]))


def heads_of(grams: np.ndarray, heads: bytes, places: bytes) -> np.ndarray:
    """The head of each gram of a block."""
    at = unpacked(places)
    return np.where(at > 0, np.concatenate([np.zeros(1, np.uint64), unspaced(heads)])[at], grams)


def table_of(rows: list[tuple], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(map(str, range(len(kinds)))))


def renamed(batches: Iterator[pa.RecordBatch], schema: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.rename_columns([c.split()[0] for c in schema.split(", ")])


def counted(rows: DataFrame, buckets: int, sign: int = 1) -> DataFrame:
    """BLOCKS of the chunks of rows (doc_id, text), each of which is in one task, one after the other."""
    kinds = [pa.int64()] * 2 + [pa.binary()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts = None, []
        for batch in in_chunks(batches, sign):
            for chunk, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(2))):
                if chunk != now:
                    if texts:
                        yield table_of(list(Grams(texts, buckets).blocks(now)), kinds)
                    now, texts = chunk, []
                texts.append(text)
        if texts:
            yield table_of(list(Grams(texts, buckets).blocks(now)), kinds)

    # numbered and counted in one pass, so that a task has one Python worker
    return rows.mapInArrow(lambda b: renamed(run(b), BLOCKS), BLOCKS)


def by_key(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[list[tuple]]:
    """The rows of one key after another."""
    now, held = None, []
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            for row in zip(*(c.to_pylist() for c in batch.slice(start, 200).columns)):
                if row[key] != now:
                    if held:
                        yield held
                    now, held = row[key], []
                held.append(row)
    if held:
        yield held


ANSWER = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def merged(blocks: DataFrame, buckets: int) -> DataFrame:
    """ANSWERS of each bucket: COUNTS to (chunk, bucket), 0 where a gram is not in the model; AFTER, what follows heads, to the
    head's bucket; WORDS of the model in a chunk, to their bucket; SUMS of the bucket's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches):
            out, bucket = [], rows[0][0]
            grams = [unspaced(r[4]) for r in rows]
            head = np.concatenate([heads_of(g, r[2], r[3]) for g, r in zip(grams, rows)])
            n = np.concatenate([unpacked(r[5]) for r in rows])
            target = np.repeat([r[1] < 0 for r in rows], [len(g) for g in grams])
            gram, at, place = np.unique(np.concatenate(grams), return_index=True, return_inverse=True)
            place, head = place.ravel(), head[at]
            b, t = (np.bincount(place, np.where(target == side, n, 0), len(gram)).astype(np.int64) for side in (False, True))
            word, model = head == gram, (b + t >= 2) | (t > 0)
            totals = [b[word].sum(), t[word].sum(), b[word & model].sum(), t[word & model].sum(), (word & model).sum()]
            out.append((SUMS, bucket, None, packed(np.array(totals)), None, None))
            b, t = np.where(model, b, 0), np.where(model, t, 0)
            start = 0
            for r, mine in zip(rows, grams):
                p = place[start:start + len(mine)]
                start += len(mine)
                if r[1] > 0:
                    out.append((COUNTS, r[1], bucket, checksum(mine), packed(b[p]), packed(t[p])))
                    out.append((WORDS, bucket, r[1], spaced(mine[word[p] & model[p]]), None, None))
            heads, p = np.unique(head[model & ~word], return_inverse=True)
            after = [np.bincount(p.ravel(), x[model & ~word], len(heads)).astype(np.int64) for x in (b, t)]
            of = bucket_of(heads, buckets)
            for to in np.unique(of):
                some = slice(*np.searchsorted(of, [to, to + 1]))
                out.append((AFTER, int(to), bucket, spaced(heads[some]), packed(after[0][some]), packed(after[1][some])))
            yield table_of(out, ANSWER)

    # a partition for each bucket: Arrow batches have up to 10,000 rows, so a task must not get many buckets
    return (blocks.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "chunk")
            .mapInArrow(lambda b: renamed(run(b), ANSWERS), ANSWERS))


def followed(answers: DataFrame, buckets: int) -> DataFrame:
    """AFTER answers to (chunk, bucket), in the order of the chunk's WORDS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches, 1):
            parts = [r for r in rows if r[0] == AFTER]
            heads, p = np.unique(np.concatenate([unspaced(r[3]) for r in parts] or [np.zeros(0, np.uint64)]),
                                 return_inverse=True)
            sums = [np.bincount(p.ravel(), np.concatenate([unpacked(r[c]) for r in parts] or [np.zeros(0)]), len(heads)) for c in (4, 5)]
            out = []
            for _, bucket, chunk, words, _, _ in (r for r in rows if r[0] == WORDS):
                at, there = found(heads, unspaced(words))
                b, t = (np.where(there, s[at], 0) if len(s) else np.zeros(len(at)) for s in sums)
                out.append((AFTER, chunk, bucket, None, packed(b), packed(t)))
            yield table_of(out, ANSWER)

    wanted = answers.filter(F.col("kind").isin(AFTER, WORDS))
    return (wanted.repartitionById(buckets, F.col("key").cast("int")).sortWithinPartitions("key", "kind", "at")
            .mapInArrow(lambda b: renamed(run(b), ANSWERS), ANSWERS))


def losses(grams: Grams, counts: list, after: list, sums: np.ndarray) -> list[np.ndarray]:
    """Mean target and background loss of each of a chunk's texts.

    `counts` and `after` are (background, target), of all grams and of those that are words of the model.
    """
    known = (counts[0] + counts[1] > 0) & (grams.gram == grams.head)
    doc = np.repeat(np.arange(len(grams.sizes)), grams.sizes)
    then = np.flatnonzero(grams.pair >= 0)
    then = then[known[grams.word[then - 1]]]
    out = []
    for side in (1, 0):
        total, kept, size = int(sums[side]), int(sums[2 + side]), int(sums[4])
        p = (np.where(known, counts[side], total - kept)[grams.word] + 1.0) / (total + size + 1.0)
        follows = np.zeros(len(known))
        follows[known] = after[side]
        p[then] = (counts[side][grams.pair[then]] + STRENGTH * p[then]) / (follows[grams.word[then - 1]] + STRENGTH)
        out.append(-np.bincount(doc, np.log(p, out=p), len(grams.sizes)) / np.maximum(grams.sizes, 1))
    return out


def score(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, difference of every row; `docs` itself is the background."""
    spark = docs.sparkSession
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    aims = target.select(F.lit(None).cast("long").alias("doc_id"), target[target.columns[0]].alias("text"))
    size = rows.union(aims).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // CHUNK))
    chunks = chunked(rows)
    answers = stored(merged(counted(rows, buckets).union(counted(aims, buckets, -1)), buckets))
    sums = np.zeros(5, np.int64)
    for row in answers.filter(F.col("kind") == SUMS).select("keys").toLocalIterator():
        sums = sums + unpacked(row[0])
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    schema = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, difference double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches):
            texts = [r for r in rows if r[1] < 0]
            grams = Grams([r[6] for r in texts], buckets)
            counts, after = ([np.concatenate([unpacked(r[c]) for r in rows if r[1] == kind] or [np.zeros(0, np.int64)]) for c in (3, 4)]
                             for kind in (COUNTS, AFTER))
            texts = [r[:6] for r in texts]
            if [(r[2], r[7]) for r in rows if r[1] == COUNTS] != grams.checksums():
                raise ValueError("the documents were not in the same partitions when read again")
            rows.clear()
            t, b = losses(grams, counts, after, sums)
            out = [(r[5], int(n), *((float(x), float(y), float(x - y)) if n else (None,) * 3)) for r, n, x, y in zip(texts, grams.sizes, t, b)]
            yield table_of(out, kinds)

    none = F.lit(None)
    told = answers.filter(F.col("kind") == COUNTS).union(followed(answers, buckets)).select(
        F.col("key").alias("chunk"), "kind", "at", "b", "t", none.cast("long").alias("doc_id"), none.cast("string").alias("text"), "keys")
    asked = chunks.select("chunk", F.lit(-1).alias("kind"), none.cast("long").alias("at"), none.cast("binary").alias("b"),
                          none.cast("binary").alias("t"), "doc_id", "text", none.cast("binary").alias("keys"))
    # Documents come first in both unions, so that their tasks, which number the chunks, are the same.
    return (asked.union(told).repartition(buckets, "chunk").sortWithinPartitions("chunk", "kind", "at")
            .mapInArrow(lambda b: renamed(run(b), schema), schema))
