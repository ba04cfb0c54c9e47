"""Suffix-array dedup: repeats of at least MIN bytes across and inside documents, and what is left without them.

A repeat of MIN bytes is found through its anchor: of the K-byte strings in a MIN-byte window, the one with the least hash
(the leftmost, if several).  Equal windows have equal anchors at equal offsets, so all occurrences of a repeat meet in the
bucket of one anchor hash.  A record is an anchor with the bytes left and right of it that its windows reach, at most
MIN - K on either side.

Inside a bucket the records are suffixes of one shared string.  They are sorted by their reversed left bytes and, within
that, by their right bytes: an enhanced suffix array, with the common prefix of neighbours.  A stack scan over these prefixes
walks the tree of common-prefix intervals: an interval of l shared left bytes and an interval of r shared right bytes inside
it, from more than one left extension, is a maximal repeat of l + K + r bytes.  Every occurrence but the earliest, by
(doc_id, start), is reported, with the earliest one as the group.

Scale: only anchor hashes that occur twice or more go on; counting them is one shuffle of (hash, document, place), and texts
are shuffled once, used to cut the records and again for the result.  Records with equal bytes on both sides count once per
bucket, in a stream, so memory grows with different contexts only.  Anchors with more than BUCKET records, and those that a
sample finds in a hundredth of the documents, are dealt over SALTS buckets, which pass on one occurrence per context.  These,
of which there may be one in each document, are dealt again by the bytes that a repeat must share at one of a few split points;
records that share them with others meet the earliest of these, and only what it does not share is cut into MIN-byte windows,
whose earliest row is joined to the others: no task holds them all.  Size and sample decide where rows go, never what counts.

Null text is empty.  Texts under MIN bytes lose nothing.  Each row is a document, also where ids repeat or are null: such rows
are ordered by id (null first) and hash of the text.  An empty table gives an empty result.  Hashes of K bytes have 64 bits;
bytes beyond the K are compared themselves, or by 128-bit digests of whole windows of hot anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.llm.common import NO_ID, numbered, stored

MIN, K = 100, 40
SALTS, SAMPLE, HOT = 64, 4000, 40
BUCKET = 50_000        # records of one anchor that a task may hold
BLOCK = 1 << 15
HOT_BIT = 1 << 62
ROOT = 0x9E3779B97F4A7C15


class Anchors:
    """Finds the anchors of one text after another."""

    def __init__(self, shortest: int = MIN, k: int = K):
        self.min, self.k = shortest, k
        n = BLOCK + shortest + 1
        self.power, self.inverse = (np.multiply.accumulate(np.array([1] + [base] * n, np.uint64))
                                    for base in (ROOT, pow(ROOT, -1, 1 << 64)))

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """Hash of each K-byte string of a block."""
        n, k = len(data), self.k
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.inverse[:n - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h

    def block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and hash of the anchor, and first window, of each run of windows with one anchor."""
        h = self.hashes(data)
        key = (h & np.uint64(0xFFFFFFFFFFFF0000)) | np.arange(len(h), dtype=np.uint64)
        width, have = self.min - self.k + 1, 1
        while have * 2 <= width:
            key = np.minimum(key[:-have], key[have:])
            have *= 2
        if have < width:
            key = np.minimum(key[:len(key) - (width - have)], key[width - have:])
        at = (key & np.uint64(0xFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        return at[first], h[at[first]], first

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, hash, first window, last window) of every anchor of a text."""
        windows = len(data) - self.min + 1
        if windows <= 0:
            return (np.zeros(0, np.int64),) * 4
        raw, parts = np.frombuffer(data, np.uint8), []
        for at in range(0, windows, BLOCK):
            place, h, first = self.block(raw[at:at + BLOCK + self.min - 1])
            parts.append((place + at, h.view(np.int64), first + at))
        place, h, first = (np.concatenate(p) for p in zip(*parts))
        new = np.concatenate([[True], place[1:] != place[:-1]])  # a run may go on in the next block
        place, h, first = place[new], h[new], first[new]
        return place, h, first, np.concatenate([first[1:] - 1, [windows - 1]])


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (hash, doc, info): info is place << 16 | bytes to the left << 8 | bytes to the right."""
    anchors = Anchors()
    names = ["hash", "doc", "info"]
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, out = batch.slice(at, 500), []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text and len(text) * 4 >= MIN:
                    place, h, first, last = anchors.of(text.encode())
                    out.append((h, np.full(len(h), doc), place << 16 | (place - first) << 8 | (last + MIN - place - K)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)


def keep_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (hash, doc, info) sorted by hash, those that are hot or whose hash occurs twice or more.

    A hash with more than BUCKET rows is hot from here on; at most BUCKET rows are held until that is known.
    """
    held: list[pa.RecordBatch] = []  # of the hash that the last batch ended with
    last, n, hot = None, 0, False

    def marked(rows: pa.RecordBatch, heat: np.ndarray | bool) -> pa.RecordBatch:
        info = rows.column(2).to_numpy()
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.where(heat, info | HOT_BIT, info))], names=rows.schema.names)

    def end() -> Iterator[pa.RecordBatch]:
        for rows in held:
            if n > 1:
                yield rows
            else:
                yield rows.filter(pa.array(rows.column(2).to_numpy() >= HOT_BIT))
        held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(0).to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
        if last is not None and h[0] != last:
            yield from end()
            n, hot = 0, False
        elif last is not None:
            starts = starts[1:]
            head = batch.slice(0, starts[0] if len(starts) else batch.num_rows)
            n += head.num_rows
            held.append(head)
            if n > BUCKET:
                hot = True
            if hot:
                yield from (marked(rows, True) for rows in held)
                held.clear()
            if not len(starts):
                continue
            yield from end()
            n, hot = 0, False
        # whole groups, then the one that may go on
        first, tail = starts[0], starts[-1]
        if tail > first:
            counts = np.diff(starts)
            size = np.repeat(counts, counts)
            rows = batch.slice(first, tail - first)
            keep = (size > 1) | (rows.column(2).to_numpy() >= HOT_BIT)
            yield marked(rows, size > BUCKET).filter(pa.array(keep))
        rest = batch.slice(tail)
        last, n, hot = h[-1], rest.num_rows, rest.num_rows > BUCKET
        if hot:
            yield marked(rest, True)
        else:
            held.append(rest)
    yield from end()


def cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, anchors) to records (hash, doc, place, left, right); a hot record's place has HOT_BIT."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            lists = part.column(2)
            bounds = lists.offsets.to_numpy()
            info, h = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).flatten()
            info = info.to_numpy()
            places, sides = (info & HOT_BIT - 1) >> 16, info & 0xFFFF
            lefts, rights = [], []
            for text, lo, hi in zip(part.column(1).to_pylist(), bounds[:-1] - bounds[0], bounds[1:] - bounds[0]):
                data = (text or "").encode()
                for place, side in zip(places[lo:hi].tolist(), sides[lo:hi].tolist()):
                    lefts.append(data[place - (side >> 8):place])
                    rights.append(data[place + K:place + K + (side & 255)])
            docs = np.repeat(part.column(0).to_numpy(), np.diff(bounds))
            yield pa.RecordBatch.from_arrays([h, pa.array(docs), pa.array(places | info & HOT_BIT), pa.array(lefts, pa.binary()),
                                              pa.array(rights, pa.binary())],
                                             names=["hash", "doc", "place", "left", "right"])


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of every common-prefix interval, inner ones first; prefixes[i] is that of i and i + 1."""
    stack: list[tuple[int, int]] = []
    for at, length in enumerate([*prefixes, -1]):
        start = at
        while stack and stack[-1][0] > length:
            inside, start = stack.pop()
            yield inside, start, at
        if not stack or stack[-1][0] < length:
            stack.append((length, start))


def bucket_repeats(contexts: list[tuple[bytes, bytes, tuple]], shortest: int = MIN, k: int = K) -> Iterator[tuple]:
    """(occurrence, group's earliest, l, r) for the maximal repeats of one bucket.

    `contexts` are different (left, right, (doc, place)) of its records, each with its earliest place.
    """
    flipped = [c[0][::-1] for c in contexts]
    by_left = sorted(range(len(contexts)), key=lambda i: flipped[i])
    rights = {i: n for n, i in enumerate(sorted(by_left, key=lambda i: contexts[i][1]))}
    prefixes = [common(flipped[a], flipped[b]) for a, b in zip(by_left, by_left[1:])]
    for l, lo, hi in intervals(prefixes):
        need, extension, n = shortest - k - l, {}, 0
        for at in range(lo, hi + 1):
            extension[by_left[at]] = n  # which of the interval's left extensions
            n += at < hi and prefixes[at] == l
        members = sorted(extension, key=rights.__getitem__)
        stack: list[list] = []
        for at, best in enumerate(members):
            r = common(contexts[best][1], contexts[members[at + 1]][1]) if at + 1 < len(members) else -1
            while stack and stack[-1][0] >= max(r, 0):
                length, other = stack.pop()
                first, later = sorted((other, best), key=lambda i: contexts[i][2])
                if length >= need and extension[first] != extension[later]:
                    yield contexts[later][2], contexts[first][2], l, length
                best = first
            stack.append([r, best])


SCANNED = "doc bigint, start bigint, end bigint, of_doc bigint, of_start bigint, hash bigint, left binary, right binary"


def find_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records sorted by (hash, salt, left, right, doc, place) to SCANNED.

    An occurrence with the bytes of an earlier one on both sides is reported at once; different contexts are kept until
    their bucket ends.  Salted buckets only do the former, and pass on the earliest record of each context, as (doc, place as
    start, hash, left, right).
    """
    names = [c.split()[0] for c in SCANNED.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.binary()] * 2
    bucket, contexts, out = None, [], []

    def close() -> None:
        if len(contexts) > 1 and not bucket[1]:
            for (doc, place), (of_doc, of_place), left, right in bucket_repeats(contexts):
                out.append((doc, place - left, place + K + right, of_doc, of_place - left, None, None, None))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 8
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        for h, doc, place, left, right, salt in zip(*(batch.column(c).to_pylist() for c in range(6))):
            fresh = bucket is None or bucket[0] != h or bucket[1] != salt
            if fresh:
                close()
                bucket, contexts = (h, salt), []
            elif contexts[-1][0] == left and contexts[-1][1] == right:
                first = contexts[-1][2]
                if first != (doc, place):
                    out.append((doc, place - len(left), place + K + len(right), first[0], first[1] - len(left), None, None, None))
                continue
            if salt:
                contexts = [(left, right, (doc, place))]
                out.append((doc, place, None, None, None, h, left, right))
            else:
                contexts.append((left, right, (doc, place)))
        yield flush()
    if bucket is not None:
        close()
    yield flush()


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return numbered(docs, text, doc_id).select("doc", F.col(f"row.{text}").alias("text"))


def hot_anchors(texts: DataFrame) -> DataFrame | None:
    """Anchor hashes in at least HOT of about SAMPLE sampled documents, if there are any; at most one in HOT of the sample's."""
    n = texts.count()
    sample = texts.sample(min(1.0, SAMPLE / max(n, 1)), seed=11)
    hot = (sample.mapInArrow(find_anchors, "hash bigint, doc bigint, info bigint").groupBy("hash")
           .agg(F.count_distinct("doc").alias("n")).filter(F.col("n") >= HOT).select("hash").toArrow())
    return texts.sparkSession.createDataFrame(hot).withColumn("hot", F.lit(True)) if hot.num_rows else None


def repeats(texts: DataFrame) -> DataFrame:
    """Maximal repeats of `texts` (doc, text): (doc, start, end, of_doc, of_start), one row per occurrence but the earliest.

    The matched stretch of a row never leaves its anchor's windows; a longer repeat is a chain of overlapping rows.
    """
    hot = hot_anchors(texts)
    anchors = texts.mapInArrow(find_anchors, "hash bigint, doc bigint, info bigint")
    if hot is not None:
        marked = F.when(F.col("hot"), F.col("info").bitwiseOR(F.lit(HOT_BIT))).otherwise(F.col("info"))
        anchors = anchors.join(F.broadcast(hot), "hash", "left").select("hash", "doc", marked.alias("info"))
    repeated = stored(anchors.repartition("hash", _salt("info")).sortWithinPartitions("hash")
                      .mapInArrow(keep_repeated, "hash bigint, doc bigint, info bigint"))
    per_doc = repeated.groupBy("doc").agg(F.collect_list(F.struct("info", "hash")).alias("anchors"))
    records = (per_doc.join(texts, "doc").select("doc", "text", "anchors")
               .mapInArrow(cut_records, "hash bigint, doc bigint, place bigint, left binary, right binary")
               .select("hash", "doc", F.col("place").bitwiseAND(F.lit(HOT_BIT - 1)).alias("place"), "left", "right",
                       _salt("place").alias("salt")))
    scanned = (records.repartition("hash", "salt").sortWithinPartitions("hash", "salt", "left", "right", "doc", "place")
               .mapInArrow(find_repeats, SCANNED))
    spans = ["doc", "start", "end", "of_doc", "of_start"]
    if repeated.filter(F.col("info") >= HOT_BIT).isEmpty():
        return scanned.select(*spans)
    # One record per context and salt is left of every hot anchor; equal surroundings leave few, different ones many.
    scanned = stored(scanned)
    contexts = scanned.filter("hash is not null").select("hash", "doc", F.col("start").alias("place"), "left", "right")
    return scanned.filter("hash is null").select(*spans).union(same_windows(contexts))


#: A repeat shares l bytes to the left of its anchor and r to the right, l + r >= MIN - K.  With l in [a, a + STEP), it shares a
#: to the left and MIN - K - STEP - a to the right: records that share this with no other record at any a are in no repeat.
STEP = 10


def cut_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, doc, place, left, right) to (split, at, hash, doc, place, left, right): a digest of the bytes shared at each split."""
    names = ["split", "at", "hash", "doc", "place", "left", "right"]
    kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    spare = MIN - K - STEP
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            out = []
            for h, doc, place, left, right in zip(*(c.to_pylist() for c in batch.slice(start, 1000).columns)):
                head = h.to_bytes(8, "little", signed=True)
                for at in range(0, spare + 1, STEP):
                    if at <= len(left) and spare - at <= len(right):
                        shared = left[len(left) - at:] + right[:spare - at]
                        out.append((xxhash.xxh3_128_digest(head + bytes([at]) + shared), at, h, doc, place, left, right))
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def meet_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (at, hash, doc, place, left, right) with the earliest record of their split, `first`, to (doc, start, end, of_doc,
    of_start) of what they share with it, and to (window, doc, start, before) of what is left.

    `window` is a digest of a MIN-byte window with the anchor `before` bytes after its start (here, `start` is the anchor's place):
    of those that belong to the split `at`, the ones that the earliest record does not share.
    """
    names = ["doc", "start", "end", "of_doc", "of_start", "window", "before"]
    kinds = [pa.int64()] * 5 + [pa.binary(), pa.int32()]
    need = MIN - K
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            out = []
            for at, h, doc, place, left, right, first in zip(*(c.to_pylist() for c in batch.slice(start, 1000).columns)):
                if (first["doc"], first["place"]) == (doc, place):
                    continue
                l, r = common(left[::-1], first["left"][::-1]), common(right, first["right"])
                if l + r >= need:
                    out.append((doc, place - l, place + K + r, first["doc"], first["place"] - l, None, None))
                context, head = left + right, h.to_bytes(8, "little", signed=True)
                last = at + STEP if at + STEP < need else need + 1  # the last split has one more
                for before in range(max(at, need - len(right)), min(last - 1, len(left)) + 1):
                    if not need - r <= before <= l:
                        begin = len(left) - before
                        digest = xxhash.xxh3_128_digest(head + bytes([before]) + context[begin:begin + need])
                        out.append((doc, place, None, None, None, digest, before))
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def same_windows(contexts: DataFrame) -> DataFrame:
    """Repeats among records (hash, doc, place, left, right), one row for each pair of a later and an earliest occurrence."""
    splits = stored(contexts.mapInArrow(cut_splits, "split binary, at int, hash bigint, doc bigint, place bigint, left binary, right binary"))
    shared = (splits.groupBy("split").agg(F.min(F.struct("doc", "place", "left", "right")).alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select("split", "first"))
    met = stored(splits.join(shared, "split").select("at", "hash", "doc", "place", "left", "right", "first").mapInArrow(
        meet_first, "doc bigint, start bigint, end bigint, of_doc bigint, of_start bigint, window binary, before int"))
    windows = met.filter("window is not null").select("window", "doc", F.col("start").alias("place"), "before")
    first = windows.groupBy("window").agg(F.min(F.struct("doc", "place")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(first.select("window", "first"), "window").filter("doc <> first.doc or place <> first.place")
    pairs = later.groupBy("doc", "place", F.col("first.doc").alias("of_doc"), F.col("first.place").alias("of_place")).agg(
        F.min("before").alias("low"), F.max("before").alias("high"))
    return met.filter("window is null").select("doc", "start", "end", "of_doc", "of_start").union(pairs.select(
        "doc", (F.col("place") - F.col("high")).alias("start"), (F.col("place") + MIN - F.col("low")).alias("end"),
        "of_doc", (F.col("of_place") - F.col("high")).alias("of_start")))


def _salt(marked: str) -> Column:
    """0, or for hot rows one of SALTS numbers by document."""
    return F.when(F.col(marked) >= HOT_BIT, F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int") + 1).otherwise(0)


def merged(spans: list[int], n: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the spans (start << 8 | length: a row spans less than 2 * MIN bytes)."""
    runs: list[list[int]] = []
    for span in sorted(spans):
        start = span >> 8
        end = min(start + (span & 255), n)
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        elif start < end:
            runs.append([start, end])
    return [tuple(r) for r in runs]


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for start, end in runs:
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]])


def spans_of(texts: DataFrame) -> DataFrame:
    """(doc, spans) of the documents of `texts` (doc, text) that have any, unmerged."""
    span = F.shiftleft("start", 8) + F.col("end") - F.col("start")
    return repeats(texts).groupBy("doc").agg(F.collect_list(span).alias("spans"))


def original(doc: Column) -> Column:
    return F.nullif(doc, F.lit(NO_ID))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()]
        for batch in batches:
            out = []
            for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in range(3))):
                data = (text or "").encode()
                runs = merged(spans or [], len(data))
                out.append((doc, len(data), sum(e - s for s, e in runs), len(runs), hashlib.sha256(without(data, runs)).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = numbered(docs).select("doc", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"))
    return rows.join(spans_of(rows.select("doc", "text")), "doc", "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with repeated stretches cut out of the text; a character cut in two goes whole.  All rows and columns stay."""
    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        def one(value: str | None, found: list | None) -> str | None:
            if not found or value is None:
                return value
            data = value.encode()
            return without(data, merged(found, len(data))).decode(errors="ignore")
        return pa.array(map(one, texts.to_pylist(), spans.to_pylist()), pa.string())

    rows = numbered(docs, text, doc_id)
    joined = rows.join(spans_of(rows.select("doc", F.col(f"row.{text}").alias("text"))), "doc", "left")
    shorter = cut(F.col(f"row.{text}"), F.col("spans"))
    return joined.select(*[shorter.alias(c) if c == text else F.col(f"row.{c}") for c in docs.columns])
