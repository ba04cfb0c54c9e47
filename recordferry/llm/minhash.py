"""Near-duplicate classes by BagMinHash over multisets of five-word shingles, similarity (weighted Jaccard) of at least 0.8.

Signature: every shingle of weight w (its count) is a set of levels 0..w-1, cut into dyadic ranges [0,1), [1,2), [2,4), ...
Each range runs one Poisson process whose rate is its width; a point has a time, a register and a level, all from hashes of
the shingle, the range and the point's number, so every document sees the same points.  A register holds the first point
whose level the document reaches.  Two registers agree with probability sum(min) / sum(max) of the weights, and a process
stops once its time is past every register, which for long texts is after its first point.

Candidates: 32 bands of 4 registers; a pair at 0.8 misses all with probability 5e-8.  Every document first meets the one least
document of its buckets that it shares most of them with.  Where such links leave a bucket in several components, documents
of different components are compared as well, inside the bucket, in the order of their agreement, until they are connected
or all tested; so all pairs in a bucket are tested or connected.  A pair goes on if SURE registers agree (a pair at 0.8 fails that with probability 1e-8) and is a link if the multisets
themselves overlap by 0.8.  Classes are the connected components of the links; no group is ever expanded into its pairs.

Equal word sequences count once and are members of their class; so white space does not matter, and texts without words
(null, empty) are copies of one another.  Texts of one to four words are one shingle.  Each row is a document, also where
ids repeat or are null; a null doc_id counts as the least id.  An empty table gives no classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.llm.common import NO_ID, components, join_counted, numbered, own_ids, saved, stored

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
SURE = 76
HUB, BUCKET = 400, 4096
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Hashes and counts of the different shingles, and the digest of the word sequence."""
    found = (text or "").encode().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    digest = xxhash.xxh3_128_digest(h.tobytes())
    if not len(h):
        return h, np.zeros(0, np.int64), digest
    width = min(words, len(h))
    n = len(h) - width + 1
    s = np.full(n, width, np.uint64)
    for j in range(width):
        s = mixed(s * GOLDEN + h[j:j + n])
    return *np.unique(s, return_counts=True), digest


def signature(elements: np.ndarray, weights: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The winning point of each register, as a 64-bit id; needs at least one element."""
    parts = [(elements, 0, 1, weights)]
    low = 1
    while (reach := weights > low).any():
        parts.append((elements[reach], low, low, weights[reach]))
        low *= 2
    seeds = np.concatenate([mixed(e + np.uint64(int(GOLDEN) * (lo + 1) % 2**64)) for e, lo, _, _ in parts])
    lows = np.concatenate([np.full(len(e), lo, np.float64) for e, lo, _, _ in parts])
    widths = np.concatenate([np.full(len(e), wide, np.float64) for e, _, wide, _ in parts])
    tops = np.concatenate([w for _, _, _, w in parts]).astype(np.float64)
    times = np.zeros(len(seeds))
    first, owner, number = np.full(m, np.inf), np.zeros(m, np.uint64), 0
    while len(seeds):
        block = int(min(256, 1 + 2 * m // len(seeds)))
        ids = mixed(seeds[:, None] + GOLDEN * np.arange(number + 1, number + block + 1, dtype=np.uint64))
        wait = -np.log((ids >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54)
        at = times[:, None] + np.cumsum(wait, axis=1) / widths[:, None]
        times, number = at[:, -1], number + block
        more = mixed(ids + GOLDEN)
        register = (more >> np.uint64(40)).astype(np.int64) % m
        level = lows[:, None] + np.floor((more & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32 * widths[:, None])
        counts = ((level < tops[:, None]) & (at < first[register])).ravel()
        at, register, ids = at.ravel()[counts], register.ravel()[counts], ids.ravel()[counts]
        order = np.lexsort((ids, -at))  # the least time of a register is written last
        first[register[order]], owner[register[order]] = at[order], ids[order]
        going = times < first.max()
        seeds, lows, widths, tops, times = seeds[going], lows[going], widths[going], tops[going], times[going]
    return owner


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (doc, words, bands, sketch)."""
    powers = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part, words, bands, sketches = batch.slice(start, 1000), [], [], []
            for text in part.column(1).to_pylist():
                elements, counts, digest = shingles(text)
                words.append(digest)
                if not len(elements):
                    bands.append([])
                    sketches.append(b"")
                    continue
                owner = signature(elements, counts)
                of = powers.copy()
                for row in owner.reshape(BANDS, ROWS).T:
                    of = mixed(of * GOLDEN + row)
                bands.append(of.view(np.int64).tolist())
                sketches.append(owner.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc", "words", "bands", "sketch"])


@F.arrow_udf(T.IntegerType())
def _agreeing(a: pa.Array, b: pa.Array) -> pa.Array:
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint8).reshape(-1, REGISTERS)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint8).reshape(-1, REGISTERS)
    return pa.array((x == y).sum(axis=1).astype(np.int32))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """sum(min) and sum(max) of two multisets of (different shingles, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both, int(a[1].sum() + b[1].sum()) - both


def is_link(both: int, total: int) -> bool:
    return both * 10 >= total * round(SIMILAR * 10)


class Held:
    """The rows of a bucket outside its main component, in growing arrays, and which labels links have joined so far."""

    def __init__(self) -> None:
        self.n, self.docs, self.labels, self.bags, self.joined = 0, np.zeros(16, np.int64), np.zeros(16, np.int64), [], {}
        self.sketches, self.bands = np.zeros((16, REGISTERS), np.uint8), np.zeros((16, BANDS), np.int64)

    def add(self, doc: int, label: int, sketch: np.ndarray, bands: np.ndarray, bag: tuple) -> None:
        if self.n == len(self.docs):
            for name, value in list(vars(self).items()):
                if isinstance(value, np.ndarray):
                    setattr(self, name, np.concatenate([value, np.zeros_like(value)]))
        self.docs[self.n], self.labels[self.n], self.sketches[self.n], self.bands[self.n] = doc, label, sketch, bands
        self.bags.append(bag)
        self.n += 1

    def root(self, label: int) -> int:
        while label in self.joined:
            label = self.joined[label]
        return label

    def links(self, band: int, doc: int, label: int, sketch: np.ndarray, bands: np.ndarray, bag: tuple) -> Iterator[tuple[int, int]]:
        """Links of the row to held ones that it isn't connected to yet.  A pair is tested in its first common band only."""
        agree = (self.sketches[:self.n] == sketch).sum(axis=1)
        at = np.flatnonzero((agree >= SURE) & (self.labels[:self.n] != label))
        at = at[(self.bands[at] == bands).argmax(axis=1) == np.flatnonzero(bands == band)[0]] if len(at) else at
        for i in at[np.argsort(-agree[at], kind="stable")]:
            mine, other = self.root(label), self.root(int(self.labels[i]))
            if mine != other and is_link(*similarity(self.bags[i], bag)):
                self.joined[max(mine, other)] = min(mine, other)
                yield int(self.docs[i]), doc


def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, salt, main, doc, label, sketch, bands, text), sorted so that a bucket's main component comes last, to
    links (a, b) between components.  Only the rows outside the main component are held; the others stream past them."""
    group, held = None, Held()
    for batch in batches:
        out = []
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for band, salt, main, doc, label, sketch, bands, text in zip(*(part.column(c).to_pylist() for c in range(8))):
                if group != (band, salt):
                    group, held = (band, salt), Held()
                if main and not held.n:
                    continue
                one, own, bag = np.frombuffer(sketch, np.uint8), np.array(bands), shingles(text)[:2]
                out += held.links(band, doc, label, one, own, bag)
                if not main:
                    held.add(doc, label, one, own, bag)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*out)) or [[], []]], names=["a", "b"])


def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hub, salt, member, text), the hub's own (member null) before its members, to links (a, b, similarity)."""
    hub = hub_elements = hub_counts = None
    for batch in batches:
        out = []
        for a, salt, member, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
            elements, counts, _ = shingles(text)
            if member is None:
                hub, hub_elements, hub_counts = (a, salt), elements, counts
                continue
            assert hub == (a, salt)
            both, total = similarity((hub_elements, hub_counts), (elements, counts))
            if is_link(both, total):
                out.append((a, member, both / total))
        columns = list(zip(*out)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                          pa.array(columns[2], pa.float64())], names=["a", "b", "similarity"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b, similarity) among `pairs` (a, b).  A hub with many members is dealt over several tasks with its text."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB).cast("int").alias("salts"))
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    hubs = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = hubs.join(texts, hubs["a"] == texts["doc"]).select("a", "salt", F.lit(None).cast("long").alias("member"), "text").union(
        dealt.join(texts, dealt["b"] == texts["doc"]).select("a", "salt", "b", "text"))
    return (rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("member").asc_nulls_first())
            .mapInArrow(overlap, "a bigint, b bigint, similarity double"))


def _between(members: DataFrame, known: DataFrame, different: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components `known` (node, label) within the buckets of `members`: enough to connect what is to
    be connected, so never more than a bucket has rows.

    A bucket's main component is that of its least document.  Its rows are dealt out in parts of BUCKET, for each of which
    the rows outside it are repeated.
    """
    labelled = members.join(known.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    several = (labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                            F.min_by("label", "doc").alias("main_label"), F.count("*").alias("size"))
               .filter("low < high").select("band", "main_label", F.ceil(F.col("size") / BUCKET).cast("int").alias("salts")))
    rows = stored(labelled.join(several, "band").select(
        "band", "salts", (F.col("label") == F.col("main_label")).alias("main"), "doc", "label"))
    salted = rows.filter("main").withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int")).union(
        rows.filter("not main").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    whole = salted.join(different.select("doc", "sketch", "bands"), "doc").join(texts, "doc")
    return (whole.select("band", "salt", "main", "doc", "label", "sketch", "bands", "text").repartition("band", "salt")
            .sortWithinPartitions("band", "salt", "main", "doc").mapInArrow(across, "a bigint, b bigint"))


def near_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc, class_id, copies): every row's key (doc_id, null as the least long), the least key of its class, and how many
    documents have its very words."""
    if own_ids(docs, doc_id):
        return classes_of(docs.select(F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)).alias("doc"), docs[text].alias("text")))
    rows = numbered(docs, text, doc_id)
    ids = rows.select("doc", F.coalesce(F.col(f"row.{doc_id}").cast("long"), F.lit(NO_ID)).alias("id"))
    classes = stored(classes_of(rows.select("doc", F.col(f"row.{text}").alias("text"))))
    # The least key of a class has the least id; a class is one row here, its members many.
    sizes = classes.groupBy("class_id").agg(F.count("*").alias("members"))
    named = sizes.join(ids, sizes["class_id"] == ids["doc"]).select("class_id", "members", F.col("id").alias("class"))
    found = join_counted(classes.join(ids, "doc"), named, "class_id", "members", classes.count())
    return found.select(F.col("id").alias("doc"), F.col("class").alias("class_id"), "copies")


def classes_of(texts: DataFrame) -> DataFrame:
    """(doc, class_id, copies) of `texts` (doc, text), in which each doc is there once."""
    signed = stored(texts.mapInArrow(sign, "doc bigint, words binary, bands array<bigint>, sketch binary"))
    total = signed.count()
    different = stored(signed.groupBy("words").agg(F.min("doc").alias("doc"), F.count("*").alias("copies"),
                                                   F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")))
    banded = different.select("doc", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("doc").alias("least"), F.count("*").alias("n")).filter("n > 1")
    members = stored(join_counted(banded, buckets, "band", "n", BANDS * total).filter("n is not null"))
    sketches = different.select("doc", "sketch")

    def likely(pairs: DataFrame) -> DataFrame:
        a = sketches.select(F.col("doc").alias("a"), F.col("sketch").alias("sketch_a"))
        b = sketches.select(F.col("doc").alias("b"), F.col("sketch").alias("sketch_b"))
        return pairs.join(a, "a").join(b, "b").filter(_agreeing("sketch_a", "sketch_b") >= SURE).select("a", "b")

    # First every document meets the one least document that it shares most of its buckets with.
    leaders = members.filter("doc > least").groupBy("doc", "least").agg(F.count("*").alias("bands"))
    leader = F.max(F.struct("bands", (-F.col("least")).alias("minus")))
    first = saved(likely(leaders.groupBy("doc").agg((-leader["minus"]).alias("a")).withColumnRenamed("doc", "b").select("a", "b")))
    wanted = members.select("doc").distinct()
    pool = stored(texts.join(wanted, "doc"))
    links = saved(verified(first, pool).select("a", "b"))
    # Then the components that still share a bucket.
    rest = saved(_between(members, components(links), different, pool).distinct())
    label = components(links.union(rest)).withColumnsRenamed({"node": "doc"})
    classes = stored(different.select("words", "doc", "copies").join(label, "doc", "left")
                     .select("words", F.coalesce("label", "doc").alias("class_id"), "copies"))
    return join_counted(signed.select("doc", "words"), classes, "words", "copies", total).select("doc", "class_id", "copies")


def one_per_class(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that come first in their class by id, columns unchanged; of those that share the least id one stays."""
    rows = numbered(docs, text, doc_id)
    keep = classes_of(rows.select("doc", F.col(f"row.{text}").alias("text"))).filter("doc = class_id").select("doc")
    return rows.join(keep, "doc").select("row.*")
