"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

All rows, as integer vectors, are sorted along a Hilbert curve and written as Parquet, one block of a bounded number of rows per
record, with zone maps: the least and greatest value in each dimension, the least id, the least and greatest label.  Interval
arithmetic over a block's zone map bounds every inner product with it from above and below.  For each anchor the blocks are
chosen whose bounds can reach what is asked for, and only those meet the anchor:

* positives, the best rows of the anchor's own label.  The best in the anchor's own block give a first bound, so blocks whose
  upper bound stays below it are not read;
* negatives, the best rows of other labels inside each positive's window of scores.  The best in the anchor's own block raise
  the window's lower end, so blocks below it or wholly above the window are not read.

Blocks that tie with a bound are read only if they hold a smaller id.  Zone maps are read without the vectors (a column of their
own); anchors are dealt in batches, and a task holds one block and one batch.  Nothing is skipped that could be an answer.

Scores are exact: in double precision where all partial sums are below 2^53, else in Python's integers, which are held to the
range of long before they are compared.  Rows with a null id or label, a null vector or a null or non-finite component (256 times it, too) take no part; vectors of
different lengths do not meet; of rows with one id, the one with the least label and vector counts.  Zero vectors take part.  An
empty table gives no rows; fewer rows than asked for are all returned.  Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordferry.llm.common import stored

BLOCK_BYTES, BATCH, ZONES = 1 << 20, 1024, 1024  # of a block's vectors; anchors in a batch; zone maps in a shard
BITS = 4                                         # of a dimension on the curve
POSITIVES, NEGATIVES = 5, 3
LOWER, UPPER = 50, 95                            # of 100: a window, as shares of the positive's score
EXACT = 2.0 ** 53
LONG = 2 ** 63 - 1


def prepared(vectors: DataFrame, label: Column, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, label, dim, vector (little-endian doubles of whole numbers): the rows that take part, one per id."""
    raw = vectors[embedding].cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), label.cast("long").alias("label"), raw.alias("v"),
                          finite.alias("finite"))
    rows = rows.filter("vec_id is not null and label is not null and v is not null and finite and size(v) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [np.floor(256 * np.array(v, float)) for v in batch["v"].to_pylist()]
            kept = np.array([bool(np.isfinite(w).all()) for w in whole], bool)
            yield pa.record_batch({"vec_id": batch["vec_id"], "label": batch["label"], "dim": pa.array([len(w) for w in whole], pa.int32()),
                                   "vector": pa.array([w.astype("<f8").tobytes() for w in whole], pa.binary())}).filter(pa.array(kept))

    whole = rows.select("vec_id", "label", "v").mapInArrow(run, "vec_id bigint, label bigint, dim int, vector binary")
    return whole.groupBy("vec_id").agg(F.min(F.struct("label", "dim", "vector")).alias("row")).select("vec_id", "row.*")


def ranges(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and greatest value in each dimension, by length of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims = np.asarray(batch["dim"])
            for dim in np.unique(dims).tolist():
                m = matrix(batch["vector"].filter(pa.array(dims == dim)), dim)
                lo, hi = found.get(dim, (m[0], m[0]))
                found[dim] = np.minimum(lo, m.min(axis=0)), np.maximum(hi, m.max(axis=0))
        for dim, (lo, hi) in found.items():
            yield pa.record_batch({"dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(range(dim), pa.int32()),
                                   "lo": pa.array(lo), "hi": pa.array(hi)})

    parts = rows.select("dim", "vector").mapInArrow(run, "dim int, at int, lo double, hi double")
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in parts.groupBy("dim", "at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("dim", "at").collect():
        lo, hi = out.setdefault(r.dim, (np.zeros(r.dim), np.zeros(r.dim)))
        lo[r["at"]], hi[r["at"]] = r.lo, r.hi
    return out


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Position on the Hilbert curve of each row of `cells` (rows x dimensions, whole numbers below 2**bits).

    The transpose form of the published method for any number of dimensions: undo excess work from the top bit down, then
    decode the Gray code; the bits of all dimensions, interleaved, are the position.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            inverted = (x[i] & q) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(inverted, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    planes = ((x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1).astype(np.uint8)  # bit, dimension, row
    packed = np.packbits(planes.reshape(bits * n, -1), axis=0)
    return [row.tobytes() for row in np.ascontiguousarray(packed.T)]


def curve_order(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """`rows` with their `place` on the curve through the range of each dimension."""
    spans = ranges(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, place = np.asarray(batch["dim"]), np.empty(batch.num_rows, object)
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                lo, hi = spans[dim]
                with np.errstate(over="ignore", invalid="ignore"):
                    share = (matrix(batch["vector"].take(pa.array(mine)), dim) - lo) / np.where(hi > lo, hi - lo, 1)
                cells = np.clip(np.nan_to_num(share) * (1 << bits), 0, (1 << bits) - 1)
                place[mine] = hilbert_keys(cells, bits)
            yield batch.append_column("place", pa.array(place.tolist(), pa.binary()))

    return rows.mapInArrow(run, "vec_id bigint, label bigint, dim int, vector binary, place binary")


ZONE = "block bigint, dim int, n int, least bigint, low_label bigint, high_label bigint, lo binary, hi binary"
BLOCK = f"{ZONE}, ids binary, labels binary, vectors binary"


def blocks(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index over `rows` of `prepared`: one record per block, zone map and content, along the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        labels: list[int] = []
        vectors: list[bytes] = []
        dim = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            if ids:
                by = np.argsort(ids, kind="stable")  # in a block, the smaller id comes first
                m = np.frombuffer(b"".join(vectors), "<f8").reshape(-1, dim)[by]
                own, kinds = np.array(ids, "<i8")[by], np.array(labels, "<i8")[by]
                yield pa.record_batch({
                    "block": pa.array([number], pa.int64()), "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
                    "least": pa.array([int(own[0])], pa.int64()), "low_label": pa.array([int(kinds.min())], pa.int64()),
                    "high_label": pa.array([int(kinds.max())], pa.int64()),
                    **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (
                        ("lo", m.min(axis=0)), ("hi", m.max(axis=0)), ("ids", own), ("labels", kinds), ("vectors", m))}})
                number += 1
                ids.clear(), labels.clear(), vectors.clear()

        for batch in batches:
            for vec_id, label, n, vector in zip(*[batch[c].to_pylist() for c in ("vec_id", "label", "dim", "vector")]):
                if n != dim or len(ids) >= max(32, block_bytes // (8 * n)):
                    yield from close()
                    dim = n
                ids.append(vec_id), labels.append(label), vectors.append(vector)
        yield from close()

    ordered = stored(curve_order(rows)).repartitionByRange("dim", "place", "vec_id").sortWithinPartitions("dim", "place", "vec_id")
    return stored(ordered.mapInArrow(run, BLOCK))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers, held to the range of long."""
    size = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if size < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LONG, LONG).astype(np.int64)


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(upper, lower): of the inner products of each row of `a` with any vector inside each box; never too tight."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    far = np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T
    slack = np.where(far < EXACT, 0, far * 1e-9)
    return up @ hi.T + down @ lo.T + slack, up @ lo.T + down @ hi.T - slack


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
    """(row, column) of each row's k greatest allowed scores, ties to the smaller column, best first."""
    n = scores.shape[1]
    if np.abs(scores).max(initial=0) >= LONG // (2 * max(n, 1)):  # too large for one key of score and column
        for row in range(len(scores)):
            at = np.flatnonzero(allowed[row])
            yield from ((row, c) for c in at[np.argsort(-scores[row, at], kind="stable")][:k].tolist())
        return
    keys = np.where(allowed, scores * n + (n - 1 - np.arange(n)), -LONG)
    top = np.argpartition(keys, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), scores.shape)
    order = np.argsort(-np.take_along_axis(keys, top, 1), axis=1, kind="stable")
    top = np.take_along_axis(top, order, 1)
    rows, at = np.nonzero(np.take_along_axis(allowed, top, 1))
    yield from zip(rows.tolist(), top[rows, at].tolist())


class Block:
    def __init__(self, record: dict):
        self.dim, self.n = record["dim"], record["n"]
        self.ids, self.labels = (np.frombuffer(record[c], "<i8") for c in ("ids", "labels"))
        self.vectors = np.frombuffer(record["vectors"], "<f8").reshape(self.n, self.dim)


ANCHOR = "anchor_id bigint, label bigint, dim int, vector binary, home bigint"


def anchors_of(index: DataFrame, every: int, k: int = POSITIVES) -> DataFrame:
    """Rows of `index` whose id is divisible by `every`: ANCHOR, and floor: the k-th best of their label in their own block.

    `floor_id` is that row's id; both are null where the block has fewer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                block = Block(record)
                mine = np.flatnonzero(block.ids % every == 0)
                scores = products(block.vectors[mine], block.vectors)
                allowed = (block.labels[mine][:, None] == block.labels) & (mine[:, None] != np.arange(block.n))
                floor: list[list] = [[] for _ in mine]
                for row, at in best(scores, allowed, k):
                    floor[row].append((int(scores[row, at]), int(block.ids[at])))
                floor = [f[-1] if len(f) == k else (None, None) for f in floor]
                yield pa.record_batch({
                    "anchor_id": pa.array(block.ids[mine]), "label": pa.array(block.labels[mine]),
                    "dim": pa.array([block.dim] * len(mine), pa.int32()),
                    "vector": pa.array([v.tobytes() for v in block.vectors[mine]], pa.binary()),
                    "home": pa.array([record["block"]] * len(mine), pa.int64()),
                    "floor": pa.array([f[0] for f in floor], pa.int64()), "floor_id": pa.array([f[1] for f in floor], pa.int64())})

    return index.mapInArrow(run, f"{ANCHOR}, floor bigint, floor_id bigint")


def choose(index: DataFrame, anchors: DataFrame, kind: str) -> DataFrame:
    """(block, anchor_id): the blocks that each anchor must read, by the zone maps of `index`.

    kind "positives": rows of the anchor's label that reach its floor.  kind "negatives": rows of another label inside one of
    its windows (array of lows and their ids, array of highs).
    """
    zones = index.select("block", "dim", "n", "least", "low_label", "high_label", "lo", "hi")
    n_blocks, n_anchors = zones.count(), anchors.count()
    shards, batches = max(1, -(-n_blocks // ZONES)), max(1, -(-n_anchors // BATCH))
    held = zones.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")).withColumn(
        "batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    asked = anchors.withColumn("batch", F.pmod(F.xxhash64("anchor_id"), F.lit(batches)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(zone: pa.Table, wanted: pa.Table) -> pa.Table:
        out_block, out_anchor = [], []
        if len(zone) and len(wanted):
            dim = zone["dim"][0].as_py()
            lo, hi, a = matrix(zone["lo"], dim), matrix(zone["hi"], dim), matrix(wanted["vector"], dim)
            upper, lower = bounds(a, lo, hi)
            least, low, high = (np.asarray(zone[c])[None] for c in ("least", "low_label", "high_label"))
            label = np.asarray(wanted["label"])[:, None]
            if kind == "positives":
                floor = np.array([-np.inf if v is None else v for v in wanted["floor"].to_pylist()])[:, None]
                floor_id = np.array([LONG if v is None else v for v in wanted["floor_id"].to_pylist()], np.int64)[:, None]
                need = (low <= label) & (label <= high) & ((upper > floor) | ((upper == floor) & (least <= floor_id)))
            else:
                need = np.zeros(upper.shape, bool)
                other = (low != label) | (high != label)
                for row, (lows, low_ids, highs) in enumerate(zip(*[wanted[c].to_pylist() for c in ("lows", "low_ids", "highs")])):
                    for w_lo, w_id, w_hi in zip(lows, low_ids, highs):
                        reach = (upper[row] > w_lo) | ((upper[row] == w_lo) & (least[0] <= w_id))
                        need[row] |= other[row] & reach & (lower[row] <= w_hi)
            rows, at = np.nonzero(need)
            out_block, out_anchor = np.asarray(zone["block"])[at], np.asarray(wanted["anchor_id"])[rows]
        return pa.table({"block": pa.array(out_block, pa.int64()), "anchor_id": pa.array(out_anchor, pa.int64())})

    return (held.groupBy("dim", "shard", "batch").cogroup(asked.groupBy("dim", "shard", "batch"))
            .applyInArrow(run, "block bigint, anchor_id bigint"))


FOUND = "anchor_id bigint, positive_id bigint, vec_id bigint, score bigint"


def read(index: DataFrame, anchors: DataFrame, chosen: DataFrame, kind: str, k: int) -> DataFrame:
    """FOUND: the k best of each chosen block for each anchor, or for each of its windows."""
    n_anchors = anchors.count()
    batches = max(1, -(-n_anchors // BATCH))
    batch = F.pmod(F.xxhash64("anchor_id"), F.lit(batches)).cast("int")
    asked = chosen.withColumnRenamed("block", "of_block").join(anchors, "anchor_id").withColumn("of_batch", batch)
    pairs = chosen.withColumn("batch", batch).select("block", "batch").distinct()
    content = index.select("block", "dim", "n", "ids", "labels", "vectors").join(pairs, "block")

    def run(content: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[int, int | None, int, int]] = []
        if len(content) and len(wanted):
            block = Block(content.to_pylist()[0])
            own, label = np.asarray(wanted["anchor_id"]), np.asarray(wanted["label"])
            scores = products(matrix(wanted["vector"], block.dim), block.vectors)
            same = label[:, None] == block.labels
            if kind == "positives":
                allowed = same & (own[:, None] != block.ids)
                out = [(int(own[r]), None, int(block.ids[c]), int(scores[r, c])) for r, c in best(scores, allowed, k)]
            else:
                lows, highs, ids = (wanted[c].to_pylist() for c in ("lows", "highs", "positive_ids"))
                for place in range(max(map(len, lows))):
                    mine = [r for r, w in enumerate(lows) if len(w) > place]
                    low, high = (np.array([w[r][place] for r in mine], np.int64)[:, None] for w in (lows, highs))
                    part = scores[mine]
                    allowed = ~same[mine] & (part >= low) & (part <= high)
                    out += [(int(own[mine[r]]), ids[mine[r]][place], int(block.ids[c]), int(part[r, c]))
                            for r, c in best(part, allowed, k)]
        columns = list(zip(*out)) or [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor_id", "positive_id", "vec_id", "score"), columns)})

    return (content.groupBy("block", "batch").cogroup(asked.groupBy("of_block", "of_batch")).applyInArrow(run, FOUND))


def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def windows(positives: DataFrame) -> DataFrame:
    """anchor_id and arrays positive_ids, scores, lows, low_ids, highs, by rank: the scores that hard negatives may have."""
    score = F.col("score").cast("decimal(38,0)")
    # whole numbers w with LOWER * score <= 100 * w <= UPPER * score
    low = F.ceil(score * LOWER / F.lit(100).cast("decimal(3,0)")).cast("long")
    high = F.floor(score * UPPER / F.lit(100).cast("decimal(3,0)")).cast("long")
    row = F.struct("rank", F.col("vec_id").alias("id"), "score", low.alias("low"), high.alias("high"))
    each = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.when(low <= high, row))).alias("w"))
    return each.select("anchor_id", F.col("w.id").alias("positive_ids"), F.col("w.score").alias("scores"), F.col("w.low").alias("lows"),
                       F.transform("w", lambda w: F.lit(LONG)).alias("low_ids"), F.col("w.high").alias("highs"))


def raised(asked: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """`asked` with the lower end of a window, for choosing blocks, at the k-th best score that `seeds` have in it."""
    at_k = ranked(seeds, ["anchor_id", "positive_id"], k).filter(F.col("rank") == k)
    known = at_k.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("positive_id", F.struct("score", "vec_id")))).alias("known"))
    found = F.transform("positive_ids", lambda p: F.col("known")[p])
    return (asked.join(known, "anchor_id", "left").withColumn("found", found)
            .withColumn("lows", F.transform("lows", lambda low, i: F.coalesce(F.get("found", i)["score"], low)))
            .withColumn("low_ids", F.transform("low_ids", lambda low, i: F.coalesce(F.get("found", i)["vec_id"], low)))
            .drop("known", "found"))


def mine(index: DataFrame, every: int, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive with negatives."""
    anchors = stored(anchors_of(index, every, positives))
    near = stored(ranked(read(index, anchors, stored(choose(index, anchors, "positives")), "positives", positives), ["anchor_id"], positives))
    asked = stored(anchors.select("anchor_id", "label", "dim", "vector", "home").join(windows(near), "anchor_id"))
    seeds = read(index, asked, asked.select(F.col("home").alias("block"), "anchor_id"), "negatives", negatives)
    narrowed = stored(raised(asked, seeds, negatives))
    found = read(index, asked, stored(choose(index, narrowed, "negatives")), "negatives", negatives)
    scores = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (ranked(found, ["anchor_id", "positive_id"], negatives).join(scores, ["anchor_id", "positive_id"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
