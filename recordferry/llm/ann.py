"""Approximate nearest neighbours: a robust-pruned directed graph per shard, beam search over every shard.

Equal vectors are one node that carries its least ids, as many as an answer can need; nodes are dealt to shards of about
SHARD by hash.  A shard's graph starts at random.  In batches, every node is searched for greedily from the medoid; of what
the beam holds, relaxed pruning keeps the nearest node and drops all that are ALPHA times nearer to it than to the node in
question, and so on up to DEGREE diverse edges, which are also offered backwards.  Queries run the same beam search, with a
wider beam, in every shard; the best of all shards are merged.  The index is a table of nodes and edges in the shared folder;
queries meet it in blocks, so a task holds one shard and one block.

Every valid vector is indexed.  Vectors that are null, zero, or hold null or non-finite numbers neither query nor answer;
vectors of different lengths do not meet.  Distances are Euclidean in double precision; ties go to the smaller id.  Repeated
rows are one, and of rows with one id and several vectors the least vector counts (`valid`).  An empty table, or fewer candidates than asked for, gives what there is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordferry.llm.common import stored

DEGREE, BEAM, QUERY_BEAM, ALPHA = 28, 64, 128, 1.2
SHARD, BLOCK, BATCH = 8192, 20000, 256


def squares(points: np.ndarray, ids: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of points[ids] (rows x n) to `to` (rows x dim); infinite where an id is -1."""
    d = points[ids] - to[:, None, :]
    out = np.einsum("rnd,rnd->rn", d, d)
    out[ids < 0] = np.inf
    return out


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances), nearest first, of the `beam` nodes reached; -1 fills up."""
    rows = np.arange(len(queries))
    ids = np.full((len(queries), beam), -1)
    ids[:, 0] = start
    far = squares(points, ids, queries)
    seen = np.zeros((len(queries), len(points) + 1), bool)  # the last column takes -1
    seen[:, [start, -1]] = True
    open_ = ids >= 0
    while open_.any():
        at = np.where(open_, far, np.inf).argmin(axis=1)
        has = open_[rows, at]
        open_[rows, at] = False
        near = np.where(has[:, None], edges[ids[rows, at]], -1)
        near = np.where(seen[rows[:, None], near], -1, near)
        seen[rows[:, None], near] = True
        all_ids, all_far = np.hstack([ids, near]), np.hstack([far, squares(points, near, queries)])
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids, far = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_far, order, 1)
        open_ = np.take_along_axis(np.hstack([open_, near >= 0]), order, 1)
    return ids, far


def prune(points: np.ndarray, of: np.ndarray, ids: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """The edges that relaxed pruning leaves for each node of `of` among its candidates `ids` (-1: none)."""
    ids = np.where(ids == of[:, None], -1, ids)
    order = np.argsort(ids, axis=1)
    ids = np.take_along_axis(ids, order, 1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    far = squares(points, ids, points[of])
    order = np.argsort(far, axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    vectors = points[ids]
    norms = np.einsum("rnd,rnd->rn", vectors, vectors)
    between = norms[:, :, None] + norms[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    rows, live = np.arange(len(of)), ids >= 0
    out = np.full((len(of), degree), -1)
    for k in range(degree):
        at = live.argmax(axis=1)
        has = live[rows, at]
        if not has.any():
            break
        out[:, k] = np.where(has, ids[rows, at], -1)
        live[rows, at] = False
        live &= ~(has[:, None] & (alpha * alpha * between[rows, at] <= far))
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, int]:
    """(edges as nodes x degree with -1 for none, medoid)."""
    n = len(points)
    rng = np.random.default_rng(seed)
    edges = rng.integers(n, size=(n, min(degree, 8)))
    edges = np.hstack([np.where(edges == np.arange(n)[:, None], -1, edges), np.full((n, degree - edges.shape[1]), -1)])
    d = points - points.mean(axis=0)
    start = int(np.einsum("nd,nd->n", d, d).argmin())
    order = rng.permutation(n)
    for lo in range(0, n, BATCH):
        batch = order[lo:lo + BATCH]
        found, _ = beam_search(points, edges, start, points[batch], beam)
        edges[batch] = prune(points, batch, np.hstack([found, edges[batch]]), degree, alpha)
        # offer the new edges backwards
        to, of = edges[batch].ravel(), np.repeat(batch, degree)
        to, of = to[to >= 0], of[to >= 0]
        by = np.argsort(to, kind="stable")
        to, of = to[by], of[by]
        nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
        offered = np.full((len(nodes), counts.max(initial=0)), -1)
        offered[np.repeat(np.arange(len(nodes)), counts), np.arange(len(to)) - np.repeat(first, counts)] = of
        for k in range(0, len(nodes), BATCH):
            part = nodes[k:k + BATCH]
            edges[part] = prune(points, part, np.hstack([edges[part], offered[k:k + BATCH]]), degree, alpha)
    return edges, start


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.values if isinstance(flat, pa.ListArray) else flat.chunk(0).values
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def valid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    rows = vectors.select(vectors[vec_id].alias("vec_id"), vectors[embedding].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(
        finite & F.exists("vector", lambda x: x != 0))
    return usable.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def index(vectors: DataFrame, k: int = 10, shard_rows: int = SHARD) -> DataFrame:
    """The index over all of `vectors` (vec_id, vector): dim, shard, at, start, vector, ids, edges."""
    # One more than k ids per vector: the query's own falls out.  The rank limit is applied before the shuffle, too.
    least = Window.partitionBy("vector").orderBy("vec_id")
    nodes = stored(vectors.distinct().withColumn("place", F.row_number().over(least)).filter(F.col("place") <= k + 1)
                   .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int").alias("shard"),
                         "vector", "ids")

    def graph(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort([i[0] for i in table["ids"].to_pylist()], kind="stable")))
        edges, start = build_graph(_matrix(table["vector"]))
        return pa.table({"dim": table["dim"], "shard": table["shard"], "at": pa.array(np.arange(len(table), dtype=np.int32)),
                         "start": pa.array(np.full(len(table), start, np.int32)), "vector": table["vector"], "ids": table["ids"],
                         "edges": pa.array(list(edges.astype(np.int32)), pa.list_(pa.int32()))})

    return stored(dealt.groupBy("dim", "shard").applyInArrow(
        graph, "dim int, shard int, at int, start int, vector array<double>, ids array<bigint>, edges array<int>"))


def search(nodes: DataFrame, queries: DataFrame, k: int = 10, beam: int = QUERY_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of `queries` (query_id, vector) the k nearest found in `nodes`, an index."""
    blocks = max(1, -(-queries.count() // BLOCK))
    shards = nodes.select(F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard")).distinct()
    asked = queries.select("query_id", F.col("vector").alias("asked"), F.size("vector").alias("of_dim"),
                           F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("of_block")).join(shards, "of_dim")
    spread = nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(graph: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if len(graph) and len(wanted):
            graph = graph.sort_by("at")
            points, asking = _matrix(graph["vector"]), _matrix(wanted["asked"])
            edges, ids = np.array(graph["edges"].to_pylist()), graph["ids"].to_pylist()
            own = wanted["query_id"].to_pylist()
            for lo in range(0, len(own), BATCH):
                found, _ = beam_search(points, edges, graph["start"][0].as_py(), asking[lo:lo + BATCH], beam)
                found = found[:, :k + 1]
                exact = np.sqrt(squares(points, found, asking[lo:lo + BATCH]))
                for query, nodes_, scores in zip(own[lo:lo + BATCH], found, exact):
                    best = sorted((s, i) for n, s in zip(nodes_, scores) if n >= 0 for i in ids[n] if i != query)
                    out += [(query, i, float(s)) for s, i in best[:k]]
        columns = list(zip(*out)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    found = (spread.groupBy("dim", "shard", "block").cogroup(asked.groupBy("of_dim", "of_shard", "of_block"))
             .applyInArrow(run, "query_id bigint, vec_id bigint, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
