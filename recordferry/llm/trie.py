"""Prefix trie of conversations by truncation peeling.

A conversation becomes a path: for each depth the 128-bit chained digest of its turns so far, and the bytes of the turn's text.
Conversations of one path are counted first, so a path goes on as one row.  Rows sorted by path lie as the trie's depth-first
order does; they are dealt by range and peeled in blocks of a bounded number of turns: from the greatest depth down, the paths
that newly end at a depth are merged with the nodes that survived from below, every node is finished and emitted, its last turn
is stripped, and what is left is regrouped by the parent, which takes over counts and sums.  So nodes are found and aggregated
in the same pass, with as many steps inside a block as it is deep and none between tasks.

Only nodes on the first and the last path of a block may go on in another block.  They are not finished there: the block hands
on their sums so far, and the same peeling is run over what the tasks hand on, two paths per task.  No group is ever gathered:
a prefix that a third of all conversations share spans many ranges.

Turns are ordered by turn (null first), ties by the digest of role and text; repeated rows are turns of their own; null role or
text is empty; rows of a null conversation id belong to no conversation and are left out; other columns do not matter.  An empty
table gives no nodes.  A task holds the digests of one conversation's turns (24 bytes each), not their texts.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.llm.common import join_counted, stored

KEY = 16             # bytes of a prefix digest
BLOCK = 100_000      # turns in a block
IDS = 50_000         # ids in a chunk that is hashed
NOBODY = (1 << 63) - 1
STATE = "<5q?32s"    # sums of a node, whether conversations end there, their digest


def paths(turns: DataFrame, family: Column | None = None, taken: Callable[[int], int] = lambda conv: 0) -> DataFrame:
    """conv_id, depth, path, sizes from rows (conv_id, turn, role, text).

    With `family`, the first taken(c) turns of a conversation c are those of the conversation whose id is its family (as many as
    that has, none if it is absent); its own turns after as many follow.
    """
    role, text = F.coalesce(turns["role"], F.lit("")), F.coalesce(turns["text"], F.lit(""))
    conv = turns["conv_id"].cast("long")
    of = conv if family is None else family
    mark = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.filter(conv.isNotNull()).select(
        of.cast("long").alias("family"), conv.alias("conv_id"), turns["turn"].alias("turn"), mark.alias("mark"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = ["family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "mark"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, giver, given = None, None, []
        own: list[tuple[bytes, int]] = []
        out: list[tuple] = []

        def close() -> None:
            nonlocal giver, given
            of, conv = now
            if conv == of:
                giver, given = of, own
            n = taken(conv)
            whole = (given[:n] if giver == of else []) + own[n:]
            chain, keys = b"", []
            for mark, _ in whole:
                chain = hashlib.blake2b(chain + mark, digest_size=KEY).digest()
                keys.append(chain)
            out.append((conv, len(whole), b"".join(keys), struct.pack(f"<{len(whole)}q", *[size for _, size in whole])))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[], [], [], []]
            out.clear()
            return pa.record_batch({"conv_id": pa.array(columns[0], pa.int64()), "depth": pa.array(columns[1], pa.int64()),
                                    "path": pa.array(columns[2], pa.binary()), "sizes": pa.array(columns[3], pa.binary())})

        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("family", "conv_id", "mark", "bytes")]):
                if row[:2] != now:
                    if now is not None:
                        close()
                    now, own = row[:2], []
                own.append(row[2:])
            yield flush()
        if now is not None:
            close()
        yield flush()

    return rows.repartition("family").sortWithinPartitions(*order).mapInArrow(
        run, "conv_id bigint, depth bigint, path binary, sizes binary")


def ends_digests(convs: DataFrame) -> DataFrame:
    """(leaf, ends): SHA-256 of the decimal ids, ascending and comma-joined, of the conversations (leaf, conv_id) of each leaf.

    Ids are sorted over all tasks and joined to chunks there, so only strings of a leaf with very many ids meet, one at a time.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, ids, out = None, [], []

        def close() -> None:
            if ids:
                out.append((leaf, ids[0], ",".join(map(str, ids)).encode()))
                ids.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[], [], []]
            out.clear()
            return pa.record_batch({"leaf": pa.array(columns[0], pa.binary()), "first": pa.array(columns[1], pa.int64()),
                                    "ids": pa.array(columns[2], pa.binary())})

        for batch in batches:
            for key, conv in zip(batch["leaf"].to_pylist(), batch["conv_id"].to_pylist()):
                if key != leaf or len(ids) >= IDS:
                    close()
                    leaf = key
                ids.append(conv)
            yield flush()
        close()
        yield flush()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, digest = None, None
        for batch in batches:
            keys, ends = [], []
            for key, ids in zip(batch["leaf"], batch["ids"]):
                if key.as_py() != leaf:
                    if digest is not None:
                        keys.append(leaf)
                        ends.append(digest.digest())
                    leaf, digest = key.as_py(), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_buffer())
            yield pa.record_batch({"leaf": pa.array(keys, pa.binary()), "ends": pa.array(ends, pa.binary())})
        if digest is not None:
            yield pa.record_batch({"leaf": pa.array([leaf], pa.binary()), "ends": pa.array([digest.digest()], pa.binary())})

    parts = (convs.select("leaf", "conv_id").repartitionByRange("leaf", "conv_id").sortWithinPartitions("leaf", "conv_id")
             .mapInArrow(chunks, "leaf binary, first bigint, ids binary"))
    return (parts.repartition("leaf").sortWithinPartitions("leaf", "first")
            .mapInArrow(hashed, "leaf binary, ends binary"))


class Node:
    """Sums of a node: conversations, the least of them, children, childless nodes below, bytes saved below, digest of its ends."""

    __slots__ = ("n", "least", "kids", "leaves", "saved", "ends", "path", "depth", "size", "waited")

    def __init__(self, path: bytes, depth: int, size: int):
        self.path, self.depth, self.size = path, depth, size
        self.n, self.least, self.kids, self.leaves, self.saved, self.ends = 0, NOBODY, 0, 0, 0, None
        self.waited = False  # handed on by an earlier block, which finished some of its children

    def add(self, n: int, least: int, kids: int, leaves: int, saved: int) -> None:
        self.n += n
        self.least = min(self.least, least)
        self.kids += kids
        self.leaves += leaves
        self.saved += saved

    def packed(self) -> bytes:
        return struct.pack(STATE, self.n, self.least, self.kids, self.leaves, self.saved, self.ends is not None, self.ends or b"")


NOTHING = struct.pack(STATE, 0, NOBODY, 0, 0, 0, False, b"")


def key_at(path: bytes, depth: int) -> bytes:
    return path[KEY * (depth - 1):KEY * depth] if depth else b""


def size_at(sizes: bytes, depth: int) -> int:
    return struct.unpack_from("<q", sizes, 8 * (depth - 1))[0] if depth else 0


def peel(rows: list[tuple], edges: tuple[tuple[bytes, bytes], ...]) -> tuple[list[tuple], list[tuple]]:
    """(finished nodes, rows handed on) of rows (path, sizes, n, least, ends, states).

    A row has either the conversations that end with its path, or the packed sums of all nodes on its path.  Nodes on the paths
    of `edges` (path, sizes) are not finished.
    """
    levels: list[dict[bytes, Node]] = [{} for _ in range(max(len(r[0]) for r in rows) // KEY + 1)]

    def at(path: bytes, sizes: bytes, depth: int) -> Node:
        key = key_at(path, depth)
        node = levels[depth].get(key)
        if node is None:
            node = levels[depth][key] = Node(path, depth, size_at(sizes, depth))
        return node

    size_of = {}
    for path, sizes, n, least, ends, states in rows:
        size_of[path] = sizes
        if states is None:
            node = at(path, sizes, len(path) // KEY)
            node.add(n, least, 0, 0, 0)
            node.ends = ends
        else:
            for depth, (*sums, has, digest) in enumerate(struct.iter_unpack(STATE, states)):
                node = at(path, sizes, depth)
                node.add(*sums)
                node.waited = True
                if has:
                    node.ends = digest
    held = {(depth, key_at(path, depth)) for path, _ in edges for depth in range(len(path) // KEY + 1)}
    done = []
    for depth in range(len(levels) - 1, -1, -1):
        finished = []
        for key, node in levels[depth].items():
            if (depth, key) in held:
                continue
            if not node.kids:
                node.leaves = 1
            node.saved += (node.n - 1) * node.size
            parent = None
            if depth:
                parent = at(node.path, size_of[node.path], depth - 1)
                parent.add(node.n, node.least, 1, node.leaves, node.saved)
            finished.append((key, node, parent))
        for key, node, parent in finished:  # all children are in: the least conversation of a parent that can be finished is known
            above = None if parent is None else key_at(node.path, depth - 1)
            known = parent is not None and (depth - 1, above) not in held
            done.append((key, node.least, depth, above, parent.least if known else None, node.n, node.kids, node.leaves,
                         node.saved, node.ends, node.waited))
    passed, taken = [], set()
    for path, sizes in dict.fromkeys(edges):
        states = []
        for depth in range(len(path) // KEY + 1):
            place = depth, key_at(path, depth)
            node = None if place in taken else levels[depth].get(place[1])
            taken.add(place)
            states.append(NOTHING if node is None else node.packed())
        passed.append((path, sizes, None, None, None, b"".join(states)))
    return done, passed


NODE = ("key binary, conv_id bigint, depth bigint, parent binary, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends binary, waited boolean")
HANDED = "path binary, sizes binary, states binary"


def _peeled(last: bool) -> Callable:
    """Peels a task's rows (path, sizes, n, least, ends, states), sorted by path; `last`: nothing lies outside this task."""
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.binary(), pa.bool_(), *[pa.binary()] * 3]
    names = [c.split()[0] for c in f"{NODE}, {HANDED}".split(", ")]

    def table(done: list[tuple], passed: list[tuple]) -> pa.RecordBatch:
        rows = [(*d, None, None, None) for d in done] + [(*[None] * 11, p[0], p[1], p[5]) for p in passed]
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        first, turns = None, 0
        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("path", "sizes", "n", "least", "ends", "states")]):
                first = first or row[:2]
                rows.append(row)
                turns += len(row[0]) // KEY + 1
                if turns >= BLOCK:
                    done, rows = peel(rows, (first, row[:2]))
                    turns = 0
                    yield table(done, [])
        if rows:
            done, rows = peel(rows, () if last else (first, rows[-1][:2]))
            yield table(done, rows)

    return run


def build(convs: DataFrame) -> DataFrame:
    """The trie of `convs` (conv_id, depth, path, sizes), one row per node, as the module says.

    key, conv_id (least member), depth, parent (key), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends.
    """
    convs = stored(convs.withColumn("leaf", F.when(F.col("depth") > 0, F.substring("path", -KEY, KEY)).otherwise(F.lit(b""))))
    ended = convs.groupBy("leaf").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"),
                                      F.first("sizes").alias("sizes"))
    rows = stored(ended.join(ends_digests(convs), "leaf").select("path", "sizes", "n", "least", "ends"))
    sorted_rows = rows.withColumn("states", F.lit(None).cast("binary")).repartitionByRange("path").sortWithinPartitions("path")
    found = stored(sorted_rows.mapInArrow(_peeled(last=False), f"{NODE}, {HANDED}"))
    node_columns = [c.split()[0] for c in NODE.split(", ")]
    # two paths per task at most
    none = [F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("least", "long"), ("ends", "binary"))]
    handed = found.filter("states is not null").select("path", "sizes", *none, "states")
    rest = stored(handed.repartition(1).sortWithinPartitions("path").mapInArrow(_peeled(last=True), f"{NODE}, {HANDED}")
                  .select(*node_columns))
    nodes = found.filter("conv_id is not null").select(*node_columns).unionByName(rest)
    # children that were finished in an earlier block than their parent
    orphan = F.col("parent").isNotNull() & F.col("parent_conv_id").isNull()
    orphans = nodes.filter(orphan)
    parents = nodes.filter("waited").select(F.col("key").alias("parent"), F.col("conv_id").alias("above"), F.col("n_children").alias("rows"))
    adopted = join_counted(orphans, parents, "parent", "rows", orphans.count()).withColumn("parent_conv_id", F.col("above"))
    return nodes.filter(~orphan).unionByName(adopted.select(*node_columns)).drop("waited")


def ends_text(ends: Column) -> Column:
    """Lowercase hexadecimal digits; those of the empty string where no conversation ends."""
    return F.coalesce(F.lower(F.hex(ends)), F.lit(hashlib.sha256(b"").hexdigest()))
