"""Hierarchical packing of token sequences for several context sizes.

A document is tokenized and closed with one end id.  It gives up whole windows of the longest tier first; what is left is
routed to the shortest tier that holds it.  Each tier is packed, longest pieces first, and the gap that a piece leaves in its
window is filled from shorter tiers, a piece being cut where it is longer than the gap.  Every window so ends exactly full,
and since windows are powers of two, it carries no padding.  Windows of one tier form step groups of equal token counts.

All of this happens inside a task while it streams over its documents: no shuffle, no group that grows with the corpus, a
buffer of `BUFFER` pieces per task.  What the buffer still holds when a task ends is laid into a ladder of falling powers of
two, so a task adds a few short windows and no padding either.  A lost task repeats the same split and so the same ids.

Null or empty text is the end id alone.  Repeated rows are packed as rows of their own.  An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TIERS = (1024, 512, 256)
STEP_TOKENS = 8 * 1024
BUFFER = 4096
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, window int, step_group bigint")


class Encoder:
    """Ids of whole texts, as little-endian bytes of unsigned 32-bit numbers.

    `path` is the vocabulary for `tokenizers`; with `ranks`, the same vocabulary as tiktoken ranks, texts are encoded by the
    faster library, to the same ids.  Texts that hold a special token's string, and those on which the faster library panics, go to the
    tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as lines:
                known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(self, text: str) -> bytes:
        ids = None
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                ids = self.fast.encode_ordinary(text)
            except BaseException as error:  # its pattern matcher panics on very long runs of white space
                if type(error).__name__ != "PanicException":
                    raise
        if ids is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


class Packer:
    """Packs pieces (doc_id, ids as bytes, start, length, document's tokens) into windows; `rows` collects what is placed."""

    def __init__(self, first_id: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, buffer: int = BUFFER):
        self.tiers, self.step_tokens, self.buffer = sorted(tiers, reverse=True), step_tokens, buffer
        self.sequence = self.step = first_id
        self.filled: dict[int, tuple[int, int]] = {}  # window: its step group, tokens in that group
        self.waiting: dict[int, list] = {t: [] for t in self.tiers}
        self.held, self.rows = 0, []

    def place(self, window: int, pieces: list) -> None:
        group, tokens = self.filled.get(window, (-1, self.step_tokens))
        if tokens >= self.step_tokens:
            group, tokens = self.step, 0
            self.step += 1
        self.filled[window] = group, tokens + window
        offset = 0
        for doc_id, ids, start, length, doc_tokens in pieces:
            self.rows.append((doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), doc_tokens,
                              self.sequence, offset, window, group))
            offset += length
        self.sequence += 1

    def route(self, piece: tuple) -> None:
        self.waiting[next(t for t in reversed(self.tiers) if piece[3] <= t)].append(piece)
        self.held += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n, start, longest = len(ids) // 4, 0, self.tiers[0]
        while n - start >= longest:
            self.place(longest, [(doc_id, ids, start, longest, n)])
            start += longest
        if start < n:
            self.route((doc_id, ids, start, n - start, n))
        if self.held >= self.buffer:
            self.pack()

    def pack(self) -> None:
        """Full windows only; a piece whose gap can't be filled now waits on."""
        for pieces in self.waiting.values():
            pieces.sort(key=lambda p: p[3])
        for at, tier in enumerate(self.tiers):
            mine, left = self.waiting[tier], []
            while mine:
                window, gap = [mine.pop()], tier
                gap -= window[0][3]
                while gap and (shorter := next((t for t in self.tiers[at:] if self.waiting[t]), None)):
                    piece = self.fitting(self.waiting[shorter], gap)
                    if piece[3] > gap:
                        doc_id, ids, start, length, n = piece
                        self.route((doc_id, ids, start + gap, length - gap, n))
                        self.held -= 1
                        piece = (doc_id, ids, start, gap, n)
                    window.append(piece)
                    gap -= piece[3]
                if gap:
                    left += window
                else:
                    self.place(tier, window)
            self.waiting[tier] = left
        self.held = sum(map(len, self.waiting.values()))

    @staticmethod
    def fitting(pieces: list, gap: int) -> tuple:
        """The longest piece if it fits into the gap, else the shortest, which may have to be cut."""
        return pieces.pop() if pieces[-1][3] <= gap else pieces.pop(0)

    def finish(self) -> None:
        self.pack()
        rest = [p for t in self.tiers for p in self.waiting[t]]
        self.waiting, self.held = {t: [] for t in self.tiers}, 0
        total, window = sum(p[3] for p in rest), self.tiers[0]
        while total:
            while window > total:
                window //= 2
            parts, gap = [], window
            while gap:
                doc_id, ids, start, length, n = rest.pop()
                parts.append((doc_id, ids, start, min(length, gap), n))
                if length > gap:
                    rest.append((doc_id, ids, start + gap, length - gap, n))
                gap -= parts[-1][3]
            self.place(window, parts)
            total -= window

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 9
        self.rows = []
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=[c.split()[0] for c in SCHEMA.split(", ")])


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, text: str = "text", doc_id: str = "doc_id", end_id: int = 0,
         tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: SCHEMA.  `tokenizer` and `ranks` are paths of vocabulary files that every executor has."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(tokenizer, ranks), Packer(TaskContext.get().partitionId() << 33, tiers, step_tokens)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    packer.add(key, encoder.encode(value or "") + end)
                yield packer.batch()
        packer.finish()
        yield packer.batch()

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, SCHEMA)
