"""Hierarchical multi-length packing of token sequences.

Documents are routed to tiers of context sizes (powers of two). From the longest tier down, each document opens a window of
its tier's size; the gap is filled with the best fitting documents of shorter tiers, and what no whole document fits with a
cut of one, whose rest is routed again. So every window is full. Each task packs its own documents in pools of bounded
size and hands what is left over to its next pool; the last rest is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, with_text
from .encoding import encoder

LENGTH = 4096
TIERS = (512, 1024, 2048, 4096)
POOL = 1 << 20
STEP = 64
SLICE = 1 << 21
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

Piece = tuple[int, int, int]  # document in the pool, start, length


class Pool:
    """Pieces by tier; each tier is sorted by length."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.held = tiers, [[] for _ in tiers]

    def add(self, doc: int, start: int, length: int) -> None:
        if length:
            bisect.insort(self.held[bisect.bisect_left(self.tiers, length)], (length, doc, start))

    def fit(self, tier: int, gap: int) -> Piece | None:
        """The longest piece of a tier up to `tier` that fits the gap whole."""
        for held in self.held[tier::-1]:
            at = bisect.bisect_right(held, (gap, 1 << 62, 0))
            if at:
                length, doc, start = held.pop(at - 1)
                return doc, start, length
        return None

    def cut(self, tier: int, gap: int) -> Piece | None:
        """A piece of just the gap's length, cut from the shortest that is longer."""
        for held in self.held[: tier + 1]:
            if held:
                length, doc, start = held.pop(0)
                self.add(doc, start + gap, length - gap)
                return doc, start, gap
        return None


def pack(pool: Pool) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows as (size, pieces), and the pieces of a window that could not be filled."""
    windows: list[tuple[int, list[Piece]]] = []
    for tier in range(len(pool.tiers) - 1, -1, -1):
        size, held = pool.tiers[tier], pool.held[tier]
        while held:
            length, doc, start = held.pop()
            window, gap = [(doc, start, length)], size - length
            while gap:
                piece = pool.fit(tier, gap) or pool.cut(tier, gap)
                if piece is None:
                    return windows, window
                window.append(piece)
                gap -= piece[2]
            windows.append((size, window))
    return windows, []


def powers(pieces: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """Windows of powers of two, largest first, that take all pieces in order."""
    total, rest, out = sum(p[2] for p in pieces), list(pieces), []
    for bit in range(total.bit_length() - 1, -1, -1):
        if total >> bit & 1:
            gap, window = 1 << bit, []
            while gap:
                doc, start, length = rest.pop(0)
                take = min(length, gap)
                window.append((doc, start, take))
                gap -= take
                if take < length:
                    rest.insert(0, (doc, start + take, length - take))
            out.append((1 << bit, window))
    return out


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A group for each window, so that groups hold about `step_tokens` tokens and differ little: longest first, to the lightest."""
    groups = [(0, g) for g in range(max(1, round(sum(sizes) / step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        total, g = heapq.heappop(groups)
        out[i] = g
        heapq.heappush(groups, (total + sizes[i], g))
    return out


def _pack(path: str, end_id: int, length: int, pool_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(path, True), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        docs: list[tuple[int | None, np.ndarray]] = []
        sequence, group, pool, tokens = base, base, Pool(), 0

        def emit(windows: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            nonlocal sequence, group
            groups = step_groups([size for size, _ in windows], STEP * length)
            rows = []
            for (size, window), g in zip(windows, groups, strict=True):
                offset = 0
                for doc, start, n in window:
                    doc_id, ids = docs[doc]
                    rows.append((doc_id, start, n, zlib.crc32(ids[start : start + n].astype("<u4").tobytes()), len(ids), sequence, offset, size, group + g))
                    offset += n
                sequence += 1
            group += max(groups, default=-1) + 1
            cols = list(zip(*rows, strict=True)) if rows else [()] * 9
            types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        def close(last: bool) -> pa.RecordBatch:
            nonlocal docs, pool, tokens
            windows, rest = pack(pool)
            if last:
                windows += powers(rest)
                rest = []
            out = emit(windows)
            kept = sorted({p[0] for p in rest})
            docs, pool, tokens = [docs[i] for i in kept], Pool(), sum(p[2] for p in rest)
            for doc, start, n in rest:
                pool.add(kept.index(doc), start, n)
            return out

        for batch in slices(batches, "text", SLICE):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text")), strict=True):
                docs.append((doc_id, np.append(ids, np.uint16(end_id))))
                n = len(ids) + 1
                for start in range(0, n, length):
                    pool.add(len(docs) - 1, start, min(length, n - start))
                tokens += n
                if tokens >= pool_tokens:
                    yield close(False)
        yield close(True)

    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH, pool_tokens: int = POOL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    A document is its ids and then `end_id`; null and empty texts are that id alone. Every id is in exactly one piece.
    Sequences are full windows of a tier, or powers of two; their offsets run from 0 without gaps. Ties go by order of
    reading; repeated rows and repeated or null doc_ids are documents of their own. An empty table gives no rows. A text of
    any length is cut into windows of `length`. Other columns are ignored. A task run again gives the same pieces.
    """
    if length != TIERS[-1]:
        raise ValueError("the longest tier is the window")
    return with_text(docs, id_col, text_col).mapInArrow(_pack(tokenizer, end_id, length, pool_tokens), SCHEMA)


def padding(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Sequences, ids and padding ids of a packing; a sequence that is a power of two long is not padded."""
    total = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, 0).otherwise(length - F.col("n"))
    return total.agg(F.count("*").alias("sequences"), F.sum("n").alias("ids"), F.sum(pad).alias("padding"))
