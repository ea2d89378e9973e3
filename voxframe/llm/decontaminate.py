"""Benchmark decontamination: a prefix-filtered join of document shingles with windows of benchmark items.

A window lies in a document only if its rarest shingle does, so that one is its prefix: documents are joined on it alone, the
place of the shingle fixes where the window would begin, windows that would leave the document are passed over,
and the rest is compared byte by byte. Rarity is counted over all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, staged, with_text
from .wordhash import Words, gathered, mix

SLICE = 1 << 21
BLOCK = 32 << 20
CANDIDATES = 1 << 18
BITS = 22
FOUND = "doc_id long, n_words long, n_hit long, spans array<struct<start:long,length:long>>, items array<string>"
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[0x00:0x30] = _BETWEEN[0x3A:0x61] = _BETWEEN[0x7B:0x80] = True


class Spaced(Words):
    """Words of letters, digits and other than ASCII bytes, and their bytes with one space after each."""

    def __init__(self, column: pa.Array):
        super().__init__(column, _BETWEEN)
        size = self.end - self.start
        self.at = np.concatenate([[0], np.cumsum(size + 1)])
        self.flat = np.full(self.at[-1], 32, dtype=np.uint8)
        self.flat[gathered(self.at[:-1], size)] = self.raw[gathered(self.start, size)]

    def bytes(self, first: int, n: int) -> bytes:
        return self.flat[self.at[first] : self.at[first + n] - 1].tobytes()


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of `width` words in a row, from each word on."""
    n = len(words) - width + 1
    x = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(width if n > 0 else 0):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25) + words[i : n + i]
    return mix(x)


def _windows(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE // 8):
            w = Spaced(batch.column("text"))
            n = np.diff(w.rows)
            width = np.minimum(n, window)
            count = np.where(n > 0, n - width + 1, 0)
            first = gathered(w.rows[:-1], count)
            width = np.repeat(width, count)
            texts = [w.bytes(i, k).decode("utf-8") for i, k in zip(first.tolist(), width.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(width, pa.int32()), batch.column("item_id").take(pa.array(np.repeat(np.arange(len(n)), count)))], ["window", "n", "item_id"])

    return run


class Block:
    """A bounded number of windows: their words, shingles, items, and after `rank` the rarest shingle of each."""

    def __init__(self, pairs: pa.Table, shingle: int):
        names = pairs.column("window").combine_chunks().dictionary_encode()
        self.items = pairs.column("item_id").to_pylist()
        codes = names.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        self.members, self.edges = order, np.searchsorted(codes[order], np.arange(len(names.dictionary) + 1))
        w = Spaced(names.dictionary)
        self.n, self.flat = np.diff(w.rows), w.flat
        self.first, self.size = w.at[w.rows[:-1]], w.at[w.rows[1:]] - w.at[w.rows[:-1]]
        self.hash, self.rows = w.hash, w.rows
        self.width = np.minimum(self.n, shingle)
        held = []
        for width in np.unique(self.width):
            mine = np.flatnonzero(self.width == width)
            count = self.n[mine] - width + 1
            owner = np.repeat(mine, count)
            offset = gathered(np.zeros(len(mine), np.int64), count)
            held.append((np.full(len(owner), width), owner, offset, grams(w.hash, int(width))[w.rows[owner] + offset]))
        self.of, self.owner, self.offset, self.key = (np.concatenate(x) for x in zip(*held, strict=True))
        self.keys = {int(width): np.unique(self.key[self.of == width]) for width in np.unique(self.of)}

    def rank(self, counts: dict[int, np.ndarray]) -> None:
        """Keep of each window its rarest shingle, given how often each of `keys` occurs; windows with one that never does go."""
        n = np.zeros(len(self.key), dtype=np.int64)
        for width, keys in self.keys.items():
            mine = self.of == width
            n[mine] = counts[width][np.searchsorted(keys, self.key[mine])]
        order = np.lexsort((self.offset, n, self.owner))
        first = order[np.flatnonzero(np.r_[True, self.owner[order][1:] != self.owner[order][:-1]])]
        first = first[n[first] > 0]
        first = first[np.lexsort((self.key[first], self.of[first]))]
        self.of, self.owner, self.offset, self.key = self.of[first], self.owner[first], self.offset[first], self.key[first]
        self.keys = {int(width): np.unique(self.key[self.of == width]) for width in np.unique(self.of)}


class _Filter:
    """Which of many hashes are among sorted keys: a bit table first, then a search."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.shift = keys, np.uint64(64 - BITS)
        self.bits = np.zeros(1 << BITS, dtype=bool)
        self.bits[(keys >> self.shift).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `hashes`, and the place of each among the keys."""
        some = np.flatnonzero(self.bits[(hashes >> self.shift).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[some]), len(self.keys) - 1)
        same = self.keys[at] == hashes[some]
        return some[same], at[same]


def _counts(block) -> Callable:
    """How often each shingle of the block's windows occurs in the documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = block.value.keys
        filters, total = {k: _Filter(v) for k, v in keys.items()}, {k: np.zeros(len(v), np.int64) for k, v in keys.items()}
        for batch in slices(batches, "text", SLICE):
            w = Words(batch.column("text"), _BETWEEN)
            for width, f in filters.items():
                at, slot = f.find(grams(w.hash, width))
                # shingles that run into the next document don't count
                inside = w.rows[np.searchsorted(w.rows, at, side="right")] >= at + width
                total[width] += np.bincount(slot[inside], minlength=len(f.keys))
        for width, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), width), pa.int32()), pa.array(some, pa.int32()), pa.array(n[some], pa.int64())], ["width", "slot", "n"])

    return run


def _matches(block: Block, filters: dict[int, _Filter], w: Spaced) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of all occurrences of windows within rows."""
    begins, wins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for width, f in filters.items():
        at, slot = f.find(grams(w.hash, width))
        mine = np.flatnonzero(block.of == width)
        low, high = (np.searchsorted(block.key[mine], f.keys[slot], side=s) for s in ("left", "right"))
        done = np.concatenate([[0], np.cumsum(high - low)])
        cut = 0
        while cut < len(at):
            upto = max(cut + 1, int(np.searchsorted(done, done[cut] + CANDIDATES, side="right")) - 1)
            count = (high - low)[cut:upto]
            entry = mine[gathered(low[cut:upto], count)]
            win = block.owner[entry]
            begin = np.repeat(at[cut:upto], count) - block.offset[entry]
            end = begin + block.n[win]
            row = np.searchsorted(w.rows, np.repeat(at[cut:upto], count), side="right")
            fits = (begin >= w.rows[row - 1]) & (end <= w.rows[row])
            begin, win, end = begin[fits], win[fits], end[fits]
            long = w.at[end] - w.at[begin] == block.size[win]
            begin, win = begin[long], win[long]
            same = w.flat[gathered(w.at[begin], block.size[win])] == block.flat[gathered(block.first[win], block.size[win])]
            equal = np.logical_and.reduceat(same, np.cumsum(block.size[win]) - block.size[win]) if len(win) else np.zeros(0, bool)
            begins.append(begin[equal])
            wins.append(win[equal])
            cut = upto
    return np.concatenate(begins), np.concatenate(wins)


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return edge[::2], edge[1::2]


def _found(block) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        filters = {k: _Filter(v) for k, v in held.keys.items()}
        for batch in slices(batches, "text", SLICE):
            w = Spaced(batch.column("text"))
            begin, win = _matches(held, filters, w)
            delta = np.zeros(len(w.hash) + 1, dtype=np.int64)
            np.add.at(delta, begin, 1)
            np.add.at(delta, begin + held.n[win], -1)
            hit = np.cumsum(delta[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            items: list[list[str]] = [[] for _ in range(batch.num_rows)]
            row = np.searchsorted(w.rows, begin, side="right") - 1
            order = np.argsort(row, kind="stable")
            cuts = np.flatnonzero(np.diff(row[order])) + 1
            for part in np.split(order, cuts) if len(order) else ():
                mine, r = np.unique(win[part]), row[part[0]]
                items[r] = sorted({held.items[i] for x in mine for i in held.members[held.edges[x] : held.edges[x + 1]]} - {None})
            spans = []
            for a, b in zip(w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True):
                lo, hi = _runs(hit[a:b]) if total[b] > total[a] else (np.zeros(0, int), np.zeros(0, int))
                spans.append([{"start": s, "length": e - s} for s, e in zip(lo.tolist(), hi.tolist(), strict=True)])
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.diff(w.rows), pa.int64()), pa.array(total[w.rows[1:]] - total[w.rows[:-1]], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(items, pa.list_(pa.string()))],
                [*(c for c in batch.schema.names if c != "text"), "n_words", "n_hit", "spans", "items"],
            )

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the blocks of one document put together."""
    for batch in batches:
        spans, sizes, items = [], [], []
        for parts, names in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
            own: list[list[int]] = []
            for s, e in sorted((x["start"], x["start"] + x["length"]) for part in parts for x in part):
                if own and s <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], e)
                else:
                    own.append([s, e])
            spans.append([{"start": s, "length": e - s} for s, e in own])
            sizes.append(sum(e - s for s, e in own))
            items.append(sorted({x for part in names for x in part}))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "n_hit", "spans", "items"])


def find_items(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, spans of hit words (start, length; from 0, merged), items found in it.

    Words are runs of a-z, digits and characters beyond ASCII, with A-Z as a-z. An item's windows are all its `window` consecutive
    words, or all its words if there are fewer; a document word inside any occurrence of a window is hit. Null and
    wordless texts have no words and no windows. items are ids as strings, sorted; a null id is never listed, though its windows hit
    words; rows that repeat an item id are one item, rows that repeat a document are each a row. Empty tables are fine.

    Windows are taken in blocks of about `block` bytes of texts and ids, chosen by a hash. Documents are read twice for each
    block, to count shingles and to find windows, and never shuffled; only a block is broadcast.
    """
    spark = docs.sparkSession
    texts = with_text(docs, id_col, text_col)
    source = items.select(F.col(item_col).cast("string").alias("item_id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    pairs = staged(source.mapInArrow(_windows(window), "window string, n int, item_id string").select("window", "item_id").distinct(), "benchmark-windows")
    size = pairs.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 64)).first()[0] or 0
    if not size:
        nothing = F.array().cast("array<struct<start:long,length:long>>")
        return texts.mapInArrow(_lengths, "doc_id long, n_words long").select("*", F.lit(0).cast("long").alias("n_hit"), nothing.alias("spans"), F.array().cast("array<string>").alias("items"))
    blocks = -(-size // block)
    if blocks > 1:
        texts = texts.withColumn("digest", F.sha2("text", 256))
    schema = ", ".join(f"{c} {t}" for c, t in texts.drop("text").dtypes) + FOUND[FOUND.index(",") :]
    parts: list[DataFrame] = []
    for i in range(blocks):
        got = pairs.filter(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == i).toArrow()
        if not got.num_rows:
            continue
        held = Block(got, shingle)
        counts = {k: np.zeros(len(v), np.int64) for k, v in held.keys.items()}
        n = texts.select("text").mapInArrow(_counts(spark.sparkContext.broadcast(held)), "width int, slot int, n long").groupBy("width", "slot").agg(F.sum("n").alias("n")).toArrow()
        for width in counts:
            mine = n.filter(pc.equal(n.column("width"), width))
            counts[width][mine.column("slot").to_numpy()] = mine.column("n").to_numpy()
        held.rank(counts)
        parts.append(texts.mapInArrow(_found(spark.sparkContext.broadcast(held)), schema))
    if len(parts) == 1:
        return parts[0].select("doc_id", "n_words", "n_hit", "spans", "items")
    each = reduce(DataFrame.union, parts).groupBy("doc_id", "digest", "n_words").agg(F.count("*").alias("n"), F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    copies = F.explode(F.array_repeat(F.lit(1), (F.col("n") / len(parts)).cast("int")))
    return each.select("doc_id", "n_words", "spans", "items", copies.alias("one")).drop("one").mapInArrow(_merged, FOUND)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(Words(batch.column("text"), _BETWEEN).rows), pa.int64())], ["doc_id", "n_words"])


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`find_items` as one digest per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_items(docs, items, **options)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
