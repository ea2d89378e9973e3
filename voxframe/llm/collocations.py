"""Phrase collocations by prefix-free parsing.

Words chosen by their hash, and the ends of pieces, cut the corpus into chunks that overlap by one word less than the longest phrase.
Equal chunks are kept once, with the number of their occurrences in the parse. Phrases are then counted inside distinct
chunks, weighted; those that begin in a chunk's overlap belong to the next chunk and are counted there alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered_batches, remove, slices, staged
from .wordhash import _LOWER, Words, gathered, mix, span_hashes, text_bytes

SLICE = 1 << 21
BITS = 26
SALTS = 64
UNKNOWN = "und"
_SPACE, _STOP, _ONLY = (np.zeros(256, dtype=bool) for _ in range(3))
_SPACE[[9, 32]] = True
_STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_ONLY[32] = True


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _parse(longest: int, every: int) -> Callable:
    """The chunks of a task's documents: lang, tail (overlapping words at the end), chunk, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            raw, offsets = text_bytes(pc.binary_join_element_wise(batch.column("text"), "", "\n"))
            raw = _LOWER[raw]
            stop = _STOP[raw]
            inside = np.r_[False, ~(stop | _SPACE[raw]), False]
            start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
            if not len(start):
                continue
            piece = np.cumsum(stop)[start]
            first = np.r_[True, piece[1:] != piece[:-1]]
            begins = np.flatnonzero(first | (span_hashes(raw, start, end) % np.uint64(every) == 0))
            ends = np.r_[begins[1:], len(start)]
            bounds = np.r_[np.flatnonzero(first), len(start)]
            last = bounds[np.searchsorted(bounds, begins, side="right")]
            tail = np.minimum(last - ends, longest - 1)
            size = end - start + 1
            at = np.concatenate([[0], np.cumsum(size)])
            flat = raw[gathered(start, size)]
            flat[at[1:] - 1] = 32
            lengths = at[ends + tail] - at[begins] - 1
            row = np.searchsorted(offsets, start[begins], side="right") - 1
            chunks = pa.table([batch.column("lang").take(pa.array(row)), pa.array(tail.astype(np.int32)), _strings(flat[gathered(at[begins], lengths)], lengths)], ["lang", "tail", "chunk"])
            held = chunks.group_by(["lang", "tail", "chunk"]).aggregate([([], "count_all")])
            yield from pa.table([held.column("lang"), held.column("tail"), held.column("chunk").cast(pa.string()), held.column("count_all")], ["lang", "tail", "chunk", "n"]).to_batches()

    return run


class Phrases:
    """Hashes of the words of a batch of chunks or phrases, mixed with those of their language."""

    def __init__(self, lang: pa.Array, text: pa.Array):
        self.words = Words(text, _ONLY)
        langs = lang.dictionary_encode()
        raw, offsets = text_bytes(langs.dictionary)
        salt = span_hashes(raw, offsets[:-1], offsets[1:]) if len(langs.dictionary) else np.zeros(0, np.uint64)
        self.langs, self.lang, count = langs.dictionary, langs.indices.to_numpy(), np.diff(self.words.rows)
        self.row = np.repeat(np.arange(len(count)), count)
        self.hash = mix(self.words.hash ^ salt[self.lang[self.row]])

    def grams(self, at: np.ndarray, order: int) -> np.ndarray:
        x = np.zeros(len(at), dtype=np.uint64)
        for i in range(order):
            x = mix(x + self.hash[at + i])
        return x


def _marks(order: int) -> Callable:
    """The cells of a bit table that phrases of `order` words set: cell, bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = Phrases(batch.column("lang"), batch.column("phrase"))
            h = p.grams(p.words.rows[:-1], order) >> np.uint64(64 - BITS)
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (h & np.uint64(63))).view(np.int64))], ["cell", "bits"])

    return run


def _bit_table(phrases: DataFrame, order: int):
    """A table of 2 ** BITS bits in which all given phrases are marked: it can only let through too many."""
    got = phrases.mapInArrow(_marks(order), "cell int, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), dtype=np.int64)
    table[got.column("cell").to_numpy()] = got.column("bits").to_numpy()
    return phrases.sparkSession.sparkContext.broadcast(table.view(np.uint64))


def _marked(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    h = h >> np.uint64(64 - BITS)
    return (table[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def _count(order: int, table) -> Callable:
    """Weighted counts of the phrases of `order` words in a task's chunks, if both their parts of one word less are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(gathered_batches(batches, "chunk", SLICE), "chunk", SLICE):
            p = Phrases(batch.column("lang"), batch.column("chunk"))
            rows, n = p.words.rows, batch.column("n").to_numpy()
            at = np.arange(len(p.hash))
            some = (at < rows[p.row + 1] - batch.column("tail").to_numpy()[p.row]) & (at + order <= rows[p.row + 1])
            at = at[some]
            if order > 1:
                known = np.zeros(len(p.hash) + 1, dtype=bool)
                sub = np.flatnonzero(np.arange(len(p.hash)) + order - 1 <= rows[p.row + 1])
                known[sub] = _marked(table.value, p.grams(sub, order - 1))
                at = at[known[at] & known[at + 1]]
            if not len(at):
                continue
            size = p.words.end - p.words.start
            names = _strings(p.words.raw[gathered(p.words.start, size)], size).dictionary_encode()
            codes, many = names.indices.to_numpy().astype(np.int64), len(names.dictionary)
            # equal phrases by exact codes: language, then a word at a time, renumbered so that numbers stay small
            key, sample = p.lang[p.row[at]].astype(np.int64), np.arange(len(at))
            for i in range(order):
                _, sample, key = np.unique(key * many + codes[at + i], return_index=True, return_inverse=True)
            total = np.bincount(key, weights=n[p.row[at]]).astype(np.int64)
            parts = [names.dictionary.take(pa.array(codes[at[sample] + i])) for i in range(order)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if order > 1 else parts[0]
            yield pa.RecordBatch.from_arrays([p.langs.take(pa.array(p.lang[p.row[at[sample]]])), phrase.cast(pa.string()), pa.array(total)], ["lang", "phrase", "n"])

    return run


def chunk_dictionary(docs: DataFrame, longest: int = 3, every: int = 32, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The distinct chunks of the parse: lang, tail, chunk (words with one space between), n."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parsed = rows.mapInArrow(_parse(longest, every), "lang string, tail int, chunk string, n long")
    return parsed.groupBy("lang", "tail", "chunk").agg(F.sum("n").alias("n"))


def _words(first: int, n: int) -> Column:
    return F.array_join(F.slice("w", first + 1, n), " ")


def _with_score(phrases: DataFrame, parts: dict[int, DataFrame], order: int) -> DataFrame:
    """l, r and score of the lowest-scoring cut."""
    out = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = []
    for k in range(1, order):
        for side, first, n in (("l", 0, k), ("r", k, order - k)):
            held = parts[n].select("lang", F.col("phrase").alias("_part"), F.col("n").alias(f"{side}{k}"))
            out = out.withColumn("_part", _words(first, n)).join(held, ["lang", "_part"]).drop("_part")
        out = out.withColumn("_num", wide("a") * wide("a") * F.lit(1_000_000)).withColumn("_den", wide(f"l{k}") * wide(f"r{k}"))
        out = out.withColumn(f"s{k}", F.expr("_num div _den").cast("long")).drop("_num", "_den")
        cuts.append(F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return out.select("lang", "phrase", "a", best.alias("best"), "w").select("lang", "phrase", "a", "best.l", "best.r", "best.score", "w")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, most: int = 2000, inside: int = 50, every: int = 32, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The `most` best phrases of 2 to `longest` words of each language: lang, rank, phrase, a, l, r, n, score.

    Words are runs between spaces and tabs within pieces, which end at .,;:!? and line ends; A-Z count as a-z. A null
    language is `und`, a null text empty; neither an empty text nor an empty table adds anything. Rows that repeat count as often. A phrase is a
    candidate if it occurs at least `least` times (a). Of its cuts in two the one with the least score floor(1000000 * a * a / (l * r))
    counts, the first at a tie; l and r are the counts of its parts, n the words of the language. Candidates inside a
    longer one with at least `inside` percent of their count are left out. Ties of the score go to the larger a, then to the phrase
    first in byte order. Counts are exact up to 2 ** 49. Other columns are ignored.

    A phrase can be as frequent as `least` only if its parts are: before phrases are shuffled, a table of 2 ** 26 bits
    of the frequent ones of one word less passes over the rest. It never drops a candidate.
    """
    spark = docs.sparkSession
    chunks = staged(chunk_dictionary(docs, longest, every, text_col, lang_col), "chunks")
    held: dict[int, DataFrame] = {}
    table = None
    for order in range(1, longest + 1):
        counted = chunks.mapInArrow(_count(order, table), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        if order == 1:
            words = staged(counted, "words")
            held[1] = words.filter(F.col("n") >= least)
        else:
            held[order] = staged(counted.filter(F.col("n") >= least), f"phrases-{order}")
        if order < longest:
            table = _bit_table(held[order], order)
    remove(spark, chunks)
    found = None
    for order in range(2, longest + 1):
        part = _with_score(held[order], held, order)
        for longer in range(order + 1, longest + 1):
            subs = F.explode(F.array(*(_words(i, order) for i in range(longer - order + 1))))
            around = held[longer].select("lang", "n", F.split("phrase", " ").alias("w")).select("lang", "n", subs.alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("_longer"))
            part = part.join(around, ["lang", "phrase"], "left").filter(F.coalesce(F.col("_longer") * 100 < F.col("a") * inside, F.lit(True))).drop("_longer")
        found = part if found is None else found.unionByName(part)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = found.drop("w").withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_r") <= most)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    return best.join(words.groupBy("lang").agg(F.sum("n").alias("n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
