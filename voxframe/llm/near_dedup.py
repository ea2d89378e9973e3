"""MinHash near-duplicate classes: one-permutation hashing with optimal densification, banded buckets, star edges.

1. One pass computes each document's set of word shingles, a 128-bit key of the set and its band keys. Documents with the
   same set form one class, so thousands of copies continue as one row.
2. Every bucket links its members to its smallest class only: edges grow with the rows, not with their square.
3. Each edge is confirmed on the full shingle sets, and confirmed edges give components.
4. Star edges also give families, the classes reachable through buckets. Where a family holds several components, its
   members are compared with each other in bounded blocks: block pairs whose set sizes rule a link out are never formed,
   and shingles that no other member of a block pair has bound the similarity of the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, slices, sorted_groups, staged, with_text
from .graph import connected_components
from .wordhash import Words, mix, shingles

SLICE = 1 << 20
BLOCK = 192
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    return np.unique(shingles(words, k))


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: sums of two mixes of its members."""
    with np.errstate(over="ignore"):
        a, b = mix(s).sum(dtype=np.uint64), mix(s ^ _GOLD).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(a.astype(np.int64)), int(b.astype(np.int64))


class Signer:
    """Band keys of a set: one permutation cut into bins, empty bins filled from bins picked by a hash of bin and attempt."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.donors: list[np.ndarray] = []

    def _donor(self, attempt: int) -> np.ndarray:
        while len(self.donors) <= attempt:
            seed = np.arange(self.bins, dtype=np.uint64) * _GOLD + np.uint64(len(self.donors) + 1)
            self.donors.append((mix(seed) % np.uint64(self.bins)).astype(np.int64))
        return self.donors[attempt]

    def __call__(self, s: np.ndarray) -> np.ndarray:
        x = mix(s ^ np.uint64(0xA0761D6478BD642F))
        place = ((x >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        empty = np.uint64(0xFFFFFFFFFFFFFFFF)
        bins = np.full(self.bins, empty, dtype=np.uint64)
        np.minimum.at(bins, place, x)
        full = np.zeros(self.bins, dtype=bool)
        full[place] = True
        source, todo, attempt = np.arange(self.bins), np.flatnonzero(~full), 0
        while len(todo):
            pick = self._donor(attempt)[todo]
            hit = full[pick]
            source[todo[hit]] = pick[hit]
            todo, attempt = todo[~hit], attempt + 1
        grid = bins[source].reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64) * _GOLD
        for i in range(self.rows):
            key = mix(key ^ grid[:, i])
        return key.view(np.int64)


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows)
        for batch in slices(batches, "text", SLICE):
            words = Words(batch.column("text"))
            n, hi, lo, keys = [], [], [], []
            for i in range(batch.num_rows):
                s = shingle_set(words.row(i), k)
                a, b = set_key(s)
                n.append(len(s))
                hi.append(a)
                lo.append(b)
                keys.append(signer(s) if len(s) else np.zeros(0, np.int64))
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("doc_id"), batch.column("print"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], ["row_id", "doc_id", "print", "n_shingles", "hi", "lo", "bands"])

    return run


def _sets(k: int):
    """The sets of rows whose text still has the wanted key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = Words(batch.column("text"))
            cls, hi, lo = (batch.column(c).to_pylist() for c in ("cls", "hi", "lo"))
            out, raw = [], []
            for i in range(batch.num_rows):
                s = shingle_set(words.row(i), k)
                if set_key(s) == (hi[i], lo[i]):
                    out.append(cls[i])
                    raw.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(raw, pa.binary())], ["cls", "members"])

    return run


def similar(inter: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (a + b - inter)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in (x, y))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                at = np.searchsorted(x, y)
                inter = np.count_nonzero(x[np.minimum(at, len(x) - 1)] == y)
                keep.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def block_links(cls: np.ndarray, comp: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int, cells: int = 1 << 23) -> list[tuple[int, int]]:
    """Pairs of components that some link joins. side: 0 compares all rows, else only rows of different sides."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.r_[True, flat[1:] != flat[:-1]]
    ident = np.cumsum(first) - 1
    shared = np.bincount(ident)[ident] > 1
    # shingles that no other row here has can't be in an intersection
    core = np.bincount(owner[shared], minlength=len(sets))
    live = np.flatnonzero(100 * core >= percent * size)
    if len(live) < 2:
        return []
    place = np.full(len(sets), -1)
    place[live] = np.arange(len(live))
    ok = shared & (place[owner] >= 0)
    _, col = np.unique(ident[ok], return_inverse=True)
    row, width = place[owner[ok]], int(col.max()) + 1 if ok.any() else 0
    inter = np.zeros((len(live), len(live)), dtype=np.float32)
    step = max(1, cells // len(live))
    for at in range(0, width, step):
        part = (col >= at) & (col < at + step)
        dense = np.zeros((len(live), min(step, width - at)), dtype=np.float32)
        dense[row[part], col[part] - at] = 1
        inter += dense @ dense.T
    n, c, d = size[live], comp[live], side[live]
    linked = similar(inter.astype(np.int64), n[:, None], n[None, :], percent) & (c[:, None] != c[None, :])
    if d.any():
        linked &= d[:, None] != d[None, :]
    a, b = np.nonzero(np.triu(linked, 1))
    return sorted({(max(x, y), min(x, y)) for x, y in zip(c[a].tolist(), c[b].tolist(), strict=True)})


def _residual(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["fam", "bucket", "step", "h0", "h1"]):
            sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in t.column("members")]
            cls, comp, side = (t.column(c).to_numpy() for c in ("cls", "comp", "side"))
            links = block_links(cls, comp, side, sets, percent)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    return run


def _block_pairs(open_: DataFrame, percent: int, block: int) -> DataFrame:
    """Rows of every block pair in which a link between two components of a family is possible.

    Bucket s holds sizes whose logarithm to base 100/percent is in [s, s+1): linked sets are in the same or in adjacent
    buckets. A bucket is dealt at random to blocks of about `block` rows.
    """
    base = math.log(100 / percent)
    rows = open_.withColumn("bucket", F.floor(F.log(F.col("n")) / base + 1e-9).cast("long"))
    count = rows.groupBy("fam", "bucket").agg(F.ceil(F.count("*") / F.lit(float(block))).cast("long").alias("blocks"))
    near = count.select("fam", F.explode(F.array(*(F.struct((F.col("bucket") - d).alias("bucket"), F.lit(d).alias("d"), F.col("blocks").alias("blocks")) for d in (-1, 0, 1)))).alias("x"))
    near = near.select("fam", "x.*").groupBy("fam", "bucket").agg(*(F.max(F.when(F.col("d") == d, F.col("blocks"))).alias(name) for d, name in ((-1, "below"), (0, "own"), (1, "above"))))
    rows = rows.join(near.filter("own is not null"), ["fam", "bucket"]).withColumn("h", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("own")))

    def span(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<bigint>"))

    def pair(bucket, step, h0, h1, side):
        return F.struct(bucket.alias("bucket"), F.lit(step).alias("step"), h0.cast("long").alias("h0"), h1.cast("long").alias("h1"), side.cast("int").alias("side"))

    h, s = F.col("h"), F.col("bucket")
    same = F.transform(span("own"), lambda x: pair(s, 0, F.least(h, x), F.greatest(h, x), F.when(h == x, 0).when(h < x, 1).otherwise(2)))
    # within one block no sides; of two blocks of a bucket only rows of different blocks
    up = F.transform(F.coalesce(span("above"), F.array().cast("array<bigint>")), lambda x: pair(s, 1, h, x, F.lit(1)))
    down = F.transform(F.coalesce(span("below"), F.array().cast("array<bigint>")), lambda x: pair(s - 1, 1, x, h, F.lit(2)))
    return rows.select("fam", "comp", "cls", F.explode(F.concat(same, up, down)).alias("p")).select("fam", "comp", "cls", "p.*")


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 64, rows: int = 7, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents link where 100 * intersection >= percent * union of their k-word shingle sets; component_id is the smallest
    doc_id reachable. A text of fewer than k words is one shingle. Null text, or text without words, has an empty set and
    links with nothing; its component is itself. A null doc_id is never chosen over another one; rows that repeat a doc_id
    and a text are all kept or all dropped. Tied sets are one class. Other columns are ignored. Long texts are
    hashed whole. A pair at the threshold shares a bucket with probability 1 - (1 - t^rows)^bands: all but 3 of
    10 million by default.
    """
    spark = docs.sparkSession
    # a row is found again by its id and a hash of its text, so null ids meet only their own text
    text = with_text(docs, id_col, text_col).withColumn("print", F.xxhash64("text"))
    n = partitions_for(spark)
    sig = staged(text.withColumn("row_id", F.monotonically_increasing_id()).mapInArrow(_sign(k, bands, rows), "row_id long, doc_id long, print long, n_shingles long, hi long, lo long, bands array<long>"), "signatures")
    classes = staged(sig.filter("n_shingles > 0").groupBy("hi", "lo", "n_shingles").agg(F.min("row_id").alias("cls"), F.min("doc_id").alias("first")).select("hi", "lo", F.col("n_shingles").alias("n"), "cls", "first"), "classes")

    keys = sig.select("row_id", "doc_id", F.col("bands")).join(classes.select(F.col("cls").alias("row_id")), "row_id").select(F.col("row_id").alias("cls"), F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.min("cls").alias("center"), F.count("*").alias("members")).filter("members > 1")
    star = staged(keys.join(buckets, "band").filter("cls <> center").select(F.col("center").alias("a"), F.col("cls").alias("b")).distinct(), "star")

    wanted = star.select(F.col("a").alias("cls")).union(star.select("b")).distinct().join(classes, "cls")
    where = wanted.join(sig.select(F.col("row_id").alias("cls"), "doc_id", "print"), "cls").select("cls", "hi", "lo", F.col("doc_id").alias("wanted_id"), F.col("print").alias("wanted_print"))
    sets = staged(text.join(where, F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("print") == F.col("wanted_print"))).select("cls", "hi", "lo", "text").mapInArrow(_sets(k), "cls long, members binary").dropDuplicates(["cls"]), "sets")
    sized = star.join(classes.select(F.col("cls").alias("a"), F.col("n").alias("na")), "a").join(classes.select(F.col("cls").alias("b"), F.col("n").alias("nb")), "b")
    sized = sized.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b")
    pairs = sized.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("sa")), "a").join(sets.select(F.col("cls").alias("b"), F.col("members").alias("sb")), "b")
    links = staged(pairs.select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a long, b long"), "links")
    comps = connected_components(links)
    families = connected_components(star)

    at = families.select(F.col("node").alias("cls"), F.col("root").alias("fam"))
    at = at.union(at.select(F.col("fam").alias("cls"), "fam").distinct())
    at = at.join(comps.select(F.col("node").alias("cls"), "root"), "cls", "left").select("cls", "fam", F.coalesce("root", "cls").alias("comp"))
    split = at.groupBy("fam").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("fam")
    open_ = at.join(split, "fam").join(classes.select("cls", "n"), "cls")
    blocks = _block_pairs(open_, percent, block).join(sets, "cls")
    group = ["fam", "bucket", "step", "h0", "h1"]
    more = staged(blocks.repartition(n, *group).sortWithinPartitions(*group).select(*group, "cls", "comp", "side", "members").mapInArrow(_residual(percent), "a long, b long").distinct(), "residual")
    merged = connected_components(more)

    root = classes.join(comps.select(F.col("node").alias("cls"), F.col("root").alias("r1")), "cls", "left").withColumn("r1", F.coalesce("r1", "cls"))
    root = root.join(merged.select(F.col("node").alias("r1"), F.col("root").alias("r2")), "r1", "left").withColumn("r2", F.coalesce("r2", "r1"))
    least = root.groupBy("r2").agg(F.min("first").alias("component_id"))
    named = root.join(least, "r2").select("hi", "lo", F.col("n").alias("n_shingles"), "component_id")
    out = sig.select("doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns: one of each near-duplicate component, by its smallest doc_id.

    A repeated doc_id is one document: its rows stay or go together. Rows with a null doc_id stay.
    """
    gone = near_groups(docs, k, percent, id_col=id_col, text_col=text_col, **options).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == F.col("__gone"), "left_anti")
