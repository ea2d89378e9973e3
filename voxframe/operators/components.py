"""Connected components in two levels: within slices in one grouped pass, then between slices over border pairs only.

A slice's foreground is one row with its voxels' codes; numpy joins neighbours inside it, for many slices at once. What touches
across slices becomes edges between components, far fewer than voxels, which are contracted to stars.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import released, settled

CELLS = 1 << 21
EDGES = 1 << 20
SIDE = 21
_LOW = (1 << SIDE) - 1


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the edges a-b connect it with."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def _positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _portions(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about CELLS cells; a larger row goes alone."""
    at, total = 0, np.cumsum(sizes)
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CELLS, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values of all rows, row of each, length of each row) of a column of lists."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes), sizes


def _as_lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int64()))


def _pair_rows(base: np.ndarray, at: np.ndarray, row: np.ndarray, other: np.ndarray, other_row: np.ndarray, dy: int, dx: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) where other[j] lies at (dy, dx) from at[i] in the same row; both are sorted by row and code."""
    y, x = (at >> SIDE) + dy, (at & _LOW) + dx
    fits = np.flatnonzero((y >= 0) & (x >= 0) & (y <= _LOW) & (x <= _LOW))
    want = (y[fits] << SIDE) + x[fits]
    # one sorted key for (row, code): codes are renumbered, as a row and 42 bits don't fit 64
    codes = np.unique(other)
    place = np.minimum(np.searchsorted(codes, want), max(len(codes) - 1, 0))
    known = codes[place] == want if len(codes) else np.zeros(len(want), bool)
    fits, place = fits[known], place[known]
    keys = other_row * (len(codes) + 1) + np.searchsorted(codes, other)
    j = np.minimum(np.searchsorted(keys, row[fits] * (len(codes) + 1) + place), max(len(keys) - 1, 0))
    same = keys[j] == row[fits] * (len(codes) + 1) + place if len(keys) else np.zeros(len(fits), bool)
    return fits[same], j[same]


def _within(offsets: list[tuple[int, int]]) -> Callable:
    """Each slice's codes in order, with the least voxel code of the component of each within the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole, _lists(whole.column("at"))[2]):
                at, row, sizes = _lists(batch.column("at"))
                if len(at) and at.min() < 0:
                    raise ValueError("voxel coordinates must lie in 0 to 2097151")
                at = at[np.lexsort((at, row))]
                once = np.ones(len(at), dtype=bool)
                once[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
                at, row = at[once], row[once]
                sizes = np.bincount(row, minlength=len(sizes))
                pairs = [_pair_rows(at, at, row, at, row, dy, dx) for dy, dx in offsets]
                root = joined(len(at), *(np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, int) for i in (0, 1)))
                z = batch.column("z").to_numpy(zero_copy_only=False).astype(np.int64)
                names = [c for c in batch.schema.names if c != "at"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), _as_lists(at, sizes), _as_lists((z[row] << 2 * SIDE) + at[root], sizes)], [*names, "at", "part"])

    return run


def _between(offsets: list[tuple[int, int]], keys: list[str]) -> Callable:
    """Pairs of components that touch from a slice to the other one of its row: a and b, once for each pair of slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole, _lists(whole.column("at"))[2] + _lists(whole.column("at2"))[2]):
                (at, row, _), (part, _, _) = _lists(batch.column("at")), _lists(batch.column("part"))
                (at2, row2, _), (part2, _, _) = _lists(batch.column("at2")), _lists(batch.column("part2"))
                pairs = [_pair_rows(at, at, row, at2, row2, dy, dx) for dy, dx in offsets]
                i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
                found = np.unique(np.column_stack([row[i], part[i], part2[j]]), axis=0) if len(i) else np.zeros((0, 3), np.int64)
                mine = pa.array(found[:, 0])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(mine) for c in keys), pa.array(found[:, 1]), pa.array(found[:, 2])], [*keys, "a", "b"])

    return run


def _contract(keys: list[str], most: int) -> Callable:
    """Forests of the edges of each group, which are adjacent: node, root, and whether all edges of the group were seen at once."""

    def forest(held: list[pa.RecordBatch], whole: bool) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        a, b = t.column("a").to_numpy(), t.column("b").to_numpy()
        nodes, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = nodes[joined(len(nodes), codes[: len(a)], codes[len(a) :])]
        moved = np.flatnonzero(root != nodes)
        first = pa.array(np.zeros(len(moved), np.int64))
        return pa.RecordBatch.from_arrays([*(t.column(k).combine_chunks().take(first) for k in keys), pa.array(nodes[moved]), pa.array(root[moved]), pa.array(np.full(len(moved), whole))], [*keys, "node", "root", "whole"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key, size, cut = None, 0, False
        for batch in batches:
            groups = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            at = 0
            while at < len(groups):
                upto = at
                while upto < len(groups) and groups[upto] == groups[at]:
                    upto += 1
                if held and (groups[at] != key or size >= most):
                    cut = cut if groups[at] != key else True
                    yield forest(held, not cut)
                    cut = groups[at] == key
                    held, size = [], 0
                key = groups[at]
                held.append(batch.slice(at, upto - at))
                size += upto - at
                at = upto
        if held:
            yield forest(held, not cut)

    return run


def contracted(edges: DataFrame, keys: list[str], most: int = EDGES, rounds: int = 60) -> DataFrame:
    """(keys, node, root) for every node of the graphs `edges` (keys, a, b) whose least reachable node is another.

    The edges of a group are joined in one task, `most` at a time. Groups with more edges than that go on as stars: each round
    gives every node's larger, then its smaller neighbours the least one. Earlier rounds are deleted.
    """
    names = ", ".join(f"{k} {t}" for k, t in edges.dtypes if k in keys)
    dealt = edges.repartition(*keys).sortWithinPartitions(*keys)
    now = settled(dealt.mapInArrow(_contract(keys, most), f"{names}, node long, root long, whole boolean"), "forest")
    done, left = now.filter("whole").drop("whole"), now.filter("not whole").drop("whole")
    if left.isEmpty():
        return done
    old = None
    stars = left
    for _ in range(rounds):
        # large star, then small star
        both = stars.unionByName(stars.select(*keys, F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy(*keys, "node").agg(F.least(F.min("root"), F.col("node")).alias("m"))
        large = both.filter("root > node").join(least, [*keys, "node"]).select(*keys, F.col("root").alias("node"), F.col("m").alias("root"))
        least = large.groupBy(*keys, "node").agg(F.min("root").alias("m"))
        small = large.join(least, [*keys, "node"]).select(*keys, F.explode(F.array("node", "root")).alias("node"), "m").filter("node > m").select(*keys, "node", F.col("m").alias("root")).distinct()
        after = settled(small, "stars")
        changed = not after.exceptAll(stars).isEmpty() or not stars.distinct().exceptAll(after).isEmpty()
        if old is not None:
            released(old)
        old = stars = after
        if not changed:
            return done.unionByName(stars)
    raise RuntimeError("components have not settled")


def _renamed(keys: list[str]) -> Callable:
    """Voxel rows of slices: component is the root of each part, or the part itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole, _lists(whole.column("at"))[2]):
                (at, row, _), (part, _, _) = _lists(batch.column("at")), _lists(batch.column("part"))
                node, own, sizes = _lists(batch.column("node"))
                root, _, _ = _lists(batch.column("root"))
                # parts are voxel codes of this slice and so told apart by row and code
                codes, place = np.unique(np.concatenate([part, node]), return_inverse=True)
                want, have = row * (len(codes) + 1) + place[: len(part)], own * (len(codes) + 1) + place[len(part) :]
                order = np.argsort(have)
                j = np.minimum(np.searchsorted(have[order], want), max(len(have) - 1, 0))
                hit = have[order][j] == want if len(have) else np.zeros(len(part), bool)
                out = part.copy()
                out[hit] = root[order[j[hit]]]
                mine = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(mine) for c in [*keys, "z"]), pa.array((at >> SIDE).astype(np.int32)), pa.array((at & _LOW).astype(np.int32)), pa.array(out)], [*keys, "z", "y", "x", "component"])

    return run


def slice_code() -> Column:
    """One long for y and x; -1 for coordinates beyond 21 bits, which are an error where it is read."""
    fits = F.col("y").between(0, _LOW) & F.col("x").between(0, _LOW) & F.col("z").between(0, _LOW)
    return F.when(fits, F.shiftleft(F.col("y").cast("long"), SIDE) + F.col("x")).otherwise(F.lit(-1))


def by_slice(mask: DataFrame, keys: list[str]) -> DataFrame:
    """One row per slice with the codes of its voxels, in any order: keys, z, at."""
    return mask.groupBy(*keys, F.col("z").cast("int").alias("z")).agg(F.collect_list(slice_code()).alias("at"))


def components(mask: DataFrame, keys: list[str], offsets: list[tuple[int, int, int]]) -> DataFrame:
    """The mask's voxels with `component`, the smallest voxel code that `offsets` (and their opposites) connect each with."""
    names = ", ".join(f"{k} {t}" for k, t in mask.dtypes if k in keys)
    flat = sorted({o[1:] for o in offsets if o[0] == 0 and o[1:] != (0, 0)})
    steps = sorted({abs(o[0]) for o in offsets} - {0})
    slices = by_slice(mask, keys).mapInArrow(_within(flat), f"{names}, z int, at array<long>, part array<long>")
    ends = f"{names}, z int, y int, x int, component long"
    nothing = [F.array().cast("array<long>").alias(c) for c in ("node", "root")]
    if not steps:
        return slices.select("*", *nothing).mapInArrow(_renamed(keys), ends)
    slices = settled(slices, "slices")
    edges = None
    for dz in steps:
        moves = sorted({o[1:] if o[0] > 0 else (-o[1], -o[2]) for o in offsets if abs(o[0]) == dz})
        above = slices.select(*keys, (F.col("z") - dz).alias("z"), F.col("at").alias("at2"), F.col("part").alias("part2"))
        found = slices.join(above, [*keys, "z"]).mapInArrow(_between(moves, keys), f"{names}, a long, b long")
        edges = found if edges is None else edges.unionByName(found)
    roots = contracted(edges, keys).withColumn("z", F.shiftright("node", 2 * SIDE).cast("int"))
    roots = roots.groupBy(*keys, "z").agg(F.collect_list(F.struct("node", "root")).alias("r")).select(*keys, "z", F.col("r.node").alias("node"), F.col("r.root").alias("root"))
    return slices.join(roots, [*keys, "z"], "left").mapInArrow(_renamed(keys), ends)


def _holes(keys: list[str]) -> Callable:
    """Background cells of each slice's box that no path through background joins to the frame around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole, whole.column("cells").to_numpy(zero_copy_only=False)):
                at, row, sizes = _lists(batch.column("at"))
                if len(at) and at.min() < 0:
                    raise ValueError("voxel coordinates must lie in 0 to 2097151")
                y, x = at >> SIDE, at & _LOW
                starts = np.cumsum(sizes) - sizes
                low_y, low_x = np.minimum.reduceat(y, starts) - 1, np.minimum.reduceat(x, starts) - 1
                high, wide = np.maximum.reduceat(y, starts) + 2 - low_y, np.maximum.reduceat(x, starts) + 2 - low_x
                base = np.cumsum(high * wide) - high * wide
                total = int((high * wide).sum())
                free = np.ones(total, dtype=bool)
                free[base[row] + (y - low_y[row]) * wide[row] + x - low_x[row]] = False
                of = np.repeat(np.arange(len(sizes)), high * wide)
                place = np.arange(total) - base[of]
                open_ = np.flatnonzero(free)
                right = open_[place[open_] % wide[of[open_]] < wide[of[open_]] - 1]
                right = right[free[right + 1]]
                down = open_[place[open_] // wide[of[open_]] < high[of[open_]] - 1]
                down = down[free[down + wide[of[down]]]]
                root = joined(total, np.concatenate([right, down]), np.concatenate([right + 1, down + wide[of[down]]]))
                hole = open_[root[open_] != base[of[open_]]]
                mine = pa.array(of[hole])
                hy, hx = low_y[of[hole]] + place[hole] // wide[of[hole]], low_x[of[hole]] + place[hole] % wide[of[hole]]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(mine) for c in [*keys, "z"]), pa.array(hy.astype(np.int32)), pa.array(hx.astype(np.int32))], [*keys, "z", "y", "x"])

    return run


def fill_holes(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Background voxels of a slice that 4-connected background does not join to the border: one pass over slices."""
    names = ", ".join(f"{k} {t}" for k, t in mask.dtypes if k in keys)
    box = [(F.max(c) - F.min(c) + 3).cast("long") for c in "yx"]
    slices = mask.groupBy(*keys, F.col("z").cast("int").alias("z")).agg(F.collect_list(slice_code()).alias("at"), (box[0] * box[1]).alias("cells"))
    return slices.mapInArrow(_holes(keys), f"{names}, z int, y int, x int")
