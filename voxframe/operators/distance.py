"""Exact Euclidean distances to a set of voxels, an axis at a time, and what follows from them: nearest distances and balls in mm.

The squared distance to the nearest voxel is the lower envelope of parabolas along x, then of those values along y, then along
z. x and y are one pass over slices, z one over the planes of a row; no point meets another.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import _LOW, SIDE, _lists, _portions, _positions, by_slice

Spacing = tuple[float, float, float]


def envelope(f: np.ndarray, step: float) -> np.ndarray:
    """For each row i and column of f: the least f[j] + (step * (i - j)) ** 2 over all rows j; infinity stands for no value.

    Columns are worked on together; each keeps a stack of the parabolas that are lowest somewhere, and where each begins.
    """
    n, m = f.shape
    stack, begin = np.zeros((n, m), dtype=np.int32), np.full((n, m), -np.inf)
    top = np.full(m, -1, dtype=np.int64)
    for i in range(n):
        left = np.flatnonzero(np.isfinite(f[i]))
        while len(left):
            k = top[left]
            j = stack[np.maximum(k, 0), left]
            with np.errstate(divide="ignore", invalid="ignore"):
                cross = ((f[i, left] - f[j, left]) / (step * step) + float(i) * i - j.astype(np.float64) * j) / (2.0 * (i - j))
            under = (k >= 0) & (cross <= begin[np.maximum(k, 0), left])
            put, k = left[~under], k[~under] + 1
            stack[k, put], begin[k, put], top[put] = i, np.where(k > 0, cross[~under], -np.inf), k
            left = left[under]
            top[left] -= 1
    out = np.full((n, m), np.inf)
    some = np.flatnonzero(top >= 0)
    at = np.zeros(len(some), dtype=np.int64)
    for i in range(n if len(some) else 0):
        while True:
            on = (at < top[some]) & (begin[np.minimum(at + 1, n - 1), some] < i)
            if not on.any():
                break
            at[on] += 1
        j = stack[at, some]
        out[i, some] = f[j, some] + (step * (i - j)) ** 2
    return out


def _planes(keys: list[str], spacing: Spacing, outside: bool) -> Callable:
    """Rows (keys, y, z, x0, values): squared in-slice distances of a box's row to the slice's voxels, or to what isn't one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole, whole.column("cells").to_numpy(zero_copy_only=False)):
                at, row, _ = _lists(batch.column("at"))
                y0, y1, x0, x1 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y0", "y1", "x0", "x1"))
                high, wide = y1 - y0 + 1, x1 - x0 + 1
                h, w, s = int(high.max()), int(wide.max()), batch.num_rows
                f = np.full((w, s, h), 0.0 if outside else np.inf)
                f[(at & _LOW) - x0[row], row, (at >> SIDE) - y0[row]] = np.inf if outside else 0.0
                d = envelope(f.reshape(w, s * h), spacing[2]).reshape(w, s, h)
                d = envelope(np.ascontiguousarray(d.transpose(2, 0, 1)).reshape(h, w * s), spacing[1]).reshape(h, w, s)
                of = np.repeat(np.arange(s), high)
                y = _positions(np.zeros(s, np.int64), high)
                x = _positions(np.zeros(len(of), np.int64), wide[of])
                values = d[np.repeat(y, wide[of]), x, np.repeat(of, wide[of])]
                mine = pa.array(of)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(wide[of])]), pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(mine) for c in [*keys, "z"]), pa.array((y0[of] + y).astype(np.int32)), pa.array(x0[of].astype(np.int32)), lists], [*keys, "z", "y", "x0", "values"])

    return run


def _columns(keys: list[str], step: float, pad: int, outside: bool, most: float | None) -> Callable:
    """Distances along z in planes (keys, y): at the voxels asked for (`za`, `xa`), or of all that lie within `most`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole, _lists(whole.column("zs"))[2] * _lists(whole.column("rows"))[2]):
                n = batch.num_rows
                (z, row, _), rows = _lists(batch.column("zs")), batch.column("rows").flatten()
                wide = np.zeros(n, np.int64)
                wide[row] = rows.value_lengths().to_numpy()
                low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(low, row, z - pad)
                np.maximum.at(high, row, z + pad)
                if most is None:
                    (za, own, _), (xa, _, _) = _lists(batch.column("za")), _lists(batch.column("xa"))
                    np.minimum.at(low, own, za)
                    np.maximum.at(high, own, za)
                # the rows' columns stand side by side, each row's z counted from its own lowest
                base, x0 = np.cumsum(wide) - wide, batch.column("x0").to_numpy(zero_copy_only=False)
                f = np.full((int((high - low).max()) + 1, int(wide.sum())), 0.0 if outside else np.inf)
                f[np.repeat(z - low[row], wide[row]), _positions(base[row], wide[row])] = rows.flatten().to_numpy()
                d = envelope(f, step)
                if most is None:
                    zs, xs, ds = za, xa, d[za - low[own], base[own] + xa - x0[own]]
                else:
                    i, j = np.nonzero(d <= most * most * (1 + 1e-12))
                    own = np.repeat(np.arange(n), wide)[j]
                    zs, xs, ds = i + low[own], j - base[own] + x0[own], d[i, j]
                mine = pa.array(own)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(mine) for c in keys), pa.array(zs.astype(np.int32)), batch.column("y").take(mine), pa.array(xs.astype(np.int32)), pa.array(np.sqrt(ds))], [*keys, "z", "y", "x", "d"])

    return run


def _boxes(points: DataFrame, keys: list[str], pad: tuple[int, int]) -> DataFrame:
    """Per group the box of y and x, widened."""
    ends = [(f(c) + s * p).cast("int").alias(f"{c}{n}") for c, p in zip("yx", pad, strict=True) for n, f, s in ((0, F.min, -1), (1, F.max, 1))]
    return points.groupBy(*keys).agg(*ends)


def _rows_of(points: DataFrame, boxes: DataFrame, keys: list[str], spacing: Spacing, outside: bool) -> DataFrame:
    names = ", ".join(f"{k} {t}" for k, t in points.dtypes if k in keys)
    slices = by_slice(points, keys).join(boxes, keys).withColumn("cells", ((F.col("y1") - F.col("y0") + 1) * (F.col("x1") - F.col("x0") + 1)).cast("long"))
    rows = slices.mapInArrow(_planes(keys, spacing, outside), f"{names}, z int, y int, x0 int, values array<double>")
    held = F.collect_list(F.struct("z", "values"))
    return rows.groupBy(*keys, "y").agg(F.first("x0").alias("x0"), held.alias("h")).select(*keys, "y", "x0", F.col("h.z").alias("zs"), F.col("h.values").alias("rows"))


def _schema(points: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {t}" for k, t in points.dtypes if k in keys) + ", z int, y int, x int, d double"


def nearest(a: DataFrame, b: DataFrame, keys: list[str], spacing: Spacing) -> DataFrame:
    """Distance `d` in mm of every voxel of `a` to the nearest of `b` in the same group; groups without one have no row.

    Linear in the boxes of the groups, whatever the distances.
    """
    boxes = _boxes(a.select(*keys, "y", "x").unionByName(b.select(*keys, "y", "x")), keys, (0, 0))
    asked = a.groupBy(*keys, F.col("y").cast("int").alias("y")).agg(F.collect_list(F.struct(F.col("z").cast("int").alias("z"), F.col("x").cast("int").alias("x"))).alias("_a"))
    rows = _rows_of(b, boxes, keys, spacing, False).join(asked, [*keys, "y"]).select("*", F.col("_a.z").alias("za"), F.col("_a.x").alias("xa")).drop("_a")
    return rows.mapInArrow(_columns(keys, spacing[0], 0, False, None), _schema(a, keys))


def dilate_ball(mask: DataFrame, keys: list[str], radius: float, spacing: Spacing = (1.0, 1.0, 1.0)) -> DataFrame:
    """Voxels within `radius` of the mask, in the units of `spacing`; coordinates below 0 are left out."""
    pad = [math.floor(radius / s + 1e-9) for s in spacing]
    rows = _rows_of(mask, _boxes(mask, keys, (pad[1], pad[2])), keys, spacing, False)
    out = rows.mapInArrow(_columns(keys, spacing[0], pad[0], False, radius), _schema(mask, keys))
    return out.filter("z >= 0 and y >= 0 and x >= 0").drop("d")


def erode_ball(mask: DataFrame, keys: list[str], radius: float, spacing: Spacing = (1.0, 1.0, 1.0)) -> DataFrame:
    """Mask voxels whose every voxel within `radius` is in the mask: the nearest outside it, the grid's outside too, is further."""
    asked = mask.groupBy(*keys, F.col("y").cast("int").alias("y")).agg(F.collect_list(F.struct(F.col("z").cast("int").alias("z"), F.col("x").cast("int").alias("x"))).alias("_a"))
    rows = _rows_of(mask, _boxes(mask, keys, (1, 1)), keys, spacing, True).join(asked, [*keys, "y"]).select("*", F.col("_a.z").alias("za"), F.col("_a.x").alias("xa")).drop("_a")
    out = rows.mapInArrow(_columns(keys, spacing[0], 1, True, None), _schema(mask, keys))
    return out.filter(F.col("d") > radius * (1 + 1e-12)).drop("d")


def closing_ball(mask: DataFrame, keys: list[str], radius: float, spacing: Spacing = (1.0, 1.0, 1.0)) -> DataFrame:
    """Dilation, then erosion. Voxels that the dilation would set outside the grid don't count as set."""
    return erode_ball(dilate_ball(mask, keys, radius, spacing), keys, radius, spacing)


def opening_ball(mask: DataFrame, keys: list[str], radius: float, spacing: Spacing = (1.0, 1.0, 1.0)) -> DataFrame:
    return dilate_ball(erode_ball(mask, keys, radius, spacing), keys, radius, spacing)
