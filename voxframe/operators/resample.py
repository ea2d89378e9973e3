"""Resampling of voxel tables and of packed volumes between grids."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .volumes import _each, _lists, _mapped, _rows

POINT = ["z", "y", "x"]


@dataclass(frozen=True)
class Grid:
    """Sizes, spacing and origin in mm in the order z, y, x; rows of `axes` are the unit vectors of the index axes."""

    size: tuple[int, int, int]
    spacing: tuple[float, float, float]
    origin: tuple[float, float, float] = (0.0, 0.0, 0.0)
    axes: tuple[tuple[float, float, float], ...] = ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0))

    def physical(self) -> list[Column]:
        """Position in mm of the voxel z, y, x."""
        return [F.lit(self.origin[k]) + sum((F.col(a) * F.lit(self.spacing[n] * self.axes[n][k]) for n, a in enumerate(POINT)), F.lit(0.0)) for k in range(3)]

    def index(self, at: list[Column]) -> list[Column]:
        """Fractional index of a position: the axes are orthonormal, so their inverse is the transpose."""
        return [sum(((at[k] - F.lit(self.origin[k])) * F.lit(self.axes[n][k]) for k in range(3)), F.lit(0.0)) / F.lit(self.spacing[n]) for n in range(3)]


def resized(source: Grid, spacing: tuple[float, float, float]) -> Grid:
    """The grid of another spacing over the same space, sizes rounded half to even.

    An origin is the middle of a voxel, so it moves by half the difference of the spacings; each of its coordinates by that of the
    axis of its place, whatever the directions are.
    """
    size = tuple(max(1, round(n * s / t)) for n, s, t in zip(source.size, source.spacing, spacing, strict=True))
    origin = tuple(o + 0.5 * (t - s) for o, s, t in zip(source.origin, source.spacing, spacing, strict=True))
    return Grid(size, spacing, origin, source.axes)


def cropped(source: Grid, start: tuple[int, int, int], size: tuple[int, int, int]) -> Grid:
    """The part of a grid from the voxel `start` on; a start below 0 pads. Points keep their position in mm."""
    origin = tuple(source.origin[k] + sum(start[n] * source.spacing[n] * source.axes[n][k] for n in range(3)) for k in range(3))
    return Grid(size, source.spacing, origin, source.axes)


def moved(points: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """Points z, y, x of one grid with their position in mm (z_mm, y_mm, x_mm) and their fractional index in another (u_z, u_y, u_x)."""
    mm = [f"{a}_mm" for a in POINT]
    at = points.select("*", *(c.alias(n) for c, n in zip(source.physical(), mm, strict=True)))
    return at.select("*", *(u.alias(f"u_{a}") for u, a in zip(target.index([F.col(n) for n in mm]), POINT, strict=True)))


def _targets(groups: DataFrame, keys: list[str], source: Grid, target: Grid) -> DataFrame:
    """Every voxel of the target grid for every group, with its fractional source index u0, u1, u2."""
    out = groups.select(*keys).distinct()
    for a, n in zip(POINT, target.size, strict=True):
        out = out.withColumn(a, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return out.select(*keys, *POINT, *(u.alias(f"u{n}") for n, u in enumerate(source.index(target.physical()))))


def resample_labels(labels: DataFrame, keys: list[str], source: Grid, target: Grid) -> DataFrame:
    """Nearest voxel's label on the target grid; outside the source, or where it has no row, 0."""
    t = _targets(labels, keys, source, target)
    near = t.select(*keys, *(F.col(a).alias(f"t{a}") for a in POINT), *(F.floor(F.col(f"u{n}") + 0.5).cast("int").alias(a) for n, a in enumerate(POINT)))
    got = near.join(labels.select(*keys, *POINT, "label"), [*keys, *POINT], "left")
    return got.select(*keys, *(F.col(f"t{a}").alias(a) for a in POINT), F.coalesce("label", F.lit(0)).alias("label"))


def resample_linear(image: DataFrame, keys: list[str], source: Grid, target: Grid, value: str = "intensity") -> DataFrame:
    """Linear interpolation on the target grid; within half a voxel of the border the border holds on, farther out it is 0."""
    t = _targets(image, keys, source, target)
    inside = F.lit(True)
    for n in range(3):
        inside &= F.col(f"u{n}").between(-0.5, source.size[n] - 0.5)
    corners = F.array(*(F.struct(*(F.lit(b).alias(f"b{n}") for n, b in enumerate(o))) for o in [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]))
    at = t.filter(inside).withColumn("o", F.explode(corners))
    weight = F.lit(1.0)
    for n in range(3):
        part = F.col(f"u{n}") - F.floor(f"u{n}")
        weight *= F.when(F.col(f"o.b{n}") == 1, part).otherwise(1 - part)
    place = [F.least(F.greatest(F.floor(f"u{n}") + F.col(f"o.b{n}"), F.lit(0)), F.lit(source.size[n] - 1)).cast("int").alias(a) for n, a in enumerate(POINT)]
    hit = at.select(*keys, *(F.col(a).alias(f"t{a}") for a in POINT), weight.alias("w"), *place).filter("w > 0").join(image.select(*keys, *POINT, value), [*keys, *POINT])
    mine = [*keys, *(f"t{a}" for a in POINT)]
    sums = hit.groupBy(*mine).agg(F.sum(F.col("w") * F.col(value)).alias(value))
    whole = t.select(*keys, *(F.col(a).alias(f"t{a}") for a in POINT)).join(sums, mine, "left")
    return whole.select(*keys, *(F.col(f"t{a}").alias(a) for a in POINT), F.coalesce(value, F.lit(0.0)).alias(value))


def _places(source: Grid, target: Grid) -> list[np.ndarray]:
    """Fractional source index, along each axis, of every voxel of the target grid in the order z, y, x."""
    at = [a.ravel() for a in np.meshgrid(*(np.arange(n) for n in target.size), indexing="ij")]
    mm = [target.origin[k] + sum((a * (target.spacing[n] * target.axes[n][k]) for n, a in enumerate(at)), 0.0) for k in range(3)]
    return [sum(((mm[k] - source.origin[k]) * source.axes[n][k] for k in range(3)), 0.0) / source.spacing[n] for n in range(3)]


def _resampled(packed: DataFrame, keys: list[str], source: Grid, column: str, out: str, kind: str, of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (cube,) in _each(batches, source.size, [column]):
            values = of(cube.reshape(len(cube), math.prod(source.size)))
            yield _rows(part, keys, np.arange(len(cube)), {out: _lists(pa.array(values.ravel()), values.shape[1])})

    return _mapped(packed, keys, run, f"{out} array<{kind}>")


def nearest(packed: DataFrame, keys: list[str], source: Grid, target: Grid) -> DataFrame:
    """`resample_labels` of packed volumes: `label`, the array of the target grid in the order z, y, x."""
    at = [np.floor(u + 0.5).astype(np.int64) for u in _places(source, target)]
    inside = np.logical_and.reduce([(a >= 0) & (a < n) for a, n in zip(at, source.size, strict=True)])
    place = np.ravel_multi_index([np.clip(a, 0, n - 1) for a, n in zip(at, source.size, strict=True)], source.size)
    return _resampled(packed, keys, source, "labels", "label", "int", lambda cube: np.where(inside, cube[:, place], 0).astype(np.int32))


def linear(packed: DataFrame, keys: list[str], source: Grid, target: Grid) -> DataFrame:
    """`resample_linear` of packed images: `intensity`, the array of the target grid in the order z, y, x."""
    u = _places(source, target)
    inside = np.logical_and.reduce([(a >= -0.5) & (a <= n - 0.5) for a, n in zip(u, source.size, strict=True)])
    corners = []
    for corner in itertools.product((0, 1), repeat=3):
        weight = np.where(inside, 1.0, 0.0)
        for a, b in zip(u, corner, strict=True):
            weight = weight * (a - np.floor(a) if b else 1 - (a - np.floor(a)))
        at = [np.clip(np.floor(a).astype(np.int64) + b, 0, n - 1) for a, b, n in zip(u, corner, source.size, strict=True)]
        if weight.any():
            corners.append((weight, np.ravel_multi_index(at, source.size)))

    def of(image: np.ndarray) -> np.ndarray:
        return sum((weight * image[:, place] for weight, place in corners), np.zeros((len(image), len(inside))))

    return _resampled(packed, keys, source, "image", "intensity", "double", of)


def unfolded(packed: DataFrame, keys: list[str], target: Grid, column: str) -> DataFrame:
    """Voxel rows of the arrays of a grid."""
    _, ny, nx = target.size
    at = packed.select(*keys, F.posexplode(column).alias("_at", column))
    return at.selectExpr(*keys, f"cast(_at div {ny * nx} as int) as z", f"cast(_at div {nx} % {ny} as int) as y", f"_at % {nx} as x", column)
