"""Operators on voxel neighbourhoods: surfaces, distances, morphology, components, holes, wall thickness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import settled
from . import components as two_level
from . import distance

FACES = [(-1, 0, 0), (1, 0, 0), (0, -1, 0), (0, 1, 0), (0, 0, -1), (0, 0, 1)]
IN_SLICE = [o for o in FACES if o[0] == 0]


def ball(radius: int) -> list[tuple[int, int, int]]:
    """Offsets of an in-slice disc."""
    r = range(-radius, radius + 1)
    return [(0, y, x) for y in r for x in r if y * y + x * x <= radius * radius]


def shifted(df: DataFrame, offsets: list[tuple[int, int, int]]) -> DataFrame:
    """Every voxel moved by every offset: one row for each, without a join."""
    moves = F.array(*(F.struct(F.lit(a).alias("dz"), F.lit(b).alias("dy"), F.lit(c).alias("dx")) for a, b, c in offsets))
    rest = [c for c in df.columns if c not in ("z", "y", "x")]
    return df.withColumn("o", F.explode(moves)).select(*rest, (F.col("z") + F.col("o.dz")).alias("z"), (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"))


def dilate(mask: DataFrame, keys: list[str], offsets: list[tuple[int, int, int]]) -> DataFrame:
    return shifted(mask.select(*keys, "z", "y", "x"), offsets).distinct()


def erode(mask: DataFrame, keys: list[str], offsets: list[tuple[int, int, int]]) -> DataFrame:
    """Voxels whose every offset is in the mask: counted by one aggregate."""
    back = [(-a, -b, -c) for a, b, c in offsets]
    return shifted(mask.select(*keys, "z", "y", "x"), back).groupBy(*keys, "z", "y", "x").agg(F.count("*").alias("n")).filter(F.col("n") == len(offsets)).drop("n")


def closing(mask: DataFrame, keys: list[str], offsets: list[tuple[int, int, int]]) -> DataFrame:
    return erode(dilate(mask, keys, offsets), keys, offsets)


def opening(mask: DataFrame, keys: list[str], offsets: list[tuple[int, int, int]]) -> DataFrame:
    return dilate(erode(mask, keys, offsets), keys, offsets)


def surface(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Mask voxels with a face neighbour outside the mask or the grid."""
    around = shifted(mask.select(*keys, "z", "y", "x").withColumn("_own", F.struct("z", "y", "x")), [(0, 0, 0), *FACES])
    own = F.max(F.col("_own") == F.struct("z", "y", "x"))
    return around.groupBy(*keys, "z", "y", "x").agg(F.count("*").alias("n"), own.alias("own")).filter("own and n < 7").drop("n", "own")


def nearest(a: DataFrame, b: DataFrame, keys: list[str], spacing: tuple[float, float, float]) -> DataFrame:
    """Distance `d` in mm of every point of `a` to the nearest of `b` in the same group, by an exact distance transform."""
    return distance.nearest(a, b, keys, spacing)


def surface_distances(pred: DataFrame, ref: DataFrame, keys: list[str], spacing: tuple[float, float, float], groups: DataFrame | None = None) -> DataFrame:
    """hd, hd95, asd and assd of every group in `groups`, by default of those that either mask has.

    hd95 is the percentile over both directions together; asd is the mean from prediction to reference, assd of both means.
    All are infinite where one mask of a group is empty, and 0 where both are.
    """
    sides = pred.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(ref.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("b")))
    sides = sides.groupBy(*keys).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    held = _distances(pred, ref, keys, spacing)
    out = (groups.select(*keys).distinct().join(sides, keys, "left") if groups is not None else sides).join(held, keys, "left")
    one = F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0)) == 1
    return out.select(*keys, *(F.when(one, F.lit(float("inf"))).otherwise(F.coalesce(c, F.lit(0.0))).alias(c) for c in ("hd", "hd95", "asd", "assd")))


def _distances(pred: DataFrame, ref: DataFrame, keys: list[str], spacing: tuple[float, float, float]) -> DataFrame:
    a, b = settled(surface(pred, keys), "surface"), settled(surface(ref, keys), "surface")
    both = nearest(a, b, keys, spacing).withColumn("side", F.lit(0)).unionByName(nearest(b, a, keys, spacing).withColumn("side", F.lit(1)))
    mean = [F.avg(F.when(F.col("side") == s, F.col("d"))) for s in (0, 1)]
    return both.groupBy(*keys).agg(F.max("d").alias("hd"), F.percentile("d", F.lit(0.95)).alias("hd95"), mean[0].alias("asd"), ((mean[0] + mean[1]) / 2).alias("assd"))


def voxel_code() -> Column:
    """One long for z, y and x, 21 bits each, as `components` numbers voxels."""
    return F.shiftleft(F.col("z").cast("long"), 42) + F.shiftleft(F.col("y").cast("long"), 21) + F.col("x")


def components(mask: DataFrame, keys: list[str], offsets: list[tuple[int, int, int]] = FACES) -> DataFrame:
    """The mask with `component`, the smallest voxel code of its connected component: z, y and x in 21 bits each, from the top."""
    return two_level.components(mask, keys, offsets)


def sized(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(component, size, top) per component: its voxels, and those of the largest of its group."""
    sizes = parts.groupBy(*keys, "component").agg(F.count("*").alias("size"))
    return sizes.join(sizes.groupBy(*keys).agg(F.max("size").alias("top")), keys)


def keep_largest(mask: DataFrame, keys: list[str], least: int | None = None) -> DataFrame:
    """Voxels of the largest component of each group; components that tie at the maximum all stay.

    With `least`, only components of fewer voxels go.
    """
    parts = components(mask, keys)
    stays = F.col("size") == F.col("top")
    kept = sized(parts, keys).filter(stays if least is None else stays | (F.col("size") >= least))
    return parts.join(kept.select(*keys, "component"), [*keys, "component"], "left_semi").select(*keys, "z", "y", "x")


def component_limits(labels: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Per value of `by` (among the keys): voxels of the largest component that goes and of the smallest that stays.

    The largest component of each group stays, and those that tie with it. max_removed is null where nothing goes.
    """
    return limits(sized(components(labels, keys), keys), by)


def limits(sizes: DataFrame, by: list[str]) -> DataFrame:
    """`component_limits` of components whose `size` and `top` are known."""
    n, top = F.col("size"), F.col("top")
    return sizes.groupBy(*by).agg(F.max(F.when(n < top, n)).alias("max_removed"), F.min(F.when(n == top, n)).alias("min_kept"))


def fill_holes(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Background voxels of a slice that 4-connected background does not join to the border."""
    return two_level.fill_holes(mask, keys)


def wall_thickness(labels: DataFrame, keys: list[str], wall: int, cavity: int, spacing: tuple[float, float, float]) -> DataFrame:
    """Per group: mean, max and 95th percentile of the distance from wall voxels beside the cavity to the nearest outside.

    Works slice by slice. The nearest voxel that is neither wall nor cavity touches the wall, so only those are searched.
    """
    group = [*keys, "slice"]
    l = labels.withColumn("slice", F.col("z"))
    beside = dilate(l.filter(F.col("label") == cavity), group, IN_SLICE)
    inner = l.filter(F.col("label") == wall).join(beside, [*group, "z", "y", "x"], "left_semi")
    touching = dilate(l.filter(F.col("label") == wall), group, IN_SLICE)
    outer = l.filter(~F.col("label").isin(wall, cavity)).join(touching, [*group, "z", "y", "x"], "left_semi")
    d = nearest(settled(inner, "wall"), settled(outer, "wall"), group, spacing)
    return d.groupBy(*keys).agg(F.avg("d").alias("mean_mm"), F.max("d").alias("max_mm"), F.percentile("d", F.lit(0.95)).alias("p95_mm"))
