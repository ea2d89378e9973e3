"""Choosing one of several: slices, paths, model variants, examples; crops and pastes; regions from probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .neighbours import fill_holes

VOXEL = ["z", "y", "x"]


def best_slice(slices: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Per group the slice with most of the first measure that is above 0 anywhere, the lower z at a tie; else the middle one."""
    s = F.lit(None).cast("int")
    by = F.lit(None).cast("string")
    for m in reversed(measures):
        top = F.max_by("z", F.struct(F.col(m), -F.col("z")))
        s = F.when(F.max(m) > 0, top).otherwise(s)
        by = F.when(F.max(m) > 0, F.lit(m)).otherwise(by)
    middle = F.element_at(F.array_sort(F.collect_set("z")), (F.floor(F.count_distinct("z") / 2) + 1).cast("int"))
    return slices.groupBy(*keys).agg(F.coalesce(s, middle).alias("z"), F.coalesce(by, F.lit("middle")).alias("by"))


def ranked_paths(wanted: DataFrame, keys: list[str], candidates: list[Column], listing: DataFrame) -> DataFrame:
    """The first candidate path of each wanted row that the listing holds; null where it holds none."""
    c = F.transform(F.arrays_zip(F.array(*(F.lit(i) for i in range(len(candidates)))).alias("rank"), F.array(*candidates).alias("path")), lambda x: F.struct(x["rank"].alias("rank"), x["path"].alias("path")))
    rows = wanted.select(*keys, F.explode(c).alias("c")).select(*keys, "c.rank", "c.path")
    found = rows.join(listing.select("path").distinct(), "path").groupBy(*keys).agg(F.min_by("path", "rank").alias("path"))
    return wanted.select(*keys).distinct().join(found, keys, "left")


def chosen_variants(variants: DataFrame, explicit: list[str], want: str) -> DataFrame:
    """Which variants (family, model, seed, ensemble) of each family are used.

    Those of `explicit`, where a family has any. Else `all`; or the one that `want` names (`ensemble`, `seedN`); a family
    without it falls back to seed 0, then to its first model by name. A family with seeds but not the wanted one is an error.
    """
    v = variants.withColumn("_explicit", F.col("model").isin(explicit) if explicit else F.lit(False))
    family = Window.partitionBy("family")
    v = v.withColumn("_any", F.max("_explicit").over(family))
    if want == "all":
        hit = F.lit(True)
        v = v.withColumn("_pick", F.lit(True))
    else:
        seed = int(want[4:]) if want.startswith("seed") else None
        hit = (F.col("seed") == seed) if seed is not None else F.col("ensemble")
        hit = F.coalesce(hit, F.lit(False))
        if seed is not None:
            # families without seeds fall back; with other seeds alone, the wanted one is missing
            lost = (F.count("seed").over(family) > 0) & ~F.max(hit).over(family) & ~F.col("_any")
            v = v.withColumn("model", F.when(lost, F.raise_error(F.concat(F.lit(f"no {want} in "), F.col("family")))).otherwise(F.col("model")))
        order = F.when(hit, 0).when(F.col("seed") == 0, 1).otherwise(2)
        v = v.withColumn("_pick", F.row_number().over(family.orderBy(order, "model")) == 1)
    return v.filter(F.when(F.col("_any"), F.col("_explicit")).otherwise(F.col("_pick"))).select("family", "model")


def worst_apex(slices: DataFrame, case: str, good: float = 0.8) -> DataFrame:
    """The apical slice with the least Dice among cases whose mid slices average `good` or more; ties by case and z.

    `slices` has third and dice; slices without a Dice don't count. One row, or none.
    """
    mid = slices.filter("third = 'mid'").groupBy(case).agg(F.avg("dice").alias("_m")).filter(F.col("_m") >= good).select(case)
    apex = slices.filter("third = 'apex' and dice is not null").join(mid, case, "left_semi")
    return apex.orderBy("dice", case, "z").limit(1).select(case, "z", "dice")


def most_off_heart(slices: DataFrame, case: str) -> DataFrame:
    """The case with the greatest share of its predicted voxels on slices without reference; ties by case."""
    s = slices.groupBy(case).agg((F.sum(F.when(F.col("ref") == 0, F.col("pred")).otherwise(0)) / F.nullif(F.sum("pred"), F.lit(0))).alias("share"))
    return s.filter("share > 0").orderBy(F.desc("share"), case).limit(1)


def centre_bounds(lo: Column, hi: Column, size: int, limit: int) -> tuple[Column, Column, Column, Column]:
    """(from, to, padding before, padding after) of a crop of `size` around [lo, hi) in a grid of `limit`.

    The crop is moved into the grid; a grid that is smaller is padded, one more after than before if that is odd.
    """
    if size >= limit:
        before = (size - limit) // 2
        return F.lit(0), F.lit(limit), F.lit(before), F.lit(size - limit - before)
    start = F.least(F.greatest(F.floor((lo + hi - size) / 2).cast("int"), F.lit(0)), F.lit(limit - size))
    return start, start + size, F.lit(0), F.lit(0)


def cropped(voxels: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """Voxels within each group's bounds (z0, z1, y0, ... exclusive ends), with coordinates from there."""
    inside = voxels.join(bounds, keys)
    for c in VOXEL:
        inside = inside.filter((F.col(c) >= F.col(f"{c}0")) & (F.col(c) < F.col(f"{c}1")))
    return inside.select(*(((F.col(c) - F.col(f"{c}0")).alias(c)) if c in VOXEL else c for c in voxels.columns))


def pasted(crop: DataFrame, bounds: DataFrame, grid: DataFrame, keys: list[str], empty: int = 0) -> DataFrame:
    """The labels of a crop back in the full grid; what lies outside is `empty`."""
    back = crop.join(bounds, keys).select(*keys, *((F.col(c) + F.col(f"{c}0")).alias(c) for c in VOXEL), "label")
    return grid.select(*keys, *VOXEL).join(back, [*keys, *VOXEL], "left").withColumn("label", F.coalesce("label", F.lit(empty)))


def crop_to_nonzero(image: DataFrame, keys: list[str], value: str = "intensity") -> DataFrame:
    """Voxels in the box of non-zero ones, with `inside`: non-zero, or in a hole of a slice; `label` outside becomes -1 where it is 0."""
    mask = image.filter(F.col(value) != 0).select(*keys, *VOXEL)
    filled = mask.unionByName(fill_holes(mask, keys)).withColumn("inside", F.lit(True))
    box = mask.groupBy(*keys).agg(*(x for c in VOXEL for x in (F.min(c).alias(f"{c}0"), (F.max(c) + 1).alias(f"{c}1"))))
    cut = cropped(image.join(filled, [*keys, *VOXEL], "left").withColumn("inside", F.coalesce("inside", F.lit(False))), box, keys)
    return cut.withColumn("label", F.when(~F.col("inside") & (F.col("label") == 0), -1).otherwise(F.col("label")))


def region_labels(probabilities: DataFrame, keys: list[str], order: list[int], threshold: float = 0.5) -> DataFrame:
    """Labels from overlapping regions: of the classes in `order` the last whose mean probability exceeds the threshold, else 0."""
    p = probabilities.groupBy(*keys, *VOXEL).agg(*(F.avg(F.when(F.col("class") == c, F.col("p"))).alias(f"p{c}") for c in order))
    label = F.lit(0)
    for c in order:
        label = F.when(F.col(f"p{c}") > threshold, c).otherwise(label)
    return p.select(*keys, *VOXEL, label.alias("label"))


def scaled_to_reference(image: DataFrame, keys: list[str], label: int, to: float = 100.0) -> DataFrame:
    """Intensities scaled so that the mean of a label is `to`; a group where that label is missing or not positive is an error."""
    mean = image.groupBy(*keys).agg(F.avg(F.when(F.col("label") == label, F.col("intensity"))).alias("_mean"))
    sure = F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(F.raise_error(F.concat(F.lit("no positive reference in "), F.concat_ws(" ", *(F.col(k).cast("string") for k in keys)))))
    return image.join(mean, keys).withColumn("intensity", F.lit(to) * F.col("intensity") / sure).drop("_mean")
