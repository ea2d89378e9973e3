"""Grey-level texture and shape of a masked region, as aggregates over voxel tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POINT = ["z", "y", "x"]
# one of each pair of opposite neighbours
DIRECTIONS = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) > (0, 0, 0)]
IN_SLICE = [d for d in DIRECTIONS if d[0] == 0]


def scaled(image: DataFrame, keys: list[str], value: str = "intensity", scale: float = 1.0, outliers: float | None = None) -> DataFrame:
    """`value` as z-score of its whole image times `scale`, clipped to `outliers` deviations; a flat image becomes 0."""
    s = image.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    z = F.when(F.col("_s") > 0, (F.col(value) - F.col("_m")) / F.col("_s")).otherwise(0.0)
    if outliers is not None:
        z = F.least(F.greatest(z, F.lit(-outliers)), F.lit(outliers))
    return image.join(s, keys).withColumn(value, z * F.lit(scale)).drop("_m", "_s")


def discretised(region: DataFrame, keys: list[str], value: str = "intensity", width: float | None = 25.0, bins: int | None = None) -> DataFrame:
    """`level` from 1 up: bins of `width` aligned to its multiples, or `bins` equal bins between minimum and maximum."""
    s = region.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    v, lo, hi = F.col(value), F.col("_lo"), F.col("_hi")
    if bins is None:
        level = F.floor(v / width) - F.floor(lo / width) + 1
    else:
        level = F.when(hi > lo, F.least(F.floor((v - lo) * bins / (hi - lo)) + 1, F.lit(bins))).otherwise(1)
    return region.join(s, keys).withColumn("level", level.cast("int")).drop("_lo", "_hi")


def co_occurrence(levels: DataFrame, keys: list[str], directions: list[tuple[int, int, int]] = DIRECTIONS) -> DataFrame:
    """Symmetric counts `n` of level pairs (i, j) by direction `d`: voxels and moved voxels meet in one aggregate by place, without a self join."""
    moves = F.array(*(F.struct(F.lit(k).alias("d"), F.lit(a).alias("dz"), F.lit(b).alias("dy"), F.lit(c).alias("dx")) for k, (a, b, c) in enumerate(directions)))
    base = levels.select(*keys, *POINT, "level").withColumn("o", F.explode(moves))
    nil = F.lit(None).cast("int")
    sides = F.array(
        F.struct(*(F.col(c).alias(c) for c in POINT), F.col("level").alias("i"), nil.alias("j")),
        F.struct(*((F.col(c) + F.col(f"o.d{c}")).alias(c) for c in POINT), nil.alias("i"), F.col("level").alias("j")),
    )
    met = base.select(*keys, F.col("o.d").alias("d"), F.explode(sides).alias("s")).groupBy(*keys, "d", *(F.col(f"s.{c}").alias(c) for c in POINT)).agg(F.max("s.i").alias("i"), F.max("s.j").alias("j"))
    pairs = met.filter("i is not null and j is not null").groupBy(*keys, "d", "i", "j").agg(F.count("*").alias("n"))
    both = F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return pairs.select(*keys, "d", "n", both.alias("p")).groupBy(*keys, "d", "p.i", "p.j").agg(F.sum("n").alias("n"))


def _bits(p: Column) -> Column:
    return -p * F.log2(p)


def glcm_features(levels: DataFrame, keys: list[str], directions: list[tuple[int, int, int]] = DIRECTIONS) -> DataFrame:
    """23 co-occurrence features, each the mean over directions; a direction without pairs takes no part.

    The marginal distributions of a symmetric matrix are equal, so both joint entropies of independent marginals are twice
    the marginal's entropy.
    """
    here = [*keys, "d"]
    w, g = Window.partitionBy(*here), Window.partitionBy(*keys)
    c = co_occurrence(levels, keys, directions)
    c = c.withColumn("p", F.col("n") / F.sum("n").over(w)).withColumn("u", F.sum(F.col("i") * F.col("n")).over(w) / F.sum("n").over(w)).withColumn("ng", F.max("i").over(g))
    i, j, p, u, ng = (F.col(x) for x in ("i", "j", "p", "u", "ng"))
    gap, off = F.abs(i - j), i + j - 2 * u
    joint = c.groupBy(*here).agg(
        F.sum(p * i * j).alias("autocorrelation"), F.max(u).alias("joint_average"), F.sum(p * off * off * off * off).alias("cluster_prominence"),
        F.sum(p * off * off * off).alias("cluster_shade"), F.sum(p * off * off).alias("cluster_tendency"), F.sum(p * gap * gap).alias("contrast"),
        F.sum(p * (i - u) * (j - u)).alias("_cov"), F.sum(p * (i - u) * (i - u)).alias("sum_squares"), F.sum(p * gap).alias("difference_average"),
        F.sum(p * p).alias("joint_energy"), F.sum(_bits(p)).alias("joint_entropy"), F.sum(p / (1 + gap * gap)).alias("idm"),
        F.sum(p / (1 + gap * gap / (ng * ng))).alias("idmn"), F.sum(p / (1 + gap)).alias("id"), F.sum(p / (1 + gap / ng)).alias("idn"),
        F.sum(F.when(gap > 0, p / (gap * gap)).otherwise(0.0)).alias("inverse_variance"), F.max(p).alias("maximum_probability"))
    views = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), v.cast("int").alias("v")) for k, v in enumerate((i, gap, i + j)))))
    sums = c.select(*here, "p", views.alias("m")).groupBy(*here, "m.k", "m.v").agg(F.sum("p").alias("p"))
    of = lambda k: F.sum(F.when(F.col("k") == k, _bits(p)).otherwise(0.0))
    margins = sums.groupBy(*here).agg(of(0).alias("_hx"), of(1).alias("difference_entropy"), of(2).alias("sum_entropy"))
    all_ = joint.join(margins, here)
    hx, hxy = F.col("_hx"), F.col("joint_entropy")
    all_ = all_.withColumns({
        "correlation": F.when(F.col("sum_squares") > 0, F.col("_cov") / F.col("sum_squares")).otherwise(1.0),
        "difference_variance": F.col("contrast") - F.col("difference_average") * F.col("difference_average"),
        "sum_average": 2 * F.col("joint_average"),
        "imc1": F.when(hx > 0, (hxy - 2 * hx) / hx).otherwise(0.0),
        "imc2": F.sqrt(F.greatest(F.lit(0.0), 1 - F.exp(-2 * (2 * hx - hxy)))),
    })
    names = [n for n in all_.columns if n not in here and not n.startswith("_")]
    return all_.groupBy(*keys).agg(*(F.avg(n).alias(n) for n in names))


def hull(y: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Corners (y, x) of the convex hull of grid lines, each given by its row and ends, by monotone chains over the ends."""
    order = np.argsort(y)
    chains = []
    for x, turn in ((lo, 1), (hi, -1)):
        chain: list[tuple[int, int]] = []
        for p in zip(y[order].tolist(), x[order].tolist(), strict=True):
            while len(chain) > 1 and turn * ((chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0])) <= 0:
                chain.pop()
            chain.append(p)
        chains += chain
    return np.unique(np.array(chains, dtype=np.int64).reshape(-1, 2), axis=0)


def farthest(points: np.ndarray) -> tuple[float, int]:
    """Greatest distance of two of the points (n x 3, in mm), and how many pairs were measured.

    Points go from the outermost inwards, in blocks: no pair is farther apart than both lie from the middle, so pairs
    that can't beat the greatest distance so far are left out, which changes nothing.
    """
    r = np.sqrt(((points - (points.min(axis=0) + points.max(axis=0)) / 2) ** 2).sum(axis=1))
    order = np.argsort(-r)
    p, r, best, pairs = points[order], r[order], 0.0, 0
    for i in range(0, len(p), 256):
        part = p[i : i + 256]
        end = min(i + len(part), int(np.searchsorted(-r, r[i] - best * (1 - 1e-12), side="right")))
        for j in range(0, end, 4096):
            other = p[j : min(j + 4096, end)]
            pairs += len(part) * len(other)
            best = max(best, float(np.sqrt(sum((part[:, a, None] - other[None, :, a]) ** 2 for a in range(3)).max())))
        if r[i] + r[0] < best * (1 - 1e-12):
            break
    return best, pairs


def diameters(mask: DataFrame, keys: list[str], spacing: tuple[float, float, float]) -> DataFrame:
    """Greatest distance of two voxels of each mask, in space (diameter_3d) and within a slice (diameter_slice), in mm.

    A farthest pair lies on corners of slices' convex hulls. Lines shrink to their ends, slices to their hulls, each in a
    grouped pass; only the corners of one mask meet in a task, which are at most two for each of its lines.
    """
    sz, sy, sx = spacing

    @F.pandas_udf("points array<struct<y: long, x: long>>, diameter double")
    def corners(y: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
        found = [hull(*(np.asarray(a, dtype=np.int64) for a in row)) for row in zip(y, lo, hi, strict=True)]
        far = [farthest(np.c_[np.zeros(len(h)), h[:, 0] * sy, h[:, 1] * sx])[0] for h in found]
        return pd.DataFrame({"points": [[{"y": a, "x": b} for a, b in h.tolist()] for h in found], "diameter": far})

    @F.pandas_udf("double")
    def widest(z: pd.Series, y: pd.Series, x: pd.Series) -> pd.Series:
        return pd.Series([farthest(np.c_[np.asarray(a) * sz, np.asarray(b) * sy, np.asarray(c) * sx])[0] for a, b, c in zip(z, y, x, strict=True)], dtype=float)

    lines = mask.groupBy(*keys, "z", "y").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    slices = lines.groupBy(*keys, "z").agg(F.collect_list(F.struct("y", "lo", "hi")).alias("l"))
    slices = slices.select(*keys, "z", corners("l.y", "l.lo", "l.hi").alias("h"))
    points = F.flatten(F.collect_list(F.transform("h.points", lambda p: F.struct(F.col("z").alias("z"), p["y"].alias("y"), p["x"].alias("x")))))
    whole = slices.groupBy(*keys).agg(points.alias("p"), F.max("h.diameter").alias("diameter_slice"))
    return whole.select(*keys, widest("p.z", "p.y", "p.x").alias("diameter_3d"), "diameter_slice")


def shape_features(mask: DataFrame, keys: list[str], spacing: tuple[float, float, float]) -> DataFrame:
    """Volume, greatest diameter (in space and within a slice), axis lengths, elongation and flatness of a mask, in mm.

    Axis lengths are 4 times the root of the eigenvalues of the population covariance, by the closed form for symmetric
    3 x 3 matrices. The diameters are those of `diameters`.
    """
    mm = {a: F.col(a) * F.lit(s) for a, s in zip(POINT, spacing, strict=True)}
    cov = {a + b: F.covar_pop(mm[a], mm[b]).alias(a + b) for a, b in ("zz", "yy", "xx", "zy", "zx", "yx")}
    m = mask.groupBy(*keys).agg((F.count("*") * F.lit(spacing[0] * spacing[1] * spacing[2])).alias("volume"), *cov.values())
    zz, yy, xx, zy, zx, yx = (F.col(c) for c in cov)
    m = m.withColumn("q", (zz + yy + xx) / 3)
    q = F.col("q")
    m = m.withColumn("s", F.sqrt(((zz - q) * (zz - q) + (yy - q) * (yy - q) + (xx - q) * (xx - q) + 2 * (zy * zy + zx * zx + yx * yx)) / 6))
    det = (zz - q) * ((yy - q) * (xx - q) - yx * yx) - zy * (zy * (xx - q) - yx * zx) + zx * (zy * yx - (yy - q) * zx)
    m = m.withColumn("t", F.when(F.col("s") > 0, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), det / (2 * F.col("s") * F.col("s") * F.col("s"))))) / 3).otherwise(0.0))
    third = 2 * F.acos(F.lit(-1.0)) / 3
    m = m.withColumn("l1", q + 2 * F.col("s") * F.cos("t")).withColumn("l3", F.greatest(F.lit(0.0), q + 2 * F.col("s") * F.cos(F.col("t") + third)))
    m = m.withColumn("l2", F.greatest(F.lit(0.0), 3 * q - F.col("l1") - F.col("l3")))
    d = diameters(mask, keys, spacing)
    axis = lambda n: 4 * F.sqrt(F.col(n))
    ratio = lambda n: F.when(F.col("l1") > 0, F.sqrt(F.col(n) / F.col("l1")))
    return m.join(d, keys).select(*keys, "volume", "diameter_3d", "diameter_slice", axis("l1").alias("major"), axis("l2").alias("minor"), axis("l3").alias("least"), ratio("l2").alias("elongation"), ratio("l3").alias("flatness"))


def first_order(values: DataFrame, keys: list[str], spacing: tuple[float, float, float], width: float = 25.0, value: str = "intensity") -> DataFrame:
    """The 18 first-order features of a region's intensities; entropy and uniformity over levels of `width`.

    Total energy is per voxel volume in mm3; robust deviation is over values between the 10th and 90th percentile; a flat
    region has skewness and kurtosis 0.
    """
    v = F.col(value)
    base = values.groupBy(*keys).agg(F.avg(v).alias("_m"), F.percentile(v, F.lit(0.1)).alias("_p10"), F.percentile(v, F.lit(0.9)).alias("_p90"))
    j = values.select(*keys, v.alias(value)).join(base, keys)
    core = (v >= F.col("_p10")) & (v <= F.col("_p90"))
    robust = j.groupBy(*keys).agg(F.avg(F.when(core, v)).alias("_r"))
    j = j.join(robust, keys)
    d = v - F.col("_m")
    quarter = [F.percentile(v, F.lit(q)) for q in (0.25, 0.75)]
    flat = F.var_pop(v) == 0
    out = j.groupBy(*keys).agg(
        F.sum(v * v).alias("energy"), (F.sum(v * v) * F.lit(float(spacing[0] * spacing[1] * spacing[2]))).alias("total_energy"), F.min(v).alias("minimum"), F.first("_p10").alias("p10"), F.first("_p90").alias("p90"), F.max(v).alias("maximum"),
        F.avg(v).alias("mean"), F.percentile(v, F.lit(0.5)).alias("median"), (quarter[1] - quarter[0]).alias("iqr"), (F.max(v) - F.min(v)).alias("range"), F.avg(F.abs(d)).alias("mad"), F.avg(F.when(core, F.abs(v - F.col("_r")))).alias("robust_mad"),
        F.sqrt(F.avg(v * v)).alias("rms"), F.when(flat, 0.0).otherwise(F.avg(d * d * d) / F.pow(F.var_pop(v), 1.5)).alias("skewness"), F.when(flat, 0.0).otherwise(F.avg(d * d * d * d) / F.pow(F.var_pop(v), 2)).alias("kurtosis"), F.var_pop(v).alias("variance"),
    )
    low = values.groupBy(*keys).agg(F.floor(F.min(v) / width).alias("_lo"), F.count(v).alias("_n"))
    levels = values.join(low, keys).groupBy(*keys, (F.floor(v / width) - F.col("_lo")).alias("_level")).agg((F.count("*") / F.first("_n")).alias("_p"))
    return out.join(levels.groupBy(*keys).agg((-F.sum(F.col("_p") * F.log2("_p"))).alias("entropy"), F.sum(F.col("_p") * F.col("_p")).alias("uniformity")), keys)
