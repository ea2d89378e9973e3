"""Cleaning of masks: dark pool voxels that belong to the wall, largest components, and whether cleaning helps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import settled
from .labels import darkest, otsu
from .neighbours import IN_SLICE, ball, closing, components, dilate, fill_holes, keep_largest, opening, shifted, sized, voxel_code

VOXEL = ["z", "y", "x"]
WALL, POOL = 2, 3


def _touching(parts: DataFrame, wall: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Per component the number of wall voxels within an in-slice disc around it."""
    near = shifted(parts.select(*keys, "component", *VOXEL), ball(radius)).distinct()
    return near.join(wall.select(*keys, *VOXEL), [*keys, *VOXEL], "left_semi").groupBy(*keys, "component").agg(F.count("*").alias("touching"))


def _capped(selected: DataFrame, pool: DataFrame, keys: list[str], most: float, keep: float) -> DataFrame:
    """The darkest selected voxels of each group, as many as leave the pool a share `keep` and move at most a share `most`."""
    size = pool.groupBy(*keys).agg(F.count("*").alias("_n"))
    allowed = F.least(F.floor(F.lit(most) * F.col("_n")), F.greatest(F.lit(0), F.col("_n") - F.floor(F.lit(keep) * F.col("_n"))))
    return darkest(selected.join(size.select(*keys, allowed.alias("_most")), keys), keys, "_most").drop("_most")


class RingRelabel:
    """Pool voxels beside the wall that are dark by Otsu's threshold of each slice's ring, and what is dark and joined to them.

    `voxels` has keys, z, y, x, label and intensity. strength, from 0 to 1, sets radius, growth, sizes and confidence;
    `most` and `keep` bound the share of the pool that moves and that must remain. All steps work on all groups at once.
    """

    def __init__(self, voxels: DataFrame, keys: list[str], strength: float = 0.5, most: float = 0.25, keep: float = 0.5, bins: int = 48, least: int = 8):
        self.keys, self.s = keys, min(1.0, max(0.0, strength))
        self.most, self.keep = min(min(1.0, max(0.0, most)), 0.03 + 0.22 * self.s), max(min(1.0, max(0.0, keep)), 0.70 - 0.20 * self.s)
        self.pool, self.wall = voxels.filter(F.col("label") == POOL).drop("label"), voxels.filter(F.col("label") == WALL).select(*keys, *VOXEL)
        self.slice = [*keys, "z"]
        ring = dilate(self.wall, keys, ball(1 if self.s <= 0.6 else 2)).join(self.pool, [*keys, *VOXEL])
        v = F.col("intensity")
        stats = ring.groupBy(*self.slice).agg(F.stddev_pop(v).alias("sd"), F.percentile(v, F.lit(0.95)).alias("p95"), F.min(v).alias("low"), F.max(v).alias("high"))
        cuts = otsu(ring, self.slice, bins=bins, least=least).filter("threshold is not null").join(stats, self.slice)
        self.cuts = cuts.withColumn("domain", F.least(F.col("threshold") + F.lit(0.10 + 0.40 * self.s) * F.col("sd"), F.col("p95")))
        self.seeds = ring.join(self.cuts, self.slice).filter("intensity <= threshold").select(*keys, *VOXEL)

    def grown(self) -> DataFrame:
        """The seeds and the dark pool voxels that a bounded number of in-slice steps through dark ones reaches."""
        dark = self.pool.join(self.cuts, self.slice).filter("intensity <= domain").select(*self.keys, *VOXEL)
        now = self.seeds
        for _ in range(1 + round(5 * self.s)):
            now = dilate(now, self.keys, ball(1)).join(dark, [*self.keys, *VOXEL], "left_semi")
        return settled(now)

    def judged(self) -> tuple[DataFrame, DataFrame]:
        """(voxels with their component, components with size, darkness, adjacency, seed share, confidence and `why`)."""
        parts = components(self.grown(), self.keys, IN_SLICE)
        held = parts.join(self.pool, [*self.keys, *VOXEL]).join(self.seeds.withColumn("_s", F.lit(1)), [*self.keys, *VOXEL], "left")
        found = held.groupBy(*self.slice, "component").agg(F.count("*").alias("size"), F.avg("intensity").alias("mean"), F.count("_s").alias("seeds"))
        found = found.join(_touching(parts, self.wall, self.keys, 1), [*self.keys, "component"], "left").join(self.cuts, self.slice)

        def unit(x):
            return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))

        size, touching = F.greatest("size", F.lit(1)), F.coalesce("touching", F.lit(0))
        found = found.withColumn("touching", touching).withColumn("darkness", unit(1 - (F.col("mean") - F.col("low")) / (F.col("high") - F.col("low") + 1e-8)))
        found = found.withColumn("adjacency", unit(2 * F.col("touching") / size)).withColumn("seeding", unit(2 * F.col("seeds") / size))
        found = found.withColumn("confidence", 0.55 * F.col("darkness") + 0.25 * F.col("adjacency") + 0.20 * F.col("seeding"))
        why = F.when(F.col("size") < (2 if self.s >= 0.7 else 3), "small").when(F.col("touching") == 0, "apart").when(F.col("confidence") < 0.78 - 0.20 * self.s, "unsure").otherwise("accepted")
        return parts, found.withColumn("why", why)

    def selected(self) -> DataFrame:
        """The voxels that move from pool to wall, with their intensity."""
        parts, found = self.judged()
        good = parts.join(found.filter("why = 'accepted'").select(*self.keys, "component"), [*self.keys, "component"], "left_semi")
        return _capped(good.join(self.pool, [*self.keys, *VOXEL]), self.pool, self.keys, self.most, self.keep)


def band_relabel(voxels: DataFrame, keys: list[str], percentile: float | None = 0.15, absolute: float = 0.0, least: int = 3, band: int = 1, reach: int = 1, smooth: int = 0, most: float = 0.25, keep: float = 0.5) -> DataFrame:
    """Dark pool voxels near the wall that move to it, with their intensity.

    Dark is at or below a percentile of the pool, or `absolute` where percentile is None. Candidates lie within `band` of
    the wall (0: anywhere); components (faces, all three axes) need `least` voxels and wall within `reach` (0: no such need).
    `smooth` rounds of closing and opening, holes filled, stay within pool and band. Shares `most` and `keep` as in RingRelabel.
    """
    pool, wall = voxels.filter(F.col("label") == POOL).drop("label"), voxels.filter(F.col("label") == WALL).select(*keys, *VOXEL)
    cut = pool.groupBy(*keys).agg((F.lit(absolute) if percentile is None else F.percentile("intensity", F.lit(percentile))).alias("_cut"))
    near = pool if band <= 0 else pool.join(dilate(wall, keys, ball(band)), [*keys, *VOXEL], "left_semi")
    candidates = near.join(cut, keys).filter("intensity <= _cut").select(*keys, *VOXEL)
    parts = components(candidates, keys)
    good = sized(parts, keys).filter(F.col("size") >= least).select(*keys, "component")
    if reach > 0:
        good = good.join(_touching(parts, wall, keys, reach), [*keys, "component"], "left_semi")
    chosen = parts.join(good, [*keys, "component"], "left_semi").select(*keys, *VOXEL)
    for _ in range(smooth):
        chosen = opening(closing(chosen, keys, ball(1)), keys, ball(1))
    if smooth:
        chosen = settled(chosen)
        chosen = chosen.unionByName(fill_holes(chosen, keys)).distinct()
    return _capped(chosen.join(near, [*keys, *VOXEL]), pool, keys, most, keep)


def relabel_statistics(voxels: DataFrame, moved: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: pool and wall before and after, voxels moved and their share of the pool (0 without a pool)."""
    n = moved.groupBy(*keys).agg(F.count("*").alias("changed"))
    before = voxels.groupBy(*keys).agg(F.count_if(F.col("label") == POOL).alias("pool_before"), F.count_if(F.col("label") == WALL).alias("wall_before"))
    out = before.join(n, keys, "left").withColumn("changed", F.coalesce("changed", F.lit(0).cast("long")))
    share = F.when(F.col("pool_before") > 0, F.col("changed") / F.col("pool_before")).otherwise(0.0)
    return out.select(*keys, "pool_before", "wall_before", "changed", (F.col("pool_before") - F.col("changed")).alias("pool_after"), (F.col("wall_before") + F.col("changed")).alias("wall_after"), share.alias("share"))


def relabelled(voxels: DataFrame, moved: DataFrame, keys: list[str]) -> DataFrame:
    """The labels after the move, with `delta`, 1 where a voxel moved."""
    out = voxels.join(moved.select(*keys, *VOXEL, F.lit(1).alias("delta")), [*keys, *VOXEL], "left").withColumn("delta", F.coalesce("delta", F.lit(0)))
    return out.withColumn("label", F.when(F.col("delta") == 1, WALL).otherwise(F.col("label")))


def largest_foreground(labels: DataFrame, keys: list[str], least: int | None = None) -> DataFrame:
    """Labels within the largest component of all labels together."""
    kept = keep_largest(labels.filter("label > 0").select(*keys, *VOXEL), keys, least)
    return labels.filter("label > 0").join(kept, [*keys, *VOXEL], "left_semi")


def largest_by_label(labels: DataFrame, keys: list[str], classes: list[int], least: int | None = None) -> DataFrame:
    """Labels of `classes` within their own largest component, and all other labels."""
    mine = labels.filter(F.col("label").isin(classes))
    kept = keep_largest(mine.select(*keys, "label", *VOXEL), [*keys, "label"], least)
    return mine.join(kept, [*keys, "label", *VOXEL], "left_semi").unionByName(labels.filter((F.col("label") > 0) & ~F.col("label").isin(classes)))


def _apart(groups: dict[str, list[int]]) -> list[list[str]]:
    """Groups in batches without a common label; a group comes after earlier ones that it shares a label with."""
    batches: list[list[str]] = []
    for name, labels in groups.items():
        last = max((n for n, b in enumerate(batches) if any(set(labels) & set(groups[o]) for o in b)), default=-1)
        if last + 1 == len(batches):
            batches.append([])
        batches[last + 1].append(name)
    return batches


def keep_by_groups(labels: DataFrame, keys: list[str], groups: dict[str, list[int]], volume: float = 1.0, least: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Foreground without the smaller components of each group of labels, and a report.

    The labels of a group count as one region. Groups go in order, each on what earlier ones left; those without a common label
    share one run. Components as large as the largest stay, and with a group in `least` also those of at least that volume (a voxel
    has `volume`). The report has a row for each mask of `labels` and group: `largest_removed` (null where nothing goes) and `kept`,
    the largest one's volume (null without the group's labels). A label of 0 in a group is an error.
    """
    if any(k <= 0 for members in groups.values() for k in members):
        raise ValueError("background can't be cleaned")
    image, reports = labels.filter("label > 0").select(*keys, *VOXEL, "label"), None
    batches = _apart(groups)
    for n, batch in enumerate(batches):
        name, floor = F.lit(None).cast("string"), F.lit(None).cast("double")
        for g in batch:
            name = F.when(F.col("label").isin(groups[g]), g).otherwise(name)
            if least and g in least:
                floor = F.when(F.col("_g") == g, F.lit(float(least[g]))).otherwise(floor)
        mine = [*keys, "_g"]
        parts = settled(components(image.withColumn("_g", name).filter("_g is not null").select(*mine, *VOXEL), mine), "groups")
        goes = (F.col("size") < F.col("top")) & F.coalesce(F.col("size") * F.lit(volume) < floor, F.lit(True))
        sizes = sized(parts, mine).withColumn("_goes", goes)
        report = sizes.groupBy(*mine).agg((F.max(F.when(F.col("_goes"), F.col("size"))) * F.lit(volume)).alias("largest_removed"), (F.max("size") * F.lit(volume)).alias("kept"))
        reports = report if reports is None else reports.unionByName(report)
        gone = parts.join(sizes.filter("_goes").select(*mine, "component"), [*mine, "component"], "left_semi")
        image = image.join(gone.select(*keys, *VOXEL), [*keys, *VOXEL], "left_anti")
        if n + 1 < len(batches):
            image = settled(image, "cleaned")
    masks = labels.select(*keys).distinct().withColumn("_g", F.explode(F.array(*map(F.lit, groups))))
    return image, masks.join(reports, [*keys, "_g"], "left").withColumnRenamed("_g", "group_name")


def component_scores(pred: DataFrame, ref: DataFrame, keys: list[str], by: list[str], classes: list[int]) -> DataFrame:
    """Every component of every class: keys, by, label, component, size, hits (voxels of the class in the reference), in_largest.

    One run finds the components of each label and, as label 0, those of all labels together; in_largest says whether the
    component lies in a largest one of all labels. It lies in one as a whole, so its least voxel tells.
    """
    group = [*keys, *by]
    l = pred.filter("label > 0").select(*group, *VOXEL, "label")
    forest = settled(components(l.unionByName(l.withColumn("label", F.lit(0).cast(l.schema["label"].dataType))), [*group, "label"]), "forest")
    union = forest.filter("label = 0").drop("label")
    own = forest.filter(F.col("label").isin(classes))
    hit = ref.filter(F.col("label").isin(classes)).select(*keys, *VOXEL, "label", F.lit(1).alias("_hit"))
    found = own.join(hit, [*keys, *VOXEL, "label"], "left").groupBy(*group, "label", "component").agg(F.count("*").alias("size"), F.count("_hit").alias("hits"))
    largest = sized(union, group).filter("size = top").select(*group, F.col("component").alias("_whole"))
    least = union.withColumnRenamed("component", "_whole").withColumn("component", voxel_code())
    return found.join(least.select(*group, "component", "_whole"), [*group, "component"]).join(largest.withColumn("_in", F.lit(True)), [*group, "_whole"], "left").select(*group, "label", "component", "size", "hits", F.coalesce("_in", F.lit(False)).alias("in_largest"))


def decide(pred: DataFrame, ref: DataFrame, keys: list[str], by: list[str], classes: list[int], eps: float = 0.0) -> DataFrame:
    """Which cleaning helps: rows (step, label, mean Dice before, after, accepted), one or two for each class.

    First the largest component of all labels together, accepted if a class gains more than `eps` and none loses; then, on
    the result, each class by itself (if there are several), accepted where it gains more than `eps`. Largest components that tie all
    stay. Means are over the groups that have the class on either side. `keys` are in both tables, `by` in `pred` alone.
    Both steps are sums over one table of components; only the last windows, over the classes, see all rows.
    """
    from pyspark.sql import Window

    group, c = [*keys, *by], component_scores(pred, ref, keys, by, classes)
    mine = Window.partitionBy(*group, "label")
    c = c.withColumn("_top", F.max("size").over(mine)).withColumn("_top_in", F.max(F.when(F.col("in_largest"), F.col("size"))).over(mine))
    kept = {"raw": F.lit(True), "whole": F.col("in_largest"), "each_raw": F.col("size") == F.col("_top"), "each_whole": F.col("in_largest") & (F.col("size") == F.col("_top_in"))}
    sums = c.groupBy(*group, "label").agg(*(F.sum(F.when(k, F.col(v))).alias(f"{v}_{n}") for n, k in kept.items() for v in ("size", "hits")))
    theirs = ref.filter(F.col("label").isin(classes)).groupBy(*keys, "label").agg(F.count("*").alias("_r"))
    groups = settled(pred.select(*group).distinct(), "groups")
    # frames that only the reference has, once for each value of `by`
    lone = theirs.select(*keys).distinct().join(groups.select(*keys).distinct(), keys, "left_anti")
    groups = groups.unionByName(lone.crossJoin(groups.select(*by).distinct()) if by else lone)
    rows = groups.withColumn("label", F.explode(F.array(*map(F.lit, classes)))).join(sums, [*group, "label"], "left").join(theirs, [*keys, "label"], "left")

    return decided(rows.withColumnRenamed("_r", "r"), classes, eps)


def decided(sums: DataFrame, classes: list[int], eps: float = 0.0) -> DataFrame:
    """The rows of `decide` from sums of every group and class: label, size and hits as they are (raw) and with what either step keeps
    (whole, each_raw, each_whole), and `r`, the class's voxels in the reference."""
    from pyspark.sql import Window

    def n(name: str):
        return F.coalesce(name, F.lit(0))

    dice = sums.groupBy("label").agg(*(F.avg(2.0 * n(f"hits_{k}") / F.nullif(n(f"size_{k}") + n("r"), F.lit(0))).alias(k) for k in ("raw", "whole", "each_raw", "each_whole")))
    all_ = Window.partitionBy(F.lit(1))  # a row for each class
    good = F.coalesce(F.bool_or(F.col("whole") > F.col("raw") + eps).over(all_), F.lit(False)) & ~F.coalesce(F.bool_or(F.col("whole") < F.col("raw")).over(all_), F.lit(False))
    d = dice.withColumn("good", good)
    before, after = F.when(F.col("good"), F.col("whole")).otherwise(F.col("raw")), F.when(F.col("good"), F.col("each_whole")).otherwise(F.col("each_raw"))
    step = lambda name, b, a, ok: F.struct(F.lit(name).alias("step"), "label", b.alias("before"), a.alias("after"), ok.alias("accepted"))
    steps = [step("all", F.col("raw"), F.col("whole"), F.col("good"))]
    if len(classes) > 1:
        steps.append(step("label", before, after, F.coalesce(after > before + eps, F.lit(False))))
    return d.select(F.explode(F.array(*steps)).alias("s")).select("s.*")


def apply_decision(pred: DataFrame, keys: list[str], decision: list[tuple]) -> DataFrame:
    """The labels after the cleaning that a saved decision, rows as those of `decide`, accepts; `keys` are those of a whole mask."""
    whole, classes = accepted(decision)
    out = largest_foreground(pred, keys) if whole else pred.filter("label > 0")
    return largest_by_label(out, keys, classes) if classes else out


def accepted(decision: list[tuple]) -> tuple[bool, list[int]]:
    """Whether a decision accepts the step on all labels, and the classes of the step on single ones that it accepts."""
    return any(step == "all" and ok for step, _, _, _, ok in decision), [k for step, k, _, _, ok in decision if step == "label" and ok]


def known_wall(labels: DataFrame, keys: list[str], wall: int) -> DataFrame:
    """Groups whose wall label is known and that have two more: renamed to 1, 2 (wall) and 3 (cavity).

    The cavity is the label of which the greater share, above a tenth, lies in the wall's holes; else the one whose centroid
    is nearer to the wall's, the smaller at a tie; without a wall the larger label. Groups with other numbers of labels stay.
    """
    l = labels.filter("label > 0").select(*keys, *VOXEL, "label")
    holes = fill_holes(l.filter(F.col("label") == wall).select(*keys, *VOXEL), keys).withColumn("_in", F.lit(1))
    per = l.join(holes, [*keys, *VOXEL], "left").groupBy(*keys, "label").agg((F.count("_in") / F.count("*")).alias("inside"), *(F.avg(c).alias(c) for c in VOXEL))
    return wall_named(labels, per, keys, wall)


def wall_named(labels: DataFrame, per: DataFrame, keys: list[str], wall: int) -> DataFrame:
    """Rows with a label renamed as `known_wall` does; `per` has each positive label's share `inside` the wall's holes and mean z, y, x."""
    at = per.filter(F.col("label") == wall).select(*keys, *(F.col(c).alias(f"{c}0") for c in VOXEL))
    rest = per.filter(F.col("label") != wall).join(at, keys, "left")
    far = F.sqrt(sum((F.pow(F.col(c) - F.col(f"{c}0"), 2) for c in VOXEL), F.lit(0.0)))
    best = rest.groupBy(*keys).agg(F.count("*").alias("n"), F.max(F.struct("inside", (-F.col("label")).alias("m"))).alias("in"), F.min(F.struct(far.alias("d"), "label")).alias("near"), F.max("label").alias("high"))
    cavity = F.when(F.col("in.inside") > 0.1, -F.col("in.m")).when(F.col("near.d").isNotNull(), F.col("near.label")).otherwise(F.col("high"))
    named = best.filter("n = 2").select(*keys, cavity.alias("_cavity"))
    out = labels.join(named, keys, "left")
    v = F.col("label")
    return out.withColumn("label", F.when(F.col("_cavity").isNull() | (v == 0), v).when(v == wall, WALL).when(v == F.col("_cavity"), POOL).otherwise(1).cast("int")).drop("_cavity")


def stacked(slices: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """Slice predictions put into the full grid; what has no prediction is background."""
    return grid.select(*keys, *VOXEL).join(slices.select(*keys, *VOXEL, "label"), [*keys, *VOXEL], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def sampled_locations(labels: DataFrame, keys: list[str], most: int = 10_000, share: float = 0.01, seed: int = 1234) -> DataFrame:
    """Voxels of each positive label: `most` or, if more, a share of them, or all if there are fewer, in the order of a hash."""
    from pyspark.sql import Window

    l = labels.filter("label > 0").select(*keys, "label", *VOXEL)
    size = l.groupBy(*keys, "label").agg(F.count("*").alias("_n"))
    target = F.least(F.col("_n"), F.greatest(F.lit(most), F.ceil(F.col("_n") * share)))
    order = Window.partitionBy(*keys, "label").orderBy(F.xxhash64(F.lit(seed), *VOXEL), *VOXEL)
    return l.join(size, [*keys, "label"]).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= target).drop("_r", "_n")
