"""Which label is which: anatomy from enclosure, dense renumbering, thresholds from histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .neighbours import fill_holes

POINT = ["z", "y", "x"]


def enclosure(labels: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and pair of labels: the share of `inner`'s voxels that lie in holes of `outer`, slice by slice; 0 is not listed."""
    l = labels.filter("label > 0").select(*keys, *POINT, "label")
    holes = fill_holes(l.withColumnRenamed("label", "outer"), [*keys, "outer"])
    total = l.groupBy(*keys, F.col("label").alias("inner")).agg(F.count("*").alias("total"))
    held = holes.join(l.withColumnRenamed("label", "inner"), [*keys, *POINT]).groupBy(*keys, "outer", "inner").agg(F.count("*").alias("held"))
    return held.join(total, [*keys, "inner"]).select(*keys, "outer", "inner", (F.col("held") / F.col("total")).alias("score"))


def anatomy(labels: DataFrame, keys: list[str], least: float = 0.1, margin: float = 0.05) -> DataFrame:
    """Per group: `wall`, the label that best encloses another, and `cavity`, the label that it encloses; the best score must
    exceed `least` and lead every other outer label's by `margin`. Groups without such a label have no row."""
    return surest(enclosure(labels, keys), keys, least, margin)


def surest(enclosures: DataFrame, keys: list[str], least: float = 0.1, margin: float = 0.05) -> DataFrame:
    """`anatomy` of scores that are known: rows as of `enclosure`."""
    by_outer = enclosures.groupBy(*keys, "outer").agg(F.max(F.struct("score", (-F.col("inner")).alias("minus"))).alias("best"))
    ranked = by_outer.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("best.score"), "outer")))
    two = ranked.filter("place <= 2").groupBy(*keys).agg(F.max_by("outer", -F.col("place")).alias("wall"), F.max(F.when(F.col("place") == 1, F.col("best"))).alias("best"), F.max(F.when(F.col("place") == 2, F.col("best.score"))).alias("second"))
    sure = (F.col("best.score") > least) & (F.col("best.score") - F.coalesce("second", F.lit(0.0)) >= margin)
    return two.filter(sure).select(*keys, "wall", (-F.col("best.minus")).alias("cavity"), F.col("best.score").alias("score"))


def canonical(labels: DataFrame, keys: list[str]) -> DataFrame:
    """Labels renamed to 1 (the rest), 2 (wall) and 3 (cavity); groups without a sure wall keep theirs."""
    return named(labels, anatomy(labels, keys), keys)


def named(labels: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a label renamed by their group's `wall` and `cavity`, as `canonical` does."""
    a, v = found.drop("score"), F.col("label")
    name = F.when(F.col("wall").isNull() | (v == 0), v).when(v == F.col("wall"), 2).when(v == F.col("cavity"), 3).otherwise(1)
    return labels.join(a, keys, "left").withColumn("label", name.cast("int")).drop("wall", "cavity")


def dense(labels: DataFrame, keys: list[str]) -> DataFrame:
    """Positive labels renumbered 1, 2, ... in their order within each group: the ranks come from the distinct labels alone."""
    rank = labels.filter("label > 0").select(*keys, "label").distinct().withColumn("_to", F.dense_rank().over(Window.partitionBy(*keys).orderBy("label")))
    return labels.join(rank, [*keys, "label"], "left").withColumn("label", F.coalesce("_to", F.lit(0))).drop("_to")


def otsu(values: DataFrame, keys: list[str], value: str = "intensity", bins: int = 48, least: int = 8) -> DataFrame:
    """Per group the `threshold` (a bin's centre) of greatest variance between classes, the first at a tie; null for fewer than
    `least` values or equal ones. Windows run over at most `bins` rows a group."""
    s = values.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("total"))
    good = s.filter((F.col("total") >= least) & (F.col("hi") > F.col("lo")))
    step = (F.col("hi") - F.col("lo")) / bins
    counts = values.join(good, keys).groupBy(*keys, F.least(F.floor((F.col(value) - F.col("lo")) / step), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    full = good.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).join(counts, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("at", F.col("lo") + (F.col("bin") + 0.5) * step)
    up = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    run = full.withColumn("w0", F.sum("n").over(up)).withColumn("s0", F.sum(F.col("n") * F.col("bin")).over(up)).withColumn("sum", F.sum(F.col("n") * F.col("bin")).over(whole)).withColumn("w1", F.col("total") - F.col("w0"))
    lead = F.col("s0") * F.col("total") - F.col("sum") * F.col("w0")
    between = F.when(F.col("w1") > 0, lead.cast("double") * lead / (F.col("w0") * F.col("w1")))
    top = run.withColumn("b", between).filter("b is not null").groupBy(*keys).agg(F.max_by("at", F.struct("b", -F.col("bin"))).alias("threshold"))
    return s.select(*keys).join(top, keys, "left")


def darkest(region: DataFrame, keys: list[str], most: str, value: str = "intensity") -> DataFrame:
    """At most `most` (an expression over the row) voxels of each group, the darkest first, ties by z, y, x."""
    w = Window.partitionBy(*keys).orderBy(value, *POINT)
    return region.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.expr(most)).drop("_r")
