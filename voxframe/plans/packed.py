"""Queries of `texts` whose voxels stay in packed volumes. The SQL that checks them is the text over voxels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import images as im
from ..operators import volumes as vol
from ..tables import CLASSES, FOLDS, X, Y, Z, images, probabilities, sql, volumes
from . import texts

KEYS = ["case_id", "frame_tag"]
SHAPE = (Z, Y, X)


def _counted(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the slices of every predicted volume, one row a volume."""
    return vol.slice_counts(vol.paired(volumes(spark, d, "vox_pred"), volumes(spark, d, "vox_gt"), KEYS), [*KEYS, "model"], SHAPE, 3)


def _on_slices(name: str):
    text = texts.PLANS[name].replace(f"({texts.SLICE})", "{slices}")

    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = _counted(spark, d).selectExpr(*KEYS, "model", "inline(slices)")
        return sql(spark, d, text, slices=rows.selectExpr(*KEYS, "model", "z", "pred", "ref", "tp", "pool + ref_pool as size", "changed"))

    return query


def dice_by_third(spark: SparkSession, d: str) -> DataFrame:
    """Slices with a heart by their place between its ends, of which the one with the larger pool is the base."""
    hearts = _counted(spark, d).filter("case_id is not null").selectExpr("model", "filter(slices, s -> s.ref > 0) as h").filter("size(h) > 0")
    rows = hearts.selectExpr("model", "h[0] as a", "element_at(h, -1) as b", "explode(h) as s")
    way = "case when a.ref_pool >= b.ref_pool then s.z - a.z else b.z - s.z end"
    at = rows.selectExpr("model", "s", f"case when a.z = b.z then 0.5e0 else cast({way} as double) / (b.z - a.z) end as pos")
    scored = at.selectExpr("model", "case when pos <= 1e0 / 3 then 'base' when pos <= 2e0 / 3 then 'mid' else 'apex' end as third", "2e0 * s.tp / nullif(s.pool + s.ref_pool, 0) as dice")
    return scored.groupBy("model", "third").agg(F.count("*").alias("n"), F.round(F.avg("dice"), 6).alias("dice"))


def three_way(spark: SparkSession, d: str) -> DataFrame:
    """Dice of the pool between two models and the reference, each pair of a frame."""
    p = volumes(spark, d, "vox_pred")
    a, b = (p.filter(F.col("model") == f"model_{c}").select(*KEYS, F.col("labels").alias(c)) for c in "ab")
    rows = a.join(b, KEYS).join(volumes(spark, d, "vox_gt").select(*KEYS, F.col("labels").alias("g")), KEYS)
    n = vol.overlaps(rows, KEYS, SHAPE, ["a", "b", "g"], 3)
    return n.selectExpr(*KEYS, *(f"round(2e0 * n_{p}_{q} / nullif(n_{p} + n_{q}, 0), 6) as {p}{q}" for p, q in ("ab", "ag", "bg")))


def shown(spark: SparkSession, d: str) -> DataFrame:
    out = im.label_means(images(spark, d).filter("case_id is not null"), KEYS, SHAPE, [0, 1, 2, 3], im.display_range(0.01, 0.99))
    return out.select(*KEYS, "label", F.round("mean", 6).alias("shown"))


def stability(spark: SparkSession, d: str) -> DataFrame:
    return im.stability(probabilities(spark, d), KEYS, SHAPE, FOLDS, CLASSES, 4, 8).withColumn("score", F.round("score", 6))


def soft_argmax(spark: SparkSession, d: str) -> DataFrame:
    """Of a case without a key, whose probabilities are unknown, the places are null."""
    rows = im.soft_argmax(probabilities(spark, d), KEYS, SHAPE, FOLDS, CLASSES, 0.2).selectExpr(*KEYS, "posexplode(places) as (_at, p)")
    known = [f"case when case_id is not null then {v} end as {n}" for n, v in (("soft_y", "round(p.soft_y, 6)"), ("soft_x", "round(p.soft_x, 6)"), ("hard", "p.hard"))]
    return rows.selectExpr(*KEYS, f"cast(_at div {FOLDS * CLASSES} as int) as z", f"cast(_at div {CLASSES} % {FOLDS} as int) as fold", f"_at % {CLASSES} as class", *known)


QUERIES = {"A27_off_heart": _on_slices("A27_off_heart"), "A29_dice_by_third": dice_by_third, "A52_display_range": shown, "J09_three_way": three_way, "W18_best_slice": _on_slices("W18_best_slice"), "W19_examples": _on_slices("W19_examples"), "V34_stability": stability, "V35_soft_argmax": soft_argmax}
ORACLES: dict[str, str] = {}
