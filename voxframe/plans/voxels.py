"""Queries on voxel tables by the operators, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import images as im
from ..operators import neighbours as nb
from ..operators import overlap
from ..operators import volumes as vol
from ..tables import CLASSES, FOLDS, X, Y, Z, images, probabilities, slices, stored, view
from ..tables import volumes as packed

KEYS, MODEL = ["case_id", "frame_tag"], ["model"]
SPACING = (10.0, 1.25, 1.25)
SHAPE = (Z, Y, X)
COUNTS = """select p.case_id, p.model, p.frame_tag, l.label, count_if(p.label = l.label and g.label = l.label) as tp, count_if(p.label = l.label and g.label <> l.label) as fp,
    count_if(p.label <> l.label and g.label = l.label) as fn, count_if(p.label <> l.label and g.label <> l.label) as tn
    from vox_pred p join vox_gt g on p.case_id = g.case_id and p.frame_tag = g.frame_tag and p.z = g.z and p.y = g.y and p.x = g.x
    cross join (select 1 as label union all select 2 union all select 3) l group by p.case_id, p.model, p.frame_tag, l.label"""

# inventory id -> metric name
METRIC_IDS = {"A02_dice_or_one": "dice_or_one", "A03_dice": "dice", "A04_jaccard": "jaccard", "A05_precision": "precision", "A06_recall": "recall", "A07_specificity": "specificity", "A08_accuracy": "accuracy", "A09_f_beta": "f2_score", "A10_false_positive_rate": "false_positive_rate", "A11_false_omission_rate": "false_omission_rate", "A12_false_negative_rate": "false_negative_rate", "A13_false_discovery_rate": "false_discovery_rate", "A14_negative_predictive_value": "negative_predictive_value"}


def counts(spark: SparkSession, d: str) -> DataFrame:
    return vol.confusion(vol.paired(packed(spark, d, "vox_pred"), packed(spark, d, "vox_gt"), KEYS), ["case_id", "model", "frame_tag"], SHAPE, [1, 2, 3])


def _metric(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        c = counts(spark, d)
        return c.select("case_id", "model", "frame_tag", "label", overlap.metric(c, name))

    return query


def model_summary(spark: SparkSession, d: str) -> DataFrame:
    c = counts(spark, d)
    return c.withColumn("dice", F.expr(overlap.METRICS["dice_or_one"]).cast("double")).groupBy("model", "label").agg(F.count("*").alias("n"), F.round(F.avg("dice"), 6).alias("mean"), F.round(F.stddev_samp("dice"), 6).alias("sd"), F.round(F.percentile("dice", F.lit(0.5)), 6).alias("median"))


def totals(spark: SparkSession, d: str) -> DataFrame:
    return counts(spark, d).select("case_id", "model", "frame_tag", "label", (F.col("tp") + F.col("fp")).alias("positives_test"), (F.col("tn") + F.col("fn")).alias("negatives_test"), (F.col("tp") + F.col("fn")).alias("positives_reference"), (F.col("tn") + F.col("fp")).alias("negatives_reference"))


def slice_dice(spark: SparkSession, d: str) -> DataFrame:
    p, g = (slices(spark, d, n).withColumn("slice", F.col("z")) for n in ("vox_pred", "vox_gt"))
    c = overlap.confusion(p, g, [*KEYS, "slice"], MODEL, [3], Y * X)
    return c.select(*KEYS, "model", "slice", F.round(F.expr(overlap.METRICS["dice"]), 6).cast("double").alias("dice"), (F.col("tp") + F.col("fn")).alias("gt"), (F.col("tp") + F.col("fp")).alias("pred"))


def volumes(spark: SparkSession, d: str) -> DataFrame:
    ml = SPACING[0] * SPACING[1] * SPACING[2] / 1000
    of = lambda k: F.col("counts")[k - 1] * F.lit(ml)
    counted = vol.label_counts(packed(spark, d, "vox_gt"), KEYS, SHAPE, [1, 2, 3])
    return counted.select(*KEYS, F.round(of(1), 6).alias("rv_ml"), F.round(of(2), 6).alias("myo_ml"), F.round(of(3), 6).alias("lv_ml"), F.round(1.05 * of(2), 6).alias("mass_g"))


def clinical(spark: SparkSession, d: str) -> DataFrame:
    v = volumes(spark, d).groupBy("case_id").pivot("frame_tag", ["ED", "ES"]).agg(F.max("lv_ml"))
    return v.select("case_id", F.col("ED").alias("edv"), F.col("ES").alias("esv"), F.when(F.col("ED") > 0, F.round(100 * (F.col("ED") - F.col("ES")) / F.col("ED"), 6)).alias("ef"))


def bounding_box(spark: SparkSession, d: str) -> DataFrame:
    hit = lambda c: F.when(F.col("label") > 0, F.col(c))
    aggs = [x for c in "zyx" for x in (F.coalesce(F.min(hit(c)), F.lit(-1)).alias(f"{c}_min"), F.coalesce(F.max(hit(c)) + 1, F.lit(-1)).alias(f"{c}_max"))]
    return view(spark, d, "vox_gt").groupBy(*KEYS).agg(*aggs)


def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    votes = packed(spark, d, "vox_pred").groupBy(*KEYS).agg(F.collect_list("labels").alias("votes"))
    return vol.majority(votes, KEYS, SHAPE, [0, 1, 2, 3])


def majority(votes: DataFrame, keys: list[str], labels: list[int]) -> DataFrame:
    """The label that most rows of a voxel have, the smallest at a tie: one hash aggregate of a count for each label."""
    counts = votes.groupBy(*keys, "z", "y", "x").agg(*(F.count_if(F.col("label") == k).alias(f"n{k}") for k in sorted(labels)))
    top = F.greatest(*(F.col(f"n{k}") for k in labels)) if len(labels) > 1 else F.col(f"n{labels[0]}")
    won = F.coalesce(*(F.when(F.col(f"n{k}") == top, F.lit(k)) for k in sorted(labels)))
    return counts.select(*keys, "z", "y", "x", won.alias("label"))


def probability_vote(spark: SparkSession, d: str) -> DataFrame:
    return im.likeliest(probabilities(spark, d), KEYS, SHAPE, FOLDS, CLASSES)


def likeliest(folds: DataFrame, keys: list[str], classes: list[int]) -> DataFrame:
    """The class with the highest mean p of a voxel, the smallest at a tie: one hash aggregate of a mean for each class."""
    means = folds.filter(F.col("class").isin(classes)).groupBy(*keys, "z", "y", "x").agg(F.min("class").alias("least"), *(F.avg(F.when(F.col("class") == k, F.col("p"))).alias(f"p{k}") for k in classes))
    top = F.greatest(*(F.col(f"p{k}") for k in classes)) if len(classes) > 1 else F.col(f"p{classes[0]}")
    won = F.coalesce(*(F.when(F.col(f"p{k}") == top, F.lit(k)) for k in sorted(classes)), "least")
    return means.select(*keys, "z", "y", "x", won.alias("label"))


def component_limits(spark: SparkSession, d: str) -> DataFrame:
    parts = vol.components(packed(spark, d, "vox_pred"), [*KEYS, "model"], SHAPE, [1, 2, 3])
    return nb.limits(parts, ["model", "label"])


def remap(spark: SparkSession, d: str) -> DataFrame:
    table = spark.createDataFrame([(1, 3), (2, 2), (3, 1)], "label int, to int")
    return view(spark, d, "vox_gt").join(F.broadcast(table), "label", "left").groupBy(*KEYS, F.coalesce("to", F.lit(0)).alias("label")).agg(F.count("*").alias("n"))


def difference_map(spark: SparkSession, d: str) -> DataFrame:
    return overlap.label_pairs(stored(spark, d, "vox_pred"), stored(spark, d, "vox_gt"), KEYS, MODEL).filter("label <> ref")


def _mask(spark: SparkSession, d: str, name: str = "vox_gt", label: int = 3) -> DataFrame:
    return view(spark, d, name).filter(F.col("label") == label).drop("label")


def surface_count(spark: SparkSession, d: str) -> DataFrame:
    return nb.surface(_mask(spark, d), KEYS).groupBy(*KEYS).agg(F.count("*").alias("n"))


def dilation(spark: SparkSession, d: str) -> DataFrame:
    return nb.dilate(_mask(spark, d), KEYS, nb.ball(1)).groupBy(*KEYS).agg(F.count("*").alias("n"))


def erosion(spark: SparkSession, d: str) -> DataFrame:
    return nb.erode(_mask(spark, d), KEYS, nb.ball(1)).groupBy(*KEYS).agg(F.count("*").alias("n"))


def surfaces(spark: SparkSession, d: str) -> DataFrame:
    keys = [*KEYS, "model"]
    out = vol.surface_distances(vol.paired(packed(spark, d, "vox_pred"), packed(spark, d, "vox_gt"), KEYS), keys, SHAPE, 3, SPACING)
    return out.select(*keys, *(F.round(c, 6).alias(c) for c in ("hd", "hd95", "asd", "assd")))


def component_sizes(spark: SparkSession, d: str) -> DataFrame:
    parts = vol.components(packed(spark, d, "vox_pred"), [*KEYS, "model"], SHAPE, [1])
    return parts.select(*KEYS, "model", *((F.shiftright("component", s) % (1 << 21)).alias(c) for c, s in (("z", 42), ("y", 21), ("x", 0))), F.col("size").alias("n"))


def largest(spark: SparkSession, d: str) -> DataFrame:
    parts = vol.components(packed(spark, d, "vox_pred"), [*KEYS, "model"], SHAPE, [1])
    return parts.filter("size = top").groupBy(*KEYS, "model").agg(F.sum("size").alias("n"))


def holes(spark: SparkSession, d: str) -> DataFrame:
    return nb.fill_holes(_mask(spark, d, "vox_gt", 2), KEYS).groupBy(*KEYS).agg(F.count("*").alias("n"))


def thickness(spark: SparkSession, d: str) -> DataFrame:
    out = vol.wall_thickness(packed(spark, d, "vox_gt"), KEYS, SHAPE, 2, 3, SPACING)
    return out.select(*KEYS, *(F.round(c, 6).alias(c) for c in ("mean_mm", "max_mm", "p95_mm")))


def image_reference(spark: SparkSession, d: str) -> DataFrame:
    means = im.label_means(images(spark, d).filter("case_id is not null"), KEYS, SHAPE, [0, 1, 2, 3], im.to_reference(3, strict=False))
    return means.withColumn("mean", F.round("mean", 6))


def firstorder(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("intensity")
    m = view(spark, d, "vox_img").filter("label = 2")
    out = m.groupBy(*KEYS).agg(F.sum(v * v).alias("energy"), F.min(v).alias("minimum"), F.percentile(v, F.lit(0.1)).alias("p10"), F.percentile(v, F.lit(0.9)).alias("p90"), F.max(v).alias("maximum"), F.avg(v).alias("mean"), F.percentile(v, F.lit(0.5)).alias("median"), F.var_pop(v).alias("variance"), F.sqrt(F.avg(v * v)).alias("rms"))
    return out.select(*KEYS, *(F.round(c, 6).alias(c) for c in out.columns[2:]))


def zscore(spark: SparkSession, d: str) -> DataFrame:
    out = im.heart_deviations(images(spark, d).filter("case_id is not null"), KEYS, SHAPE)
    return out.withColumn("total", F.round("total", 4))


QUERIES = {
    "A01_confusion": counts, "A15_totals": totals, "A21_model_summary": model_summary, "A28_slice_dice": slice_dice, "A30_volumes": volumes, "A33_bounding_box": bounding_box, "A38_clinical": clinical,
    "A16_surface_distances": surfaces, "A50_intensity_reference": image_reference, "A53_zscore": zscore, "V01_remap": remap, "V07_fill_holes": holes, "V08_components": component_sizes, "A56_component_limits": component_limits, "V09_keep_largest": largest,
    "V10_surface": surface_count, "V11_dilation": dilation, "V11_erosion": erosion, "V12_wall_thickness": thickness, "V13_majority_vote": majority_vote, "V14_probability_vote": probability_vote, "V25_difference_map": difference_map, "V28_first_order": firstorder,
} | {k: _metric(n) for k, n in METRIC_IDS.items()}

ML = "0.015625"
_neighbours = "(m.z, m.y, m.x)"
ORACLES = {
    "A01_confusion": COUNTS,
    "A15_totals": f"select case_id, model, frame_tag, label, tp + fp as positives_test, tn + fn as negatives_test, tp + fn as positives_reference, tn + fp as negatives_reference from ({COUNTS}) c",
    "A21_model_summary": f"select model, label, count(*) as n, round(avg(dice), 6) as mean, round(stddev_samp(dice), 6) as sd, round(median(dice), 6) as median from (select *, {overlap.METRICS['dice_or_one']} as dice from ({COUNTS}) c) t group by model, label",
    "A28_slice_dice": "select p.case_id, p.frame_tag, p.model, p.z as slice, round(2.0 * count_if(p.label = 3 and g.label = 3) / nullif(count_if(p.label = 3) + count_if(g.label = 3), 0), 6) as dice, count_if(g.label = 3) as gt, count_if(p.label = 3) as pred from vox_pred p join vox_gt g on p.case_id = g.case_id and p.frame_tag = g.frame_tag and p.z = g.z and p.y = g.y and p.x = g.x group by p.case_id, p.frame_tag, p.model, p.z",
    "A30_volumes": f"select case_id, frame_tag, round(count_if(label = 1) * {ML}::double, 6) as rv_ml, round(count_if(label = 2) * {ML}::double, 6) as myo_ml, round(count_if(label = 3) * {ML}::double, 6) as lv_ml, round(1.05::double * count_if(label = 2) * {ML}::double, 6) as mass_g from vox_gt group by case_id, frame_tag",
    "A33_bounding_box": "select case_id, frame_tag, coalesce(min(case when label > 0 then z end), -1) as z_min, coalesce(max(case when label > 0 then z end) + 1, -1) as z_max, coalesce(min(case when label > 0 then y end), -1) as y_min, coalesce(max(case when label > 0 then y end) + 1, -1) as y_max, coalesce(min(case when label > 0 then x end), -1) as x_min, coalesce(max(case when label > 0 then x end) + 1, -1) as x_max from vox_gt group by case_id, frame_tag",
    "A38_clinical": f"select case_id, edv, esv, case when edv > 0 then round(100 * (edv - esv) / edv, 6) end as ef from (select case_id, round(count_if(label = 3 and frame_tag = 'ED') * {ML}::double, 6) as edv, round(count_if(label = 3 and frame_tag = 'ES') * {ML}::double, 6) as esv from vox_gt group by case_id) t",
    "A50_intensity_reference": "select i.case_id, i.frame_tag, i.label, round(avg(100 * intensity / pool), 6) as mean from vox_img i join (select case_id, frame_tag, avg(case when label = 3 then intensity end) as pool from vox_img group by case_id, frame_tag) p on i.case_id = p.case_id and i.frame_tag = p.frame_tag group by i.case_id, i.frame_tag, i.label",
    "A53_zscore": "select i.case_id, i.frame_tag, i.z, round(sum(case when label > 0 then (intensity - m) / (s + 1e-8) else 0 end), 4) as total from vox_img i join (select case_id, frame_tag, avg(intensity) as m, stddev_pop(intensity) as s from vox_img where label > 0 group by case_id, frame_tag) p on i.case_id = p.case_id and i.frame_tag = p.frame_tag group by i.case_id, i.frame_tag, i.z",
    "V01_remap": "select case_id, frame_tag, case label when 1 then 3 when 2 then 2 when 3 then 1 else 0 end as label, count(*) as n from vox_gt group by case_id, frame_tag, case label when 1 then 3 when 2 then 2 when 3 then 1 else 0 end",

    "V10_surface": "select case_id, frame_tag, count(*) as n from (select m.case_id, m.frame_tag, m.z, m.y, m.x from vox_gt m left join vox_gt o on o.label = 3 and o.case_id = m.case_id and o.frame_tag = m.frame_tag and o.z between m.z - 1 and m.z + 1 and abs(o.z - m.z) + abs(o.y - m.y) + abs(o.x - m.x) = 1 where m.label = 3 group by m.case_id, m.frame_tag, m.z, m.y, m.x having count(o.z) < 6) t group by case_id, frame_tag",
    "V11_dilation": "select case_id, frame_tag, count(*) as n from (select distinct case_id, frame_tag, z, y + dy as y, x + dx as x from vox_gt cross join (values (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) o(dy, dx) where label = 3) t group by case_id, frame_tag",
    "V11_erosion": "select case_id, frame_tag, count(*) as n from (select case_id, frame_tag, z, y + dy as y, x + dx as x, count(*) as c from vox_gt cross join (values (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) o(dy, dx) where label = 3 group by case_id, frame_tag, z, y + dy, x + dx having count(*) = 5) t group by case_id, frame_tag",
    "V13_majority_vote": "select case_id, frame_tag, label, count(*) as n from (select case_id, frame_tag, z, y, x, case when max(n) = 1 then min(label) else max(case when n > 1 then label end) end as label from (select case_id, frame_tag, z, y, x, label, count(*) as n from vox_pred group by case_id, frame_tag, z, y, x, label) t group by case_id, frame_tag, z, y, x) u group by case_id, frame_tag, label",
    "V14_probability_vote": "select case_id, frame_tag, label, count(*) as n from (select case_id, frame_tag, z, y, x, class as label, row_number() over (partition by case_id, frame_tag, z, y, x order by p desc, class) as r from (select case_id, frame_tag, z, y, x, class, avg(p) as p from vox_prob group by case_id, frame_tag, z, y, x, class) t) u where r = 1 group by case_id, frame_tag, label",
    "V25_difference_map": "select p.case_id, p.frame_tag, p.model, p.label, g.label as ref, count(*) as n from vox_pred p join vox_gt g on p.case_id = g.case_id and p.frame_tag = g.frame_tag and p.z = g.z and p.y = g.y and p.x = g.x where p.label <> g.label group by p.case_id, p.frame_tag, p.model, p.label, g.label",
    "V28_first_order": "select case_id, frame_tag, round(sum(intensity * intensity), 6) as energy, min(intensity) as minimum, round(quantile_cont(intensity, 0.1), 6) as p10, round(quantile_cont(intensity, 0.9), 6) as p90, max(intensity) as maximum, round(avg(intensity), 6) as mean, round(median(intensity), 6) as median, round(var_pop(intensity), 6) as variance, round(sqrt(avg(intensity * intensity)), 6) as rms from vox_img where label = 2 group by case_id, frame_tag",
} | {k: f"select case_id, model, frame_tag, label, cast(round({overlap.METRICS[n]}, 6) as double) as {n} from ({COUNTS}) c" for k, n in METRIC_IDS.items()}
