"""Score tables: long and wide forms, means over structures, phases and cases, comparisons, failures, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import inference, overlap

# fixed values: label numbers and names of the kinds of masks that are scored, and how each side's voxels count
SCHEMAS = {
    "ventricular": {"labels": {1: "rv", 2: "myo", 3: "lv"}},
    "atrial": {"labels": {1: "wall", 2: "ra", 3: "la"}},
    "atrial_binary_union": {"labels": {1: "biatrial"}, "pred": {1: [1, 2, 3]}, "ref": "any"},
    "atrial_la_cavity": {"labels": {3: "la"}, "ref": "any"},
}


def schema_for(architecture: str, schema: str = "architecture_default") -> str:
    """The schema that scores an architecture's masks; binary ones are for atrial networks alone."""
    if schema == "architecture_default":
        return "atrial" if architecture == "atrial_nnunet" else "ventricular"
    if schema not in SCHEMAS or schema in ("ventricular", "atrial"):
        raise ValueError(f"unknown label schema {schema!r}")
    if architecture != "atrial_nnunet":
        raise ValueError(f"label schema {schema!r} needs the architecture atrial_nnunet")
    return schema


def schemas_of(architectures: DataFrame, name: str = "architecture") -> DataFrame:
    """The structures that each architecture is scored on by default: architecture, schema, label, name. Null has none."""
    schema = F.when(F.col(name) == "atrial_nnunet", "atrial").when(F.col(name).isNotNull(), "ventricular")
    entry = lambda s, k, n: F.struct(F.lit(s).alias("schema"), F.lit(k).alias("label"), F.lit(n).alias("name"))
    every = F.array(*(entry(s, k, n) for s in ("ventricular", "atrial") for k, n in SCHEMAS[s]["labels"].items()))
    return architectures.select(name).distinct().select(name, F.explode(F.filter(every, lambda e: e["schema"] == schema)).alias("e")).select(name, "e.*")


def score_by_schema(pred: DataFrame, ref: DataFrame, keys: list[str], by: list[str], schema: str, grid: int | None = None) -> DataFrame:
    """Confusion counts of a schema's structures with their `name`. In binary schemas every positive reference voxel counts."""
    s = SCHEMAS[schema]
    labels = list(s["labels"])
    if s.get("ref") == "any":
        ref = ref.withColumn("label", F.when(F.col("label") > 0, labels[0]).otherwise(0))
    out = overlap.confusion(pred, ref, keys, by, labels, grid, pred_regions=s.get("pred"))
    names = F.create_map(*(F.lit(x) for kv in s["labels"].items() for x in kv))
    return out.withColumn("name", names[F.col("label")])


def finite(x: Column) -> Column:
    """x, or null where it is NaN or infinite."""
    return F.when(F.abs(x) < float("inf"), x)


def mean_of_finite(columns: list[str], empty: float | None = None) -> Column:
    """Mean of a row's finite values; `empty` where there is none."""
    good = F.filter(F.array(*(finite(F.col(c)) for c in columns)), lambda x: x.isNotNull())
    total = F.aggregate(good, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(good) > 0, total / F.size(good)).otherwise(F.lit(empty))


def first_by(scores: DataFrame, row: str, column: str, values: list[str], value: str, order: Column) -> DataFrame:
    """One row per `row`, one column per value of `column`, holding the first `value` in `order`."""
    return scores.groupBy(row).pivot(column, values).agg(F.min_by(value, order))


def patient_level(scores: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Means over a patient's frames; an infinite distance stays infinite."""
    return scores.groupBy(*keys).agg(*(F.avg(c).alias(c) for c in columns))


def summarise(scores: DataFrame, groups: list[list[str]], patient: str, dice: list[str], distance: list[str], resamples: int = 2000) -> DataFrame:
    """Per group of each set in `groups`: patients, and of patient means: Dice mean, sd and bootstrap interval, distance quartiles.

    Columns of other sets are null. Scores are first averaged per group and patient. Without resamples there are no intervals.
    """
    every = list(dict.fromkeys(c for g in groups for c in g))
    out = None
    for g in groups:
        per = patient_level(scores, [*g, patient], [*dice, *distance])
        aggs = [F.count("*").alias("n_patients")]
        for c in dice:
            aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd")]
        for c in distance:
            aggs += [F.percentile(c, F.lit(q)).alias(f"{c}_{n}") for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
        one = per.groupBy(*g).agg(*aggs)
        for c in dice if resamples else []:
            ends = inference.bootstrap_mean(per, g, c, [patient], resamples).select(*g, F.col("low").alias(f"{c}_ci_lo"), F.col("high").alias(f"{c}_ci_hi"))
            one = one.join(ends, g, "left")
        one = one.select(*(F.col(c) if c in g else F.lit(None).cast("string").alias(c) for c in every), *(c for c in one.columns if c not in g))
        out = one if out is None else out.unionByName(one)
    return out


def row_means(scores: DataFrame, groups: list[str], patient: str, columns: list[str]) -> DataFrame:
    """Mean over a row's structures, then over a patient's rows, then over the patients of each group."""
    row = sum((F.col(c) for c in columns[1:]), F.col(columns[0])) / len(columns)
    per = scores.select(*groups, patient, row.alias("_m")).groupBy(*groups, patient).agg(F.avg("_m").alias("_m"))
    return per.groupBy(*groups).agg(F.count("*").alias("n_patients"), F.avg("_m").alias("dice_avg_mean"))


def long_scores(scores: DataFrame, keys: list[str], structures: list[str]) -> DataFrame:
    """Rows (keys, structure, dice, hd95) of wide dice_ and hd95_ columns; pairs without a Dice are dropped."""
    rows = F.array(*(F.struct(F.lit(s).alias("structure"), F.col(f"dice_{s}").alias("dice"), F.col(f"hd95_{s}").alias("hd95")) for s in structures))
    return scores.select(*keys, F.explode(rows).alias("s")).select(*keys, "s.*").filter("dice is not null")


def failed(dice: Column, distance: Column, least: float = 0.5, most: float = 20.0) -> Column:
    """Dice under `least`, or a distance that is over `most`, missing or not finite."""
    return F.coalesce(dice < least, F.lit(False)) | F.coalesce(finite(distance) > most, F.lit(True))


def failure_rates(long: DataFrame, groups: list[str], least: float = 0.5, most: float = 20.0) -> DataFrame:
    bad = failed(F.col("dice"), F.col("hd95"), least, most)
    return long.groupBy(*groups).agg(F.count("*").alias("n_frames"), F.count_if(bad).alias("failures"), F.avg(bad.cast("int")).alias("failure_rate"), F.count_if(finite(F.col("hd95")).isNull()).alias("missing"))


def metric_matrix(counts: DataFrame, keys: list[str], names: list[str], labels: list[int]) -> DataFrame:
    """One row per group and metric, one column per label."""
    rows = F.array(*(F.struct(F.lit(n).alias("metric"), F.expr(overlap.METRICS[n]).cast("double").alias("v")) for n in names))
    long = counts.select(*keys, "label", F.explode(rows).alias("m")).select(*keys, "label", "m.metric", "m.v")
    return long.groupBy(*keys, "metric").pivot("label", labels).agg(F.max("v"))


def case_means(matrix: DataFrame, groups: list[str], labels: list[int], skip_missing: bool = True) -> DataFrame:
    """Mean over cases of a metric matrix; with skip_missing, undefined values don't count, else they make the mean undefined."""
    means = []
    for k in labels:
        c = F.col(f"`{k}`")
        means.append((F.avg(c) if skip_missing else F.when(F.count(c) == F.count("*"), F.avg(c))).alias(str(k)))
    return matrix.groupBy(*groups).agg(*means)


def determinism(first: DataFrame, second: DataFrame, ref: DataFrame, keys: list[str], by: list[str], group: str, labels: list[int], grid: int) -> DataFrame:
    """Two runs of the same models, as packed slices with the columns `by`, per `group` (one of them).

    masks, identical (masks without a different voxel), least_agreement (smallest share of equal voxels of a mask) and
    largest_difference (of the Dice of any structure of a mask; both empty: 1). Masks that both runs have count; a slice
    that one of them lacks differs in all its voxels.
    """
    all_ = [*keys, *by]
    a, b = first.select(*all_, "z", F.col("labels").alias("_a")), second.select(*all_, "z", F.col("labels").alias("_b"))
    pairs = F.zip_with(F.coalesce("_a", F.array().cast("array<int>")), F.coalesce("_b", F.array().cast("array<int>")), lambda x, y: F.coalesce(x == y, F.lit(False)))
    slices = a.join(b, [*all_, "z"], "full").select(*all_, F.size(pairs).alias("_n"), F.size(F.filter(pairs, lambda e: e)).alias("_same"), F.col("_a").isNotNull().alias("_in_a"), F.col("_b").isNotNull().alias("_in_b"))
    masks = slices.groupBy(*all_).agg((F.sum("_same") == F.sum("_n")).alias("same"), (F.sum("_same") / F.sum("_n")).alias("share"), (F.max("_in_a") & F.max("_in_b")).alias("both")).filter("both")

    def dice(run: DataFrame, name: str) -> DataFrame:
        return overlap.confusion(run, ref, keys, by, labels, grid).select(*all_, "label", F.expr(overlap.METRICS["dice_or_one"]).cast("double").alias(name))

    far = dice(first, "x").join(dice(second, "y"), [*all_, "label"]).groupBy(*all_).agg(F.max(F.abs(F.col("x") - F.col("y"))).alias("far"))
    return masks.join(far, all_).groupBy(group).agg(F.count("*").alias("masks"), F.count_if("same").alias("identical"), F.min("share").alias("least_agreement"), F.max("far").alias("largest_difference"))


def labels_present(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """All positive labels of both sides."""
    return pred.select("label").union(ref.select("label")).filter("label > 0").distinct()


def many_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """`left` with the columns of `right`; a key that `right` holds twice is an error, as rows would multiply."""
    once = right.groupBy(key).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in right.columns if c != key))
    sure = once.withColumn("_n", F.when(F.col("_n") == 1, 1).otherwise(F.raise_error(F.concat(F.lit("key is not unique: "), F.col(key).cast("string")))))
    return left.join(sure.filter("_n = 1").drop("_n"), key, "left")


def all_found(joined: DataFrame, column: str, name: str) -> DataFrame:
    """The rows as they are; a row whose `column` is null is an error that tells its `name`."""
    return joined.withColumn(column, F.when(F.col(column).isNotNull(), F.col(column)).otherwise(F.raise_error(F.concat(F.lit(f"no {column} for "), F.col(name).cast("string")))))


def clinical(volumes: DataFrame, keys: list[str]) -> DataFrame:
    """End-diastolic and end-systolic volumes and ejection fractions of both ventricles, mass and wall thickness at ED.

    `volumes` has frame_tag, lv_ml, rv_ml, myo_ml and max_mm. A fraction is null where the diastolic volume is 0.
    """

    def at(tag: str, c: str) -> Column:
        return F.max(F.when(F.col("frame_tag") == tag, F.col(c)))

    w = volumes.groupBy(*keys).agg(at("ED", "lv_ml").alias("lvedv"), at("ES", "lv_ml").alias("lvesv"), at("ED", "rv_ml").alias("rvedv"), at("ES", "rv_ml").alias("rvesv"), (1.05 * at("ED", "myo_ml")).alias("mass_g"), at("ED", "max_mm").alias("wall_mm"))

    def ef(v: str) -> Column:
        return F.when(F.col(f"{v}edv") > 0, 100 * (F.col(f"{v}edv") - F.col(f"{v}esv")) / F.col(f"{v}edv")).alias(f"{v}ef")

    return w.select("*", ef("lv"), ef("rv"))


def agreement(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: whether two label maps are identical, and the share of voxels that agree; missing voxels are background."""
    both = a.select(*keys, *overlap.VOXEL, F.col("label").alias("p")).join(b.select(*keys, *overlap.VOXEL, F.col("label").alias("q")), [*keys, *overlap.VOXEL], "full_outer")
    same = F.coalesce("p", F.lit(0)) == F.coalesce("q", F.lit(0))
    return both.groupBy(*keys).agg(F.bool_and(same).alias("identical"), F.avg(same.cast("int")).alias("agreement"))


def quantiles(values: DataFrame, column: str, shares: list[float], bins: int = 4096) -> list[float | None]:
    """Exact quantiles of all finite values of a column, interpolated between ranks; null for an empty column.

    Each round counts the values between two bounds in at most `bins` bins, with the least and greatest of each, and goes on in the
    bin that holds the wanted rank until all its values are equal: no task sees more than such a table, and no value is sorted.
    """
    v = values.select(finite(F.col(column).cast("double")).alias("_v")).filter("_v is not null and not isnan(_v)")
    low, high, n = v.agg(F.min("_v"), F.max("_v"), F.count("*")).first()
    if not n:
        return [None] * len(shares)
    tables: dict[tuple[float, float], list] = {}

    def table(a: float, b: float) -> list:
        if (a, b) not in tables:
            place = F.least(F.floor((F.col("_v") / 2 - a / 2) / (b / 2 - a / 2) * bins), F.lit(bins - 1))
            tables[a, b] = v.filter(F.col("_v").between(a, b)).groupBy(place.alias("p")).agg(F.count("*").alias("n"), F.min("_v").alias("a"), F.max("_v").alias("b")).orderBy("p").collect()
        return tables[a, b]

    def at(rank: int) -> float:
        a, b = low, high
        while a < b:
            for r in table(a, b):
                if rank < r.n:
                    a, b = r.a, r.b
                    break
                rank -= r.n
        return a

    out: list[float | None] = []
    for q in shares:
        place = (n - 1) * q
        one, two = at(int(place)), at(min(int(place) + 1, n - 1))
        out.append(one + (two - one) * (place - int(place)))
    return out
