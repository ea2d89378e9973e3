"""Report tables with text cells, made of score tables.

A number is rounded to 9 digits first, so that noise of summation doesn't show, then half away from zero. A missing number is a
dash, an infinite one "inf", and zero has no sign. `place` numbers the rows of a dataset in the order of its table, from 1.
Each table has one row per line of the report: datasets times models, pathologies or measures, whatever the scores' size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import inference
from . import scores as sc

DASH = "–"


def fixed(value: Column, digits: int) -> Column:
    v = value.cast("double")
    text = F.format_string(f"%.{digits}f", F.round(F.round(v, 9), digits) + F.lit(0.0))
    return F.when(v.isNull() | F.isnan(v), F.lit(DASH)).when(v == float("inf"), F.lit("inf")).when(v == float("-inf"), F.lit("-inf")).otherwise(text)


def p_text(p: Column) -> Column:
    return F.when(p < 0.001, F.lit("<0.001")).otherwise(fixed(p, 3))


def _rank(c: str, values: list[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, values)), F.col(c))


def _placed(rows: DataFrame, order: list[Column], columns: list[Column | str]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("dataset").orderBy(*order)).alias("place")
    return rows.select("dataset", place, *columns)


def variants(summary: DataFrame, structures: list[str], models: list[str]) -> DataFrame:
    """Accuracy of every variant. `model` is a name, or a name, two underscores and `seedN` or `ensemble`.

    A model's plain row comes first, then its seeds, then its ensemble.
    """
    rest = F.split_part("model", F.lit("__"), F.lit(2))
    s = summary.withColumn("_v", F.when(rest.isin("", "ensemble"), rest).otherwise(F.concat(F.lit("seed "), F.regexp_replace(rest, "^seed", "")))).withColumn("model", F.split_part("model", F.lit("__"), F.lit(1)))
    kind = F.when(F.col("_v") == "", 0).when(F.col("_v") == "ensemble", 2).otherwise(1)
    dice = [F.concat(fixed(F.col(f"dice_{k}_mean"), 3), F.lit(" ± "), fixed(F.col(f"dice_{k}_sd"), 3)).alias(f"dice_{k}") for k in structures]
    far = [F.concat(fixed(F.col(f"hd95_{k}_median"), 1), F.lit(" ["), fixed(F.col(f"hd95_{k}_q1"), 1), F.lit("–"), fixed(F.col(f"hd95_{k}_q3"), 1), F.lit("]")).alias(f"hd95_{k}") for k in structures]
    return _placed(s, [_rank("model", models), kind, F.col("_v")], ["model", F.when(F.col("_v") == "", DASH).otherwise(F.col("_v")).alias("variant"), F.col("n_patients").alias("n"), *dice, *far])


def pair_tests(long: DataFrame, patient: str, models: list[str], metrics: list[str], structures: list[str]) -> DataFrame:
    """Friedman's test over all models and signed-rank tests of every pair, Holm's correction per dataset, metric and structure.

    `long` has one `value` per dataset, metric, structure, patient and model. Patients without a finite value of every model are
    left out. Values count to 6 digits.
    """
    keys = ["dataset", "metric", "structure"]
    finite = long.select(*keys, patient, "model", F.round(sc.finite(F.col("value")), 6).alias("value")).filter("value is not null")
    whole = finite.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, patient))).filter(F.col("_n") == len(models)).drop("_n")
    overall = inference.friedman(whole, keys, patient, "model", "value", len(models)).select(*keys, F.col("p").alias("friedman_p"))
    other = whole.select(*keys, patient, F.col("model").alias("model_b"), F.col("value").alias("b"))
    pairs = whole.withColumnRenamed("model", "model_a").join(other, [*keys, patient]).filter(_rank("model_a", models) < _rank("model_b", models))
    tests = inference.holm(inference.signed_rank(pairs, [*keys, "model_a", "model_b"], "value", "b"), keys, "p", ["model_a", "model_b"]).join(overall, keys, "left")
    median = F.when(F.col("metric") == "dice", fixed(F.col("median"), 3)).otherwise(fixed(F.col("median"), 2)).alias("median_difference")
    order = [_rank("metric", metrics), _rank("structure", structures), _rank("model_a", models), _rank("model_b", models)]
    return _placed(tests, order, ["metric", "structure", p_text(F.col("friedman_p")).alias("friedman_p"), "model_a", "model_b", median, p_text(F.col("p_holm")).alias("p_holm")])


def effect(long: DataFrame, patient: str, models: list[str], structures: list[str], resamples: int = 2000) -> DataFrame:
    """Change of Dice by cleaning, of patients with both: means, bootstrap interval, signed-rank p by Holm over all rows of `structures`.

    `long` has one row per dataset, model, structure, patient and `cleaned`, with `dice`; other structures are left out.
    """
    keys = ["dataset", "model", "structure"]
    wide = long.filter(F.col("structure").isin(structures)).groupBy(*keys, patient).pivot("cleaned", [False, True]).agg(F.round(F.avg("dice"), 6))
    both = wide.select(*keys, patient, F.col("false").alias("raw"), F.col("true").alias("pp")).filter("raw is not null and pp is not null").withColumn("change", F.round(F.col("pp") - F.col("raw"), 6))
    means = both.groupBy(*keys).agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in ("raw", "pp", "change")))
    ends = inference.bootstrap_mean(both, keys, "change", [patient], resamples).select(*keys, "low", "high")
    ranks = inference.signed_rank(both, keys, "pp", "raw").select(*keys, "p").withColumn("_all", F.lit(1))
    # one window over all tests of the table, not over scores
    rows = means.join(ends, keys).join(inference.holm(ranks, ["_all"], "p", keys).select(*keys, "p_holm"), keys)
    change = F.concat(fixed(F.col("change"), 3), F.lit(" ["), fixed(F.col("low"), 3), F.lit(", "), fixed(F.col("high"), 3), F.lit("]")).alias("change")
    return _placed(rows, [_rank("model", models), _rank("structure", structures)], ["model", "structure", "n", fixed(F.col("raw"), 3).alias("dice_raw"), fixed(F.col("pp"), 3).alias("dice_cleaned"), change, p_text(F.col("p_holm")).alias("p_holm")])


def off_heart(pred: DataFrame, ref: DataFrame, keys: list[str], by: list[str], heart: list[int]) -> DataFrame:
    """Per mask of packed slices: `predicted` foreground, `off` (that on slices whose reference holds no label of `heart`), and
    `off_slices` (slices with such). A slice without a reference holds none."""
    met = ref.select(*keys, "z", F.exists("labels", lambda v: v.isin(heart)).alias("_heart"))
    n = F.size(F.filter("labels", lambda v: v > 0)).cast("long")
    rows = pred.join(met, [*keys, "z"], "left").select(*keys, *by, n.alias("_n"), (~F.coalesce("_heart", F.lit(False))).alias("_off"))
    return rows.groupBy(*keys, *by).agg(F.sum("_n").alias("predicted"), F.sum(F.when(F.col("_off"), F.col("_n")).otherwise(0)).alias("off"), F.count_if(F.col("_off") & (F.col("_n") > 0)).alias("off_slices"))


def failures(rates: DataFrame, masks: DataFrame, structures: list[str], models: list[str], own: dict[str, str]) -> DataFrame:
    """Failures per structure, missing structures and predictions off the heart.

    `rates` are `scores.failure_rates` per dataset, model and structure, `masks` rows of `off_heart` with dataset and model. A model
    whose dataset in `own` is the row's has a dagger. A mask without foreground has no share off the heart.
    """
    keys = ["dataset", "model"]
    wide = [F.max(F.when(F.col("structure") == k, F.concat(F.col("failures").cast("string"), F.lit(" ("), fixed(100 * F.col("failure_rate"), 1), F.lit(")")))).alias(f"failures_{k}") for k in structures]
    rows = rates.groupBy(*keys).agg(F.max("n_frames").alias("frames"), *wide, F.sum("missing").alias("missing"))
    off = masks.groupBy(*keys).agg(F.avg((F.col("off_slices") > 0).cast("int")).alias("_with"), F.avg(F.try_divide("off", "predicted")).alias("_share"))
    home = F.lit(False)
    for m, d in own.items():
        home = home | ((F.col("model") == m) & (F.col("dataset") == d))
    name = F.concat("model", F.when(home, " †").otherwise("")).alias("model")
    return _placed(rows.join(off, keys, "left"), [_rank("model", models)], [name, "frames", *(f"failures_{k}" for k in structures), "missing", fixed(100 * F.col("_with"), 0).alias("frames_off_heart"), fixed(100 * F.col("_share"), 1).alias("foreground_off_heart")])


def by_pathology(means: DataFrame, models: list[str]) -> DataFrame:
    """`scores.row_means` per dataset, pathology and model, a column for each model; groups of another size are rows of their own."""
    wide = means.groupBy("dataset", "pathology", F.col("n_patients").alias("n")).pivot("model", models).agg(F.max("dice_avg_mean"))
    return _placed(wide, [F.desc("n"), F.col("pathology")], ["pathology", "n", *(fixed(F.col(m), 3).alias(m) for m in models)])


def agreement(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Bias of a against b, its 95 % limits, mean absolute error, and ICC(2,1), of pairs that are finite on both sides.

    The mean squares of two raters come from the variances of sums and differences: between subjects var(a + b) / 2, error
    var(a - b) / 2, between raters n * bias^2 / 2. One pair alone has a bias only.
    """
    both = pairs.select(*keys, sc.finite(F.col(a)).alias("_a"), sc.finite(F.col(b)).alias("_b")).filter("_a is not null and _b is not null")
    d = F.col("_a") - F.col("_b")
    s = both.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.try_divide(F.var_samp(F.col("_a") + F.col("_b")), F.lit(2)).alias("_msr"), F.try_divide(F.var_samp(d), F.lit(2)).alias("_mse"))
    reach = 1.96 * F.sqrt(2 * F.col("_mse"))
    rows, error, raters = F.col("_msr"), F.col("_mse"), F.col("n") * F.col("bias") * F.col("bias") / 2
    icc = F.when(F.col("n") > 1, F.try_divide(rows - error, rows + error + 2 * (raters - error) / F.col("n")))
    return s.select(*keys, "n", "bias", (F.col("bias") - reach).alias("low"), (F.col("bias") + reach).alias("high"), "mae", icc.alias("icc"))


def by_vendor(agreed: DataFrame, models: list[str], measures: list[str]) -> DataFrame:
    """`agreement` per dataset, vendor, measure, unit and model: cells of bias [limits]; ICC, a column for each model."""
    cell = F.concat(fixed(F.col("bias"), 1), F.lit(" ["), fixed(F.col("low"), 1), F.lit(", "), fixed(F.col("high"), 1), F.lit("]; "), fixed(F.col("icc"), 2))
    wide = agreed.withColumn("_c", cell).groupBy("dataset", "vendor", "measure", "unit", "n").pivot("model", models).agg(F.max("_c"))
    name = F.concat("measure", F.lit(" ("), "unit", F.lit(")")).alias("measure")
    return _placed(wide, [F.col("vendor"), _rank("measure", measures), F.col("n")], ["vendor", name, "n", *(F.coalesce(F.col(m), F.lit(DASH)).alias(m) for m in models)])
