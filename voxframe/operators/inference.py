"""Statistics of paired scores: bootstrap intervals, rank tests, adjusted p values."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIME = 2_147_483_647
EXACT = 50


def erfc(x: Column) -> Column:
    """The complementary error function for x >= 0: a series of positive terms below 3, a continued fraction above."""
    power = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.struct(x.alias("t"), x.alias("s")), lambda a, n: F.struct((a["t"] * 2 * x * x / (2 * n + 1)).alias("t"), (a["s"] + a["t"] * 2 * x * x / (2 * n + 1)).alias("s")))["s"]
    deep = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), x, lambda t, n: x + n / 2 / t)
    e = F.exp(-x * x) / math.sqrt(math.pi)
    return F.when(x < 3, 1 - 2 * e * power).otherwise(e / deep)


def chi2_survival(x: Column, df: int) -> Column:
    """P(X > x) for `df` degrees of freedom: two more degrees add one term."""
    half = x / 2
    out = F.exp(-half) if df % 2 == 0 else erfc(F.sqrt(half))
    for j in range((df - 1) // 2 if df % 2 else df // 2 - 1):
        a = j + (0.5 if df % 2 else 1.0)
        out = out + F.pow(half, F.lit(a)) * F.exp(-half) / math.gamma(a + 1)
    return F.when(x <= 0, F.lit(1.0)).otherwise(out)


def exact_rank_p(w: Column, n: Column) -> Column:
    """Two-sided p of a signed-rank sum of n untied differences: subsets of 1 to n by their sum, a rank at a time."""
    zeros = lambda k: F.array_repeat(F.lit(0.0), k.cast("int"))
    counts = F.aggregate(F.sequence(F.lit(1).cast("long"), n), F.array(F.lit(1.0)), lambda c, k: F.zip_with(F.concat(c, zeros(k)), F.concat(zeros(k), c), lambda a, b: a + b))
    low = F.least(w, n * (n + 1) / 2 - w).cast("int")
    return F.least(F.lit(1.0), 2 * F.aggregate(F.slice(counts, F.lit(1), low + 1), F.lit(0.0), lambda a, b: a + b) / F.pow(F.lit(2.0), n))


def _draw(b: Column, i: Column) -> Column:
    """A number below 2^31 - 1 for a resample and a position: squarings modulo a prime, equal in any engine."""
    step = lambda u, c: (u * u + F.lit(c)) % PRIME
    u = (b * 48271 + i * 69621 + 12345) % PRIME
    return reduce(step, (11, 101, 1009), u)


def bootstrap_mean(values: DataFrame, keys: list[str], value: str, order: list[str], resamples: int = 2000) -> DataFrame:
    """Mean and the 2.5 and 97.5 percentiles of the means of `resamples` draws with replacement; only finite values count.

    Values are numbered within their group, then every draw meets its value by number. The draws of a group are dealt by
    resample, so a large group's work is spread. Every draw has a value; the join is an outer one because Spark estimates
    the draws by the few rows they unfold from, and would broadcast them.
    """
    v = F.col(value)
    finite = values.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    w = Window.partitionBy(*keys)
    numbered = finite.select(*keys, (F.row_number().over(w.orderBy(value, *order)) - 1).cast("long").alias("_i"), v.alias("_v"))
    sizes = finite.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(v).alias("mean"))
    tests = sizes.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1)).cast("array<bigint>")).alias("_b"))
    tests = tests.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_b")
    draws = tests.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    drawn = draws.select(*keys, "_b", (_draw(F.col("_b"), F.col("_k")) % F.col("n")).alias("_i")).join(numbered, [*keys, "_i"], "left")
    means = drawn.groupBy(*keys, "_b").agg(F.avg("_v").alias("_m"))
    ends = means.groupBy(*keys).agg(F.percentile("_m", F.lit(0.025)).alias("low"), F.percentile("_m", F.lit(0.975)).alias("high"))
    return sizes.join(ends, keys).select(*keys, "n", "mean", "low", "high")


def friedman(scores: DataFrame, keys: list[str], subject: str, treatment: str, value: str, treatments: int) -> DataFrame:
    """Tie-corrected chi-square over subjects that have all treatments, and its p, for any number of treatments above 1."""
    block = Window.partitionBy(*keys, subject)
    full = scores.filter(F.col(value).isNotNull()).withColumn("_n", F.count("*").over(block)).filter(F.col("_n") == treatments)
    ties = F.count("*").over(Window.partitionBy(*keys, subject, value))
    ranked = full.withColumn("_t", ties).withColumn("_r", F.rank().over(block.orderBy(value)) + (ties - 1) / 2)
    sums = ranked.groupBy(*keys, treatment).agg(F.sum("_r").alias("_sum"), F.count("*").alias("_of"), F.sum(F.col("_t") * F.col("_t") - 1).alias("_tc"))
    k = treatments
    whole = sums.groupBy(*keys).agg(F.max("_of").alias("n"), F.sum(F.col("_sum") * F.col("_sum")).alias("_ss"), F.sum("_tc").alias("_ties"))
    plain = 12 * F.col("_ss") / (F.col("n") * k * (k + 1)) - 3 * F.col("n") * (k + 1)
    shrink = 1 - F.col("_ties") / (F.col("n") * k * (k * k - 1))
    out = whole.withColumn("chi2", F.when(shrink > 0, plain / shrink))
    return out.select(*keys, "n", "chi2", chi2_survival(F.col("chi2"), k - 1).alias("p"))


def signed_rank(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """W+, median difference and two-sided p: exact for at most EXACT differences without ties or zeros, else by the normal
    approximation with tie correction; without any difference p is 1. Ranks are windows of one test's pairs each."""
    d = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_d", F.round(F.col(a) - F.col(b), 12))
    w = Window.partitionBy(*keys)
    ties = F.count("*").over(Window.partitionBy(*keys, F.abs("_d")))
    ranked = d.filter("_d <> 0").withColumn("_t", ties).withColumn("_r", F.rank().over(w.orderBy(F.abs("_d"))) + (ties - 1) / 2)
    stats = ranked.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.when(F.col("_d") > 0, F.col("_r")).otherwise(0.0)).alias("w_plus"), F.sum(F.col("_t") * F.col("_t") - 1).alias("_tc"))
    every = d.groupBy(*keys).agg(F.percentile("_d", F.lit(0.5)).alias("median"), F.count("*").alias("_all"))
    n = F.col("n")
    z = (F.col("w_plus") - n * (n + 1) / 4) / F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("_tc") / 48)
    out = every.join(stats, keys, "left")
    plain = (n <= EXACT) & (n == F.col("_all")) & (F.col("_tc") == 0)
    p = F.when(plain, exact_rank_p(F.col("w_plus"), n)).otherwise(erfc(F.abs(z) / math.sqrt(2)))
    return out.select(*keys, F.coalesce("n", F.lit(0)).alias("n"), "median", F.coalesce("w_plus", F.lit(0.0)).alias("w_plus"), F.coalesce(p, F.lit(1.0)).alias("p"))


def holm(tests: DataFrame, keys: list[str], p: str = "p", order: list[str] | None = None) -> DataFrame:
    """`p_holm`, the step-down adjusted p within each group."""
    w = Window.partitionBy(*keys)
    ranked = w.orderBy(p, *(order or []))
    raised = F.col(p) * (F.count("*").over(w) - F.row_number().over(ranked) + 1)
    return tests.withColumn("_a", raised).withColumn("p_holm", F.least(F.lit(1.0), F.max("_a").over(ranked.rowsBetween(Window.unboundedPreceding, 0)))).drop("_a")
