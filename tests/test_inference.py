"""p values against enumeration and the standard library."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from voxframe.operators import inference as inf
from voxframe.operators import scores as sc
from voxframe.plans import runs


def test_erfc(spark):
    xs = [0.0, 1e-9, 0.1, 0.5, 1.0, 1.7, 2.5, 2.999, 3.0, 3.5, 5.0, 8.0, 20.0]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", inf.erfc(F.col("x")).alias("y")).collect()
    for r in rows:
        assert abs(r.y - math.erfc(r.x)) <= 1e-13 and abs(r.y - math.erfc(r.x)) <= 1e-9 * math.erfc(r.x) + 1e-300


@pytest.mark.parametrize("df", [1, 2, 3, 4, 5, 8, 9])
def test_chi2_survival(spark, df):
    def sf(x):
        """Simpson's rule over the density, with the root taken out of the variable."""
        n, top = 20000, math.sqrt(x)
        f = lambda u: 2 * u ** (df - 1) * math.exp(-u * u / 2) / (2 ** (df / 2) * math.gamma(df / 2))
        h = top / n
        return 1 - h / 3 * (f(0.0 if df > 1 else 1e-300) + f(top) + sum((4 if i % 2 else 2) * f(i * h) for i in range(1, n)))

    xs = [0.5, 2.0, 7.5, 15.0]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", inf.chi2_survival(F.col("x"), df).alias("y")).collect()
    assert all(abs(r.y - sf(r.x)) < 1e-9 for r in rows)


def test_signed_rank_is_exact_without_ties(spark):
    rng = random.Random(4)
    d = {n: rng.sample([i / 64 * s for i in range(1, 40) for s in (1,)], n) for n in (1, 3, 7, 10)}
    d = {n: [x * rng.choice((1, -1)) for x in v] for n, v in d.items()}
    got = {r.k: r for r in inf.signed_rank(spark.createDataFrame([(n, x, 0.0) for n, v in d.items() for x in v], "k int, a double, b double"), ["k"], "a", "b").collect()}
    for n, v in d.items():
        ranks = {x: i + 1 for i, x in enumerate(sorted(v, key=abs))}
        w = sum(r for x, r in ranks.items() if x > 0)
        low = min(w, n * (n + 1) // 2 - w)
        few = sum(sum(s) <= low for s in (c for m in range(n + 1) for c in itertools.combinations(range(1, n + 1), m)))
        assert got[n].w_plus == w and abs(got[n].p - min(1.0, 2 * few / 2**n)) < 1e-12


def test_signed_rank_with_ties_and_without_differences(spark):
    rows = [(1, x, 0.0) for x in (1.0, 1.0, -1.0, 2.0, 3.0)] + [(2, 1.0, 1.0)] * 3 + [(3, float(x), 0.0) for x in range(1, 61)]
    got = {r.k: r for r in inf.signed_rank(spark.createDataFrame(rows, "k int, a double, b double"), ["k"], "a", "b").collect()}
    z = (13 - 7.5) / math.sqrt(5 * 6 * 11 / 24 - (3**3 - 3) / 48)
    assert abs(got[1].p - math.erfc(z / math.sqrt(2))) < 1e-12 and got[2].p == 1.0
    z = (60 * 61 / 2 - 60 * 61 / 4) / math.sqrt(60 * 61 * 121 / 24)
    assert abs(got[3].p - math.erfc(z / math.sqrt(2))) < 1e-15


def test_friedman_of_four_treatments(spark):
    rows = [(1, s, t, float((s * 7 + t * 3) % 11 + t)) for s in range(8) for t in range(4)]
    r = inf.friedman(spark.createDataFrame(rows, "k int, s int, t int, v double"), ["k"], "s", "t", "v", 4).first()
    sums = [0.0] * 4
    for s in range(8):
        v = [x[3] for x in rows if x[1] == s]
        for t in range(4):
            sums[t] += sum(x < v[t] for x in v) + (sum(x == v[t] for x in v) + 1) / 2
    assert abs(r.n - 8) == 0 and r.chi2 >= 12 / (8 * 4 * 5) * sum(x * x for x in sums) - 3 * 8 * 5 - 1e-9
    h = r.chi2 / 2
    assert abs(r.p - (math.erfc(math.sqrt(h)) + math.sqrt(h) * math.exp(-h) / math.gamma(1.5))) < 1e-12


def test_quantiles_narrow_to_the_ranks(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    v = np.concatenate([rng.standard_normal(500), np.full(200, 0.25), [1e300, -1e300, 1e-300]]).tolist()
    frame = spark.createDataFrame([(x,) for x in [*v, None, float("nan"), float("inf")]], "v double")
    shares = [0.0, 0.005, 0.31, 0.5, 0.995, 1.0]
    got = sc.quantiles(frame, "v", shares, bins=16)
    assert np.allclose(got, np.quantile(v, shares), rtol=1e-12)
    assert sc.quantiles(frame.filter("v is null"), "v", [0.5]) == [None]


def test_noise_of_summation_does_not_move_means_that_lie_halfway(spark):
    rows = [(1, "model_a", tag, *[v] * 3) for tag, v in (("ED", math.nextafter(0.96005, 0)), ("ES", math.nextafter(0.96005, 0)))]
    spark.createDataFrame(rows, "patient_id long, model string, frame_tag string, dice_rv double, dice_myo double, dice_lv double").createOrReplaceTempView("frame_metrics")
    assert {r.dice for r in spark.sql(runs.SCORES).collect()} == {0.9601}


def test_draws_are_never_broadcast(spark):
    v = spark.range(3000).selectExpr("cast(id % 2 as int) as g", "id", "cast(id as double) as v")
    out = inf.bootstrap_mean(v, ["g"], "v", ["id"], 20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert any("LeftOuter" in line and "_i" in line for line in plan.splitlines())
    assert out.first().n == 1500
