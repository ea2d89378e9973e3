"""Report tables against SQL, and small cases worked out by hand."""

import random

import pytest
from test_catalog import test_query_equals_sql as equals_sql

from pyspark.sql import functions as F

from voxframe.operators import supplement as sp
from voxframe.plans import supplement


@pytest.mark.parametrize("name", sorted(supplement.QUERIES))
def test_table_equals_sql(spark, name):
    equals_sql(spark, name)


def test_cells(spark):
    values = [0.0125, -0.0001, 2.5, None, float("nan"), float("inf"), float("-inf"), 0.1 + 0.2]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.t for r in df.orderBy("i").select(sp.fixed(F.col("v"), 3).alias("t")).collect()]
    assert got == ["0.013", "0.000", "2.500", sp.DASH, sp.DASH, "inf", "-inf", "0.300"]
    p = spark.createDataFrame([(0.0009,), (0.001,), (None,)], "p double").select(sp.p_text(F.col("p")).alias("t")).collect()
    assert [r.t for r in p] == ["<0.001", "0.001", sp.DASH]


def test_agreement_equals_the_analysis_of_variance(spark):
    rng = random.Random(3)
    groups = {g: [(rng.gauss(100, 20), rng.gauss(0, 5)) for _ in range(n)] for g, n in (("a", 30), ("b", 2), ("c", 1))}
    pairs = {g: [(x + 2 + e, x) for x, e in v] for g, v in groups.items()}
    rows = [(g, p, r) for g, v in pairs.items() for p, r in v] + [("a", None, 1.0), ("a", float("inf"), 1.0), ("same", 1.0, 1.0), ("same", 1.0, 1.0)]
    got = {r.g: r for r in sp.agreement(spark.createDataFrame(rows, "g string, p double, r double"), ["g"], "p", "r").collect()}
    for g in ("a", "b"):
        v, n = pairs[g], len(pairs[g])
        d = [p - r for p, r in v]
        bias = sum(d) / n
        sd = (sum((x - bias) ** 2 for x in d) / (n - 1)) ** 0.5
        grand = sum(p + r for p, r in v) / (2 * n)
        of_rows = 2 * sum(((p + r) / 2 - grand) ** 2 for p, r in v)
        raters = n * sum((sum(x[i] for x in v) / n - grand) ** 2 for i in (0, 1))
        error = (sum((x - grand) ** 2 for pair in v for x in pair) - of_rows - raters) / (n - 1)
        rows_ = of_rows / (n - 1)
        assert got[g].n == n and got[g].bias == pytest.approx(bias) and got[g].mae == pytest.approx(sum(map(abs, d)) / n)
        assert (got[g].low, got[g].high) == (pytest.approx(bias - 1.96 * sd), pytest.approx(bias + 1.96 * sd))
        assert got[g].icc == pytest.approx((rows_ - error) / (rows_ + error + 2 * (raters - error) / n))
    assert got["c"].n == 1 and got["c"].low is None and got["c"].icc is None
    # no variance at all: nothing to agree on
    assert got["same"].bias == 0 and got["same"].icc is None


def test_off_heart_counts_slices_without_the_heart(spark):
    ref = spark.createDataFrame([(1, 0, [0, 0, 1]), (1, 1, [0, 2, 3])], "case_id int, z int, labels array<int>")
    pred = spark.createDataFrame([(1, "m", 0, [1, 3, 0]), (1, "m", 1, [2, 2, 2]), (1, "m", 2, [0, 0, 3]), (1, "n", 0, [0, 0, 0])], "case_id int, model string, z int, labels array<int>")
    got = {r.model: (r.predicted, r.off, r.off_slices) for r in sp.off_heart(pred, ref, ["case_id"], ["model"], [2, 3]).collect()}
    # slice 0 holds only the other chamber, slice 2 has no reference
    assert got == {"m": (6, 3, 2), "n": (0, 0, 0)}


def test_order_of_variants(spark):
    names = ["b", "a__ensemble", "a__seed2", "a", "a__seed1"]
    s = spark.createDataFrame([("d", m, 5, 0.9, None, float("inf"), 1.0, 2.0) for m in names], "dataset string, model string, n_patients long, dice_lv_mean double, dice_lv_sd double, hd95_lv_median double, hd95_lv_q1 double, hd95_lv_q3 double")
    rows = sp.variants(s, ["lv"], ["a", "b"]).orderBy("place").collect()
    assert [(r.model, r.variant) for r in rows] == [("a", sp.DASH), ("a", "seed 1"), ("a", "seed 2"), ("a", "ensemble"), ("b", sp.DASH)]
    assert rows[0].dice_lv == "0.900 ± –" and rows[0].hd95_lv == "inf [1.0–2.0]"


def test_patients_without_all_models_are_left_out(spark):
    rows = [("d", "dice", "lv", p, m, 0.5 + 0.01 * p * k) for p in range(1, 8) for k, m in enumerate("abc")]
    rows += [("d", "dice", "lv", 99, "a", 0.1), ("d", "dice", "lv", 98, "a", 0.1), ("d", "dice", "lv", 98, "b", float("inf")), ("d", "dice", "lv", 98, "c", 0.1)]
    long = spark.createDataFrame(rows, "dataset string, metric string, structure string, patient int, model string, value double")
    got = sp.pair_tests(long, "patient", ["c", "b", "a"], ["dice"], ["lv"]).orderBy("place").collect()
    # seven patients in the same order: p of each pair is 2 / 2^7, times three by Holm
    assert [(r.model_a, r.model_b, r.median_difference, r.p_holm) for r in got] == [("c", "b", "0.040", "0.047"), ("c", "a", "0.080", "0.047"), ("b", "a", "0.040", "0.047")]
    assert got[0].friedman_p == "<0.001"


def test_empty_scores_give_empty_tables(spark):
    none = spark.createDataFrame([], "dataset string, metric string, structure string, patient int, model string, value double, cleaned boolean, dice double")
    assert sp.pair_tests(none, "patient", ["a", "b"], ["dice"], ["lv"]).isEmpty() and sp.effect(none, "patient", ["a"], ["lv"], 20).isEmpty()
