"""Duplicate search by products of groups of unit vectors, against all pairs."""

import numpy as np
from pyspark.sql import functions as F

from test_catalog import test_query_equals_sql as equals_sql
from voxframe.operators import frames as fr

VOX = "site int, id long, value array<double>"


def brute(cases, entries, turns):
    best = {}
    for site, i, v in cases:
        for s, e, w in entries:
            for t in turns:
                a, b = (np.array(x, float) - np.mean(x) for x in (np.array(v)[t], w))
                n = np.linalg.norm(a) * np.linalg.norm(b)
                r = round(float(a @ b / n), 9) if n > 0 else 0.0
                if s == site and i != e and r > 0 and (i not in best or (r, -e) > (best[i][0], -best[i][1])):
                    best[i] = (r, e)
    return best


def test_groups_find_what_all_pairs_find(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(0, 9, (60, 12)).astype(float)
    vectors[7], vectors[20], vectors[33] = vectors[5][::-1], vectors[5], 4.0  # a flipped copy, a copy, a flat one
    rows = [(0 if i < 40 else i % 3, i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame([*rows, (0, 900, None), (0, 901, [float("nan")] * 12)], VOX)
    turns = [list(range(12)), list(range(11, -1, -1))]
    columns = [(str(k), F.array(*(F.lit(i) for i in t))) for k, t in enumerate(turns)]
    want = brute(rows, rows, turns)
    for numbers in (12, 100, 1 << 18):
        got = {r.case_id: (r.r, r.entry) for r in fr.best_correlation(table, table, ["site"], columns, 12, numbers).collect()}
        assert got == want
    assert want[20] == (1.0, 5) and want[5] == (1.0, 7) and want[7] == (1.0, 5)


def test_tails_leave_out_entries_without_changing_the_best():
    rng = np.random.default_rng(5)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.normal(size=(20, 64)), rng.normal(size=(300, 64))))
    b[[30, 200]] = a[3]
    ids = np.arange(1000, 1300)
    for step in (1, 5, 64, 100):
        r, e = fr.best_products(a, np.arange(20), b, ids, step)
        want = np.round(a @ b.T, 9)
        assert np.array_equal(e, ids[want.argmax(axis=1)]) and np.allclose(r, want.max(axis=1))
    assert e[3] == 1030 and fr.best_products(a[:1], ids[:1], a[:1], ids[:1])[0].tolist() == [-1.0]


def test_one_large_block_is_dealt_over_tasks(spark):
    table = spark.range(3000).select(F.lit(1).alias("site"), "id", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.pmod(F.xxhash64(F.floor(F.col("id") / 2), i), F.lit(1000)).cast("double")).alias("value"))
    got = fr.best_correlation(table, table, ["site"], [("same", F.sequence(F.lit(0), F.lit(7)))], 8, 8 * 200)
    rows = got.collect()
    assert len(rows) == 3000 and all(r.r == 1.0 and r.entry == r.case_id ^ 1 for r in rows)


def test_duplicate_query_equals_sql(spark):
    equals_sql(spark, "J20_duplicate_scans")


def test_variants_are_made_after_groups_have_met(spark):
    table = spark.range(60).select(F.lit(1).alias("site"), "id", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(1000)).cast("double")).alias("value"))
    turns = [(str(k), F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i, k=k: (i + k) % 8)) for k in range(4)]
    found = fr.best_correlation(table, table, ["site"], turns, 8)
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # arrays of cases are shuffled once for each group of the catalogue, not for each variant too
    assert not any("posexplode" in line.lower() for line in lines)
    assert found.count() == 60


def test_rows_without_a_direction_are_left_out():
    v, held = fr.unit_rows(np.array([[1.0, 3.0], [2.0, 2.0], [np.nan, 1.0], [np.inf, 1.0], [5.0, 1.0]]))
    assert held.tolist() == [0, 4] and np.allclose(v, np.array([[-1, 1], [1, -1]]) / np.sqrt(2))
