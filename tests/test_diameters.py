"""Greatest diameters by convex hulls against all pairs, and how many pairs they measure."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_catalog import test_query_equals_sql as equals_sql
from voxframe.operators import texture as tx

SPACING = (2.5, 1.25, 0.75)


def all_pairs(points):
    gap = lambda p, q: math.sqrt(sum(((a - b) * s) ** 2 for a, b, s in zip(p, q, SPACING, strict=True)))
    pairs = list(itertools.product(points, points))
    return max(gap(p, q) for p, q in pairs), max(gap(p, q) for p, q in pairs if p[0] == q[0])


def test_diameters_equal_all_pairs(spark):
    rng = np.random.default_rng(11)
    masks = {c: {tuple(p) for p in rng.integers(-5, 6, (n, 3)).tolist()} for c, n in enumerate((1, 2, 3, 9, 40, 150, 300))}
    masks |= {7: {(0, 0, x) for x in range(6)}, 8: {(z, 3, 3) for z in range(5)}, 9: {(0, y, -y) for y in range(7)}, 10: {(1, y, x) for y in range(4) for x in range(4)}}
    rows = spark.createDataFrame([(c, *p) for c, m in masks.items() for p in m], "case_id int, z int, y int, x int")
    got = {r.case_id: (r.diameter_3d, r.diameter_slice) for r in tx.diameters(rows, ["case_id"], SPACING).collect()}
    assert set(got) == set(masks)
    for c, m in masks.items():
        assert got[c] == pytest.approx(all_pairs(m), rel=1e-12)


def test_corners_of_a_hull():
    y, x = np.array([0, 1, 2, 3, 4]), np.array([2, 1, 0, 1, 2])
    assert tx.hull(y[::-1], x, 4 - x).tolist() == [[0, 2], [2, 0], [2, 4], [4, 2]]


def test_a_filled_box_measures_few_pairs(spark):
    box = spark.range(200**3).select(F.lit(1).alias("case_id"), (F.col("id") / 40000).cast("int").alias("z"), (F.col("id") / 200 % 200).cast("int").alias("y"), (F.col("id") % 200).cast("int").alias("x"))
    row = tx.diameters(box, ["case_id"], (1.0, 1.0, 1.0)).first()
    assert math.isclose(row.diameter_3d, 199 * math.sqrt(3)) and math.isclose(row.diameter_slice, 199 * math.sqrt(2))
    corners = np.array([(z, y, x) for z in range(200) for y in (0, 199) for x in (0, 199)], dtype=float)
    assert tx.farthest(corners)[1] < 200_000 < len(corners) ** 2


def test_corners_of_a_ball_measure_a_small_share_of_pairs():
    g = np.arange(-40, 41)
    z, y, x = (a.ravel() for a in np.meshgrid(g, g, g, indexing="ij"))
    inside = z * z + y * y + x * x <= 1600
    corners = []
    for k in g:
        at = inside & (z == k)
        rows = np.unique(y[at])
        corners += [(k, *c) for c in tx.hull(rows, np.array([x[at & (y == r)].min() for r in rows]), np.array([x[at & (y == r)].max() for r in rows]))]
    best, pairs = tx.farthest(np.array(corners, dtype=float))
    assert best == 80.0 and pairs < len(corners) ** 2 / 3


def test_shape_query_equals_sql(spark):
    equals_sql(spark, "V31_shape")
