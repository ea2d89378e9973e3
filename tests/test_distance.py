"""Distance transforms and balls against all pairs of points."""

import math
import random

import numpy as np

from voxframe.operators import distance as ds

KEYS = ["k"]


def points(rng, n, size):
    return sorted({(rng.randrange(size[0]), rng.randrange(size[1]), rng.randrange(size[2])) for _ in range(n)})


def frame(spark, groups):
    return spark.createDataFrame([(k, *p) for k, ps in groups.items() for p in ps], "k int, z int, y int, x int")


def test_envelope_is_the_least_parabola():
    rng = np.random.default_rng(1)
    f = np.where(rng.random((17, 40)) < 0.3, rng.integers(0, 60, (17, 40)).astype(float), np.inf)
    f[:, 0] = np.inf
    i = np.arange(17)
    want = (f[None, :, :] + (1.5 * (i[:, None] - i[None, :])[:, :, None]) ** 2).min(axis=1)
    got = ds.envelope(f, 1.5)
    assert np.isinf(got[:, 0]).all() and np.allclose(got[:, 1:], want[:, 1:])


def test_nearest_equals_all_pairs(spark):
    rng, s = random.Random(2), (10.0, 1.25, 1.5)
    a = {k: points(rng, 30, (6, 15, 9)) for k in range(4)}
    b = {k: points(rng, 3 * k + 1, (9, 12, 20)) for k in range(3)}
    got = {(r.k, r.z, r.y, r.x): r.d for r in ds.nearest(frame(spark, a), frame(spark, b), KEYS, s).collect()}
    want = {(k, *p): min(math.dist([u * v for u, v in zip(p, s)], [u * v for u, v in zip(q, s)]) for q in b[k]) for k in b for p in a[k]}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_balls_in_voxels_and_mm(spark):
    rng = random.Random(3)
    masks = {k: [(z, y, x) for z in range(7) for y in range(9) for x in range(9) if rng.random() < 0.93 and abs(y - 4) + abs(x - 4) < 7] for k in range(2)}
    m = frame(spark, masks)
    for radius, s in ((1, (1.0, 1.0, 1.0)), (2, (1.0, 1.0, 1.0)), (3.0, (2.5, 1.25, 1.5))):
        r = [math.floor(radius / v + 1e-9) for v in s]
        ball = [(z, y, x) for z in range(-r[0], r[0] + 1) for y in range(-r[1], r[1] + 1) for x in range(-r[2], r[2] + 1) if (z * s[0]) ** 2 + (y * s[1]) ** 2 + (x * s[2]) ** 2 <= radius**2 * (1 + 1e-12)]
        move = lambda p, o: tuple(i + j for i, j in zip(p, o))
        grown = {(k, *move(p, o)) for k, ps in masks.items() for p in ps for o in ball if min(move(p, o)) >= 0}
        shrunk = {(k, *p) for k, ps in masks.items() for held in [set(ps)] for p in ps if all(move(p, o) in held for o in ball)}
        assert {tuple(x) for x in ds.dilate_ball(m, KEYS, radius, s).select("k", "z", "y", "x").collect()} == grown
        assert {tuple(x) for x in ds.erode_ball(m, KEYS, radius, s).select("k", "z", "y", "x").collect()} == shrunk


def test_empty_sides(spark):
    none, one = frame(spark, {}), frame(spark, {1: [(0, 0, 0)]})
    assert ds.nearest(none, one, KEYS, (1.0, 1.0, 1.0)).isEmpty() and ds.nearest(one, none, KEYS, (1.0, 1.0, 1.0)).isEmpty()
    assert ds.dilate_ball(none, KEYS, 2).isEmpty() and ds.erode_ball(one, KEYS, 1).isEmpty()
