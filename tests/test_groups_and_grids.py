"""Cleaning by groups of labels against a search, and grids that are resized, cut and padded."""

import random

import pytest
from test_catalog import test_query_equals_sql as equals_sql

from voxframe.operators import relabel as rl
from voxframe.operators import resample as rs


@pytest.mark.parametrize("name", ["V09_class_groups", "F26_grid_points"])
def test_query_equals_sql(spark, name):
    equals_sql(spark, name)


def pieces(points):
    left, out = set(points), []
    while left:
        todo = [left.pop()]
        found = set(todo)
        while todo:
            z, y, x = todo.pop()
            for n in ((z + 1, y, x), (z - 1, y, x), (z, y + 1, x), (z, y - 1, x), (z, y, x + 1), (z, y, x - 1)):
                if n in left:
                    left.discard(n)
                    found.add(n)
                    todo.append(n)
        out.append(found)
    return out


def test_groups_in_order_equal_a_search(spark):
    rng = random.Random(8)
    images = {k: {(z, y, x): rng.choice([0, 0, 1, 2, 3]) for z in range(3) for y in range(7) for x in range(7)} for k in range(4)}
    images[4] = {(0, 0, 0): 0, (0, 0, 1): 1}
    groups, least = {"all": [1, 2, 3], "two": [2], "one and three": [1, 3], "two again": [2]}, {"two": 1.0, "one and three": 2.5}
    df = spark.createDataFrame([(k, *p, v) for k, m in images.items() for p, v in m.items()], "k int, z int, y int, x int, label int")
    image, report = rl.keep_by_groups(df, ["k"], groups, 0.5, least)
    got, said = {(r.k, r.z, r.y, r.x): r.label for r in image.collect()}, {(r.k, r.group_name): (r.largest_removed, r.kept) for r in report.collect()}
    want, told = {}, {}
    for k, m in images.items():
        m = dict(m)
        for g, labels in groups.items():
            sizes = [(len(c) / 2, c) for c in pieces([p for p, v in m.items() if v in labels])]
            top = max((n for n, _ in sizes), default=None)
            gone = [(n, c) for n, c in sizes if n != top and (g not in least or n < least[g])]
            told[k, g] = (max((n for n, _ in gone), default=None), top)
            for p in (p for _, c in gone for p in c):
                m[p] = 0
        want |= {(k, *p): v for p, v in m.items() if v}
    assert got == want and said == told


def test_groups_without_a_common_label_share_a_run():
    assert rl._apart({"a": [1], "b": [2, 3], "c": [3, 4], "d": [5], "e": [4, 1]}) == [["a", "b", "d"], ["c"], ["e"]]


def test_background_is_no_group(spark):
    with pytest.raises(ValueError):
        rl.keep_by_groups(spark.createDataFrame([], "k int, z int, y int, x int, label int"), ["k"], {"all": [0, 1]})


def test_resizing_keeps_the_outer_faces_and_cropping_keeps_points(spark):
    source = rs.Grid((6, 8, 10), (4.0, 1.5, 1.0), (7.0, -2.0, 3.0))
    fine = rs.resized(source, (2.0, 1.0, 2.0))
    assert fine.size == (12, 12, 5)
    for n in range(3):
        for g in (source, fine):
            assert g.origin[n] - g.spacing[n] / 2 == source.origin[n] - source.spacing[n] / 2
            assert g.origin[n] + (g.size[n] - 0.5) * g.spacing[n] == source.origin[n] + (source.size[n] - 0.5) * source.spacing[n]
    turned = rs.Grid((6, 8, 10), (4.0, 1.5, 1.0), (7.0, -2.0, 3.0), ((0.0, 0.0, 1.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0)))
    points = spark.createDataFrame([(0, 0, 0), (5, 7, 9), (2, 3, 4)], "z int, y int, x int")
    for r in rs.moved(points, turned, rs.cropped(turned, (1, -2, 3), (4, 4, 4))).collect():
        assert (r.u_z, r.u_y, r.u_x) == pytest.approx((r.z - 1, r.y + 2, r.x - 3))
        assert (r.z_mm, r.y_mm, r.x_mm) == pytest.approx((7 + 1.5 * r.y, -2 + r.x, 3 + 4.0 * r.z))
