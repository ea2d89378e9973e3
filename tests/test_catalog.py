"""Registered queries against their SQL on the smallest tables, and phantoms worked out by hand."""

import glob
import math
import os
import random

import duckdb
import pytest

from voxframe import catalog
from voxframe.operators import labels as lb
from voxframe.operators import neighbours as nb
from voxframe.operators import overlap
from voxframe.operators import resample as rs
from voxframe.operators import texture as tx

SF = "/root/testdata/sf0.001"
NAMES = ["A03_dice", "A21_model_comparison", "A28_slice_dice", "A30_volumes", "A33_bounding_box", "V10_surface", "V11_erosion", "V13_majority_vote", "W01_ed_es", "W02_local_minima", "W10_holm", "S13_mask_catalogue", "A42_task_profile", "J23_geometry_mates", "V05_nearest_labels", "V06_linear_resample", "V07_fill_holes", "V30_glcm", "V31_shape", "W15_otsu", "A29_dice_by_third", "J09_three_way", "W03_slice_position", "F12_spacing", "V16_crop_to_nonzero"]


def plain(rows):
    return sorted((tuple(round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) and v == v else str(v) for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    got, want = catalog.queries()[name](spark, SF), c.execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(cols)
    assert plain(tuple(r) for r in got.select(*cols).collect()) == plain(want.fetchall())


def box(spark, z, y, x):
    return spark.createDataFrame([(1, a, b, c) for a in z for b in y for c in x], "case_id int, z int, y int, x int")


def test_missed_slice_and_shift_cost_their_spacing(spark):
    ref = box(spark, range(1, 5), range(5, 15), range(5, 15))
    for pred, want in ((box(spark, range(1, 4), range(5, 15), range(5, 15)), 10.0), (box(spark, range(1, 5), range(5, 15), range(6, 16)), 1.5)):
        row = nb.surface_distances(pred, ref, ["case_id"], (10.0, 1.5, 1.5)).first()
        assert math.isclose(row.hd95, want)


def test_components_holes_and_largest(spark):
    ring = [(1, 0, y, x) for y in range(1, 5) for x in range(1, 5) if y in (1, 4) or x in (1, 4)]
    mask = spark.createDataFrame([*ring, (1, 0, 7, 7)], "case_id int, z int, y int, x int")
    assert nb.components(mask, ["case_id"]).select("component").distinct().count() == 2
    assert nb.keep_largest(mask, ["case_id"]).count() == len(ring)
    assert {(r.y, r.x) for r in nb.fill_holes(mask, ["case_id"]).collect()} == {(2, 2), (2, 3), (3, 2), (3, 3)}


def test_wall_thickness_of_a_square_ring(spark):
    cells = [(1, 0, y, x, 3 if max(abs(y - 8), abs(x - 8)) <= 2 else 2 if max(abs(y - 8), abs(x - 8)) <= 4 else 0) for y in range(17) for x in range(17)]
    row = nb.wall_thickness(spark.createDataFrame(cells, "case_id int, z int, y int, x int, label int"), ["case_id"], 2, 3, (10.0, 1.0, 1.0)).first()
    assert row.mean_mm == 2.0 and row.max_mm == 2.0


def test_unknown_metric_is_an_error(spark):
    with pytest.raises(KeyError):
        overlap.metric(None, "no such metric")


def test_holes_equal_a_flood_from_the_border(spark):
    rng, n = random.Random(5), 14
    masks = {c: {(y, x) for y in range(n) for x in range(n) if rng.random() < 0.25 + 0.12 * c} for c in range(4)}
    rows = [(c, 0, y, x) for c, m in masks.items() for y, x in m]
    got = {(r.case_id, r.y, r.x) for r in nb.fill_holes(spark.createDataFrame(rows, "case_id int, z int, y int, x int"), ["case_id"]).collect()}
    want = set()
    for c, m in masks.items():
        seen, todo = set(), [(y, x) for y in range(-1, n + 1) for x in range(-1, n + 1) if y in (-1, n) or x in (-1, n)]
        while todo:
            y, x = todo.pop()
            if (y, x) in seen or (y, x) in m or not (-1 <= y <= n and -1 <= x <= n):
                continue
            seen.add((y, x))
            todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
        want |= {(c, y, x) for y in range(n) for x in range(n) if (y, x) not in seen and (y, x) not in m}
    assert got == want


def test_anatomy_needs_an_enclosing_label(spark):
    ring = [(1, 0, y, x, 7 if y in (1, 5) or x in (1, 5) else 4) for y in range(1, 6) for x in range(1, 6)]
    apart = [(2, 0, 1, 1, 7), (2, 0, 4, 4, 4)]
    df = spark.createDataFrame([*ring, (1, 0, 8, 8, 9), *apart], "case_id int, z int, y int, x int, label int")
    assert [tuple(r) for r in lb.anatomy(df, ["case_id"]).collect()] == [(1, 7, 4, 1.0)]
    names = {(r.case_id, r.label) for r in lb.canonical(df, ["case_id"]).collect()}
    assert names == {(1, 1), (1, 2), (1, 3), (2, 7), (2, 4)}


def test_resampling_to_the_same_grid_changes_nothing(spark):
    grid = rs.Grid((2, 3, 4), (10.0, 1.5, 1.25), (5.0, -3.0, 2.0), ((1.0, 0.0, 0.0), (0.0, 0.0, 1.0), (0.0, -1.0, 0.0)))
    rows = [(1, z, y, x, z * 12 + y * 4 + x, float(z * 12 + y * 4 + x)) for z in range(2) for y in range(3) for x in range(4)]
    df = spark.createDataFrame(rows, "case_id int, z int, y int, x int, label int, intensity double")
    near, line = rs.resample_labels(df, ["case_id"], grid, grid), rs.resample_linear(df, ["case_id"], grid, grid)
    assert near.join(df.withColumnRenamed("label", "was"), ["case_id", "z", "y", "x"]).filter("label = was").count() == 24
    assert all(math.isclose(r.intensity, r.z * 12 + r.y * 4 + r.x, abs_tol=1e-9) for r in line.collect())


def test_empty_inputs_give_empty_results(spark):
    none = spark.createDataFrame([], "case_id int, z int, y int, x int, label int, intensity double")
    assert nb.fill_holes(none, ["case_id"]).isEmpty() and lb.dense(none, ["case_id"]).isEmpty() and lb.otsu(none, ["case_id"]).isEmpty()
    assert tx.glcm_features(tx.discretised(none, ["case_id"]), ["case_id"]).isEmpty() and tx.shape_features(none, ["case_id"], (1.0, 1.0, 1.0)).isEmpty()


@pytest.mark.parametrize(("n", "k"), [(10, 4), (30, 5), (25, 7), (7, 3), (8, 3), (10, 2), (10, 1), (3, 5)])
def test_even_frames_keep_first_and_last(spark, n, k):
    from voxframe.plans.catalogue import even_frames
    from voxframe.tables import for_spark

    spark.range(n).selectExpr("1 as patient_id", "cast(id as int) as frame_index", f"{n} as n_frames").createOrReplaceTempView("some_curve")
    got = sorted(r.frame_index for r in spark.sql(for_spark(even_frames(k, "some_curve"), SF)).collect())
    assert got == (list(range(n)) if k >= n else [0] if k == 1 else sorted({round(i * (n - 1) / (k - 1)) for i in range(k)}))


def test_component_limits_keep_fragments_apart(spark):
    cells = [(1, 0, 0, x, 3) for x in (0, 1, 2, 3, 6, 7)] + [(2, 0, 0, x, 3) for x in (0, 1, 2)]
    df = spark.createDataFrame(cells, "case_id int, z int, y int, x int, label int")
    assert [tuple(r) for r in nb.component_limits(df, ["case_id", "label"], ["label"]).collect()] == [(3, 2, 3)]


@pytest.mark.parametrize("name", ["W08_even_subsampling", "F23_slice_distance"])
def test_survey_plan_equals_sql(spark, name):
    test_query_equals_sql(spark, name)


def test_slice_distance_depends_on_the_orientation(spark):
    odd = {r.distance >= 0 for r in catalog.queries()["F23_slice_distance"](spark, SF).filter("exam % 2 = 1").collect()}
    assert odd == {False}
