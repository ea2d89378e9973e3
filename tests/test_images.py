"""Whole packed images and probabilities against the views they stand for, their operators against those on voxels, and plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxframe import catalog, tables
from voxframe.operators import choices as ch
from voxframe.operators import images as im
from voxframe.operators import resample as rs
from voxframe.operators import volumes as vol

SF = "/root/testdata/sf0.001"
KEYS = ["case_id", "frame_tag"]


@pytest.fixture
def odd(spark, tmp_path):
    """Cases of odd keys."""
    spark.createDataFrame([(k,) for k in (-1000001, -221, -38, -1, 0, 36, 37, 221, 10**15 + 7, None)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_images_and_probabilities_hold_the_views_whatever_the_key(spark, odd):
    for name, packed, column, order, value in (("vox_img", tables.images(spark, odd), "image", ["z", "y", "x"], "intensity"), ("vox_prob", tables.probabilities(spark, odd), "probs", ["fold", "class", "z", "y", "x"], "p")):
        voxels = tables.view(spark, odd, name).groupBy(*KEYS).agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, F.coalesce(value, F.lit(0)).alias("v")))), lambda s: s["v"]).alias("v"))
        want = {tuple(r)[:2]: [int(v) for v in r.v] for r in voxels.filter("case_id is not null").collect()}
        kind = np.int8 if name == "vox_prob" else np.uint8
        got = {(r.case_id, r.frame_tag): np.frombuffer(r[column], kind).tolist() for r in packed.collect()}
        assert {k: v for k, v in got.items() if k[0] is not None} == want
        assert not any(got[(None, "ED")])


def test_queries_on_images_and_slices_unfold_and_shuffle_no_voxels(spark):
    for name in ("J09_three_way", "J16_matching_frames", "J16_frame_match", "V05_nearest_labels", "V06_linear_resample", "W19_picked_examples", "V15_pasted", "A27_off_heart", "A29_dice_by_third", "V14_regions", "A52_display_range", "V32_normalised", "A53_zscore", "A50_intensity_reference", "A50_reference_scaled", "W18_best_slices", "W18_best_slice", "W19_examples", "F27_crop_bounds"):
        assert "Range (0, 12" not in catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString(), name


def test_resampling_of_packed_volumes_equals_that_of_voxels(spark, monkeypatch):
    monkeypatch.setattr(vol, "CELLS", 100)
    rng, shape = np.random.default_rng(3), (2, 3, 4)
    cubes = rng.integers(0, 200, (5, *shape)).astype(np.uint8)
    packed = spark.createDataFrame([(i, bytearray(c.tobytes()), bytearray(c.tobytes())) for i, c in enumerate(cubes)], "k int, labels binary, image binary")
    voxels = spark.createDataFrame([(i, *map(int, at), int(c[tuple(at)]), float(c[tuple(at)])) for i, c in enumerate(cubes) for at in np.argwhere(c >= 0)], "k int, z int, y int, x int, label int, intensity double")
    turned = ((1.0, 0.0, 0.0), (0.0, 0.6, 0.8), (0.0, -0.8, 0.6))
    source = rs.Grid(shape, (10.0, 1.25, 1.5), (5.0, -3.0, 2.0), turned)
    for target in (rs.Grid((3, 4, 3), (6.0, 1.0, 2.0), (1.0, -3.5, 1.0), turned), rs.Grid((1, 1, 2), (1.0, 1.0, 1.0))):
        near, line = rs.unfolded(rs.nearest(packed, ["k"], source, target), ["k"], target, "label"), rs.unfolded(rs.linear(packed, ["k"], source, target), ["k"], target, "intensity")
        for got, want, value in ((near, rs.resample_labels(voxels, ["k"], source, target), "label"), (line, rs.resample_linear(voxels, ["k"], source, target), "intensity")):
            a, b = ({tuple(r)[:4]: r[4] for r in df.select("k", "z", "y", "x", value).collect()} for df in (got, want))
            assert got.dtypes == want.dtypes and a == pytest.approx(b, abs=1e-9)


def test_pastes_boxes_and_references(spark):
    cube = np.zeros((2, 4, 4), np.uint8)
    cube[1, 1:3, 2] = 7
    cube[0, 3, 3] = 1
    rows = spark.createDataFrame([(1, bytearray(cube.tobytes()), 1, 2, 0, 2, 0, 4), (2, bytearray(32), 0, 2, 0, 4, 0, 4)], "k int, labels binary, z0 int, z1 int, y0 int, y1 int, x0 int, x1 int")
    assert [tuple(r) for r in vol.boxes(rows, ["k"], cube.shape).collect()] == [(1, 0, 2, 1, 4, 2, 4)]
    voxels = spark.createDataFrame([(1, *map(int, at), int(cube[tuple(at)])) for at in np.argwhere(cube >= 0)], "k int, z int, y int, x int, label int")
    box = rows.filter("k = 1").drop("labels")
    want = ch.pasted(ch.cropped(voxels, box, ["k"]), box, voxels, ["k"]).groupBy("k", "label").agg(F.count("*").alias("n"))
    got = vol.voxels_by_label(vol.pasted(rows, ["k"], cube.shape).filter("k = 1"), ["k"], cube.shape, [0, 1, 7])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    image = rows.select("k", "labels", F.col("labels").alias("image"))
    with pytest.raises(Exception, match="no positive reference"):
        im.label_means(image, ["k"], cube.shape, [7], im.to_reference(7)).collect()
    loose = im.label_means(image, ["k"], cube.shape, [0, 7], im.to_reference(7, strict=False)).collect()
    assert {(r.k, r.label): r["mean"] for r in loose} == {(1, 0): 0.0, (1, 7): 100.0, (2, 0): None}
