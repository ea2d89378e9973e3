"""Cases are dealt before they become voxels, and joins of voxels take that as dealt."""

import re

from voxframe import catalog, tables

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_joins_of_voxels_shuffle_no_voxels(spark):
    for name in ("J07_voxel_join", "A34_run_agreement", "J16_frame_match", "V15_paste_back"):
        text = plan(spark, name)
        assert "hashpartitioning(c_custkey" in text
        assert not re.search(r"Exchange hashpartitioning\([^)]*\b[zyx]#", text)


def test_views_are_never_broadcast(spark):
    for name in ("J23_geometry_mates", "W06_cine_frames", "V15_paste_back"):
        assert "BroadcastHashJoin" not in plan(spark, name)


def test_a_task_unfolds_a_bounded_number_of_cases(spark, monkeypatch):
    monkeypatch.setattr(tables, "CASES", 20)
    cases = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert tables.view(spark, SF, "vox_gt").rdd.getNumPartitions() == -(-cases // 20)


def test_clipping_unfolds_the_image_once(spark):
    text = plan(spark, "A51_clipped")
    assert text.count("Range (0, 5") == 1 and "Join" not in text.replace("BroadcastNestedLoopJoin", "")


def test_verified_frames_read_images_and_matches_once(spark):
    from voxframe.operators import frames as fr

    images = spark.range(4).selectExpr("id % 2 as k", "case when id % 2 = 0 then 'frame01' else 'SA_ED' end as name")
    matches = spark.range(2).selectExpr("id as k", "case when id = 0 then 'frame01' else 'SA_ED' end as name", "0 as t")
    manifest = spark.createDataFrame([(0, "ED", 0), (1, "ED", 1), (2, "ES", 0)], "k long, tag string, idx int")
    found = fr.verified_frames(manifest, images, matches, "k")
    assert "Range (" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.k: (r.status, r.against) for r in found.collect()} == {0: ("verified", "numbered"), 1: ("mismatch", "SA_ED"), 2: ("no reference", None)}
