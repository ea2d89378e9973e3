"""Walks of folder trees with pruning, manifests beside masks, and sheets behind a gate."""

import os

import pytest
from pyspark.sql import functions as F

from test_catalog import test_query_equals_sql as equals_sql
from voxframe.plans import trees as plans
from voxframe.sources import trees


@pytest.mark.parametrize("name", list(plans.ORACLES))
def test_query_equals_sql(spark, name):
    equals_sql(spark, name)


def put(root, *paths, text=""):
    for p in paths:
        os.makedirs(os.path.dirname(f"{root}/{p}"), exist_ok=True)
        with open(f"{root}/{p}", "w") as f:
            f.write(text)


def test_pruned_folders_are_never_opened(tmp_path):
    put(tmp_path, "cinema/a/1_ED_cinema.nii.gz", "cinema/a/Previews/x.png", "vsa3l/1_ED_vsa3l.nii.gz", "other/cinema/y.txt", "top.txt", "metrics/deep/er/z.csv")
    reader = trees._TreeReader({"path": str(tmp_path), "skip": "previews, metrics", "among": "cinema,vsa3l", "allowed": "cinema", "partitions": "3"})
    opened, list_ = [], reader._children
    reader._children = lambda system, folder, root: opened.append(folder) or list_(system, folder, root)
    got = sorted(r[0] for part in reader.partitions() for r in reader.read(part))
    assert got == ["cinema/a/1_ED_cinema.nii.gz", "other/cinema/y.txt", "top.txt"]
    assert not [o for o in opened if "Previews" in o or "metrics" in o or "vsa3l" in o]


@pytest.mark.parametrize("parts", [1, 2, 5, 40])
def test_every_file_comes_once_however_the_walk_is_dealt(tmp_path, parts):
    paths = [f"{a}/{b}/{c}.txt" for a in "pqr" for b in "stu" for c in "vw"] + ["p/1.txt", "0.txt"]
    put(tmp_path, *paths)
    reader = trees._TreeReader({"path": str(tmp_path), "partitions": str(parts)})
    got = [r[0] for part in reader.partitions() for r in reader.read(part)]
    assert sorted(got) == sorted(paths) and len(reader.partitions()) == parts


def test_masks_take_the_index_of_their_manifest(spark, tmp_path):
    put(tmp_path, "cinema/s/7_ED_cinema_x.nii.gz", "cinema/s/7_frame05_cinema_x.nii.gz", "cinema/t/7_ED_cinema_x.nii.gz", "cinema/s/8_ES_cinema_x.nii.gz", "cinema/s/8_ES_cinema_x_pp.nii.gz", "cinema/s/9_ES_nnformer.nii.gz", "cinema/s/ED.nii.gz", "cinema/s/9_ED_stranger.nii.gz")
    put(tmp_path, "cinema/s/7_cinema_x_manifest.json", text='{"frames": [{"tag": "ED", "idx": 4}, {"tag": "ED", "idx": 9}, {"tag": "ES"}]}')
    put(tmp_path, "cinema/s/8_cinema_x_manifest.json", text="{broken")
    got = trees.mask_frames(trees.read_tree(spark, str(tmp_path), content="_manifest.json"), ["cinema", "nnformer"])
    assert sorted((r.patient_id, r.frame_tag, r.architecture, r.frame_idx, r.path) for r in got.collect()) == [
        ("7", "ED", "cinema", 4, "cinema/s/7_ED_cinema_x.nii.gz"), ("7", "frame05", "cinema", 5, "cinema/s/7_frame05_cinema_x.nii.gz"),
        ("8", "ES", "cinema", 1, "cinema/s/8_ES_cinema_x.nii.gz"), ("9", "ES", "nnformer", 1, "cinema/s/9_ES_nnformer.nii.gz")]


def test_empty_tree_and_odd_case_folders(spark, tmp_path):
    os.makedirs(f"{tmp_path}/none/deeper")
    assert trees.read_tree(spark, f"{tmp_path}/none").count() == 0
    put(tmp_path / "acdc", "t/patient1/patient1_4d.nii.gz", "t/patient2/patient1_4d.nii.gz", "t/patient1/Info.cfg", "t/notes/patient3_4d.nii.gz")
    assert [tuple(r) for r in trees.case_sheet(trees.read_tree(spark, str(tmp_path / "acdc"))).collect()] == [("patient1", "t/patient1/patient1_4d.nii.gz", "t/patient1", "t/patient1/Info.cfg")]


def test_a_sheet_with_one_bad_row_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None), ("c", -1)], "id string, v int").repartition(3)
    assert trees.publish(rows, f"{tmp_path}/bad", F.col("v") > 0) == 2 and os.listdir(tmp_path) == []
    assert trees.publish(rows.filter("v > 0"), f"{tmp_path}/good", F.col("v") > 0) == 0
    assert os.listdir(tmp_path) == ["good"] and [tuple(r) for r in spark.read.option("header", True).csv(f"{tmp_path}/good").collect()] == [("a", "1")]
    with pytest.raises(FileExistsError):
        trees.publish(rows.filter("v > 0"), f"{tmp_path}/good", F.col("v") > 0)
