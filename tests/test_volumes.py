"""Operators on whole packed volumes against those on voxel tables, and their plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxframe import catalog, tables
from voxframe.operators import distance, overlap
from voxframe.operators import labels as lb
from voxframe.operators import neighbours as nb
from voxframe.operators import volumes as vol

SF = "/root/testdata/sf0.001"
SPACING = (3.0, 1.5, 0.75)


def made(spark, shape, n=12, seed=5):
    """(packed, voxels) of made-up volumes, the first empty, the second full of one label."""
    rng = np.random.default_rng(seed)
    cubes = rng.choice(4, (n, *shape), p=[0.15, 0.1, 0.6, 0.15]).astype(np.uint8)
    cubes[0], cubes[1] = 0, 3
    packed = spark.createDataFrame([(i, bytearray(c.tobytes())) for i, c in enumerate(cubes)], "k int, labels binary")
    voxels = spark.createDataFrame([(i, *map(int, at), int(c[tuple(at)])) for i, c in enumerate(cubes) for at in np.argwhere(c >= 0)], "k int, z int, y int, x int, label int")
    return packed, voxels


def rows(df, *columns):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(params=[(5, 6, 7), (1, 4, 40)], ids=str)
def case(request, spark, monkeypatch):
    monkeypatch.setattr(vol, "CELLS", 500)
    return request.param, *made(spark, request.param)


def test_components_and_counts(case):
    shape, packed, voxels = case
    want = nb.sized(nb.components(voxels.filter("label in (1, 3)"), ["k", "label"]), ["k", "label"])
    assert rows(vol.components(packed, ["k"], shape, [1, 3]), "k", "label", "component", "size", "top") == rows(want, "k", "label", "component", "size", "top")
    per = voxels.groupBy("k").agg(F.array(*(F.count_if(F.col("label") == v) for v in (2, 1))).alias("counts"))
    assert rows(vol.label_counts(packed, ["k"], shape, [2, 1]), "k", "counts") == rows(per, "k", "counts")


def test_distances(case):
    shape, packed, voxels = case
    ref, other = made(packed.sparkSession, shape, seed=9)
    a, b = (v.filter("label = 1").drop("label") for v in (voxels, other))
    names = ["k", "hd", "hd95", "asd", "assd"]
    want = nb.surface_distances(a, b, ["k"], SPACING, groups=packed)
    assert rows(vol.surface_distances(vol.paired(packed, ref, ["k"]), ["k"], shape, 1, SPACING), *names) == rows(want, *names)
    names = ["k", "mean_mm", "max_mm", "p95_mm"]
    assert rows(vol.wall_thickness(packed, ["k"], shape, 2, 3, SPACING), *names) == rows(nb.wall_thickness(voxels, ["k"], 2, 3, SPACING), *names)


def test_closing(case):
    shape, packed, voxels = case
    mask = voxels.filter("label = 2").drop("label")
    for got, want in ((vol.closing(packed, ["k"], shape, 2, nb.ball(1), below=True), nb.closing(mask, ["k"], nb.ball(1))), (vol.closing(packed, ["k"], shape, 2, vol.ball(2), below=False), distance.closing_ball(mask, ["k"], 2))):
        assert rows(got, "k", "z", "n") == rows(want.groupBy("k", "z").agg(F.count("*").alias("n")), "k", "z", "n")


def test_votes_and_confusion(case):
    from voxframe.plans import voxels as plans

    shape, packed, voxels = case
    votes = packed.groupBy((F.col("k") % 5).alias("g")).agg(F.collect_list("labels").alias("votes"))
    want = plans.majority(voxels.withColumn("g", F.col("k") % 5), ["g"], [0, 1, 2, 3]).groupBy("g", "label").agg(F.count("*").alias("n"))
    assert rows(vol.majority(votes, ["g"], shape, [0, 1, 2, 3]), "g", "label", "n") == rows(want, "g", "label", "n")
    ref, other = made(packed.sparkSession, shape, seed=9)
    names = ["k", "label", "tp", "fp", "fn", "tn"]
    want = overlap.confusion(voxels, other, ["k"], [], [1, 2, 3])
    assert rows(vol.confusion(vol.paired(packed, ref, ["k"]), ["k"], shape, [1, 2, 3]), *names) == rows(want, *names)


def test_shapes_and_names(case):
    shape, packed, voxels = case
    got = vol.shapes(packed, ["k"], shape, [0, 1, 2, 3], [2, 3])
    per = voxels.groupBy("k", "label").agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in "zyx"))
    assert rows(got, "k", "label", "n", "z", "y", "x") == rows(per, "k", "label", "n", "z", "y", "x")
    scores = got.filter("label > 0").select("k", F.col("label").alias("inner"), "n", F.posexplode("held").alias("outer", "h")).filter("h > 0")
    want = lb.enclosure(voxels, ["k"]).filter("outer > 1")
    assert rows(scores.select("k", (F.col("outer") + 2).alias("outer"), "inner", (F.col("h") / F.col("n")).alias("score")), "k", "outer", "inner", "score") == rows(want, "k", "outer", "inner", "score")
    assert shape[0] == 1 or want.count() > 10
    other = vol.renamed(packed, ["k"], shape, F.array(*((F.lit(i) + F.col("k")) % 4 for i in range(4))))
    turned = voxels.groupBy("k", ((F.col("label") + F.col("k")) % 4).alias("label")).agg(F.count("*").alias("n"))
    assert rows(vol.shapes(other, ["k"], shape, [0, 1, 2, 3], [1]), "k", "label", "n") == rows(turned, "k", "label", "n")


def test_holes_behind_a_winding_path_are_open(spark):
    wall = np.ones((1, 1, 9, 9), dtype=bool)
    wall[0, 0, 1:8, 1] = wall[0, 0, 1, 1:8] = wall[0, 0, 1:6, 7] = wall[0, 0, 5, 3:8] = wall[0, 0, 3:6, 3] = False
    assert vol._holes(wall).sum() == (~wall).sum()
    wall[0, 0, 8, 1] = False
    assert vol._holes(wall).sum() == 0


def test_a_volume_of_another_size_is_an_error(spark):
    short = spark.createDataFrame([(1, bytearray(5))], "k int, labels binary")
    with pytest.raises(Exception, match="must have 6 labels"):
        vol.label_counts(short, ["k"], (1, 2, 3), [1]).collect()


def test_volumes_hold_the_views_of_their_names_whatever_the_key(spark, tmp_path):
    d, shape = str(tmp_path), (tables.Z, tables.Y, tables.X)
    spark.createDataFrame([(k,) for k in (-1000001, -220, -1, 0, 219, 221, 10**15 + 7, None)], "c_custkey long").write.parquet(f"{d}/customer.parquet")
    for name in ("vox_gt", "vox_pred"):
        keys = [k for k in tables.SLICES[name][1] if k != "z"]
        voxels = tables.view(spark, d, name)
        want = voxels.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("z", "y", "x", "label"))), lambda v: v["label"]).alias("labels"))
        got = {tuple(r)[:-1]: list(r.labels) for r in tables.volumes(spark, d, name).collect()}
        assert got == {tuple(r)[:-1]: r.labels for r in want.collect()} and len(next(iter(got.values()))) == shape[0] * shape[1] * shape[2]


def test_queries_on_volumes_unfold_and_shuffle_no_voxels(spark):
    for name in ("V08_components", "V09_keep_largest", "A56_component_limits", "A16_surface_distances", "V12_wall_thickness", "V11_closing", "V11_ball_closing_2", "V13_majority_vote", "A38_clinical_measures", "A19_case_means", "A01_confusion", "V02_canonical_labels", "V03_known_wall"):
        text = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        # ranges of y and x make voxels
        assert "Range (0, 12" not in text, name
