"""Sparse masks, empty sides, large grids, cleaning decisions and choices, by cases worked out by hand; new plans against SQL."""

import math
import random

import pytest
from pyspark.sql import functions as F

from test_catalog import SF, box, test_query_equals_sql as equals_sql
from voxframe import catalog
from voxframe.functions import texts as tx
from voxframe.operators import choices as ch
from voxframe.operators import frames as fr
from voxframe.operators import neighbours as nb
from voxframe.operators import overlap
from voxframe.operators import relabel as rl
from voxframe.operators import scores as sc
from voxframe.sources import files

VOX = "case_id int, z int, y int, x int, label int"
NEW = [
    "A01_sparse_masks", "A16_surface_distances", "V08_components", "V09_keep_largest", "V12_wall_thickness", "V18_ring_relabel", "V20_confidence", "V03_known_wall", "V23_decision", "V24_apply_decision", "A56_component_limits", "V11_ball_dilation_2", "V11_ball_erosion_1", "V11_ball_closing_2",
    "A60_slice_scores", "W12_signed_ranks", "R02_pairwise_tests", "R03_effect_table", "J18_ground_truths", "J19_outputs_to_frames", "J20_duplicate_scans", "W07_series_kinds", "F14_memory_units", "F25_directions", "F27_crop_bounds", "F30_radiomics_settings",
    "A40_execution_metrics", "S23_provenance", "S28_markdown", "S29_json_summaries", "S31_info_files", "V15_pasted", "V21_band_relabel", "A19_case_means", "A24_accuracy_summary", "P10_binary_masks", "V28_all_first_order", "W09_frame_manifests", "J17_verified_frames",
    "W01_phases", "F13_duration_units", "A44_scientific_summary", "S15_generic_sheet", "W13_chosen_variants", "V16_filled_crop",
]


@pytest.mark.parametrize("name", NEW)
def test_new_plan_equals_sql(spark, name):
    equals_sql(spark, name)


def test_every_module_has_sql_for_its_queries():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_reference_only_voxels_are_missed_voxels(spark):
    ref = spark.createDataFrame([(1, 0, 0, x, 3) for x in range(10)], VOX)
    pred = spark.createDataFrame([(1, "a", 0, 0, x, 3) for x in range(4)] + [(1, "b", 5, 5, 5, 3)], "case_id int, model string, z int, y int, x int, label int")
    for grid, tn in ((None, {"a": 0, "b": 0}), (100, {"a": 90, "b": 89})):
        got = {r.model: (r.tp, r.fp, r.fn, r.tn) for r in overlap.confusion(pred, ref, ["case_id"], ["model"], [3], grid).collect()}
        assert got == {"a": (4, 0, 6, tn["a"]), "b": (0, 1, 10, tn["b"])}
    none = overlap.confusion(pred.filter("case_id = 2"), ref, ["case_id"], [], [3], 100).collect()
    assert [(r.tp, r.fn, r.tn) for r in none] == [(0, 10, 90)]


def test_empty_sides_of_distances(spark):
    a, none = box(spark, range(2), range(2), range(2)), box(spark, [], [], [1]).filter("false")
    groups = spark.createDataFrame([(1,), (2,)], "case_id int")
    assert [tuple(r)[1:] for r in nb.surface_distances(a, none, ["case_id"], (1.0, 1.0, 1.0)).collect()] == [(math.inf,) * 4]
    assert {r.case_id: r.hd95 for r in nb.surface_distances(none, a, ["case_id"], (1.0, 1.0, 1.0), groups=groups).collect()} == {1: math.inf, 2: 0.0}


def test_components_of_large_grids_stay_apart(spark):
    m = spark.createDataFrame([(1, 0, 0, 1000), (1, 0, 1, 0), (1, 1, 0, 0), (1, 0, 0, 1001)], "case_id int, z int, y int, x int")
    got = nb.components(m, ["case_id"]).collect()
    assert len(got) == 4 and len({r.component for r in got}) == 3
    with pytest.raises(Exception, match="coordinates"):
        nb.components(spark.createDataFrame([(1, 0, 0, 1 << 21)], "case_id int, z int, y int, x int"), ["case_id"]).collect()


def test_small_components_may_stay(spark):
    m = spark.createDataFrame([(1, 0, 0, x) for x in (0, 1, 2, 3, 4, 6, 7, 8, 10)], "case_id int, z int, y int, x int")
    assert nb.keep_largest(m, ["case_id"]).count() == 5 and nb.keep_largest(m, ["case_id"], least=3).count() == 8


def test_decision_accepts_what_helps_and_nothing_else(spark):
    ref = spark.createDataFrame([(c, 0, 0, x, 1) for c in (1, 2) for x in range(6)] + [(c, 0, 1, x, 2) for c in (1, 2) for x in (0, 1, 4, 5)], VOX)
    pred = ref.unionByName(spark.createDataFrame([(1, 3, 3, 3, 1), (2, 3, 3, 0, 1)], VOX))
    rows = sorted((r.step, r.label, r.before, r.after, r.accepted) for r in rl.decide(pred, ref, ["case_id"], [], [1, 2]).collect())
    assert [(step, k, ok) for step, k, _, _, ok in rows] == [("all", 1, True), ("all", 2, True), ("label", 1, False), ("label", 2, False)]
    assert rows[0][2] < rows[0][3] == 1.0 and rows[3][3] == rows[3][2] == 1.0  # label 2's two parts tie, so both stay
    assert rl.apply_decision(pred, ["case_id"], rows).count() == ref.count()


def test_ring_relabel_moves_a_dark_bay_beside_the_wall(spark):
    rows = []
    for y in range(21):
        for x in range(21):
            d = (y - 10) ** 2 + (x - 10) ** 2
            label = 3 if d <= 36 else 2 if d <= 64 else 0
            dark = label == 3 and x >= 14 and abs(y - 10) <= 2
            rows.append((1, 0, y, x, label, 40.0 if dark else 200.0 + (x * y) % 7 if label == 3 else 60.0))
    v = spark.createDataFrame(rows, VOX + ", intensity double")
    moved = {(r.y, r.x) for r in rl.RingRelabel(v, ["case_id"], 0.5).selected().collect()}
    assert moved and all(x >= 14 and abs(y - 10) <= 2 for y, x in moved)
    pool = sum(r[4] == 3 for r in rows)
    assert len(moved) <= 0.14 * pool
    after = rl.relabelled(v, rl.RingRelabel(v, ["case_id"], 0.5).selected(), ["case_id"])
    assert after.filter("label = 3").count() == pool - len(moved) and after.filter("delta = 1 and label <> 2").isEmpty()
    smooth = rl.band_relabel(v, ["case_id"], 0.2, smooth=1)
    assert smooth.join(v.filter("label = 3").select("case_id", "z", "y", "x"), ["case_id", "z", "y", "x"], "left_anti").isEmpty()


def test_known_wall_by_centroid_and_by_value(spark):
    near = [(1, 0, 0, 0, 5), (1, 0, 0, 1, 5), (1, 0, 0, 2, 8), (1, 0, 0, 9, 2)]
    lost = [(2, 0, 0, 0, 2), (2, 0, 0, 1, 8)]
    got = {(r.case_id, r.x): r.label for r in rl.known_wall(spark.createDataFrame(near + lost, VOX), ["case_id"], 5).collect()}
    assert got == {(1, 0): 2, (1, 1): 2, (1, 2): 3, (1, 9): 1, (2, 0): 1, (2, 1): 3}


def test_schemas_are_for_their_architectures():
    assert sc.schema_for("cinema") == "ventricular" and sc.schema_for("atrial_nnunet") == "atrial"
    for wrong in (("cinema", "atrial_la_cavity"), ("atrial_nnunet", "other")):
        with pytest.raises(ValueError):
            sc.schema_for(*wrong)


def test_errors_that_the_data_raise(spark):
    a, twice = spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    with pytest.raises(Exception, match="not unique"):
        sc.many_to_one(a, twice, "k").collect()
    with pytest.raises(Exception, match="no w for 1"):
        sc.all_found(a.withColumn("w", F.lit(None).cast("string")), "w", "k").collect()
    with pytest.raises(Exception, match="no positive reference"):
        ch.scaled_to_reference(spark.createDataFrame([(1, 0, 0, 0, 2, 5.0)], VOX + ", intensity double"), ["case_id"], 3).collect()
    with pytest.raises(Exception, match="no such model"):
        files.looked_up(spark.createDataFrame([("m",)], "model string"), spark.createDataFrame([("n", "a")], "model string, architecture string")).collect()
    v = spark.createDataFrame([("f", "f_seed1", 1, False)], "family string, model string, seed int, ensemble boolean")
    with pytest.raises(Exception, match="no seed2 in f"):
        ch.chosen_variants(v, [], "seed2").collect()


def test_texts(spark):
    d = spark.createDataFrame([("1h 2m",), ("90",), ("",), (None,), ("3 weeks",), ("250ms",)], "t string")
    assert [r[0] for r in d.select(tx.duration_seconds(F.col("t"))).collect()] == [3720.0, 90.0, None, None, None, 0.25]
    m = spark.createDataFrame([("3.5 GB",), ("2048kib",), ("7",), ("x GB",), (None,)], "t string")
    assert [r[0] for r in m.select(tx.memory_gb(F.col("t"))).collect()] == [3.5, 2048 / 1024**2, 7.0, None, None]
    e = spark.createDataFrame([("ab-1", "03Feb2021"), ("x", "n/a")], "s string, t string")
    assert [r[0] for r in e.select(tx.exam_id(F.col("s"), F.col("t"))).collect()] == ["ab1_20210203", "x_na"]
    n = spark.createDataFrame([(r"1\ 2.5\x\\",)], "t string")
    assert n.select(tx.number_list(F.col("t"))).first()[0] == [1.0, 2.5, None]


def test_first_source_and_separators(spark, tmp_path):
    (tmp_path / "b.csv").write_text("a;b\n1; x \n2;\n")
    assert files.first_source(spark, [f"file://{tmp_path}/none.csv"]) is None
    got = files.sniffed(spark, f"file://{tmp_path}/b.csv").collect()
    assert [(r.a, r.b) for r in got] == [("1", "x"), ("2", None)]


def test_outputs_all_get_a_tag(spark):
    r = random.Random(3)
    names = sorted({f"p_{r.choice(['ED', 'es', 'frame03', 'x', 'frame12', 'y'])}{r.choice(['', '_1', '_2'])}.nii.gz" for _ in range(14)})
    out = fr.outputs_to_frames(spark.createDataFrame([(1, n) for n in names], "k int, file string"), spark.createDataFrame([(1, "ED", 0), (1, "ES", 1), (1, "frame03", 2)], "k int, tag string, place int"), "k").collect()
    assert sorted(x.file for x in out) == names and len({x.tag for x in out}) == len(names)


def test_even_indices_round_halves_to_even(spark):
    for n, k in ((10, 4), (30, 5), (7, 3), (3, 5), (10, 1), (10, 0)):
        got = spark.range(1).select(fr.even_indices(F.lit(n), k).alias("i")).first().i
        assert got == (list(range(n)) if k == 0 or k >= n else [0] if k == 1 else sorted({round(i * (n - 1) / (k - 1)) for i in range(k)}))
