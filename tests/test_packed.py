"""Packed slices: arrays that are looked up by kind, and counts of blocks of slices."""

from pyspark.sql import functions as F

from voxframe import tables
from voxframe.operators import overlap

SF = "/root/testdata/sf0.001"


def test_slices_are_worked_out_once_for_each_kind(spark):
    for name in ("vox_gt", "vox_pred"):
        rows, keys, labels = tables.SLICES[name]
        each = spark.sql(tables.for_spark(rows, SF)).selectExpr(*keys, labels)
        got = tables.slices(spark, SF, name)
        assert got.columns == each.columns and got.dtypes == each.dtypes
        assert got.exceptAll(each).count() == each.exceptAll(got).count() == 0
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_keys_of_one_kind_make_equal_slices_whatever_their_sign(spark, tmp_path):
    d = str(tmp_path)
    keys = [-1000001, -441, -221, -220, -219, -1, 0, 1, 219, 220, 221, 439, 440, 659, 10**15 + 7]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{d}/customer.parquet")
    rows, cols, labels = tables.SLICES["vox_pred"]
    each = spark.sql(tables.for_spark(rows, d)).selectExpr(*cols, labels)
    got = tables.slices(spark, d, "vox_pred")
    assert got.exceptAll(each).count() == each.exceptAll(got).count() == 0


def test_counts_of_blocks_equal_those_of_voxels(spark, monkeypatch):
    monkeypatch.setattr(overlap, "BLOCK", 8)
    p = spark.createDataFrame([(1, "m", 0, [1, 2, 0, 3]), (1, "m", 1, [1, None, 2]), (2, "m", 0, [3, 3]), (3, "n", 0, [1] * 11), (4, "n", 0, []), (1, "n", 1, None)], "k long, model string, z int, labels array<int>")
    g = spark.createDataFrame([(1, 0, [1, 0, 0, 3]), (1, 1, [1, 2, None, 2]), (3, 0, [1] * 5), (5, 0, [2, 2])], "k long, z int, labels array<int>")
    pairs = overlap._slice_pairs(p, g, ["k"], ["model"])
    want = {(r.k, r.model): (r.p, r.tp) for r in pairs.groupBy("k", "model").agg(F.count_if(F.col("a").isin(1, 2)).alias("p"), F.count_if(F.col("a").isin(1, 2) & F.col("b").isin(2, 0)).alias("tp")).collect()}
    got = overlap.confusion(p, g, ["k"], ["model"], [7], None, {7: [1, 2]}, {7: [2, 0]})
    assert {(r.k, r.model): (r.tp + r.fp, r.tp) for r in got.collect() if (r.k, r.model) in want} == want
    assert {(r.k, r.model, r.tp, r.fn) for r in got.collect() if r.k == 5} == {(5, "m", 0, 2), (5, "n", 0, 2)}


def test_likeliest_class_takes_one_aggregate_and_the_smallest_at_a_tie(spark):
    rows = [(1, 0, 0, x, c, p) for x, ps in enumerate([[(0, 1.0), (1, 3.0), (1, 5.0), (2, 4.0)], [(2, 7.0), (1, 7.0)], [(2, None), (1, None)], [(0, None), (2, 0.5)]]) for c, p in ps]
    folds = spark.createDataFrame(rows, "k int, z int, y int, x int, class int, p double")
    from voxframe.plans.voxels import likeliest

    got = likeliest(folds, ["k"], [2, 1, 0])
    assert {r.x: r.label for r in got.collect()} == {0: 1, 1: 1, 2: 1, 3: 2}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
