"""File round trips, the score stream and inference tables against SQL and small cases worked out by hand."""

import glob
import math
import os

import duckdb
import pytest

from voxframe import catalog
from voxframe.operators import inference as inf
from voxframe.plans import runs
from voxframe.sources import files

from test_catalog import SF, plain


@pytest.mark.parametrize("name", [n for n in runs.ORACLES if n != "S32_packed_volumes"])
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    got, want = catalog.queries()[name](spark, SF), c.execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert plain(tuple(r) for r in got.select(*cols).collect()) == plain(want.fetchall())


def test_sheet_without_rows_and_alternative_names(spark):
    none = spark.createDataFrame([], "patient_id string, ES string")
    assert [(r.column, r.problem) for r in files.sheet_problems(none, ["patient_id"], {}).collect()] == [("", "no rows")]
    one = spark.createDataFrame([("7",), ("x",), (None,)], "`ES frame` string")
    assert [r[0] for r in one.select(files.first_present(one, ["es", "es frame"], "int")).collect()] == [7, None, None]
    assert one.select(files.first_present(one, ["ed"], "int").alias("v")).filter("v is not null").isEmpty()


def test_broken_manifest_and_info_have_no_values(spark):
    m = spark.createDataFrame([(1, '{"frames": [{"tag": "ED", "idx": 3}]}'), (2, "{"), (3, None)], "case_id int, manifest string")
    assert [tuple(r) for r in files.manifest_frames(m, ["case_id"]).collect()] == [(1, "ED", 3)]
    t = spark.createDataFrame([("ED: 1\nES:  12 ",), ("ED: 0",), ("ED: two",), (None,)], "t string")
    from pyspark.sql import functions as F

    assert [tuple(r) for r in t.select(files.info_frame(F.col("t"), "ED"), files.info_frame(F.col("t"), "ES")).collect()] == [(0, 11), (None, None), (None, None), (None, None)]


def test_packed_slices_come_back(spark):
    v = spark.createDataFrame([(1, z, y, x, 100 * z + 10 * y + x) for z in range(2) for y in range(3) for x in range(4)], "case_id int, z int, y int, x int, label int")
    back = files.unpacked(files.packed(v, ["case_id"], (2, 3, 4)), ["case_id"], (2, 3, 4))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, v.collect()))


def test_signed_rank_and_holm(spark):
    rows = [("g", float(i), 0.0) for i in (1, 2, 3, 4, -5)] + [("same", 1.0, 1.0)]
    got = {r.k: r for r in inf.signed_rank(spark.createDataFrame(rows, "k string, a double, b double"), ["k"], "a", "b").collect()}
    # ten subsets of the ranks 1 to 5 have a sum of at most 15 - 10: few untied differences are tested exactly
    assert got["g"].w_plus == 10 and math.isclose(got["g"].p, 2 * 10 / 32)
    assert got["same"].n == 0 and got["same"].p == 1.0
    p = spark.createDataFrame([(1, 0.01), (1, 0.04), (1, 0.03)], "k int, p double")
    assert sorted((r.p, round(r.p_holm, 6)) for r in inf.holm(p, ["k"]).collect()) == [(0.01, 0.03), (0.03, 0.06), (0.04, 0.06)]


def test_bootstrap_ignores_what_is_not_finite(spark):
    v = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 2.0), ("a", 3, float("inf")), ("a", 4, None), ("b", 5, float("nan"))], "k string, i int, v double")
    assert [tuple(r) for r in inf.bootstrap_mean(v, ["k"], "v", ["i"], 50).collect()] == [("a", 2, 2.0, 2.0, 2.0)]


def test_only_complete_frames_of_the_stream_are_scored(spark, tmp_path):
    from voxframe.streaming.scores import score_stream

    ref = spark.createDataFrame([(c, z, 0, x, 3) for c in (1, 2) for z in range(2) for x in range(2)], "case_id int, z int, y int, x int, label int")
    rows = ref.filter("not (case_id = 2 and z = 0)")
    rows.repartition(2, "z").write.parquet(f"{tmp_path}/rows")
    source = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/rows")
    score_stream(source, ref, ["case_id"], [], 3, 4, f"{tmp_path}/scores", f"{tmp_path}/checkpoint")
    assert [(r.case_id, r.dice) for r in spark.read.parquet(f"{tmp_path}/scores").collect()] == [(1, 1.0)]


@pytest.mark.parametrize("name", ["V14_probability_vote", "V34_stability", "V35_soft_argmax"])
def test_probabilities_of_all_voxels_count(spark, name):
    from voxframe.tables import view

    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    got, want = catalog.queries()[name](spark, SF), c.execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    rows = got.select(*cols).collect()
    assert plain(tuple(r) for r in rows) == plain(want.fetchall())
    cases = view(spark, SF, "vox_gt").select("case_id").distinct().count()
    keys = {"V14_probability_vote": lambda r: r.n, "V34_stability": lambda r: 1, "V35_soft_argmax": lambda r: 1}[name]
    assert sum(map(keys, rows)) == cases * {"V14_probability_vote": 2 * 5 * 144, "V34_stability": 2 * 3 * 4, "V35_soft_argmax": 2 * 5 * 3 * 4}[name]


def test_stream_scores_every_case(spark):
    from voxframe.tables import view

    frames = view(spark, SF, "vox_gt").select("case_id", "frame_tag").distinct().count()
    assert {r.frames for r in catalog.queries()["X01_score_stream"](spark, SF).collect()} == {frames}


def test_info_texts_of_many_patients_share_a_file(spark, tmp_path, monkeypatch):
    from voxframe.plans import records

    monkeypatch.setattr(records.files, "shared_folder", lambda *_: f"{tmp_path}/info")
    df = records.info_files(spark, "/root/testdata/sf0.001")
    assert df.count() == df.select("patient_id").distinct().count() > 100
    assert len(list((tmp_path / "info").rglob("part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
