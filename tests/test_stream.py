"""The stream of mask rows: repeated and late rows, frames given out once, and state that goes away."""

import datetime as dt

from voxframe import catalog
from voxframe.streaming.scores import score_slices, score_stream

ROWS = "case_id int, model string, z int, y int, x int, label int, came timestamp"
VOX = "case_id int, z int, y int, x int, label int"


def frame(case, minute, label=3, of=range(8), model="a"):
    return [(case, model, v // 4, v % 4 // 2, v % 2, label, dt.datetime(2026, 1, 1, 0, minute)) for v in of]


def test_repeated_and_late_rows_change_nothing_and_state_goes_away(spark, tmp_path):
    ref = spark.createDataFrame([(c, v // 4, v % 4 // 2, v % 2, 3 if v < 6 else 0) for c in (1, 2, 3, 4) for v in range(8)], VOX)
    steps = [
        frame(1, 0, of=range(5)) + frame(1, 0, of=range(3)) + frame(2, 0),  # 1 has repeats, 2 is complete
        frame(1, 1, of=range(4, 8)) + frame(2, 1, label=0, of=range(8)) + frame(3, 1, of=range(7)),  # 2 comes again
        frame(2, 2, of=[0]) + frame(4, 30),  # a late row of 2; time goes on, so 1 to 3 are over
        frame(3, 3, of=[7]),  # comes after its frame was given up
        frame(1, 59, of=range(4), model="b"),
    ]
    states = []
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/rows")
        source = spark.readStream.schema(ROWS).parquet(f"{tmp_path}/rows")
        reports = score_stream(source, ref, ["case_id"], ["model"], 3, 8, f"{tmp_path}/out", f"{tmp_path}/checkpoint", "came", "10 minutes")
        states.append(reports[-1].stateOperators[0].numRowsTotal)
    got = sorted((r.case_id, r.model, r.n, r.tp, r.fp, r.fn, round(r.dice, 6)) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(c, "a", 8, 6, 2, 0, round(12 / 14, 6)) for c in (1, 2, 4)]
    assert [(r.case_id, r.seen) for r in spark.read.parquet(f"{tmp_path}/out-abandoned").collect()] == [(3, 7)]
    assert states[1] > states[3]
    spark.createDataFrame(frame(1, 59, of=range(4, 8), model="b") + [(9, "z", 0, 0, 0, 0, dt.datetime(2026, 1, 2))], ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/rows")
    reports = score_stream(spark.readStream.schema(ROWS).parquet(f"{tmp_path}/rows"), ref, ["case_id"], ["model"], 3, 8, f"{tmp_path}/out", f"{tmp_path}/checkpoint", "came", "10 minutes")
    # one frame of one slice is left: its count, its slice and its timer, which is kept by key and by time
    assert reports[-1].stateOperators[0].numRowsTotal <= 4 < states[1]
    assert spark.read.parquet(f"{tmp_path}/out").filter("model = 'b'").count() == 1


def slices(case, minute, of=(0, 1), label=3, model="a"):
    return [(case, model, z, bytearray([label] * 4), dt.datetime(2026, 1, 1, 0, minute)) for z in of]


def test_repeated_and_late_slices_change_nothing(spark, tmp_path):
    shape = "case_id int, model string, z int, labels binary, came timestamp"
    ref = spark.createDataFrame([(c, bytearray([3] * 6 + [0] * 2)) for c in (1, 2, 3)], "case_id int, labels binary")
    steps = [
        slices(1, 0, [0]) + slices(2, 0),  # 2 is complete
        slices(1, 1, [0], 0) + slices(1, 1, [1]) + slices(2, 1, label=0) + slices(3, 1, [0]),  # 2 comes again
        slices(2, 2, [0]) + slices(4, 30),  # a late slice of 2; 4 has no reference; time goes on
        slices(3, 3, [1]),  # comes after its frame was given up
        slices(5, 59, [0], model="b"),
    ]
    states = []
    for rows in steps:
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/rows")
        source = spark.readStream.schema(shape).parquet(f"{tmp_path}/rows")
        reports = score_slices(source, ref, ["case_id"], ["model"], 3, (2, 2, 2), f"{tmp_path}/out", f"{tmp_path}/checkpoint", "came", "10 minutes")
        states.append(spark.read.parquet(f"{tmp_path}/checkpoint-frames/batch={reports[-1].batchId}/frames").count())
    got = sorted((r.case_id, r.model, r.n, r.tp, r.fp, r.fn, round(r.dice, 6)) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, "a", 8, 6, 2, 0, round(12 / 14, 6)), (2, "a", 8, 6, 2, 0, round(12 / 14, 6)), (4, "a", 8, 0, 8, 0, 0.0)]
    assert [(r.case_id, r.seen) for r in spark.read.parquet(f"{tmp_path}/out-abandoned").collect()] == [(3, 4)]
    assert states == [2, 3, 1, 1, 1] and sorted(p.name for p in (tmp_path / "checkpoint-frames").iterdir()) == ["batch=3", "batch=4"]


def test_the_query_streams_slices(spark, monkeypatch):
    from voxframe.plans import runs

    seen = []
    kept = runs.score_slices
    monkeypatch.setattr(runs, "score_slices", lambda rows, *a: (seen.append(rows.columns), kept(rows, *a)))
    assert catalog.queries()["X01_score_stream"](spark, "/root/testdata/sf0.001").count() == 3
    assert seen == [["case_id", "model", "frame_tag", "z", "labels"]]
