"""Two runs of the same models per architecture, and schema rows, by cases worked out by hand."""

import math

import pytest

from test_catalog import test_query_equals_sql as equals_sql
from voxframe.operators import scores as sc


@pytest.mark.parametrize("name", ["A34_by_architecture", "P09_label_schemas"])
def test_query_equals_sql(spark, name):
    equals_sql(spark, name)


def test_runs_that_differ_in_voxels_and_slices(spark):
    shape = "case_id int, model string, z int, labels array<int>"
    first = spark.createDataFrame([(c, m, z, [1, 1, 0, 2]) for c in (1, 2) for m in ("p", "q") for z in (0, 1)] + [(3, "p", 0, [1, 1, 1, 1])], shape)
    second = spark.createDataFrame([(1, "p", 0, [1, 1, 0, 2]), (1, "p", 1, [1, 1, 0, 2]), (2, "p", 0, [1, 0, 0, 2]), (2, "p", 1, [1, 1, 0, 2]), (1, "q", 0, [1, 1, 0, 2]), (2, "q", 0, [0, 0, 0, 0]), (2, "q", 1, [1, 1, 0, 2])], shape)
    ref = spark.createDataFrame([(c, z, [1, 1, 0, 2]) for c in (1, 2, 3) for z in (0, 1)], "case_id int, z int, labels array<int>")
    got = {r.model: tuple(r)[1:] for r in sc.determinism(first, second, ref, ["case_id"], ["model"], "model", [1, 2], 8).collect()}
    # p: one of 8 voxels differs, Dice of label 1 falls from 1 to 6/7; q: case 1 lacks a slice, case 2 an emptied one
    assert got["p"][:3] == (2, 1, 7 / 8) and math.isclose(got["p"][3], 1 / 7)
    assert got["q"][:3] == (2, 0, 1 / 2) and math.isclose(got["q"][3], 1 / 3)


def test_schemas_of_architectures(spark):
    rows = spark.createDataFrame([("atrial_nnunet",), ("cinema",), ("cinema",), (None,)], "architecture string")
    got = sorted(tuple(r) for r in sc.schemas_of(rows).collect())
    assert got == [("atrial_nnunet", "atrial", 1, "wall"), ("atrial_nnunet", "atrial", 2, "ra"), ("atrial_nnunet", "atrial", 3, "la"), ("cinema", "ventricular", 1, "rv"), ("cinema", "ventricular", 2, "myo"), ("cinema", "ventricular", 3, "lv")]
