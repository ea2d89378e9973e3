"""Overlap metrics of label volumes held as packed slices or as voxel tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import settled

VOXEL = ["z", "y", "x"]
# voxels of slices that are counted at once
BLOCK = 1 << 20
_NONE = -(1 << 40)

# metric name -> expression over tp, fp, fn, tn; undefined ratios are null
METRICS = {
    "dice": "2.0 * tp / nullif(2 * tp + fp + fn, 0)",
    "dice_or_one": "case when 2 * tp + fp + fn = 0 then 1.0 else 2.0 * tp / (2 * tp + fp + fn) end",
    "jaccard": "1.0 * tp / nullif(tp + fp + fn, 0)",
    "precision": "1.0 * tp / nullif(tp + fp, 0)",
    "recall": "1.0 * tp / nullif(tp + fn, 0)",
    "specificity": "1.0 * tn / nullif(tn + fp, 0)",
    "accuracy": "1.0 * (tp + tn) / nullif(tp + fp + fn + tn, 0)",
    "f2_score": "5.0 * tp / nullif(5 * tp + 4 * fn + fp, 0)",
    "false_positive_rate": "1 - 1.0 * tn / nullif(tn + fp, 0)",
    "false_omission_rate": "1.0 * fn / nullif(fn + tn, 0)",
    "false_negative_rate": "1 - 1.0 * tp / nullif(tp + fn, 0)",
    "false_discovery_rate": "1 - 1.0 * tp / nullif(tp + fp, 0)",
    "negative_predictive_value": "1 - 1.0 * fn / nullif(fn + tn, 0)",
}


def _members(labels: list[int], regions: dict[int, list[int]] | None) -> dict[int, list[int]]:
    return {k: (regions or {}).get(k, [] if regions else [k]) for k in labels}


def _slice_pairs(pred: DataFrame, ref: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per voxel of packed slices: `keys`, `by`, a (predicted), b (reference; 0 without a slice), `met` (it has one)."""
    both = pred.select(*keys, *by, "z", "labels").join(ref.select(*keys, "z", F.col("labels").alias("_ref")), [*keys, "z"], "left")
    other = F.coalesce("_ref", F.transform("labels", lambda v: F.lit(0)))
    code = F.zip_with("labels", other, lambda a, b: F.shiftleft(a.cast("long"), 32) + F.coalesce(b, F.lit(0)))
    rows = both.select(*keys, *by, F.col("_ref").isNotNull().alias("met"), F.explode(code).alias("_c"))
    return rows.select(*keys, *by, "met", F.shiftright("_c", 32).cast("int").alias("a"), F.col("_c").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"))


def _grid(column: pa.Array) -> np.ndarray:
    """Label arrays as rows of a matrix; what an array lacks or holds as null is _NONE."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    out = np.full((len(size), int(size.max(initial=0))), _NONE, dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().cast(pa.int64()).fill_null(_NONE).to_numpy(zero_copy_only=False)
    return out


def _sides(batches: Iterator[pa.RecordBatch], sides: list[str]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of at most BLOCK voxels a side, or of one slice, with the matrices of their label arrays."""
    for batch in batches:
        size = np.max([batch.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for c in sides], axis=0)
        at = 0
        while at < len(size):
            # a matrix is as wide as its longest row
            room = np.maximum.accumulate(size[at : at + BLOCK]) * np.arange(1, len(size[at : at + BLOCK]) + 1)
            n = max(1, int(np.searchsorted(room, BLOCK, side="right")))
            part = batch.slice(at, n)
            yield part, [_grid(part.column(c)) for c in sides]
            at += n


def _counts(carried: list[str], p_of: dict[int, list[int]], r_of: dict[int, list[int]]):
    """Per packed slice `labels` with its reference's `_ref`: p_, tp_ for each label, _p voxels, _b those on a reference slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (a, b) in _sides(batches, ["labels", "_ref"]):
            n = np.maximum(*(part.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("labels", "_ref")))
            n[part.column("labels").is_null().to_numpy(zero_copy_only=False)] = 0
            wide = max(a.shape[1], b.shape[1])
            # a predicted voxel without a reference's is background there
            a, b = (np.pad(m, ((0, 0), (0, wide - m.shape[1])), constant_values=_NONE) for m in (a, b))
            b = np.where((b == _NONE) & (a != _NONE), 0, b)
            mine = {k: np.isin(a, m) for k, m in p_of.items()}
            out = {f"p_{k}": v.sum(axis=1) for k, v in mine.items()} | {f"tp_{k}": (v & np.isin(b, r_of[k])).sum(axis=1) for k, v in mine.items()}
            out |= {"_p": n, "_b": np.where(part.column("_ref").is_null().to_numpy(zero_copy_only=False), 0, n)}
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *(pa.array(v, pa.int64()) for v in out.values())], [*carried, *out])

    return run


def _lone_counts(carried: list[str], r_of: dict[int, list[int]]):
    """Per packed slice `labels`: r_ for each label, _r voxels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (b,) in _sides(batches, ["labels"]):
            out = {f"r_{k}": np.isin(b, m).sum(axis=1) for k, m in r_of.items()} | {"_r": part.column("labels").value_lengths().fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)}
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *(pa.array(v, pa.int64()) for v in out.values())], [*carried, *out])

    return run


def _summed(rows: DataFrame, run, keys: list[str], names: list[str], total: str) -> DataFrame:
    """Counts of slices, made by `run`, added per `keys`; groups without a voxel have no row."""
    shape = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys), *(f"{n} long" for n in names)])
    return rows.mapInArrow(run, shape).groupBy(*keys).agg(*(F.sum(n).alias(n) for n in names)).filter(f"{total} > 0")


def label_pairs(pred: DataFrame, ref: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """How many voxels of packed slices have each predicted `label` and reference label `ref`, per group."""
    rows = _slice_pairs(pred, ref, keys, by)
    return rows.groupBy(*keys, *by, F.col("a").alias("label"), F.col("b").alias("ref")).agg(F.count("*").alias("n"))


def confusion(pred: DataFrame, ref: DataFrame, keys: list[str], by: list[str], labels: list[int], grid: int | None = None, pred_regions: dict[int, list[int]] | None = None, ref_regions: dict[int, list[int]] | None = None) -> DataFrame:
    """tp, fp, fn, tn per group `keys` + `by` and label.

    Both tables hold voxels (z, y, x, label) or both packed slices (z, labels). `keys` are in both, `by` in `pred` alone
    (the model). What one side lacks counts as background there, so voxel tables may hold foreground only; a
    group of either table meets all values of `by`. `grid` is the number of voxels of a group; without it tn counts the voxels
    that either table lists. Regions merge labels, on either side as given.

    Slices are joined whole, without an exchange where both are bucketed by `keys` and z, and counted as matrices, a block at
    a time. Of voxel tables one aggregate a side gives totals and groups, and only foreground is joined.
    """
    all_, p_of, r_of = [*keys, *by], _members(labels, pred_regions), _members(labels, ref_regions)

    def counted(column: str, name: str, of: dict[int, list[int]]) -> list[Column]:
        return [F.count_if(F.col(column).isin(m)).alias(f"{name}_{k}") for k, m in of.items()]

    hits = [F.count_if(F.col("a").isin(p_of[k]) & F.col("b").isin(r_of[k])).alias(f"tp_{k}") for k in labels]
    if "labels" in pred.columns:
        both = pred.select(*all_, "z", "labels").join(ref.select(*keys, "z", F.col("labels").alias("_ref")), [*keys, "z"], "left").select(*all_, "labels", "_ref")
        mine = settled(_summed(both, _counts(all_, p_of, r_of), all_, [*(f"p_{k}" for k in labels), *(f"tp_{k}" for k in labels), "_p", "_b"], "_p"), "counts")
        theirs = _summed(ref.select(*keys, "labels"), _lone_counts(keys, r_of), keys, [*(f"r_{k}" for k in labels), "_r"], "_r")
    else:
        mine = settled(pred.groupBy(*all_).agg(*counted("label", "p", p_of), F.count("*").alias("_p")), "counts")
        theirs = ref.groupBy(*keys).agg(*counted("label", "r", r_of), F.count("*").alias("_r"))
        a, b = pred.select(*all_, *VOXEL, F.col("label").alias("a")), ref.select(*keys, *VOXEL, F.col("label").alias("b"))
        if grid is not None:
            a, b = a.filter(F.col("a").isin(sorted({x for m in p_of.values() for x in m}))), b.filter(F.col("b").isin(sorted({x for m in r_of.values() for x in m})))
        mine = mine.join(a.join(b, [*keys, *VOXEL]).groupBy(*all_).agg(*hits, F.count("*").alias("_b")), all_, "left")
    out = mine.join(theirs, keys, "left")
    if by:
        # frames that only the reference has, once for each value of `by`: rows of the result
        lone = theirs.join(mine.select(*keys).distinct(), keys, "left_anti")
        out = out.unionByName(lone.crossJoin(mine.select(*by).distinct()), allowMissingColumns=True)
    else:
        out = out.unionByName(theirs.join(mine.select(*keys), keys, "left_anti"), allowMissingColumns=True)

    def n(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long")

    size = F.lit(grid) if grid is not None else n("_p") + n("_r") - n("_b")
    rows = [F.struct(F.lit(k).alias("label"), n(f"tp_{k}").alias("tp"), (n(f"p_{k}") - n(f"tp_{k}")).alias("fp"), (n(f"r_{k}") - n(f"tp_{k}")).alias("fn"), (size - n(f"p_{k}") - n(f"r_{k}") + n(f"tp_{k}")).cast("long").alias("tn")) for k in labels]
    return out.select(*all_, F.explode(F.array(*rows)).alias("c")).select(*all_, "c.*")


def metric(counts: DataFrame, name: str, more: dict[str, str] | None = None) -> Column:
    """A metric's column by name, among METRICS and those that a user gives in `more`."""
    known = METRICS | (more or {})
    if name not in known:
        raise KeyError(f"no metric {name!r}; known: {sorted(known)}")
    return F.round(F.expr(known[name]), 6).cast("double").alias(name)
