"""All registered queries of the segmentation side, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import tables
from .plans import catalogue, choices, cleaning, frames, metrics, packed, records, runs, scores, supplement, texts, texture, trees, voxels

MODULES = (voxels, texture, runs, cleaning, scores, frames, records, choices, trees, supplement, packed)
PLANS = metrics.PLANS | catalogue.PLANS | texts.PLANS


def _plan(text: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: tables.sql(spark, sf_dir, text)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _plan(text) for name, text in PLANS.items()} | {n: q for m in MODULES for n, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: tables.for_duckdb(text) for name, text in ({n: q for m in MODULES for n, q in m.ORACLES.items()} | PLANS).items()}
