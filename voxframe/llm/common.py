"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table, a parquet file or a folder of them, through Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared working folder: `spark.checkpoint.dir`, set here only where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext.getCheckpointDir()
        if not held and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = held or f"file://{tempfile.mkdtemp(prefix='spark-ckpt-')}"
        if not held:
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: lineage ends at files every executor sees."""
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files of staged frames that no later step reads."""
    for frame in frames:
        for f in {os.path.dirname(x) for x in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def lookup(rows: DataFrame, held: DataFrame, keys: list[str], weight: str, spread: list[str], how: str = "inner", share: int = 1000) -> DataFrame:
    """`rows` joined with the other columns of `held`, a written table of one row per key; no key gathers in one task.

    `weight` of a row of `held` says how many rows hold its key. Keys of more than one `share`-th of the weight of all, so
    fewer than `share` keys, are broadcast; their rows, and those with a null key, are dealt by a hash of `spread`.
    Other rows are shuffled by key. how: inner or left.
    """
    total = held.agg(F.sum(weight)).first()[0] or 0
    names = [c for c in held.columns if c not in keys and c != weight]
    body = F.struct(*names) if names else F.struct(F.lit(True).alias("__any"))
    often = F.col(weight) * share > F.lit(total)
    hot = held.filter(often).select(*(F.col(k).alias(f"__hot_{k}") for k in keys), body.alias("__hot"))
    cold = held.filter(~often).select(F.lit(0).cast("long").alias("__spread"), *keys, body.alias("__cold"))
    same = [F.col(k) == F.col(f"__hot_{k}") for k in keys]
    null = F.col(keys[0]).isNull()
    for k in keys[1:]:
        null |= F.col(k).isNull()
    rows = rows.join(F.broadcast(hot), same, "left").drop(*(f"__hot_{k}" for k in keys))
    rows = rows.withColumn("__spread", F.when(F.col("__hot").isNotNull() | null, F.xxhash64(*spread)).otherwise(F.lit(0).cast("long")))
    found = rows.join(cold, ["__spread", *keys], "left").withColumn("__hot", F.coalesce("__hot", "__cold"))
    if how == "inner":
        found = found.filter(F.col("__hot").isNotNull())
    return found.select(*(c for c in found.columns if c[:2] != "__"), *(F.col(f"__hot.{c}").alias(c) for c in names))


def partitions_for(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, null text as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text of each holds about `max_bytes`; one longer row goes alone."""
    for batch in batches:
        at, held, sizes = 0, 0, pc.binary_length(batch.column(column)).to_pylist()
        for i, n in enumerate(sizes):
            n = n or 0
            if i > at and held + n > max_bytes:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < len(sizes):
            yield batch.slice(at)


def gathered_batches(batches: Iterator[pa.RecordBatch], column: str, least_bytes: int) -> Iterator[pa.RecordBatch]:
    """Record batches put together until the text of each holds `least_bytes`; the last may hold less."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if size >= least_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, from batches in which these rows are adjacent."""
    import numpy as np

    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        cols = [t.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(t.num_rows - 1, dtype=bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        at = 0
        for end in np.flatnonzero(change) + 1:
            yield t.slice(at, int(end) - at)
            at = int(end)
        rest = t.slice(at)
    if rest is not None and rest.num_rows:
        yield rest
