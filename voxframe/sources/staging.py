"""Tables and folders that steps of a job leave for later ones, on the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path beside the session's checkpoints; a folder of this machine only where none is set and the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-files-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str = "table") -> DataFrame:
    """The frame written and read again: its lineage ends at files."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(*frames: DataFrame) -> None:
    """Delete the files of settled frames that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {os.path.dirname(f) for f in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, keys: list[str], name: str = "buckets") -> DataFrame:
    """The frame as a table bucketed and sorted by `keys`: joins of such tables on these keys need no exchange.

    There are as many buckets as shuffle partitions. Deal the frame by `repartition(that number, *keys)` first, so that each
    task writes one bucket.
    """
    spark = df.sparkSession
    buckets, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", shared_folder(spark, name)).saveAsTable(table)
    return spark.table(table)
