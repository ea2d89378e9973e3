"""Scores of frames whose mask rows arrive as a stream."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..operators import volumes as vol

VOXEL = ["z", "y", "x"]
DONE = -1
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class FrameStore(StatefulProcessor):
    """Slices of each frame until all of its voxels have come.

    State of a frame: how many different voxels it has, and for each slice the places and labels that came, so a batch
    rewrites only slices that it brings rows of. The first label of a voxel counts. A complete frame is given out once and its
    slices are dropped; a mark stays until the watermark passes the frame's last row, so that repeated rows are passed over.
    A frame that is still incomplete then is given out as one row without a slice, with the number of voxels it had.
    """

    def __init__(self, names: list[str], voxels: int):
        self.names, self.voxels = names, voxels

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long, last long")
        self.slices = handle.getMapState("slices", "z int", "places binary, labels binary")

    def _row(self, key: tuple, z: list, places: list, labels: list, seen: int) -> pd.DataFrame:
        return pd.DataFrame({**{n: [k] * len(z) for n, k in zip(self.names, key, strict=True)}, "z": pd.array(z, "Int32"), "places": places, "labels": labels, "seen": seen})

    def _until(self, last: int, before: int | None) -> None:
        """One timer a frame, at its last row."""
        if before is not None and before != last:
            self.handle.deleteTimer(before)
        if before != last:
            self.handle.registerTimer(last)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        new.columns = [*self.names, *VOXEL, "label", "_came"]  # the watermark's column comes without its name
        n, before = self.count.get() or (0, None)
        if n == DONE:
            return
        came = new["_came"].to_numpy("datetime64[ms]").astype(np.int64).max()
        last, had = int(came if before is None else max(before, came)), n > 0
        held = {z: (np.frombuffer(a, np.int64), np.frombuffer(b, np.int32)) for (z,), (a, b) in self.slices.iterator()} if had else {}
        z, labels = new["z"].to_numpy(np.int32), new["label"].to_numpy(np.int32)
        places = (new["y"].to_numpy(np.int64) << 21) | new["x"].to_numpy(np.int64)
        touched = np.unique(z).tolist()
        for k in touched:
            here = np.flatnonzero(z == k)
            old, of = held.get(k, (places[:0], labels[:0]))
            merged, first = np.unique(np.r_[old, places[here]], return_index=True)
            held[k] = merged, np.r_[of, labels[here]][first]
            n += len(merged) - len(old)
        if n < self.voxels:
            for k in touched:
                self.slices.updateValue((k,), tuple(x.tobytes() for x in held[k]))
        else:
            if had:
                self.slices.clear()
            yield self._row(key, list(held), [p for p, _ in held.values()], [v for _, v in held.values()], n)
        self.count.update((DONE if n >= self.voxels else n, last))
        self._until(last, before)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0]
        self.count.clear()
        self.slices.clear()
        if n != DONE:
            yield self._row(key, [None], [None], [None], n)

    def close(self) -> None:
        pass


def score_stream(rows: DataFrame, ref: DataFrame, keys: list[str], by: list[str], label: int, voxels: int, out: str, checkpoint: str, came: str | None = None, delay: str = "1 hour") -> list:
    """Read what is available of the stream `rows`, write a row of counts and Dice for every complete frame; the progress reports.

    A frame is complete when all `voxels` of its grid have come; a voxel that comes again is passed over. Only complete frames
    meet the reference, of which each batch reads its own frames. `came` is the column with the time of a row (else the time
    of its batch). State is dropped `delay` after a frame's last row: complete frames leave nothing, incomplete ones a row
    (keys, seen) in `<out>-abandoned`. A batch overwrites its own folder, so a repeated batch after a failure adds nothing
    twice. The reference's voxels that the frame's grid lacks are not counted.
    """
    spark, all_ = rows.sparkSession, [*keys, *by]
    timed = rows.select(*all_, *VOXEL, "label", (F.col(came) if came else F.current_timestamp()).alias("_came")).withWatermark("_came", delay)
    shape = StructType([*(rows.schema[c] for c in all_), StructField("z", IntegerType()), StructField("places", ArrayType(LongType())), StructField("labels", ArrayType(IntegerType())), StructField("seen", LongType())])
    frames = timed.groupBy(*all_).transformWithStateInPandas(FrameStore(all_, voxels), shape, "Append", "EventTime")
    p, r = F.col("label") == label, F.col("_r") == label

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        whole = batch.filter("z is not null").select(*all_, "z", F.explode(F.arrays_zip("places", "labels")).alias("v"))
        whole = whole.select(*all_, "z", F.shiftright("v.places", 21).cast("int").alias("y"), F.col("v.places").bitwiseAND(F.lit((1 << 21) - 1)).cast("int").alias("x"), F.col("v.labels").alias("label"))
        mine = ref.join(batch.filter("z is not null").select(*keys).distinct(), keys, "left_semi").select(*keys, *VOXEL, F.col("label").alias("_r"))
        counts = whole.join(mine, [*keys, *VOXEL], "left").groupBy(*all_).agg(F.count("*").alias("n"), F.count_if(p & r).alias("tp"), F.count_if(p & ~F.coalesce(r, F.lit(False))).alias("fp"), F.count_if(~p & r).alias("fn"))
        size = 2 * F.col("tp") + F.col("fp") + F.col("fn")
        counts.withColumn("dice", F.when(size == 0, 1.0).otherwise(2 * F.col("tp") / size)).write.mode("overwrite").parquet(f"{out}/batch={number}")
        batch.filter("z is null").select(*all_, "seen").write.mode("overwrite").parquet(f"{out}-abandoned/batch={number}")
        batch.unpersist()

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        query = frames.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return query.recentProgress


def score_slices(rows: DataFrame, ref: DataFrame, keys: list[str], by: list[str], label: int, shape: vol.Shape, out: str, checkpoint: str, came: str | None = None, delay: str = "1 hour") -> list:
    """`score_stream` of rows that are whole slices: `z` and its `labels` as bytes; `ref` are packed volumes, a frame that it lacks counts as
    background.

    Frames between batches are a table beside the checkpoint, `<checkpoint>-frames`: a row holds the slices that came, of which the first
    of a z counts, or that the frame is done. A batch reads the table of the one before and writes its own, both native aggregates, so
    that no frame costs a call; a repeated batch writes the same again. A frame that is given up has in `seen` the voxels that came.
    """
    spark, all_, (slices, *flat) = rows.sparkSession, [*keys, *by], shape
    late = spark.sql(f"select unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {delay})").first()[0]
    timed = rows.select(*all_, "z", "labels", F.unix_micros(F.col(came) if came else F.current_timestamp()).alias("_came"))
    table = "last long, done boolean, labels array<binary>"
    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in timed.select(*all_).schema)

    def write(batch: DataFrame, number: int) -> None:
        at, newest = f"{checkpoint}-frames/batch={number}", batch.agg(F.max("_came")).first()[0]
        known = spark.createDataFrame([], f"{held}, {table}")
        if number:
            before = f"{checkpoint}-frames/batch={number - 1}"
            known, (time,) = spark.read.schema(f"{held}, {table}").parquet(f"{before}/frames"), spark.read.parquet(f"{before}/time").first()
            batch, newest = batch.filter(F.col("_came") >= time - late), max(t for t in (time, newest) if t is not None)
        z = F.when(F.col("z").between(0, slices - 1), F.col("z")).otherwise(F.raise_error(F.lit(f"a slice's z must lie in 0 to {slices - 1}")))
        new = batch.withColumn("z", z).groupBy(*all_).agg(F.max("_came").alias("last"), F.array(*(F.first(F.when(F.col("z") == k, F.col("labels")), ignorenulls=True) for k in range(slices))).alias("labels"))
        new = new.select(*all_, "last", F.lit(False).alias("done"), "labels", F.lit(1).alias("_age"))
        met = known.withColumn("_age", F.lit(0)).unionByName(new).groupBy(*all_).agg(F.max("done").alias("done"), F.max("last").alias("last"), *(F.max(F.when(F.col("_age") == age, F.col(c))).alias(f"_{c}{age}") for age, c in ((0, "last"), (0, "labels"), (1, "labels"))))
        each = [F.coalesce(F.col("_labels0")[k], F.col("_labels1")[k]) for k in range(slices)]
        some = [c.isNotNull().cast("int") for c in each]
        n = sum(some[1:], some[0])
        met = met.select(*all_, F.when(F.col("done"), F.col("_last0")).otherwise(F.col("last")).alias("last"), "done", (~F.col("done") & (n == slices)).alias("_whole"), n.alias("_n"), F.array(*each).alias("labels")).persist()
        whole = met.filter("_whole").select(*all_, F.concat(*(F.col("labels")[k] for k in range(slices))).alias("labels"))
        pairs = whole.join(ref.select(*keys, F.col("labels").alias("_ref")), keys, "left")
        counts = vol.confusion(pairs.select(*all_, "labels", F.coalesce("_ref", F.lit(bytes(math.prod(shape)))).alias("ref")), all_, shape, [label])
        size = 2 * F.col("tp") + F.col("fp") + F.col("fn")
        scored = counts.select(*all_, F.lit(math.prod(shape)).cast("long").alias("n"), "tp", "fp", "fn", F.when(size == 0, 1.0).otherwise(2 * F.col("tp") / size).alias("dice"))
        scored.write.mode("overwrite").parquet(f"{out}/batch={number}")
        over = F.col("last") < (newest - late if newest is not None else 0)
        done = F.col("done") | F.col("_whole")
        met.filter(over & ~done).select(*all_, (F.col("_n") * math.prod(flat)).cast("long").alias("seen")).write.mode("overwrite").parquet(f"{out}-abandoned/batch={number}")
        left = met.filter(~over).select(*all_, "last", done.alias("done"), F.when(~done, F.col("labels")).alias("labels"))
        left.write.mode("overwrite").parquet(f"{at}/frames")
        spark.createDataFrame([(newest,)], "time long").write.mode("overwrite").parquet(f"{at}/time")
        met.unpersist()
        # the table of the batch before stays for a repetition of this one
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}-frames/batch={number - 2}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    query = timed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress
