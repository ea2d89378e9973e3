"""Content-addressed store of token ids.

Rolling hashes cut every document's id stream into chunks where the content says so; each distinct chunk is stored once,
under its SHA-256. A document is a recipe, the list of its chunks. The manifest is a Merkle tree over the recipes.

Layout under one folder, all Parquet, so that any file system that Spark reads will do:
  chunks    digest binary, ids binary (little-endian unsigned 16-bit)
  recipes   part, node, doc_id, row_key, offset (ids before it in its part), n_tokens, ids_crc32, digests array, sizes
            array; parts are ranges of doc_id, ascending, and nodes ascend in them
  parts     part, base (ids in all parts before)
  manifest  level, part, node, hash; the highest level has one node
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions_for, slices, with_text
from .encoding import encoder
from .wordhash import mix

SLICE = 1 << 20
WINDOW = 16
LEAST, MASK, MOST = 64, 0xFF, 2048
FAN = 1024
SEEN = 200_000


def cut_points(ids: np.ndarray) -> list[int]:
    """Chunk ends: a hash of the last WINDOW ids ends a chunk of LEAST ids or more; MOST ids always do."""
    n = len(ids)
    if n <= LEAST:
        return [n]
    x = mix(ids.astype(np.uint64) + np.uint64(1))
    total = np.cumsum(x)
    rolled = mix(np.r_[total[WINDOW - 1 : WINDOW], total[WINDOW:] - total[:-WINDOW]])
    marks = np.flatnonzero((rolled & np.uint64(MASK)) == 0) + WINDOW
    out, at = [], 0
    for m in [*marks.tolist(), n]:
        while m - at > MOST:
            at += MOST
            out.append(at)
        if m - at >= LEAST or m == n:
            if m > at:
                out.append(m)
            at = m
    return out


ROWS = "row_key long, doc_id long, n_tokens long, ids_crc32 long, digests array<binary>, sizes array<int>, digest binary, ids binary"
NAMES = [x.split()[0] for x in ROWS.split(", ")]


def _encode(path: str, end_id: int):
    """A recipe row for every document, and a chunk row for each chunk that the task hasn't met lately."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(path, False), set()
        for batch in slices(batches, "text", SLICE):
            n, crc, digests, sizes, fresh = [], [], [], [], {}
            for ids in enc.encode(batch.column("text")):
                ids = np.append(ids, np.uint16(end_id))
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                mine, lengths, at, raw = [], [], 0, ids.astype("<u2").tobytes()
                for end in cut_points(ids):
                    body = raw[2 * at : 2 * end]
                    d = hashlib.sha256(body).digest()
                    mine.append(d)
                    lengths.append(end - at)
                    if d not in seen:
                        fresh[d] = body
                        seen.add(d)
                    at = end
                digests.append(mine)
                sizes.append(lengths)
            if len(seen) > SEEN:
                seen.clear()
            rows, new = batch.num_rows, len(fresh)
            none = [None] * new
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*batch.column("row_key").to_pylist(), *none], pa.int64()),
                    pa.array([*batch.column("doc_id").to_pylist(), *none], pa.int64()),
                    pa.array([*n, *none], pa.int64()),
                    pa.array([*crc, *none], pa.int64()),
                    pa.array([*digests, *none], pa.list_(pa.binary())),
                    pa.array([*sizes, *none], pa.list_(pa.int32())),
                    pa.array([*[None] * rows, *fresh], pa.binary()),
                    pa.array([*[None] * rows, *fresh.values()], pa.binary()),
                ],
                NAMES,
            )

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, null as empty, end each with `end_id`, and write the store.

    Texts are encoded once. Rows that repeat a doc_id are documents of their own, next to each other; null doc_ids come
    first. An empty table gives an empty store. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = with_text(docs, id_col, text_col).withColumn("row_key", F.monotonically_increasing_id())
    rows = text.mapInArrow(_encode(tokenizer, end_id), ROWS)
    # one row for each chunk and each document: copies of a chunk meet after each task has merged its own
    rows = rows.withColumn("kind", F.when(F.col("digest").isNull(), "recipes").otherwise("chunks"))
    once = rows.groupBy("kind", "row_key", "digest").agg(*(F.first(c).alias(c) for c in ("doc_id", "n_tokens", "ids_crc32", "digests", "sizes", "ids")))
    raw = f"{path}/raw"
    once.write.partitionBy("kind").option("compression", "zstd").parquet(raw)

    loose = spark.read.schema(f"{ROWS}, kind string").parquet(raw).filter("kind = 'recipes'").select(*(c for c in NAMES if c not in ("digest", "ids")))
    # ranges of doc_id, as many as the session has shuffle partitions; rows that repeat an id may be split between two
    order = [F.col("doc_id").asc_nulls_first(), F.col("row_key")]
    dealt = loose.repartitionByRange(partitions_for(spark), *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = ", ".join(x for x in ROWS.split(", ") if x.split()[0] not in ("digest", "ids"))
    dealt.mapInArrow(_placed, f"{kind}, part int, node long, offset long").write.option("compression", "zstd").parquet(f"{path}/recipes")
    sums = recipes_in_parts(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    sums.select("part", F.coalesce(F.sum("n").over(base), F.lit(0)).alias("base")).write.parquet(f"{path}/parts")
    _merkle(recipes_in_parts(spark, path)).write.parquet(f"{path}/manifest")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of each recipe in its part, and the ids of the recipes before it."""
    node = at = 0
    for batch in batches:
        n = batch.column("n_tokens").to_numpy(zero_copy_only=False)
        ends = at + np.cumsum(n)
        yield batch.append_column("node", pa.array(node + np.arange(len(n)), pa.int64())).append_column("offset", pa.array(ends - n, pa.int64()))
        node, at = node + len(n), int(ends[-1]) if len(n) else at


def _leaf():
    return F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("n_tokens").cast("string"), F.lit(":"), F.col("ids_crc32").cast("string"), F.lit(":"), F.concat_ws(",", F.transform("digests", lambda d: F.hex(d)))), 256)


def _merkle(held: DataFrame) -> DataFrame:
    """Nodes above the leaves, which are hashes of whole recipes: up to FAN children each, per part, then one root over the parts' roots."""
    level, at, out = held.select("part", "node", _leaf().alias("hash")), 1, None

    def up(nodes: DataFrame, n: int) -> DataFrame:
        above = nodes.groupBy("part", F.floor(F.col("node") / FAN).alias("node")).agg(F.sha2(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))), lambda x: x["hash"])), 256).alias("hash"))
        return above.select(F.lit(n).alias("level"), "part", "node", "hash")

    widest, parts = (x or 0 for x in held.agg(F.max("node"), F.max("part")).first())
    while True:
        level = up(level.select("part", "node", "hash"), at)
        out = level if out is None else out.union(level)
        widest, at = widest // FAN, at + 1
        if not widest:
            break
    root = level.select(F.lit(0).alias("part"), F.col("part").cast("long").alias("node"), "hash")
    while True:
        root = up(root.select("part", "node", "hash"), at)
        out, at = out.union(root.select("level", F.lit(-1).alias("part"), "node", "hash")), at + 1
        parts //= FAN
        if not parts:
            return out


def chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("digest binary, ids binary, kind string").parquet(f"{path}/raw").filter("kind = 'chunks'").select("digest", "ids")


def recipes_in_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/recipes")


def recipes(spark: SparkSession, path: str) -> DataFrame:
    """The recipes with `start`, the ids of all documents before each; there is one row of `parts` for each range."""
    base = spark.read.parquet(f"{path}/parts")
    held = recipes_in_parts(spark, path).join(F.broadcast(base), "part")
    return held.withColumn("start", F.col("base") + F.col("offset")).drop("base", "offset")


def _shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC-32 of each text followed by n zero bytes, without the final and initial inversions: 32 x 32 bit matrices, squared."""
    m = np.array([0xEDB88320, *(1 << i for i in range(31))], dtype=np.uint32)  # one zero bit, columns by bit of the state
    out, n = crc.astype(np.uint32), n.astype(np.uint64) * np.uint64(8)

    def apply(m: np.ndarray, x: np.ndarray) -> np.ndarray:
        y = np.zeros_like(x)
        for byte in range(4):
            t = np.zeros(256, dtype=np.uint32)
            for b in range(8):
                t[1 << b : 2 << b] = t[: 1 << b] ^ m[8 * byte + b]
            y ^= t[(x >> np.uint32(8 * byte)) & np.uint32(255)]
        return y

    while n.any():
        odd = (n & np.uint64(1)).astype(bool)
        out[odd] = apply(m, out[odd])
        m, n = apply(m, m), n >> np.uint64(1)
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What reading a chunk shows: whether it is what its name says, its ids and their CRC."""
    for batch in batches:
        good, n, crc = [], [], []
        for d, ids in zip(batch.column("digest"), batch.column("ids"), strict=True):
            raw = ids.as_buffer()
            good.append(hashlib.sha256(raw).digest() == d.as_py())
            x = np.frombuffer(raw, dtype="<u2").astype("<u4").tobytes()
            n.append(len(x) // 4)
            crc.append(zlib.crc32(x))
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(good, pa.bool_()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["digest", "good", "n", "crc"])


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of a recipe, with the number of ids that follow it in the document."""
    for batch in batches:
        digests, sizes = batch.column("digests"), batch.column("sizes")
        n = digests.value_lengths().to_numpy(zero_copy_only=False)
        size = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends, last = np.cumsum(size), np.cumsum(n) - 1
        after = np.repeat(ends[last], n) - ends
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("row_key").to_numpy(), n)), digests.flatten(), pa.array(after, pa.int64())], ["row_key", "digest", "after"])


def _suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = _shift(batch.column("crc").to_numpy(zero_copy_only=False).astype(np.uint32), 4 * batch.column("after").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("n"), batch.column("good"), pa.array(crc.astype(np.int64), pa.int64())], ["row_key", "n", "good", "crc"])


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32, verified.

    Chunks are read, hashed and summed where they lie; only their sums travel to the documents, and the CRC of a document is
    put together from those of its chunks. verified: the recipes give the manifest's Merkle tree, and the document's chunks
    are all there, match their digests, and give the recipe's number of ids and CRC.
    """
    whole_tree = verify_manifest(spark, path)
    sums = chunks(spark, path).mapInArrow(_sums, "digest binary, good boolean, n long, crc long")
    uses = recipes_in_parts(spark, path).select("row_key", "digests", "sizes").mapInArrow(_uses, "row_key long, digest binary, after long")
    # chunks that more than a thousandth of all uses name, so fewer than a thousand, are broadcast, and their rows dealt evenly
    total = recipes_in_parts(spark, path).agg(F.sum(F.size("sizes"))).first()[0] or 0
    often = recipes_in_parts(spark, path).select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count("*").alias("uses")).filter(F.col("uses") * 1000 > total).select("digest")
    hot = F.broadcast(often.join(sums, "digest").select("digest", F.struct("n", "good", "crc").alias("hot")))
    spread = F.when(F.col("hot").isNotNull(), F.xxhash64("row_key", "after")).otherwise(F.lit(0).cast("long"))
    cold = sums.select(F.lit(0).cast("long").alias("spread"), "digest", F.struct("n", "good", "crc").alias("cold"))
    joined = uses.join(hot, "digest", "left").withColumn("spread", spread).join(cold, ["spread", "digest"], "left")
    joined = joined.withColumn("x", F.coalesce("hot", "cold")).filter("x is not null").select("row_key", "x.n", "x.good", "x.crc", "after")
    whole = joined.mapInArrow(_suffix, "row_key long, n long, good boolean, crc long").groupBy("row_key").agg(F.sum("n").alias("n"), F.bit_xor("crc").alias("crc"), F.min("good").alias("good"))
    out = recipes(spark, path).select("row_key", "doc_id", "start", "n_tokens", "ids_crc32").join(whole, "row_key", "left")
    fine = F.lit(whole_tree) & F.col("good") & (F.col("crc") == F.col("ids_crc32")) & (F.col("n") == F.col("n_tokens"))
    return out.select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"), F.coalesce(fine, F.lit(False)).alias("verified"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start and the ids as an array, put together from the chunks."""
    r = recipes(spark, path)
    parts = r.select("row_key", F.posexplode("digests").alias("i", "digest")).join(chunks(spark, path), "digest")
    bodies = parts.groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("i", "ids"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(x["ids"] for x in row), dtype="<u2").astype(np.int32) for row in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    return r.select("row_key", "doc_id", "start").join(bodies, "row_key").select("doc_id", "start", "parts").mapInArrow(run, "doc_id long, start long, ids array<int>")


def verify_manifest(spark: SparkSession, path: str) -> bool:
    """Whether the recipes still give the Merkle tree that was written."""
    keys = ["level", "part", "node", "hash"]
    held, now = (m.groupBy(*keys).agg(F.sum("side").alias("n")) for m in (spark.read.parquet(f"{path}/manifest").withColumn("side", F.lit(1)), _merkle(recipes_in_parts(spark, path)).withColumn("side", F.lit(-1))))
    return held.union(now).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0").isEmpty()
