"""Exact top-k inner products by a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it. Vectors of one pivot and one ring of distances make an
annulus, dealt to units of bounded size. A first round searches, for each query, one unit of its own pivot, which gives a score
that its k best must reach. From each pivot the query then expands over the annuli in order of their distance to it, and
stops where the triangle inequality rules that score out: only what is left is sent to units and searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_for, sorted_groups, staged

SAMPLE = 2048
PIVOTS = 24
RINGS = 3
UNIT = 32768
QUERIES = 512
CHUNK = 64
LENGTHS = 16


def choose_pivots(x: np.ndarray, n: int = PIVOTS, rounds: int = 6) -> np.ndarray:
    """Centres of a few rounds of k-means, begun at evenly spaced rows of the sample."""
    p = x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)].astype(float)
    for _ in range(rounds):
        near = ((p * p).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1)
        for j in range(len(p)):
            if (near == j).any():
                p[j] = x[near == j].mean(axis=0)
    return p


class Index:
    """Pivots, the inner radii of their rings, and how components are stored."""

    def __init__(self, pivots: np.ndarray, radii: np.ndarray, kind: str):
        self.pivots, self.radii, self.kind = pivots, radii, kind

    def vectors(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, dtype=self.kind).reshape(-1, self.pivots.shape[1])

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest pivot, ring, distance to the pivot) of every row."""
        x = x.astype(float)
        near = ((self.pivots**2).sum(axis=1) - 2 * (x @ self.pivots.T)).argmin(axis=1)
        dist = np.sqrt(((x - self.pivots[near]) ** 2).sum(axis=1))
        return near.astype(np.int32), (np.searchsorted(self.radii, dist, side="right") - 1).clip(0).astype(np.int32), dist


class Annuli:
    """What is known of the at most PIVOTS * RINGS annuli, and the numbers of their units."""

    def __init__(self, rows: list):
        self.pivot, self.ring = (np.array([r[c] for r in rows], dtype=int) for c in ("pivot", "ring"))
        self.low, self.high, self.norm = (np.array([r[c] for r in rows], dtype=float) for c in ("low", "high", "norm"))
        self.n = np.array([r["n"] for r in rows], dtype=int)
        self.units = -(-self.n // UNIT)
        self.base = np.cumsum(self.units) - self.units

    def bounds(self, q: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        """No vector of an annulus gives a query a higher score; one row per query."""
        q = q.astype(float)
        norm = np.sqrt((q * q).sum(axis=1))[:, None]
        d = np.sqrt(np.maximum(0, norm**2 + (pivots**2).sum(axis=1) - 2 * (q @ pivots.T)))[:, self.pivot]
        gap = np.maximum(0, np.maximum(d - self.high, self.low - d) - 1e-6 * (1 + d))
        by_triangle = (norm**2 + self.norm**2 - gap**2) / 2
        by_pivot = (q @ pivots.T)[:, self.pivot] + norm * self.high
        return np.minimum(np.minimum(by_triangle, by_pivot), norm * self.norm) + 1e-6 * (1 + norm * self.norm)


def _index(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, index.pivots.shape[1])
            pivot, ring, dist = index.keys(x)
            norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("asked"), pa.array([r.tobytes() for r in x.astype(index.kind)], pa.binary()), *map(pa.array, (pivot, ring, dist, norm))], ["vec_id", "asked", "v", "pivot", "ring", "dist", "norm"])

    return run


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """QUERIES or fewer queries of one pivot as one row: ids, vectors and the score that each must reach."""
    for t in sorted_groups(batches, ["pivot", "block"]):
        for at in range(0, t.num_rows, QUERIES):
            part = t.slice(at, QUERIES)
            ids, least = part.column("vec_id").to_numpy(), part.column("least").to_numpy()
            yield pa.RecordBatch.from_arrays([part.column("pivot").combine_chunks()[:1], pa.array([ids.astype("<i8").tobytes()]), pa.array([b"".join(part.column("v").to_pylist())]), pa.array([least.astype("<f8").tobytes()])], ["pivot", "ids", "v", "least"])


def _spread(index: Index, annuli: Annuli):
    """A row for every annulus that a block's queries can't leave out, with these queries alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, least = (np.frombuffer(batch.column(c)[i].as_py(), dtype=t) for c, t in (("ids", "<i8"), ("least", "<f8")))
                q = index.vectors(batch.column("v")[i].as_py())
                open_ = annuli.bounds(q, index.pivots) >= least[:, None]
                some = np.flatnonzero(open_.any(axis=0))
                if not len(some):
                    continue
                picks = [open_[:, j] for j in some]
                yield pa.RecordBatch.from_arrays([pa.array(annuli.base[some], pa.int64()), pa.array(annuli.units[some], pa.int64()), *(pa.array([x[p].tobytes() for p in picks], pa.binary()) for x in (ids, q, least))], ["base", "units", "ids", "v", "least"])

    return run


def best(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of each query's k best of the rows of x that reach its `least`, ties to smaller ids."""
    out = []
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most >= 2.0**63:
        raise OverflowError("scores don't fit 64 bits")
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**52 else np.int64
    x = x.astype(kind)
    for at in range(0, len(q_ids), CHUNK):
        mine, floor = q_ids[at : at + CHUNK], least[at : at + CHUNK]
        score = q[at : at + CHUNK].astype(kind) @ x.T
        if len(ids) > k + 1:
            # one more than k, as the query itself may be among them
            floor = np.maximum(floor, np.partition(score, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1])
        row, col = np.nonzero((score >= floor[:, None]) & (ids[None, :] != mine[:, None]))
        s = score[row, col].astype(np.int64)
        order = np.lexsort((ids[col], -s, row))
        row, col, s = row[order], col[order], s[order]
        starts = np.searchsorted(row, np.arange(len(mine)))
        top = np.arange(len(row)) - starts[row] < k
        out.append((mine[row[top]], ids[col[top]], s[top]))
    return tuple(np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(3))


def _search(index: Index, k: int):
    """Rows of a unit: first its vectors, which are held, then blocks of queries, which pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, x, ids = None, [], None, None
        for batch in batches:
            units, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "kind"))
            cuts = np.r_[0, np.flatnonzero((units[1:] != units[:-1]) | (kinds[1:] != kinds[:-1])) + 1, len(units)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if units[a] != unit:
                    unit, held, x = units[a], [], None
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    held.append((part.column("vec_id").to_numpy(zero_copy_only=False), b"".join(part.column("v").to_pylist())))
                    continue
                if x is None:
                    ids = np.concatenate([i for i, _ in held]) if held else np.zeros(0, np.int64)
                    x, held = index.vectors(b"".join(v for _, v in held)), []
                for i in range(part.num_rows):
                    q_ids, least = (np.frombuffer(part.column(c)[i].as_py(), dtype=t) for c, t in (("ids", "<i8"), ("least", "<f8")))
                    found = best(q_ids, index.vectors(part.column("v")[i].as_py()), least, ids, x, k)
                    yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["query_id", "vec_id", "score"])

    return run


def _of_length(rows: DataFrame, dim: int, most: int, k: int, sample: int) -> DataFrame:
    """(query_id, vec_id, score): for each query k rows or more of each unit searched, of the vectors of one length."""
    n = partitions_for(rows.sparkSession)
    rows = rows.filter(F.size("v") == dim)
    learned = np.array(rows.orderBy(F.xxhash64("vec_id")).limit(sample).select("v").toArrow().column("v").to_pylist(), dtype=float)
    pivots = choose_pivots(learned)
    kind = next(t for t, top in (("<i2", 15), ("<i4", 31), ("<i8", 64)) if most < 2**top)
    dist = np.sort(np.sqrt(((learned[:, None, :] - pivots[None]) ** 2).sum(axis=2).min(axis=1)))
    index = Index(pivots, np.r_[0.0, np.quantile(dist, [(i + 1) / RINGS for i in range(RINGS - 1)])], kind)
    indexed = staged(rows.mapInArrow(_index(index), "vec_id long, asked boolean, v binary, pivot int, ring int, dist double, norm double"), "index")
    annuli = Annuli(indexed.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high"), F.max("norm").alias("norm")).orderBy("pivot", "ring").collect())
    place = {(p, r): (int(b), int(u)) for p, r, b, u in zip(annuli.pivot.tolist(), annuli.ring.tolist(), annuli.base, annuli.units, strict=True)}
    table = F.array(*(F.array(*(F.lit(x).cast("long") for x in place.get((p, r), (0, 1)))) for p in range(len(pivots)) for r in range(RINGS)))
    mine = table[F.col("pivot") * RINGS + F.col("ring")]
    units = indexed.select("vec_id", "v", (mine[0] + F.pmod(F.xxhash64("vec_id"), mine[1])).alias("unit"))

    def blocks(asked: DataFrame) -> DataFrame:
        dealt = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(4 * n)))
        return dealt.repartition(n, "pivot", "block").sortWithinPartitions("pivot", "block", "vec_id").select("pivot", "block", "vec_id", "v", "least").mapInArrow(_query_blocks, "pivot int, ids binary, v binary, least binary")

    def search(vectors: DataFrame, queries: DataFrame) -> DataFrame:
        none = F.lit(None).cast("binary")
        both = vectors.select("unit", F.lit(0).alias("kind"), "vec_id", "v", none.alias("ids"), none.alias("least"))
        both = both.union(queries.select("unit", F.lit(1), F.lit(None).cast("long"), "v", "ids", "least"))
        return both.repartition(n, "unit").sortWithinPartitions("unit", "kind").mapInArrow(_search(index, k), "query_id long, vec_id long, score long")

    asked = indexed.filter("asked").select("vec_id", "v", "pivot")
    # the first round: a unit of the fullest ring of the query's own pivot
    first = [max((int(c), int(b)) for p, c, b in zip(annuli.pivot, annuli.n, annuli.base, strict=True) if p == j)[1] if (annuli.pivot == j).any() else 0 for j in range(len(pivots))]
    start = F.array(*(F.lit(f).cast("long") for f in first))[F.col("pivot")]
    unknown = asked.withColumn("least", F.lit(float("-inf")))
    near = search(units.filter(F.col("unit").isin(sorted(set(first)))), blocks(unknown).withColumn("unit", start))
    least = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score")).filter(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
    # rows that repeat an id are found together: the least of their scores holds for all
    known = asked.join(least, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    sent = blocks(known).mapInArrow(_spread(index, annuli), "base long, units long, ids binary, v binary, least binary")
    sent = sent.select(F.explode(F.sequence(F.col("base"), F.col("base") + F.col("units") - 1)).alias("unit"), "ids", "v", "least")
    return search(units, sent)


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """The k highest integer inner products of every row where `queries` holds with all other rows: query_id, rank, vec_id, score.

    Components become floor(scale * x). Ties go to the smaller vec_id. Fewer rows are returned where there are fewer
    candidates. Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null id;
    vectors meet those of their own length. Rows that repeat an id count once each as
    candidates, never for their own id, and are asked as one. Scores must fit 64 bits. An empty table gives no rows. Pivots are fitted to the
    `sample` rows of each length whose ids hash least; all rows are indexed, and what is not searched can't be among the
    k best, so the result is exact.
    """
    spark = vectors.sparkSession
    x = F.col(vec_col)
    fine = x.isNotNull() & F.col(id_col).isNotNull() & (F.size(x) > 0) & ~F.coalesce(F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))), F.lit(False))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    rows = vectors.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.max(F.array_max(F.transform("v", lambda c: F.abs(c)))).alias("most")).orderBy("dim").toLocalIterator()
    parts: list[DataFrame] = []
    for r in lengths:
        if len(parts) == LENGTHS:  # keeps the plan small
            parts = [staged(reduce(DataFrame.union, parts), "top-k")]
        parts.append(_of_length(rows, r.dim, r.most, k, sample))
    found = reduce(DataFrame.union, parts) if parts else None
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
