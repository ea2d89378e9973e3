"""Document quality without labels: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer.

1. Overlapping labellers vote junk, fine or nothing on every document. All documents' vote patterns are counted.
2. EM over the pattern counts estimates, for either class, how often each labeller votes what, and each pattern's posterior.
3. A logistic model over hashed word shapes learns the posteriors of a bounded sample of documents, and scores all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, with_text
from .wordhash import Words, mix, text_bytes

SLICE = 1 << 20
SAMPLE = 6000
BUCKETS = 1024
ABSTAIN, JUNK, FINE = 0, 1, 2
LABELLERS = ("shouting", "exclaiming", "symbols", "separators", "repetition", "sentences", "signs", "strays", "variety")
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_KIND = np.zeros(256, dtype=np.int64)
_KIND[65:91], _KIND[97:123], _KIND[_SIGN] = 1, 1 << 21, 1 << 42


class Shapes:
    """Per word of a column: case, ending, length class and whether it repeats the word before."""

    def __init__(self, column: pa.Array):
        w = Words(column)
        raw, _ = text_bytes(column)
        s, e = w.start, w.end

        self.words, self.n = w, e - s
        # upper case, lower case and signs of every word, 21 bits each, by one prefix sum
        total = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum(_KIND[raw], out=total[1:])
        total = total[e] - total[s]
        self.upper, self.lower, self.signs = total & 0x1FFFFF, (total >> 21) & 0x1FFFFF, total >> 42
        last = raw[e - 1] if len(e) else raw[:0]
        before = raw[np.maximum(e - 2, s)] if len(e) else raw[:0]
        self.double = (self.n > 1) & _SIGN[last] & (last == before)
        self.bang = self.double & (last == 33)
        self.stop = (last == 46) | (last == 44)
        self.again = np.r_[False, w.hash[1:] == w.hash[:-1]] if len(s) else np.zeros(0, bool)
        firsts = w.rows[:-1][w.rows[:-1] < w.rows[1:]]
        self.again[firsts] = False
        self.row = np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))
        self.size = np.diff(w.rows)

    def variety(self) -> np.ndarray:
        """Distinct pairs of neighbouring words, of all pairs; 1 for fewer than two words."""
        h, row = self.words.hash, self.row
        inner = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
        pair = mix(mix(h[:-1]) + h[1:])[inner] if len(h) else h
        row = row[1:][inner] if len(row) else row
        order = np.lexsort((pair, row))
        pair, row = pair[order], row[order]
        new = np.r_[True, (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])][: len(pair)]
        return np.where(self.size > 1, np.bincount(row, new, len(self.size)) / np.maximum(self.size - 1, 1), 1.0)

    def share(self, mask: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, mask, len(self.size)) / np.maximum(self.size, 1)


def votes(shapes: Shapes) -> np.ndarray:
    """One row per document, one column per labeller. A document without words gets no votes."""
    s, n = shapes, shapes.size
    letters = np.bincount(s.row, s.upper + s.lower, len(n))
    shout = np.bincount(s.row, s.upper, len(n)) / np.maximum(letters, 1)

    def vote(x: np.ndarray, fine: float, junk: float, enough: np.ndarray) -> np.ndarray:
        return np.where(~enough, ABSTAIN, np.where(x >= junk, JUNK, np.where(x <= fine, FINE, ABSTAIN)))

    some, several = n > 0, n >= 12
    stop = s.share(s.stop)
    out = [
        vote(shout, 0.1, 0.2, some & (letters > 8)),
        vote(s.share(s.bang), 0.02, 0.15, some),
        vote(s.share(s.double & ~s.bang), 0.02, 0.15, some),
        vote(s.share((s.n == 1) & (s.signs == 1)), 0.02, 0.15, some),
        vote(s.share(s.again), 0.08, 0.2, several),
        np.where(~several, ABSTAIN, np.where((stop < 0.005) | (stop > 0.6), JUNK, np.where((stop > 0.02) & (stop < 0.4), FINE, ABSTAIN))),
        # these overlap with the others, so that accuracies can be told from agreement
        vote(np.bincount(s.row, s.signs, len(n)) / np.maximum(np.bincount(s.row, s.n, len(n)), 1), 0.06, 0.08, several),
        vote(s.share((s.signs > 0) & ~s.stop), 0.05, 0.2, several),
        vote(1 - s.variety(), 0.3, 0.5, n >= 30),
    ]
    return np.stack(out, axis=1).astype(np.int64)


def features(shapes: Shapes) -> np.ndarray:
    """Shares of hashed word shapes and of pairs of them, one row per document."""
    s = shapes
    case = np.where(s.upper + s.lower == 0, np.where(s.signs == s.n, 0, 1), np.where(s.lower == 0, 2, np.where(s.upper == 0, 3, 4)))
    end = np.where(s.bang, 0, np.where(s.double, 1, np.where(s.stop, 2, 3)))
    code = ((case * 4 + end) * 4 + np.minimum(np.log2(np.maximum(s.n, 1)).astype(np.int64), 3)) * 2 + s.again
    pair = np.where(np.r_[True, s.row[1:] != s.row[:-1]], 0, np.r_[0, code[:-1]] + 1) if len(code) else code
    x = np.zeros(len(s.size) * BUCKETS)
    for key in (code, code * 1000 + pair + 1_000_000):
        x += np.bincount(s.row * BUCKETS + (mix(key.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64), minlength=len(x))
    return (np.sqrt(x.reshape(len(s.size), BUCKETS) / np.maximum(2 * s.size, 1)[:, None])).astype(np.float32)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = 3 ** np.arange(len(LABELLERS))
    for batch in slices(batches, "text", SLICE):
        code, n = np.unique(votes(Shapes(batch.column("text"))) @ base, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["pattern", "n"])


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(P(vote | class, it votes) as [labeller, class, vote], posterior P(fine) of every pattern); classes are junk, fine.

    It starts from: junk where some labeller says so. Abstaining tells nothing. Rates are smoothed by a tenth of a document. Labellers
    overlap, so that each kind of junk is seen by several: their agreement, and no prior, tells the classes apart.
    """
    labellers = len(LABELLERS)
    v = (patterns[:, None] // 3 ** np.arange(labellers)) % 3
    fine = np.where((v == JUNK).any(axis=1), 0.001, 0.95)
    rates = np.zeros((len(LABELLERS), 2, 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - fine), counts * fine])
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        for j in range(len(LABELLERS)):
            for x in (JUNK, FINE):
                rates[j, :, x] = weight[:, v[:, j] == x].sum(axis=1) + 0.1
            rates[j] /= rates[j].sum(axis=1, keepdims=True)
        log = np.log(prior)[:, None] + sum(np.where(v[:, j] == ABSTAIN, 0.0, np.log(np.maximum(rates[j], 1e-300))[:, v[:, j]]) for j in range(len(LABELLERS)))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - fine).max() < 1e-9:
            break
        fine = new
    return rates, fine


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vote pattern and compressed features of every document; most features are zero, and the driver gets all rows."""
    base = 3 ** np.arange(len(LABELLERS))
    for batch in slices(batches, "text", SLICE):
        s = Shapes(batch.column("text"))
        x = features(s)
        yield pa.RecordBatch.from_arrays([pa.array(votes(s) @ base, pa.int64()), pa.array([zlib.compress(r.tobytes(), 1) for r in x], pa.binary())], ["pattern", "x"])


def train(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 8.0, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient descent with momentum; classes weigh the same."""
    w, b, vw, vb = np.zeros(x.shape[1], np.float32), 0.0, 0.0, 0.0
    y = y.astype(np.float32)
    weight = y / max(y.sum(), 1e-9) / 2 + (1 - y) / max((1 - y).sum(), 1e-9) / 2
    for _ in range(rounds):
        g = (1 / (1 + np.exp(-np.clip(x @ w + np.float32(b), -50, 50))) - y) * weight
        vw, vb = 0.9 * vw - np.float32(rate) * (g @ x + np.float32(ridge) * w), 0.9 * vb - rate * g.sum()
        w, b = w + vw, b + vb
    return w, float(b)


def _score(w: np.ndarray, b: float, keep_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            s = Shapes(batch.column("text").fill_null(""))
            p = np.where(s.size > 0, 1 / (1 + np.exp(-np.clip(features(s) @ w + b, -50, 50))), 0.0)
            names = [c for c in batch.schema.names if c != "text" or keep_text]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(p, pa.float64())], [*names, "quality"])

    return run


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, dict[str, float]]:
    """Weights, offset and each labeller's estimated accuracy where it votes.

    The vote patterns of all documents are counted (at most 3^9 of them); the scorer learns from the `sample`
    documents whose doc_id hashes least.
    """
    text = with_text(docs)
    rows = text.mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    if not rows:
        return np.zeros(BUCKETS), 0.0, dict.fromkeys(LABELLERS, 0.5)
    patterns, counts = np.array([r.pattern for r in rows]), np.array([r.n for r in rows], dtype=float)
    rates, fine = estimate(patterns, counts)
    share = counts @ fine / counts.sum()
    accuracy = {name: float(rates[j, 0, JUNK] * (1 - share) + rates[j, 1, FINE] * share) for j, name in enumerate(LABELLERS)}
    order = F.xxhash64("doc_id")
    last = docs.select(F.col("doc_id").cast("long").alias("doc_id")).select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    got = text.filter(order <= last).limit(2 * sample).mapInArrow(_sampled, "pattern long, x binary").toArrow()
    x = np.zeros((got.num_rows, BUCKETS), dtype=np.float32)
    for i, v in enumerate(got.column("x")):
        x[i] = np.frombuffer(zlib.decompress(v.as_buffer()), dtype=np.float32)
    y = dict(zip(patterns.tolist(), fine.tolist(), strict=True))
    w, b = train(x, np.array([y.get(p, 0.5) for p in got.column("pattern").to_pylist()]))
    return w, b, accuracy


def quality_scores(docs: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, quality (0 to 1), kept (quality >= threshold).

    Null texts and texts without words score 0. Repeated rows score alike. An empty table gives no rows. Texts are read
    whole; other columns are ignored.
    """
    w, b, _ = fit(docs, sample)
    out = with_text(docs).mapInArrow(_score(w, b), "doc_id long, quality double")
    return out.select("doc_id", F.round("quality", 6).alias("quality"), (F.col("quality") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier accepts, with all their columns. Texts without words go."""
    w, b, _ = fit(docs, sample)
    names = docs.columns
    others = [c for c in names if c != "text"]
    row = docs.select(F.struct(F.lit(True).alias("k"), *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(others))).alias("row"), "text")
    kind = row.schema["row"].dataType.simpleString()
    out = row.mapInArrow(_score(w, b, True), f"row {kind}, text string, quality double").filter(F.col("quality") >= threshold)
    place = {c: F.col(f"row.k{i}") for i, c in enumerate(others)} | {"text": F.col("text")}
    return out.select(*(place[c].alias(c) for c in names))
