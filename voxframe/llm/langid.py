"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

SLICE = 1 << 18
BITS = 13
BUCKETS = 1 << BITS
MOST_LANGUAGES = 512
ROWS = 64
CELLS = 1 << 21
UNKNOWN = "und"
_letter = re.compile(r"[^\W\d_]")
_fold: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """Code points of the basic plane, with a space for everything but letters and marks between them."""
    if not _fold:
        table = np.arange(1 << 16, dtype=np.uint32)
        table[[not (0xD800 <= i < 0xE000) and not chr(i).isalpha() for i in range(1 << 16)]] = 32
        _fold.append(table)
    return _fold[0]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the hashed 1- to 3-grams of each text, by row. Letters are lower case, runs of others one space."""
    parts = [_counts(texts[at : at + ROWS]) for at in range(0, len(texts), ROWS)]
    found = [(at // BUCKETS + i * ROWS, at % BUCKETS, part[at]) for i, part in enumerate(parts) for at in (np.flatnonzero(part),)]
    return tuple(np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64) for j in range(3))


def _counts(texts: list[str]) -> np.ndarray:
    """The counts of at most ROWS texts, all buckets of one text after those of the other."""
    sizes, parts = [], []
    for t in texts:
        x = np.frombuffer(t.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        parts.append(x)
        sizes.append(len(x))
    x = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    row = np.repeat(np.arange(len(texts)), sizes)
    x = np.where(x < (1 << 16), _folded()[np.minimum(x, 0xFFFF)], x)
    keep = ~((x == 32) & np.r_[False, (x[:-1] == 32) & (row[:-1] == row[1:])]) if len(x) else np.zeros(0, bool)
    x, row = x[keep].astype(np.uint64), row[keep]
    out = np.zeros(len(texts) * BUCKETS, dtype=np.int64)
    code = np.zeros(len(x), dtype=np.uint64)
    for n in (1, 2, 3):
        m = len(x) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint64(0x100000001B3) + x[n - 1 :] + np.uint64(n)
        same = row[:m] == row[n - 1 :]
        h = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
        at = row[:m] * BUCKETS + h.astype(np.int64)
        out += np.bincount(at[same], minlength=len(out))
    return out


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language of this task: bucket -1 counts documents."""
    total: dict[str, np.ndarray] = {}
    for batch in slices(batches, "text", SLICE):
        (row, bucket, n), langs = gram_counts(batch.column("text").to_pylist()), np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in set(langs):
            mine = langs == lang
            held = total.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
            some = mine[row]
            np.add.at(held, bucket[some], n[some])
            held[BUCKETS] += mine.sum()
        if len(total) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(np.where(at == BUCKETS, -1, at), pa.int32()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])


class Model:
    """Languages and, for each, the log probability of its documents and of every bucket: at most MOST_LANGUAGES rows."""

    def __init__(self, langs: list[str], prior: np.ndarray, logs: np.ndarray):
        self.langs, self.prior, self.logs = langs, prior, logs


def fit(docs: DataFrame, learn: Column, lang_col: str = "lang") -> Model:
    """Counts over all documents where `learn` holds and the language is known, with one added to each bucket."""
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col("text").isNotNull()).select(F.col("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = rows.mapInArrow(_learn, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs = [r.lang for r in counts.filter("bucket = -1").orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    got = counts.toArrow()  # at most MOST_LANGUAGES * (BUCKETS + 1) rows
    table = np.zeros((len(langs), BUCKETS + 1))
    if langs:
        place = {x: i for i, x in enumerate(langs)}
        table[[place[x] for x in got.column("lang").to_pylist()], got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    grams = table[:, :BUCKETS] + 1
    return Model(langs, np.log(table[:, BUCKETS] / max(table[:, BUCKETS].sum(), 1)) if langs else np.zeros(0), np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32))


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """Log probability of each text and language: only the buckets that a text has are added up, CELLS numbers at a time."""
    row, bucket, n = gram_counts(texts)
    out = np.tile(model.prior.astype(np.float64), (len(texts), 1))
    step = max(1, CELLS // max(1, len(model.langs)))
    columns = np.ascontiguousarray(model.logs.T)
    for at in range(0, len(row), step):
        r = row[at : at + step]
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        out[r[starts]] += np.add.reduceat(n[at : at + step, None] * columns[bucket[at : at + step]].astype(np.float64), starts, axis=0)
    return out


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").to_pylist()
            some = np.array([bool(t and _letter.search(t)) for t in texts], dtype=bool) & bool(model.langs)
            best, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            if some.any():
                logit = scores(model, [t for t, s in zip(texts, some, strict=True) if s])
                top = logit.argmax(axis=1)
                best[some] = np.array(model.langs, dtype=object)[top]
                score[some] = 1 / np.exp(logit - logit.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(best.tolist(), pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held: int = 2) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    A document is held out, and not learned from, where crc32(doc_id as text) mod `folds` is `held`. A null doc_id
    is neither. lang_pred is `und` with score 0 where the text is null or has no letter, or nothing could be learned; ties go
    to the language first in order. score is the posterior probability. Texts are read whole. Rows that repeat
    are learned as often. Other columns are ignored.
    """
    fold = F.pmod(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")), F.lit(folds))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"), fold.alias("fold"))
    model = fit(d, F.col("fold") != held)
    out = d.select("doc_id", "text", F.coalesce(F.col("fold") == held, F.lit(False)).alias("held_out"))
    return out.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double").withColumn("score", F.round("score", 6))
