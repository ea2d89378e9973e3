"""Which frames of a cine are worked on: manifests, checks against reference images, outputs to frames, cycles, series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import settled

VOXEL = ["z", "y", "x"]


def even_indices(n: Column, k: int) -> Column:
    """k of n frames at even distances, first and last kept, halves rounded to even; all where n <= k or k <= 0."""
    every = F.sequence(F.lit(0), n - 1)
    if k <= 0:
        return every
    if k == 1:
        return F.when(n > 1, F.array(F.lit(0))).otherwise(every)
    picked = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (n - 1) / F.lit(float(k - 1))).cast("int"))
    return F.when(n > k, F.array_distinct(picked)).otherwise(every)


def frame_manifest(cases: DataFrame, key: str, mode: str = "auto", most: int | None = None) -> DataFrame:
    """Rows (key, tag, idx): the frames of each case that are worked on.

    `cases` has n_frames, has_cfg, ed and es (from 0; null where the file lacks them) and annotated (array of frames with
    labels, or null). auto: ED and ES of the file; without one the first and last annotated frame; else first and last as
    numbered frames, or `most` of them. ed_es: of the file, or first and last. all: every frame, or `most`. A last frame
    beyond the volume is its last one.
    """
    n, last = F.col("n_frames"), F.col("n_frames") - 1

    def pair(a: Column, b: Column) -> Column:
        return F.array(*(F.struct(F.lit(t).alias("tag"), i.cast("int").alias("idx")) for t, i in (("ED", a), ("ES", b))))

    def numbered(k: int | None) -> Column:
        at = even_indices(n, k if k is not None else 0)
        return F.transform(at, lambda i: F.struct(F.concat(F.lit("frame"), F.lpad(i.cast("string"), F.greatest(F.lit(2), F.length(i.cast("string"))), F.lit("0"))).alias("tag"), i.cast("int").alias("idx")))

    of_file = pair(F.coalesce("ed", F.lit(0)), F.when(F.col("es") < n, F.col("es")).otherwise(last))
    seen = F.coalesce("annotated", F.array().cast("array<int>"))
    of_labels = F.when(F.size(seen) >= 2, pair(F.array_min(seen), F.array_max(seen))).otherwise(F.slice(pair(F.array_min(seen), F.lit(0)), 1, 1))
    if mode == "all":
        frames = numbered(most)
    elif mode == "ed_es":
        frames = F.when(F.col("has_cfg"), of_file).otherwise(pair(F.lit(0), F.greatest(last, F.lit(0))))
    elif mode == "auto":
        frames = F.when(F.col("has_cfg"), of_file).when(F.size(seen) > 0, of_labels).otherwise(numbered(2 if most is None else most))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return cases.select(key, F.explode(frames).alias("f")).select(key, "f.*")


def matching_frames(cine: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, name, t): the frames of a cine that equal an image voxel by voxel, up to rounding.

    `cine` has t and value, `images` name and value. Images with other numbers of voxels match nothing.
    """
    size = cine.groupBy(*keys, "t").agg(F.count("*").alias("_n"))
    both = cine.select(*keys, "t", *VOXEL, F.col("value").alias("_c")).join(images.select(*keys, "name", *VOXEL, F.col("value").alias("_i")), [*keys, *VOXEL])
    near = F.abs(F.col("_i") - F.col("_c")) <= 1e-8 + 1e-5 * F.abs(F.col("_c"))
    same = both.groupBy(*keys, "name", "t").agg(F.count_if(near).alias("_same"))
    whole = images.groupBy(*keys, "name").agg(F.count("*").alias("_m"))
    return same.join(size, [*keys, "t"]).join(whole, [*keys, "name"]).filter("_same = _n and _n = _m").select(*keys, "name", "t")


def verified_frames(manifest: DataFrame, images: DataFrame, matches: DataFrame, key: str) -> DataFrame:
    """Per ED or ES frame of a manifest: status and what it was held against.

    `images` names references, numbered (frameNN, from 1) or tagged (SA_ED, LA_ES, ...). A numbered one must equal frame
    NN - 1, else all frames of its case are `bad reference`. A tagged one that equals some frame must equal that of its tag,
    else `mismatch`; tagged ones that equal none don't count. Without such, the frame must be one of the numbered ones, if
    there are any. What has nothing to be held against is `no reference`.
    """
    # both are small beside the images, and read several times
    named, matches = settled(images.select(key, "name").distinct(), "names"), settled(matches, "matches")
    number = F.regexp_extract("name", r"^frame(\d\d)$", 1)
    numbered = named.select(key, "name", (number.try_cast("int") - 1).alias("t")).filter("t is not null")
    right = numbered.join(matches, [key, "name", "t"], "left_semi")
    bad = numbered.join(right, [key, "name"], "left_anti").select(key).distinct().withColumn("_bad", F.lit(True))
    tagged = matches.withColumn("tag", F.regexp_extract("name", r"^[SL]A_(ED|ES)$", 1)).filter("tag <> ''")
    first = tagged.groupBy(key, "tag", "name").agg(F.collect_set("t").alias("_ts"))
    first = first.groupBy(key, "tag").agg(F.max_by("_ts", "name").alias("_ts"), F.max("name").alias("_by"))
    given = right.groupBy(key).agg(F.collect_set("t").alias("_given"))
    out = manifest.filter(F.col("tag").isin("ED", "ES")).join(bad, key, "left").join(first, [key, "tag"], "left").join(given, key, "left")
    status = F.when(F.col("_bad"), "bad reference").when(F.col("_ts").isNotNull(), F.when(F.array_contains("_ts", F.col("idx")), "verified").otherwise("mismatch"))
    status = status.when(F.col("_given").isNotNull(), F.when(F.array_contains("_given", F.col("idx")), "verified").otherwise("mismatch")).otherwise("no reference")
    return out.select(key, "tag", "idx", status.alias("status"), F.when(F.col("_ts").isNotNull(), F.col("_by")).when(F.col("_given").isNotNull(), "numbered").alias("against"))


def outputs_to_frames(outputs: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Rows (key, file, tag): a tag for every output file, in four passes, so that none is lost.

    1. a file whose name holds an expected tag (`expected` has tag and place; the first in order, where it holds several), the
    first file by name for each; 2. files left, by name, to expected tags left, in order; 3. a tag that ends the file's
    name, if it is free; 4. the least free frameNN, by name.
    """
    place = Window.partitionBy(key)
    files = outputs.select(key, "file").distinct()
    held = files.join(expected, key).filter(F.contains(F.lower("file"), F.concat(F.lit("_"), F.lower("tag"))))
    own = held.groupBy(key, "file").agg(F.min(F.struct("place", "tag")).alias("e"))
    one = own.groupBy(key, F.col("e.tag").alias("tag")).agg(F.min("file").alias("file")).select(key, "file", "tag")
    rest = files.join(one, [key, "file"], "left_anti").withColumn("_r", F.row_number().over(place.orderBy("file")))
    open_ = expected.join(one, [key, "tag"], "left_anti").withColumn("_r", F.row_number().over(place.orderBy("place")))
    two = rest.join(open_, [key, "_r"]).select(key, "file", "tag")
    used = one.unionByName(two)
    left = files.join(used, [key, "file"], "left_anti").withColumn("tag", F.regexp_extract("file", r"(?i)_(ED|ES|frame\d{2,})\.nii\.gz$", 1))
    three = left.filter("tag <> ''").groupBy(key, "tag").agg(F.min("file").alias("file")).select(key, "file", "tag").join(used, [key, "tag"], "left_anti")
    used = used.unionByName(three)
    last = files.join(used, [key, "file"], "left_anti").withColumn("_r", F.row_number().over(place.orderBy("file")))
    count = files.groupBy(key).agg(F.count("*").alias("_n"))
    # among as many numbers as files, at least as many are free as files are left
    free = count.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n"))).alias("i")).withColumn("tag", F.concat(F.lit("frame"), F.lpad(F.col("i").cast("string"), F.greatest(F.lit(2), F.length(F.col("i").cast("string"))), F.lit("0"))))
    free = free.join(used, [key, "tag"], "left_anti").withColumn("_r", F.row_number().over(place.orderBy("i")))
    return used.unionByName(last.join(free, [key, "_r"]).select(key, "file", "tag"))


def equal_sets(annotated: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Per case of either table: whether the frames with labels are those that the sheet lists."""
    sets = [t.groupBy(key).agg(F.array_sort(F.collect_set("frame")).alias(n)) for t, n in ((annotated, "annotated"), (listed, "listed"))]
    none = F.array().cast("array<int>")
    both = sets[0].join(sets[1], key, "full_outer").select(key, *(F.coalesce(n, none).alias(n) for n in ("annotated", "listed")))
    return both.withColumn("equal", F.col("annotated") == F.col("listed"))


def pick_phases(curve: DataFrame, key: str, index: str, volume: str, late: float = 0.15) -> DataFrame:
    """Per cine: ED (largest volume), ES (smallest), ejection fraction and what is odd about it.

    Frames without volume don't count; the first index wins a tie. `problem`: fewer than two frames with volume. late_ed: ED
    lies more than a share `late` of the cycle from frame 0, either way. extra_minima: strict cyclic minima of frames with
    volume, other than those of the smallest volume.
    """
    v = F.col(volume)
    valid = curve.filter(v > 0)
    w = Window.partitionBy(key).orderBy(index)
    ends = Window.partitionBy(key).orderBy(index).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    around = valid.withColumn("_a", F.coalesce(F.lag(v).over(w), F.last(v).over(ends))).withColumn("_b", F.coalesce(F.lead(v).over(w), F.first(v).over(ends))).withColumn("_low", F.min(v).over(Window.partitionBy(key)))
    picked = around.groupBy(key).agg(
        F.max_by(index, F.struct(v, -F.col(index))).alias("ed"), F.min_by(index, F.struct(v, F.col(index))).alias("es"), F.max(v).alias("_edv"), F.min(v).alias("_esv"), F.count("*").alias("valid"),
        F.count_if((v < F.col("_a")) & (v < F.col("_b")) & (v != F.col("_low"))).alias("extra_minima"),
    )
    n = curve.groupBy(key).agg(F.count("*").alias("frames"))
    out = n.join(picked, key, "left").withColumn("valid", F.coalesce("valid", F.lit(0).cast("long")))
    two = F.col("valid") >= 2
    away = F.least(F.col("ed"), F.col("frames") - F.col("ed")) / F.col("frames")
    return out.select(key, "frames", (F.col("frames") - F.col("valid")).alias("empty"), *(F.when(two, F.col(c)).alias(c) for c in ("ed", "es", "extra_minima")), F.when(two, 100 * (F.col("_edv") - F.col("_esv")) / F.col("_edv")).alias("ef"), F.when(two, away > late).alias("late_ed"), F.when(~two, "fewer than two frames with volume").alias("problem"))


def latest_positions(headers: DataFrame, exam: str, normal: Column, position: Column) -> DataFrame:
    """Of an exam's series, the latest at each slice position (a tenth of a mm along the normal), and how many are replaced."""
    at = headers.withColumn("place", F.bround(F.aggregate(F.zip_with(normal, position, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b), 1))
    each = at.select(exam, "place", "series", "series_time").distinct()
    return each.groupBy(exam, "place").agg(F.max_by("series", F.struct("series_time", "series")).alias("series"), (F.count("*") - 1).alias("replaced"))


def cine_order(headers: DataFrame, keys: list[str], position: str, times: list[str]) -> DataFrame:
    """Slice and frame number of every image: slices by position, frames of a slice by `times`, nulls last."""
    slices = headers.select(*keys, position).distinct().withColumn("slice", F.row_number().over(Window.partitionBy(*keys).orderBy(position)))
    order = Window.partitionBy(*keys, position).orderBy(*(F.col(c).asc_nulls_last() for c in times))
    return headers.withColumn("frame", F.row_number().over(order)).join(slices, [*keys, position])


def cine_problems(headers: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Per series: slices, frames a slice, whether all slices have as many, the usual gap, and whether gaps differ by over 10 %."""
    per = headers.groupBy(*keys, position).agg(F.count("*").alias("n"))
    gaps = per.withColumn("gap", F.lead(position).over(Window.partitionBy(*keys).orderBy(position)) - F.col(position))
    out = gaps.groupBy(*keys).agg(F.count("*").alias("slices"), F.max("n").alias("frames"), (F.min("n") == F.max("n")).alias("equal_counts"), F.percentile("gap", F.lit(0.5)).alias("gap"), F.max("gap").alias("_hi"), F.min("gap").alias("_lo"))
    return out.select(*keys, "slices", "frames", "equal_counts", "gap", F.coalesce((F.col("_hi") - F.col("_lo")) > 0.1 * F.col("gap"), F.lit(False)).alias("uneven"))


def geometry_mates(headers: DataFrame, exam: str, exact: list[str], near: list[str], tolerance: float = 1e-3) -> DataFrame:
    """Per series, how many series of its exam share its geometry: equal in `exact`, arrays of `near` equal within tolerance.

    One row a series. The comparison is within an exam, whose series are few.
    """
    a, b = headers, headers.select(exam, F.col("series").alias("_s"), *(F.col(c).alias(f"_{c}") for c in (*exact, *near)))
    same = F.lit(True)
    for c in exact:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    for c in near:
        same &= F.forall(F.zip_with(c, f"_{c}", lambda x, y: F.abs(x - y) <= tolerance + 1e-5 * F.abs(y)), lambda x: F.coalesce(x, F.lit(False)))
    return a.join(b, exam).filter(same).groupBy(exam, "series").agg(F.count("*").alias("mates"))


def choose_series(headers: DataFrame, exam: str, exact: list[str], near: list[str], least: int) -> DataFrame:
    """Which series of an exam are read, and how.

    `headers` has one row a series with n_slices, n_files and series_time. `stack`: the largest series (by files, then time)
    that alone has `least` slices; else `combined`: all series of the geometry that most share, if together they have
    `least`; else `too few`. `series` lists them.
    """
    mates = geometry_mates(headers, exam, exact, near)
    h = headers.join(mates, [exam, "series"])
    alone = h.filter(F.col("n_slices") >= least).groupBy(exam).agg(F.max(F.struct("n_files", "series_time", "series")).alias("a"))
    lead = h.groupBy(exam).agg(F.max(F.struct("mates", (-F.col("series")).alias("_m"))).alias("l")).select(exam, (-F.col("l._m")).alias("series"))
    lead = lead.join(headers, [exam, "series"]).select(exam, *(F.col(c).alias(f"_{c}") for c in (*exact, *near)))
    same = F.lit(True)
    for c in exact:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    for c in near:
        same &= F.forall(F.zip_with(c, f"_{c}", lambda x, y: F.abs(x - y) <= 1e-3 + 1e-5 * F.abs(y)), lambda x: F.coalesce(x, F.lit(False)))
    group = headers.join(lead, exam).filter(same).groupBy(exam).agg(F.array_sort(F.collect_set("series")).alias("all"), F.sum("n_slices").alias("slices"))
    out = group.join(alone, exam, "left")
    kind = F.when(F.col("a").isNotNull(), "stack").when(F.col("slices") >= least, "combined").otherwise("too few")
    return out.select(exam, kind.alias("kind"), F.when(F.col("a").isNotNull(), F.array(F.col("a.series"))).when(F.col("slices") >= least, F.col("all")).otherwise(F.array().cast(out.schema["all"].dataType)).alias("series"))


def best_products(a: np.ndarray, of: np.ndarray, b: np.ndarray, entries: np.ndarray, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """For each row of unit vectors `a` (of a case `of`): the greatest product with a row of `b` of another id, to 9 places, and its entry.

    Products grow by `step` components at a time; an entry goes on only while some row could still gain from it: the part
    that is left adds at most the product of both tails' lengths. Ties go to the smaller entry; no entry: r is -1.
    """
    order = np.argsort(entries, kind="stable")
    b, entries = b[order], entries[order]
    left = np.arange(len(b))
    part = np.zeros((len(a), len(b)))
    own = of[:, None] == entries[None, :]
    for at in range(0, a.shape[1], step):
        part += a[:, at : at + step] @ b[left, at : at + step].T
        rest = np.sqrt((a[:, at + step :] ** 2).sum(axis=1))[:, None] * np.sqrt((b[left, at + step :] ** 2).sum(axis=1))[None, :]
        sure = np.where(own, -np.inf, part - rest).max(axis=1, initial=-np.inf)
        keep = np.flatnonzero(((part + rest >= sure[:, None] - 2e-9) & ~own).any(axis=0))  # what rounds to a tie stays
        left, part, own = left[keep], part[:, keep], own[:, keep]
    r = np.where(own, -1.0, np.round(part, 9))
    if not len(left):
        return np.full(len(a), -1.0), np.zeros(len(a), dtype=np.int64)
    at = r.argmax(axis=1)
    return r[np.arange(len(a)), at], entries[left][at]


def unit_rows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows less their means as unit vectors, and their places; flat and non-finite ones are left out. Sums run in the rows' order."""
    with np.errstate(invalid="ignore", over="ignore"):
        v = values - np.cumsum(values, axis=1)[:, -1:] / values.shape[1]
        length = np.sqrt(np.cumsum(v * v, axis=1)[:, -1])
        held = np.flatnonzero((length > 0) & (length < np.inf))
    return v[held] / length[held, None], held


def best_correlation(cases: DataFrame, catalogue: DataFrame, block: list[str], variants: list[tuple[str, Column]], size: int, numbers: int = 1 << 18) -> DataFrame:
    """Per case: the catalogue entry with the highest Pearson r (to 9 places) over all variants, and r; only r above 0 counts.

    Both have id and value, a flat array of `size` numbers; only rows that agree in the `block` columns meet. A variant is a
    column of positions, by which a case's values are read: a flip or a turn. Ties go to the smaller id. Flat, null
    and non-finite arrays have no r. The arrays of a block are dealt into groups of about `numbers` numbers, those of cases of 512 rows at most,
    and meet as they are: a case's variants are made where its group is multiplied with one of the catalogue's as matrices. A large
    block is so dealt over as many tasks as its catalogue has groups.
    """
    rows = max(1, numbers // size)

    def groups(df: DataFrame, most: int) -> DataFrame:
        """Arrays in groups: block, _g, ids, flat."""
        df = df.select(*block, "id", "value").filter("value is not null")
        many = df.groupBy(*block).agg(F.ceil(F.count("*") / most).alias("_k"))
        dealt = df.join(many, block).withColumn("_g", F.pmod(F.xxhash64("id"), "_k"))
        in_group = F.collect_list(F.struct(F.col("id").cast("long").alias("id"), F.col("value").alias("v")))
        return dealt.groupBy(*block, "_g").agg(in_group.alias("_l"), F.first("_k").alias("_k")).select(*block, "_g", "_k", F.col("_l.id").alias("ids"), F.flatten("_l.v").alias("flat"))

    mine, theirs = groups(cases, min(512, rows)), groups(catalogue, rows)
    kinds = theirs.groupBy(*block).agg(F.first("_k").alias("_k"))
    met = mine.drop("_g", "_k").join(kinds, block).withColumn("_g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)))
    pairs = met.join(theirs.select(*block, "_g", F.col("ids").alias("entries"), F.col("flat").alias("other")), [*block, "_g"])

    @F.pandas_udf("array<struct<case_id: long, r: double, entry: long>>")
    def multiplied(ids: pd.Series, flat: pd.Series, entries: pd.Series, other: pd.Series, turns: pd.Series) -> pd.Series:
        out = []
        for i, a, e, b, ts in zip(ids, flat, entries, other, turns, strict=True):
            i, a, (b, there) = np.asarray(i), np.asarray(a, dtype=float).reshape(len(i), size), unit_rows(np.asarray(b, dtype=float).reshape(len(e), size))
            r, best = np.full(len(i), -1.0), np.zeros(len(i), dtype=np.int64)
            for t in ts:
                turned, here = unit_rows(a[:, np.asarray(t)])
                x, m = best_products(turned, i[here], b, np.asarray(e)[there])
                better = (x > r[here]) | (x == r[here]) & (m < best[here])
                r[here[better]], best[here[better]] = x[better], m[better]
            out.append([{"case_id": int(c), "r": float(x), "entry": int(m)} for c, x, m in zip(i, r, best, strict=True)])
        return pd.Series(out)

    turns = F.array(*(at for _, at in variants))
    found = pairs.select(F.explode(multiplied("ids", "flat", "entries", "other", turns)).alias("f")).select("f.case_id", F.round("f.r", 9).alias("r"), "f.entry").filter("r > 0")
    best = found.groupBy("case_id").agg(F.max(F.struct("r", (-F.col("entry")).alias("m"))).alias("t"))
    return best.select("case_id", (-F.col("t.m")).alias("entry"), F.col("t.r").alias("r"))
