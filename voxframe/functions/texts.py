"""Columns from texts: durations, sizes, lists, maps, names, directions, formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: seconds of a unit, GB of a unit
SECONDS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0, "d": 86400.0}
GIGABYTES = {"b": 1 / 1024**3, "kb": 1 / 1024**2, "mb": 1 / 1024, "gb": 1.0, "tb": 1024.0}


def comma_list(t: Column) -> Column:
    """Trimmed, lower-case, non-empty entries."""
    return F.filter(F.transform(F.split(t, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def duration_seconds(t: Column) -> Column:
    """`1d 2h 3m 4s 5ms`, in any part, or a plain number of seconds; null where nothing above 0 is found."""
    parts = F.regexp_extract_all(t, F.lit(r"([0-9.]+\s*(?:ms|[a-z])?)"), F.lit(1))

    def seconds(p: Column) -> Column:
        n, unit = F.regexp_extract(p, r"^([0-9.]+)", 1).try_cast("double"), F.regexp_extract(p, r"([a-z]+)$", 1)
        factor = F.when(unit == "", 1.0)
        for u, f in SECONDS.items():
            factor = factor.when(unit == u, f)
        return F.coalesce(n * factor, F.lit(0.0))

    total = F.coalesce(F.trim(t).try_cast("double"), F.aggregate(parts, F.lit(0.0), lambda a, p: a + seconds(p)))
    return F.when(total > 0, total)


def memory_gb(t: Column) -> Column:
    """`512 MB`, `3GiB`, ... as GB; a plain number is GB already; what doesn't parse is null."""
    flat = F.lower(F.replace(F.trim(t), F.lit(" "), F.lit("")))
    n, unit = F.regexp_extract(flat, r"^([0-9.]+)", 1).try_cast("double"), F.replace(F.regexp_extract(flat, r"^[0-9.]+([kmgt]?i?b)$", 1), F.lit("i"), F.lit(""))
    factor = F.when(F.lit(False), 0.0)
    for u, f in GIGABYTES.items():
        factor = factor.when(unit == u, f)
    return F.coalesce(flat.try_cast("double"), n * factor)


def exam_id(subject: Column, date: Column) -> Column:
    """Subject and date without signs; a date like 03Feb2021 becomes 20210203, another stays as it is."""
    day = F.coalesce(F.date_format(F.try_to_timestamp(date, F.lit("ddMMMyyyy")), "yyyyMMdd"), date)
    return F.concat(F.regexp_replace(subject, "[^A-Za-z0-9]", ""), F.lit("_"), F.regexp_replace(day, "[^A-Za-z0-9]", ""))


def label_map(t: Column, names: dict[str, int]) -> Column:
    """`rv=1,myo=2,lv=3` as a map from a raw label to the label of its name; null for auto, none or an invalid text.

    All names must be there once.
    """
    entries = F.transform(F.split(t, ","), lambda e: F.struct(F.lower(F.trim(F.split_part(e, F.lit("="), F.lit(1)))).alias("name"), F.trim(F.split_part(e, F.lit("="), F.lit(2))).try_cast("int").alias("raw")))
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    right = F.array_sort(F.transform(entries, lambda e: e["name"])) == F.array(*(F.lit(n) for n in sorted(names)))
    whole = right & F.forall(entries, lambda e: e["raw"].isNotNull()) & (F.size(F.array_distinct(F.transform(entries, lambda e: e["raw"]))) == len(names))
    return F.when(whole, F.map_from_entries(F.transform(entries, lambda e: F.struct(e["raw"], F.element_at(known, e["name"])))))


def label_spec(t: Column) -> Column:
    """`3=LV, 1=RV` as a map from label to name."""
    entries = F.transform(F.split(t, ","), lambda e: F.struct(F.trim(F.split_part(e, F.lit("="), F.lit(1))).try_cast("int").alias("label"), F.trim(F.split_part(e, F.lit("="), F.lit(2))).alias("name")))
    return F.map_from_entries(F.filter(entries, lambda e: e["label"].isNotNull() & (e["name"] != "")))


def number_list(t: Column, mark: str = "\\") -> Column:
    """Numbers between marks; blank entries are passed over, others that don't parse are null."""
    return F.transform(F.filter(F.split(t, "\\" + mark), lambda x: F.trim(x) != ""), lambda x: x.try_cast("double"))


def spacing(t: Column, zero: bool = False) -> Column:
    """Three positive numbers (or, with `zero`, none below 0) between x, commas or semicolons; else null."""
    v = F.transform(F.split(t, "[x,;]"), lambda x: F.trim(x).try_cast("double"))
    return F.when((F.size(v) == 3) & F.forall(v, lambda x: F.coalesce(x >= 0 if zero else x > 0, F.lit(False))), v)


def direction_3d(values: Column) -> Column:
    """The 3 x 3 part of 9 or 16 direction cosines, row by row; the identity for other numbers or a singular matrix."""
    one = F.array(*(F.lit(float(i % 4 == 0)) for i in range(9)))

    def checked(m: Column) -> Column:
        det = m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])
        return F.when(F.abs(det) > 1e-12, m).otherwise(one)

    def spatial(v: Column) -> Column:
        part = F.transform(F.array(F.array(*(v[i] for i in (0, 1, 2, 4, 5, 6, 8, 9, 10)))), checked)[0]
        return F.when(F.size(v) == 9, v).when(F.size(v) == 16, part).otherwise(one)

    # bound to variables, so that long expressions are not written out again and again
    return F.transform(F.array(values), spatial)[0]


def direction_4d(values: Column) -> Column:
    """A 3 x 3 matrix as the upper left part of a 4 x 4 identity."""
    return F.transform(F.array(values), lambda v: F.array(*(v[3 * (i // 4) + i % 4] if i // 4 < 3 and i % 4 < 3 else F.lit(float(i % 5 == 0)) for i in range(16))))[0]


def ras_to_lps(affine: Column) -> Column:
    """The first three rows of a 4 x 4 affine with the signs of the first two turned."""
    return F.transform(F.array(affine), lambda v: F.array(*((-v[i] if i < 8 else v[i]) for i in range(12))))[0]


def radiomics_settings(options: dict[str, Column]) -> tuple[Column, Column]:
    """(JSON of the options that differ from the defaults, what conflicts or null).

    Options: normalize (boolean), normalize_scale, remove_outliers, bin_count, bin_width, spacing (array), force2d, reference.
    """
    o = options
    on = F.coalesce(o["normalize"], F.lit(False))
    fields = [
        F.when(on, F.lit(True)).alias("normalize"), F.when(on, o["normalize_scale"].cast("double")).alias("normalizeScale"), o["remove_outliers"].cast("double").alias("removeOutliers"), o["bin_count"].cast("int").alias("binCount"), o["bin_width"].cast("double").alias("binWidth"),
        o["spacing"].alias("resampledPixelSpacing"), F.when(o["force2d"], F.lit(True)).alias("force2D"), F.when(o["force2d"], F.lit(0)).alias("force2Ddimension"), o["reference"].alias("intensityReference"), F.when(o["reference"].isNotNull(), F.lit(100.0)).alias("intensityReferenceScale"),
    ]
    conflict = F.when(o["bin_count"].isNotNull() & o["bin_width"].isNotNull(), "bin count and bin width").when(o["reference"].isNotNull() & on, "normalize and intensity reference")
    return F.when(conflict.isNull(), F.to_json(F.struct(*fields))), conflict


def model_tag(t: Column) -> Column:
    """Parts of a model tag: architecture, dataset, seed, number of seeds, fold, ensemble, post-processed."""
    rest = F.regexp_replace(F.split_part(t, F.lit("__"), F.lit(2)), "_pp$", "")

    def number(p: str) -> Column:
        return F.nullif(F.regexp_extract(rest, p, 1), F.lit("")).cast("int")

    return F.struct(
        F.split_part(t, F.lit("__"), F.lit(1)).alias("architecture"), F.nullif(F.regexp_replace(rest, "_?(ensemble|seeds?[0-9]+|fold[0-9]+)", ""), F.lit("")).alias("dataset"), number("seed([0-9]+)").alias("seed"), number("seeds([0-9]+)").alias("seeds"), number("fold([0-9]+)").alias("fold"),
        (rest.contains("ensemble") | rest.rlike("seeds[0-9]+")).alias("ensemble"), t.endswith("_pp").alias("cleaned"),
    )


def p_text(p: Column) -> Column:
    return F.when(p.isNull(), "NA").when(p < 0.001, "<0.001").otherwise(F.format_string("%.3f", p))


def value_text(v: Column) -> Column:
    """NA for null or NaN; whole numbers from 1000 on, two digits from 1 on, four below."""
    return F.when(v.isNull() | F.isnan(v), "NA").when(F.abs(v) >= 1000, F.format_string("%.0f", v)).when(F.abs(v) >= 1, F.format_string("%.2f", v)).otherwise(F.format_string("%.4f", v))
