"""Queries on texture, shape, resampling and label inference, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import images as im
from ..operators import labels as lb
from ..operators import resample as rs
from ..operators import texture as tx
from ..operators import volumes as vol
from ..tables import X, Y, Z, images, view, volumes

KEYS = ["case_id", "frame_tag"]
SPACING = (10.0, 1.25, 1.25)
WIDTH = 5.0
SOURCE = rs.Grid((Z, Y, X), SPACING)
TURNED = rs.Grid((Z, Y, X), SPACING, (5.0, -3.0, 2.0), ((1.0, 0.0, 0.0), (0.0, 0.6, 0.8), (0.0, -0.8, 0.6)))
TARGET = rs.Grid((5, 8, 8), (10.0, 1.875, 1.875), (2.5, 0.3125, -0.9375))


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*KEYS, *(F.round(F.col(c).cast("double"), digits).alias(c) for c in df.columns if c not in KEYS))


def _wall(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "vox_img").filter("label = 2")


def levels(spark: SparkSession, d: str) -> DataFrame:
    return tx.discretised(_wall(spark, d), KEYS, width=WIDTH).groupBy(*KEYS, "level").agg(F.count("*").alias("n"))


def equal_bins(spark: SparkSession, d: str) -> DataFrame:
    return tx.discretised(_wall(spark, d), KEYS, width=None, bins=8).groupBy(*KEYS, "level").agg(F.count("*").alias("n"))


def glcm(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(im.glcm_features(images(spark, d), KEYS, SOURCE.size, 2, WIDTH))


def shape(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(tx.shape_features(view(spark, d, "vox_gt").filter("label = 3"), KEYS, SPACING), 4)


def normalised(spark: SparkSession, d: str) -> DataFrame:
    means = im.label_means(images(spark, d).filter("case_id is not null"), KEYS, SOURCE.size, [0, 1, 2, 3], im.deviations(100.0, 1.5))
    return means.withColumn("mean", F.round("mean", 4))


def nearest_labels(spark: SparkSession, d: str) -> DataFrame:
    return rs.unfolded(rs.nearest(volumes(spark, d, "vox_gt"), KEYS, SOURCE, TARGET), KEYS, TARGET, "label")


def linear(spark: SparkSession, d: str) -> DataFrame:
    out = rs.unfolded(rs.linear(images(spark, d), KEYS, SOURCE, TARGET), KEYS, TARGET, "intensity")
    return out.withColumn("intensity", F.round("intensity", 6))


def canonical_labels(spark: SparkSession, d: str) -> DataFrame:
    """The reference labels under names that turn with the case, named again."""
    names = F.array(F.lit(0), *((1 + (F.lit(k) + F.col("case_id")) % 3).cast("int") for k in (1, 2, 3)))
    per = vol.shapes(vol.renamed(volumes(spark, d, "vox_gt"), KEYS, (Z, Y, X), names), KEYS, (Z, Y, X), [0, 1, 2, 3], [1, 2, 3])
    held = per.filter("label > 0").select(*KEYS, F.col("label").alias("inner"), "n", F.posexplode("held").alias("outer", "h")).filter("h > 0")
    scores = held.select(*KEYS, (F.col("outer") + 1).alias("outer"), "inner", (F.col("h") / F.col("n")).alias("score"))
    return lb.named(per.select(*KEYS, "label", "n"), lb.surest(scores, KEYS), KEYS).groupBy(*KEYS, "label").agg(F.sum("n").alias("n"))


def dense_labels(spark: SparkSession, d: str) -> DataFrame:
    odd = view(spark, d, "vox_gt").withColumn("label", F.expr("label * label * (1 + case_id % 4)").cast("int"))
    return lb.dense(odd, KEYS).groupBy(*KEYS, "label").agg(F.count("*").alias("n"))


def thresholds(spark: SparkSession, d: str) -> DataFrame:
    i = view(spark, d, "vox_img").filter("label > 1").withColumn("slice", F.col("z"))
    return lb.otsu(i, [*KEYS, "slice"]).withColumn("threshold", F.round("threshold", 6))


def dark_pool(spark: SparkSession, d: str) -> DataFrame:
    pool = view(spark, d, "vox_img").filter("label = 3")
    return lb.darkest(pool, KEYS, "2 + case_id % 3").select(*KEYS, "z", "y", "x", "intensity")


def grid_points(spark: SparkSession, d: str) -> DataFrame:
    """Pool voxels in mm, and their place in a finer grid over the same space that is then cut and padded; turned axes."""
    target = rs.cropped(rs.resized(TURNED, (5.0, 1.5, 1.0)), (1, -2, 3), (8, 12, 8))
    at = rs.moved(view(spark, d, "vox_gt").filter("label = 3"), TURNED, target)
    inside = F.lit(True)
    for a, n in zip(rs.POINT, target.size, strict=True):
        inside &= F.floor(F.col(f"u_{a}") + 0.5).between(0, n - 1)
    ends = [f(c).alias(f"{n}_{c}") for c in ("z_mm", "y_mm", "x_mm", "u_z", "u_y", "u_x") for n, f in (("least", F.min), ("most", F.max))]
    out = at.groupBy(*KEYS).agg(*ends, F.count_if(inside).alias("inside"))
    return out.select(*KEYS, "inside", *(F.round(c, 6).alias(c) for c in out.columns if c.startswith(("least", "most"))))


QUERIES = {
    "F26_grid_points": grid_points, "V02_canonical_labels": canonical_labels, "V04_dense_labels": dense_labels, "V05_nearest_labels": nearest_labels, "V06_linear_resample": linear, "V29_levels": levels, "V29_equal_bins": equal_bins,
    "V30_glcm": glcm, "V31_shape": shape, "V32_normalised": normalised, "W15_otsu": thresholds, "W16_darkest": dark_pool,
}

_low = "select case_id, frame_tag, min(intensity) as lo, max(intensity) as hi, count(*) as total from vox_img where label = 2 group by case_id, frame_tag"
_level = f"select i.case_id, i.frame_tag, z, y, x, cast(floor(intensity / {WIDTH}) - floor(lo / {WIDTH}) + 1 as int) as level from vox_img i join ({_low}) s on i.case_id = s.case_id and i.frame_tag = s.frame_tag where label = 2"
_dirs = ", ".join(str((*o, k)) for k, o in enumerate(tx.DIRECTIONS))
_K = "case_id, frame_tag"
_glcm = f"""with lv as ({_level}), o as (select * from (values {_dirs}) o(dz, dy, dx, d)),
    half as (select a.case_id, a.frame_tag, d, a.level as i, b.level as j from lv a cross join o join lv b on a.case_id = b.case_id and a.frame_tag = b.frame_tag and b.z = a.z + dz and b.y = a.y + dy and b.x = a.x + dx),
    c as (select {_K}, d, i, j, count(*) as n from (select * from half union all select {_K}, d, j, i from half) t group by {_K}, d, i, j),
    p as (select *, n / (sum(n) over (partition by {_K}, d))::double as p, (sum(i * n) over (partition by {_K}, d))::double / (sum(n) over (partition by {_K}, d))::double as u, max(i) over (partition by {_K}) as ng from c),
    ent as (select {_K}, d, sum(case when k = 0 then -p * log2(p) else 0 end) as hx, sum(case when k = 1 then -p * log2(p) else 0 end) as hd, sum(case when k = 2 then -p * log2(p) else 0 end) as hs from
      (select {_K}, d, k, v, sum(p) as p from (select {_K}, d, 0 as k, i as v, p from p union all select {_K}, d, 1, abs(i - j), p from p union all select {_K}, d, 2, i + j, p from p) t group by {_K}, d, k, v) t group by {_K}, d),
    f as (select {_K}, d, sum(p * i * j) as autocorrelation, max(u) as joint_average, sum(p * pow(i + j - 2 * u, 4)) as cluster_prominence, sum(p * pow(i + j - 2 * u, 3)) as cluster_shade, sum(p * pow(i + j - 2 * u, 2)) as cluster_tendency,
      sum(p * (i - j) * (i - j)) as contrast, sum(p * (i - u) * (j - u)) as cov, sum(p * (i - u) * (i - u)) as sum_squares, sum(p * abs(i - j)) as difference_average, sum(p * p) as joint_energy, sum(-p * log2(p)) as joint_entropy,
      sum(p / (1 + (i - j) * (i - j))) as idm, sum(p / (1 + (i - j) * (i - j) / (ng * ng)::double)) as idmn, sum(p / (1 + abs(i - j))) as id, sum(p / (1 + abs(i - j) / ng::double)) as idn,
      sum(case when i <> j then p / ((i - j) * (i - j)) else 0 end) as inverse_variance, max(p) as maximum_probability from p group by {_K}, d)
    select f.case_id, f.frame_tag, """ + ", ".join(f"round(avg({e}), 6) as {n}" for n, e in (
    *((n, n) for n in ("autocorrelation", "joint_average", "cluster_prominence", "cluster_shade", "cluster_tendency", "contrast", "sum_squares", "difference_average", "joint_energy", "joint_entropy", "idm", "idmn", "id", "idn", "inverse_variance", "maximum_probability")),
    ("difference_entropy", "hd"), ("sum_entropy", "hs"), ("correlation", "case when sum_squares > 0 then cov / sum_squares else 1 end"), ("difference_variance", "contrast - difference_average * difference_average"), ("sum_average", "2 * joint_average"),
    ("imc1", "case when hx > 0 then (joint_entropy - 2 * hx) / hx else 0 end"), ("imc2", "sqrt(greatest(0, 1 - exp(-2 * (2 * hx - joint_entropy))))"))) + f" from f join ent on f.case_id = ent.case_id and f.frame_tag = ent.frame_tag and f.d = ent.d group by f.case_id, f.frame_tag"
_cov = {a + b: f"covar_pop({a} * {SPACING['zyx'.index(a)]}, {b} * {SPACING['zyx'.index(b)]})" for a, b in ("zz", "yy", "xx", "zy", "zx", "yx")}
_shape = f"""with pool as (select case_id, frame_tag, z, y, x from vox_gt where label = 3),
    a as (select {_K}, count(*) * 15.625 as volume, {', '.join(f'{e} as {n}' for n, e in _cov.items())} from pool group by {_K}),
    b as (select *, (zz + yy + xx) / 3 as q from a),
    c as (select *, sqrt(((zz - q) * (zz - q) + (yy - q) * (yy - q) + (xx - q) * (xx - q) + 2 * (zy * zy + zx * zx + yx * yx)) / 6) as s, (zz - q) * ((yy - q) * (xx - q) - yx * yx) - zy * (zy * (xx - q) - yx * zx) + zx * (zy * yx - (yy - q) * zx) as det from b),
    e as (select *, case when s > 0 then acos(greatest(-1, least(1, det / (2 * s * s * s)))) / 3 else 0 end as t from c),
    l as (select *, q + 2 * s * cos(t) as l1, greatest(0, q + 2 * s * cos(t + 2 * acos(-1) / 3)) as l3 from e),
    m as (select *, greatest(0, 3 * q - l1 - l3) as l2 from l),
    far as (select v.case_id, v.frame_tag, max(sqrt(pow((v.z - w.z) * 10.0, 2) + pow((v.y - w.y) * 1.25, 2) + pow((v.x - w.x) * 1.25, 2))) as d3, max(case when v.z = w.z then sqrt(pow((v.y - w.y) * 1.25, 2) + pow((v.x - w.x) * 1.25, 2)) end) as d2 from pool v join pool w on v.case_id = w.case_id and v.frame_tag = w.frame_tag group by v.case_id, v.frame_tag)
    select m.case_id, m.frame_tag, round(volume, 4) as volume, round(d3, 4) as diameter_3d, round(d2, 4) as diameter_slice, round(4 * sqrt(l1), 4) as major, round(4 * sqrt(l2), 4) as minor, round(4 * sqrt(l3), 4) as least,
    case when l1 > 0 then round(sqrt(l2 / l1), 4) end as elongation, case when l1 > 0 then round(sqrt(l3 / l1), 4) end as flatness from m join far on m.case_id = far.case_id and m.frame_tag = far.frame_tag"""
_u = {a: f"(({TARGET.origin[n]} + t{a} * {TARGET.spacing[n]}) / {SPACING[n]})" for n, a in enumerate("zyx")}
_tgrid = f"(select case_id, frame_tag, tz, ty, tx, {_u['z']} as uz, {_u['y']} as uy, {_u['x']} as ux from (select distinct case_id, frame_tag from vox_gt) k cross join RANGE(tz, 5) a cross join RANGE(ty, 8) b cross join RANGE(tx, 8) c)"
_weight = " * ".join(f"case when k{a} = 1 then u{a} - floor(u{a}) else 1 - (u{a} - floor(u{a})) end" for a in "zyx")
_corner = ", ".join(f"cast(least(greatest(floor(u{a}) + k{a}, 0), {n - 1}) as int) as {a}" for a, n in zip("zyx", (Z, Y, X), strict=True))
_in = " and ".join(f"u{a} between -0.5 and {n - 0.5}" for a, n in zip("zyx", (Z, Y, X), strict=True))
# the finer grid's origin lies half a difference of spacings off, then its crop starts at voxel 1, -2, 3
_mm = "select case_id, frame_tag, 5.0 + 10.0 * z as z_mm, -3.0 + 0.6 * 1.25 * y - 0.8 * 1.25 * x as y_mm, 2.0 + 0.8 * 1.25 * y + 0.6 * 1.25 * x as x_mm from vox_gt where label = 3"
_from = "select *, z_mm - (5.0 - 2.5 + 5.0) as a, y_mm - (-3.0 + 0.125 - 3.0 * 0.6 - 3.0 * 0.8) as b, x_mm - (2.0 - 0.125 - 3.0 * 0.8 + 3.0 * 0.6) as c"
_index = "select case_id, frame_tag, z_mm, y_mm, x_mm, a / 5.0 as u_z, (0.6 * b + 0.8 * c) / 1.5 as u_y, (0.6 * c - 0.8 * b) / 1.0 as u_x"
ORACLES = {
    "F26_grid_points": f"{_index.replace('select', 'with p as (select', 1)} from ({_from} from ({_mm}) m) o) select case_id, frame_tag, count_if(floor(u_z + 0.5) between 0 and 7 and floor(u_y + 0.5) between 0 and 11 and floor(u_x + 0.5) between 0 and 7) as inside, " + ", ".join(f"round({f}({c}), 6) as {n}_{c}" for c in ("z_mm", "y_mm", "x_mm", "u_z", "u_y", "u_x") for n, f in (("least", "min"), ("most", "max"))) + " from p group by case_id, frame_tag",
    "V02_canonical_labels": "select case_id, frame_tag, label, count(*) as n from vox_gt group by case_id, frame_tag, label",
    "V04_dense_labels": "select case_id, frame_tag, dense_rank() over (partition by case_id, frame_tag order by v) - 1 as label, n from (select case_id, frame_tag, label * label as v, count(*) as n from vox_gt group by case_id, frame_tag, label) t",
    "V05_nearest_labels": f"select g.case_id, g.frame_tag, tz as z, ty as y, tx as x, coalesce(v.label, 0) as label from {_tgrid} g left join vox_gt v on v.case_id = g.case_id and v.frame_tag = g.frame_tag and v.z = floor(uz + 0.5) and v.y = floor(uy + 0.5) and v.x = floor(ux + 0.5)",
    "V06_linear_resample": f"select g.case_id, g.frame_tag, tz as z, ty as y, tx as x, round(coalesce(i, 0), 6) as intensity from {_tgrid} g left join (select h.case_id, h.frame_tag, tz, ty, tx, sum(w * intensity) as i from (select case_id, frame_tag, tz, ty, tx, {_weight} as w, {_corner} from {_tgrid} t cross join RANGE(kz, 2) p cross join RANGE(ky, 2) q cross join RANGE(kx, 2) r where {_in}) h join vox_img v on v.case_id = h.case_id and v.frame_tag = h.frame_tag and v.z = h.z and v.y = h.y and v.x = h.x group by h.case_id, h.frame_tag, tz, ty, tx) s using (case_id, frame_tag, tz, ty, tx)",
    "V29_levels": f"select case_id, frame_tag, level, count(*) as n from ({_level}) t group by case_id, frame_tag, level",
    "V29_equal_bins": f"select case_id, frame_tag, level, count(*) as n from (select i.case_id, i.frame_tag, cast(case when hi > lo then least(floor((intensity - lo) * 8 / (hi - lo)) + 1, 8) else 1 end as int) as level from vox_img i join ({_low}) s on i.case_id = s.case_id and i.frame_tag = s.frame_tag where label = 2) t group by case_id, frame_tag, level",
    "V30_glcm": _glcm,
    "V31_shape": _shape,
    "V32_normalised": "select i.case_id, i.frame_tag, label, round(avg(100 * least(greatest((intensity - m) / s, -1.5), 1.5)), 4) as mean from vox_img i join (select case_id, frame_tag, avg(intensity) as m, stddev_pop(intensity) as s from vox_img group by case_id, frame_tag) k on i.case_id = k.case_id and i.frame_tag = k.frame_tag group by i.case_id, i.frame_tag, label",
    "W15_otsu": """with s as (select case_id, frame_tag, z, min(intensity) as lo, max(intensity) as hi, count(*) as total from vox_img where label > 1 group by case_id, frame_tag, z),
        h as (select s.*, cast(least(floor((intensity - lo) / ((hi - lo) / 48)), 47) as int) as bin from s join vox_img i on s.case_id = i.case_id and s.frame_tag = i.frame_tag and s.z = i.z where label > 1 and total >= 8 and hi > lo),
        c as (select a.case_id, a.frame_tag, a.z, k.bin, any_value(lo) + (k.bin + 0.5) * ((any_value(hi) - any_value(lo)) / 48) as mid, any_value(total) as total, count_if(a.bin <= k.bin) as w0, sum(case when a.bin <= k.bin then a.bin else 0 end) as s0, sum(a.bin) as s from h a cross join RANGE(bin, 48) k group by a.case_id, a.frame_tag, a.z, k.bin),
        r as (select *, row_number() over (partition by case_id, frame_tag, z order by (s0 * total - s * w0)::double * (s0 * total - s * w0)::double / (w0 * (total - w0))::double desc, bin) as place from c where w0 > 0 and total > w0)
        select s.case_id, s.frame_tag, s.z as slice, round(mid, 6) as threshold from s left join r on s.case_id = r.case_id and s.frame_tag = r.frame_tag and s.z = r.z and place = 1""",
    "W16_darkest": "select case_id, frame_tag, z, y, x, intensity from (select *, row_number() over (partition by case_id, frame_tag order by intensity, z, y, x) as r from vox_img where label = 3) t where r <= 2 + case_id % 3",
}
