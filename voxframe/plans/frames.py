"""Queries on frames, series and volumes by the operators, and SQL of their own that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import frames as fr
from ..operators import images as im
from ..tables import X, Y, Z, imaged, sql, view, volumes
from .scores import _rounded

# each case's cine length, key-value file and annotated frames, made from its curve
CASES = """select patient_id, max(n_frames) as n_frames, patient_id % 3 <> 0 as has_cfg, case when patient_id % 3 <> 0 and patient_id % 7 <> 0 then cast(patient_id % 4 as int) end as ed, case when patient_id % 3 <> 0 then cast(4 + patient_id % 9 as int) end as es, patient_id % 2 as odd from lv_curve group by patient_id"""
ANNOTATED = "select patient_id, frame_index from lv_curve where lv_ml > 118"
OUTPUTS = """select o_custkey % 97 as case_id, concat('case_', cast(o_custkey % 97 as string), case o_orderkey % 6 when 0 then '_ED' when 1 then '_es' when 2 then '_frame07' when 3 then '_0001' when 4 then '_frame12' else '_part' end, case when o_orderkey % 6 in (3, 5) then concat('_', cast(o_orderkey % 50 as string)) else '' end, '.nii.gz') as file from orders group by 1, 2"""
IMAGES = """select case_id, 'frame01' as name, z, y, x, intensity as value from vox_img where case_id % 3 = 0 and frame_tag = 'ED'
    union all select case_id, 'frame02', z, y, x, case when case_id % 12 = 3 and z = 2 then intensity + 1.0 else intensity end from vox_img where case_id % 3 = 0 and frame_tag = 'ES'
    union all select case_id, concat('SA_', frame_tag), z, y, x, intensity from vox_img where case_id % 3 = 1 and case_id % 9 <> 1
    union all select case_id, 'SA_ES', z, y, x, intensity from vox_img where case_id % 9 = 1 and frame_tag = 'ED'
    union all select case_id, concat('LA_', frame_tag), z, y, x, intensity + 7.0 from vox_img where case_id % 3 = 2"""


# the same images of packed volumes: names, and what is added to each slice
NAME = """case when case_id % 3 = 0 then case frame_tag when 'ED' then 'frame01' else 'frame02' end when case_id % 9 = 1 then case frame_tag when 'ED' then 'SA_ES' end
    when case_id % 3 = 1 then concat('SA_', frame_tag) when case_id % 3 = 2 then concat('LA_', frame_tag) end"""
ADDED = f"""case when case_id % 3 = 2 then array_repeat(7, {Z}) when case_id % 12 = 3 and frame_tag = 'ES' then transform(sequence(0, {Z - 1}), z -> if(z = 2, 1, 0)) else array_repeat(0, {Z}) end"""


def _matches(spark: SparkSession, d: str) -> DataFrame:
    """`matching_frames` of the cine and IMAGES, on packed volumes: those of one case meet before they become images, so nothing is shuffled."""
    packed = volumes(spark, d, "vox_gt")
    cine = packed.selectExpr("case_id", "cast(case frame_tag when 'ED' then 0 else 1 end as int) as t", "labels as _c")
    named = packed.selectExpr("case_id", f"{NAME} as name", f"{ADDED} as by", "labels as _i").filter("name is not null")
    keys, shape = ["case_id", "name", "t"], (Z, Y, X)
    pairs = imaged(named.join(cine, "case_id"), {"_c": "cine", "_i": "image"})
    return im.alike(im.brightened(pairs, [*keys, "cine"], shape, "by"), keys, shape, "image", "cine").filter("same").drop("same")


def frame_matches(spark: SparkSession, d: str) -> DataFrame:
    """Frames of one case whose images are equal up to rounding."""
    a, b = (volumes(spark, d, "vox_gt").selectExpr("case_id", f"frame_tag as {tag}", f"labels as {c}") for tag, c in (("frame_tag", "_a"), ("matched", "_b")))
    keys = ["case_id", "frame_tag", "matched"]
    return im.alike(imaged(a.join(b, "case_id"), {"_a": "a", "_b": "b"}), keys, (Z, Y, X), "a", "b").filter("same").drop("same")


def manifests(spark: SparkSession, d: str) -> DataFrame:
    cases = sql(spark, d, CASES).join(sql(spark, d, ANNOTATED).groupBy("patient_id").agg(F.collect_set("frame_index").alias("annotated")), "patient_id", "left")
    out = None
    for name, mode, most in (("auto", "auto", None), ("auto_5", "auto", 5), ("ed_es", "ed_es", None), ("all_4", "all", 4), ("all", "all", None)):
        m = fr.frame_manifest(cases, "patient_id", mode, most).withColumn("mode", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    return volumes(spark, d, "vox_gt").selectExpr("case_id", "frame_tag as tag", "cast(case when frame_tag = 'ED' or case_id % 5 = 0 then 0 else 1 end as int) as idx").distinct()


def verified(spark: SparkSession, d: str) -> DataFrame:
    names = volumes(spark, d, "vox_gt").selectExpr("case_id", f"{NAME} as name").filter("name is not null")
    return fr.verified_frames(_manifest(spark, d), names, _matches(spark, d), "case_id")


def matches(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d)


def outputs(spark: SparkSession, d: str) -> DataFrame:
    files = sql(spark, d, OUTPUTS)
    expected = files.select("case_id").distinct().crossJoin(F.broadcast(spark.createDataFrame([("ED", 0), ("ES", 1), ("frame07", 2)], "tag string, place int")))
    return fr.outputs_to_frames(files, expected, "case_id")


def same_frames(spark: SparkSession, d: str) -> DataFrame:
    a = sql(spark, d, "select patient_id, frame_index as frame from lv_curve where lv_ml > 117")
    b = sql(spark, d, "select patient_id, frame_index as frame from lv_curve where lv_ml > 117 - patient_id % 2")
    out = fr.equal_sets(a, b, "patient_id")
    return out.select("patient_id", *(F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))).alias(c) for c in ("annotated", "listed")), "equal")


def phases(spark: SparkSession, d: str) -> DataFrame:
    curve = view(spark, d, "lv_curve").withColumn("lv_ml", F.expr("case when patient_id % 50 = 7 and frame_index > 0 then 0 else lv_ml end").cast("double"))
    return _rounded(fr.pick_phases(curve, "patient_id", "frame_index", "lv_ml"))


def latest(spark: SparkSession, d: str) -> DataFrame:
    h = view(spark, d, "series_headers").withColumn("position", F.array(F.lit(3.0), F.lit(-1.0), F.col("position_mm")))
    return fr.latest_positions(h, "exam", F.array(F.lit(0.0), F.lit(0.6), F.lit(0.8)), F.col("position"))


def cine(spark: SparkSession, d: str) -> DataFrame:
    h = view(spark, d, "series_headers").withColumn("trigger_ms", F.when(F.col("instance") % 5 != 0, F.col("trigger_ms")))
    return fr.cine_order(h, ["exam", "series"], "position_mm", ["trigger_ms", "instance"]).select("exam", "series", "instance", "slice", "frame")


def cine_checks(spark: SparkSession, d: str) -> DataFrame:
    h = sql(spark, d, "select exam, series, case when exam % 4 = 3 and position_mm > 30 then position_mm + 4.0 else position_mm end as position_mm, instance from series_headers")
    return fr.cine_problems(h, ["exam", "series"], "position_mm")


SERIES = "select exam, series, count(distinct position_mm) as n_slices, count(*) as n_files, max(series_time) as series_time, max(n_rows) as n_rows, max(n_cols) as n_cols from series_headers group by exam, series"


def _series(spark: SparkSession, d: str) -> DataFrame:
    turn = F.when((F.col("exam") % 6 == 0) & (F.col("series") == 1), 0.01).otherwise(0.0)
    return sql(spark, d, SERIES).withColumn("orientation", F.array(F.lit(1.0), turn, F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)))


def mates(spark: SparkSession, d: str) -> DataFrame:
    return fr.geometry_mates(_series(spark, d), "exam", ["n_rows", "n_cols"], ["orientation"])


def series_choice(spark: SparkSession, d: str) -> DataFrame:
    """At least seven slices are wanted of even exams, six of odd ones."""
    s = _series(spark, d)
    both = [fr.choose_series(s.filter(F.col("exam") % 2 == r), "exam", ["n_rows", "n_cols"], ["orientation"], 7 - r) for r in (0, 1)]
    return both[0].unionByName(both[1]).withColumn("series", F.concat_ws(",", F.transform("series", lambda x: x.cast("string"))))


# positions of a 4 x 4 x 4 volume after a flip of z, y or x, or all of them in turn
FLIPS = [(f"{a}{b}{c}", a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]


def duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Small heart volumes of one nation: each case's ES volume, flipped, against the ED volumes of the others."""
    small = sql(spark, d, "select c_nationkey as site, case_id as id, frame_tag, z, y, x, intensity from vox_img join customer on c_custkey = case_id where z < 4 and y % 3 = 0 and x % 3 = 0")
    flat = small.groupBy("site", "id", "frame_tag").agg(F.transform(F.array_sort(F.collect_list(F.struct("z", "y", "x", "intensity"))), lambda s: s["intensity"]).alias("value"))
    variants = [(n, F.array(*(F.lit(((3 - z) if a else z) * 16 + ((3 - y) if b else y) * 4 + ((3 - x) if c else x)) for z in range(4) for y in range(4) for x in range(4)))) for n, a, b, c in FLIPS]
    out = fr.best_correlation(flat.filter("frame_tag = 'ES'"), flat.filter("frame_tag = 'ED'"), ["site"], variants, 64)
    return out.withColumn("r", F.round("r", 6)).withColumn("same_scan", F.col("r") >= 0.95)


QUERIES = {
    "W09_frame_manifests": manifests, "J17_verified_frames": verified, "J16_matching_frames": matches, "J16_frame_match": frame_matches, "J19_outputs_to_frames": outputs, "J21_equal_frame_sets": same_frames, "W01_phases": phases, "W05_latest_positions": latest,
    "W06_cine_frames": cine, "W06_cine_checks": cine_checks, "J23_series_mates": mates, "W07_series_kinds": series_choice, "J20_duplicate_scans": duplicates,
}

_last = "n_frames - 1"
_ann = f"(select patient_id, min(frame_index) as lo, max(frame_index) as hi from ({ANNOTATED}) t group by patient_id)"
_tag = "case when i < 10 then concat('frame0', i) else concat('frame', i) end"


def _some(k: int, cases: str) -> str:
    """Numbered frames: k of n at even distances, halves to even."""
    even = f"case when n_frames <= {k} then i else round_even(i * (n_frames - 1) / {k - 1}.0, 0)::int end"
    return f"select distinct patient_id, {even} as i from ({cases}) c cross join RANGE(i, 10) r where i < least(n_frames, {k})"


_of_file = f"select patient_id, 'ED' as tag, coalesce(ed, 0) as idx from ({CASES}) c where has_cfg union all select patient_id, 'ES', case when es < n_frames then es else {_last} end from ({CASES}) c where has_cfg"
_bare = f"select * from ({CASES}) c where not has_cfg"
_labelled = f"select patient_id, 'ED' as tag, lo as idx from ({_bare}) b join {_ann} a using (patient_id) union all select patient_id, 'ES', hi from ({_bare}) b join {_ann} a using (patient_id) where hi > lo"
_none = f"select * from ({_bare}) b where patient_id not in (select patient_id from {_ann} a)"
_K3 = "case_id, frame_tag"
ORACLES = {
    "W09_frame_manifests": f"""select 'auto' as mode, * from ({_of_file} union all {_labelled} union all select patient_id, {_tag}, i from ({_some(2, _none)}) s) t
        union all select 'auto_5', * from ({_of_file} union all {_labelled} union all select patient_id, {_tag}, i from ({_some(5, _none)}) s) t
        union all select 'ed_es', * from ({_of_file} union all select patient_id, 'ED', 0 from ({_bare}) b union all select patient_id, 'ES', {_last} from ({_bare}) b) t
        union all select 'all_4', patient_id, {_tag}, i from ({_some(4, CASES)}) s union all select 'all', patient_id, {_tag}, i from ({_some(10, CASES)}) s""",
    "J17_verified_frames": """select case_id, tag, idx, case when case_id % 12 = 3 then 'bad reference' when case_id % 3 = 0 then 'verified' when case_id % 9 = 1 then case when tag = 'ED' then 'no reference' when idx = 0 then 'verified' else 'mismatch' end when case_id % 3 = 1 then case when tag = 'ES' and idx = 0 then 'mismatch' else 'verified' end else 'no reference' end as status,
        case when case_id % 12 = 3 then 'numbered' when case_id % 3 = 0 then 'numbered' when case_id % 9 = 1 then case when tag = 'ES' then 'SA_ES' end when case_id % 3 = 1 then concat('SA_', tag) end as against
        from (select distinct case_id, frame_tag as tag, case when frame_tag = 'ED' or case_id % 5 = 0 then 0 else 1 end as idx from vox_gt) m""",
    "J16_matching_frames": f"""with c as (select case_id, case frame_tag when 'ED' then 0 else 1 end as t, z, y, x, intensity as value from vox_img), i as ({IMAGES})
        select c.case_id, i.name, c.t from c join i using (case_id, z, y, x) group by c.case_id, i.name, c.t having count_if(abs(i.value - c.value) > 1e-8 + 1e-5 * abs(c.value)) = 0""",
    "J19_outputs_to_frames": f"""with f as ({OUTPUTS}), e as (select case_id, tag, place from (select distinct case_id from f) k cross join (values ('ED', 0), ('ES', 1), ('frame07', 2)) e(tag, place)),
        p1 as (select case_id, tag, min(file) as file from (select case_id, file, arg_min(tag, place) as tag from f join e using (case_id) where position(concat('_', lower(tag)) in lower(file)) > 0 group by case_id, file) t group by case_id, tag),
        l1 as (select *, row_number() over (partition by case_id order by file) as r from f anti join p1 using (case_id, file)), m1 as (select *, row_number() over (partition by case_id order by place) as r from e anti join p1 using (case_id, tag)),
        p2 as (select case_id, file, tag from p1 union all select l1.case_id, l1.file, m1.tag from l1 join m1 using (case_id, r)),
        p3 as (select case_id, min(file) as file, tag from (select *, regexp_extract(file, '_(ED|ES|es|ed|frame[0-9]+)[.]nii[.]gz$', 1) as tag from f anti join p2 using (case_id, file)) t where tag <> '' group by case_id, tag),
        u as (select * from p2 union all select case_id, file, tag from p3 anti join p2 using (case_id, tag)),
        l2 as (select *, row_number() over (partition by case_id order by file) as r from f anti join u using (case_id, file)),
        free as (select *, row_number() over (partition by case_id order by i) as r from (select case_id, i, concat('frame', lpad(i::varchar, 2, '0')) as tag from (select distinct case_id from f) k cross join RANGE(i, 99) n) x anti join u using (case_id, tag))
        select case_id, file, tag from u union all select l2.case_id, l2.file, free.tag from l2 join free using (case_id, r)""",
    "J21_equal_frame_sets": "select patient_id, coalesce(string_agg(frame_index::varchar, ',' order by frame_index) filter (a), '') as annotated, coalesce(string_agg(frame_index::varchar, ',' order by frame_index) filter (b), '') as listed, count_if(a <> b) = 0 as equal from (select *, lv_ml > 117 as a, lv_ml > 117 - patient_id % 2 as b from lv_curve) t where a or b group by patient_id",
    "W01_phases": """with c as (select patient_id, frame_index, case when patient_id % 50 = 7 and frame_index > 0 then 0 else lv_ml end as v from lv_curve), k as (select *, row_number() over (partition by patient_id order by frame_index) - 1 as r, count(*) over (partition by patient_id) as n, min(v) over (partition by patient_id) as low from c where v > 0),
        m as (select a.patient_id, count_if(a.v < b.v and a.v < d.v and a.v > a.low) as extra from k a join k b on b.patient_id = a.patient_id and b.r = (a.r + 1) % a.n join k d on d.patient_id = a.patient_id and d.r = (a.r + a.n - 1) % a.n group by a.patient_id),
        s as (select patient_id, count(*) as frames, count_if(v = 0) as empty, arg_max(frame_index, v * 100 - frame_index) filter (v > 0) as ed, arg_min(frame_index, v * 100 + frame_index) filter (v > 0) as es, max(v) as hi, min(v) filter (v > 0) as lo from c group by patient_id)
        select s.patient_id, frames, empty, case when frames - empty > 1 then ed end as ed, case when frames - empty > 1 then es end as es, case when frames - empty > 1 then extra end as extra_minima, case when frames - empty > 1 then round(100 * (hi - lo) / hi, 6) end as ef, case when frames - empty > 1 then least(ed, frames - ed) > 0.15 * frames end as late_ed, case when frames - empty < 2 then 'fewer than two frames with volume' end as problem from s left join m using (patient_id)""",
    "W05_latest_positions": "select exam, place, max(series) as series, count(distinct series) - 1 as replaced from (select exam, series, round(-0.6 + 0.8 * position_mm, 1) as place from series_headers) t group by exam, place",
    "W06_cine_frames": "select exam, series, instance, dense_rank() over (partition by exam, series order by position_mm) as slice, row_number() over (partition by exam, series, position_mm order by case when instance % 5 = 0 then 1 else 0 end, case when instance % 5 <> 0 then trigger_ms end, instance) as frame from series_headers",
    "W06_cine_checks": """with h as (select exam, series, case when exam % 4 = 3 and position_mm > 30 then position_mm + 4 else position_mm end as p from series_headers), s as (select exam, series, p, count(*) as n, (select min(o.p) from h o where o.exam = h.exam and o.series = h.series and o.p > h.p) - p as gap from h group by exam, series, p)
        select exam, series, count(*) as slices, max(n) as frames, count(distinct n) = 1 as equal_counts, median(gap) as gap, coalesce(max(gap) - min(gap) > 0.1 * median(gap), false) as uneven from s group by exam, series""",
    "J23_series_mates": "select exam, series, case when exam % 6 = 0 then 1 when exam % 2 = 0 then 2 else 1 end as mates from (select distinct exam, series from series_headers) s",
    "W07_series_kinds": "select exam, case when exam % 2 = 1 then 'stack' when exam % 6 = 0 then 'too few' else 'combined' end as kind, case when exam % 2 = 1 then '0' when exam % 6 = 0 then '' else '0,1' end as series from (select distinct exam from series_headers) e",
    "J20_duplicate_scans": """with s as (select c_nationkey as site, case_id as id, frame_tag, z, y // 3 as y, x // 3 as x, intensity as v from vox_img join customer on c_custkey = case_id where z < 4 and y % 3 = 0 and x % 3 = 0),
        f as (select site, id, k.k, case when k.a = 1 then 3 - z else z end as z, case when k.b = 1 then 3 - y else y end as y, case when k.c = 1 then 3 - x else x end as x, v from s cross join (select a * 4 + b * 2 + c as k, a, b, c from (values (0), (1)) a(a) cross join (values (0), (1)) b(b) cross join (values (0), (1)) c(c)) k where frame_tag = 'ES'),
        r as (select f.id as case_id, s.id as entry, f.k, round(coalesce(corr(f.v, s.v), 0), 9) as r from f join s on f.site = s.site and s.frame_tag = 'ED' and f.id <> s.id and f.z = s.z and f.y = s.y and f.x = s.x group by f.id, s.id, f.k),
        o as (select *, row_number() over (partition by case_id order by r desc, entry) as place from r where r > 0) select case_id, entry, round(r, 6) as r, round(r, 6) >= 0.95 as same_scan from o where place = 1""",
}
