"""Queries that choose slices, paths, variants and examples, crop and paste, and SQL of their own that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import texts as tx
from ..operators import choices as ch
from ..operators import frames as fr
from ..operators import images as im
from ..operators import volumes as vol
from ..sources import files
from ..tables import CLASSES, FOLDS, X, Y, Z, images, probabilities, sql, volumes
from .records import TAGS
from .scores import _rounded

KEYS = ["case_id", "frame_tag"]
SHAPE = (Z, Y, X)
SLICES = "select p.case_id, p.frame_tag, p.model, p.z, count_if(p.label <> g.label) as changed, count_if(p.label = 3) as pool, count_if(p.label > 0) as pred, count_if(g.label > 0) as ref, 2.0 * count_if(p.label = 3 and g.label = 3) / nullif(count_if(p.label = 3) + count_if(g.label = 3), 0) as dice from vox_pred p join vox_gt g on p.case_id = g.case_id and p.frame_tag = g.frame_tag and p.z = g.z and p.y = g.y and p.x = g.x group by p.case_id, p.frame_tag, p.model, p.z"
WANTED = "select distinct o_custkey % 40 as pid, case o_orderkey % 3 when 0 then 'ED' when 1 then 'ES' else 'frame05' end as tag, cast(case o_orderkey % 3 when 0 then 0 when 1 then 11 else 5 end as int) as idx from orders"
FILES = "select distinct concat('gt/', case o_orderkey % 6 when 0 then lpad(cast(o_custkey % 40 as string), 3, '0') when 1 then lpad(cast(o_custkey % 40 as string), 3, '0') when 2 then cast(o_custkey % 40 as string) else lpad(cast(o_custkey % 40 as string), 3, '0') end, case o_orderkey % 6 when 0 then '_ED_gt' when 1 then '_frame12_gt' when 2 then '_ES_gt' when 3 then '_frame06_gt' when 4 then '_notes' else '_gt_4d' end, '.nii.gz') as path from orders"


def _slices(spark: SparkSession, d: str) -> DataFrame:
    """The rows of SLICES, counted on packed volumes."""
    pairs = vol.paired(volumes(spark, d, "vox_pred"), volumes(spark, d, "vox_gt"), KEYS)
    s = vol.slice_counts(pairs, [*KEYS, "model"], SHAPE, 3).selectExpr(*KEYS, "model", "inline(slices)")
    return s.selectExpr(*KEYS, "model", "z", "changed", "pool", "pred", "ref", "2e0 * tp / nullif(pool + ref_pool, 0) as dice")


def best_slices(spark: SparkSession, d: str) -> DataFrame:
    return ch.best_slice(_slices(spark, d), [*KEYS, "model"], ["changed", "pool"])


def ground_truths(spark: SparkSession, d: str) -> DataFrame:
    """The reference file of each frame: by tag, by number from 1, by the id without zeros, or the file of all frames."""
    padded, plain = F.lpad(F.col("pid").cast("string"), 3, "0"), F.col("pid").cast("string")

    def path(pid, tag):
        return F.concat(F.lit("gt/"), pid, F.lit("_"), tag, F.lit("_gt.nii.gz"))

    number = F.concat(F.lit("frame"), F.lpad((F.col("idx") + 1).cast("string"), 2, "0"))
    names = [path(padded, F.col("tag")), path(padded, number), path(plain, F.col("tag")), path(plain, number), F.concat(F.lit("gt/"), padded, F.lit("_gt_4d.nii.gz"))]
    return ch.ranked_paths(sql(spark, d, WANTED), ["pid", "tag", "idx"], names, sql(spark, d, FILES))


def variants(spark: SparkSession, d: str) -> DataFrame:
    v = sql(spark, d, TAGS).select("tag", tx.model_tag(F.col("tag")).alias("p")).filter("not p.cleaned").select(F.col("p.architecture").alias("family"), F.col("tag").alias("model"), "p.seed", "p.ensemble")
    out = None
    for name, explicit, want in (("ensemble", [], "ensemble"), ("all", [], "all"), ("seed2", [], "seed2"), ("explicit", ["nnformer__fold0"], "ensemble")):
        one = ch.chosen_variants(v, explicit, want).withColumn("want", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _thirds(spark: SparkSession, d: str) -> DataFrame:
    third = F.when(F.col("z") == 1, "base").when(F.col("z") == 2, "mid").when(F.col("z") == 3, "apex")
    return _slices(spark, d).filter("model = 'model_c' and frame_tag = 'ED'").withColumn("third", third)


def examples(spark: SparkSession, d: str) -> DataFrame:
    worst = ch.worst_apex(_thirds(spark, d), "case_id", 0.7).select(F.lit("apex").alias("example"), "case_id", F.round("dice", 6).alias("value"))
    off = ch.most_off_heart(_slices(spark, d).filter("model = 'model_b'"), "case_id").select(F.lit("off_heart"), "case_id", F.round("share", 6))
    return worst.union(off)


def _box(spark: SparkSession, d: str, *also: str) -> DataFrame:
    """A crop of 3 x 8 x 8 around each heart, with the columns `also` of its volume."""
    b = vol.boxes(volumes(spark, d, "vox_gt"), [*KEYS, *also], SHAPE)
    for c, size, limit in (("z", 3, Z), ("y", 8, Y), ("x", 8, X)):
        start, end, _, _ = ch.centre_bounds(F.col(f"{c}lo"), F.col(f"{c}hi"), size, limit)
        b = b.withColumn(f"{c}0", start).withColumn(f"{c}1", end)
    return b.select(*KEYS, *also, *(f"{c}{i}" for c in "zyx" for i in (0, 1)))


def crop_bounds(spark: SparkSession, d: str) -> DataFrame:
    return _box(spark, d)


def pad_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Bounds and padding of a 15 x 16 x 9 patch in these grids, from the x extent of each heart."""
    b = vol.boxes(volumes(spark, d, "vox_gt"), KEYS, SHAPE).select(*KEYS, F.col("xlo").alias("lo"), F.col("xhi").alias("hi"))
    y, x = ch.centre_bounds(F.col("lo"), F.col("hi"), 17, Y), ch.centre_bounds(F.col("lo"), F.col("hi"), 9, X)
    return b.select(*KEYS, y[2].alias("y_before"), y[3].alias("y_after"), x[0].cast("int").alias("x_from"), x[1].cast("int").alias("x_to"))


def pasted(spark: SparkSession, d: str) -> DataFrame:
    back = vol.pasted(_box(spark, d, "labels").filter("case_id is not null"), KEYS, SHAPE)
    return vol.voxels_by_label(back, KEYS, SHAPE, [0, 1, 2, 3])


def nonzero(spark: SparkSession, d: str) -> DataFrame:
    """Images whose air is 0, with a dark ring around a hole, cropped to what isn't air."""
    names = F.array(*map(F.lit, (0, 1, 2)), F.when(F.col("case_id") % 2 == 0, 0).otherwise(3))
    return im.crop_to_nonzero(im.without_air(images(spark, d), KEYS, SHAPE, names), KEYS, SHAPE)


def regions(spark: SparkSession, d: str) -> DataFrame:
    labels = im.region_labels(probabilities(spark, d), KEYS, SHAPE, FOLDS, list(range(CLASSES)), [1, 3, 2], 50.0)
    return vol.voxels_by_label(labels, KEYS, SHAPE, [0, 1, 2, 3])


def reference_scaled(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(im.label_means(images(spark, d).filter("case_id is not null"), KEYS, SHAPE, [0, 1, 2, 3], im.to_reference(3)))


def info_problems(spark: SparkSession, d: str) -> DataFrame:
    """Frame numbers of key-value texts with what is wrong about them."""
    t = sql(spark, d, "select c_custkey, concat('ED: ', case c_custkey % 5 when 0 then '0' when 1 then 'x' else cast(c_custkey % 9 as string) end, case when c_custkey % 4 = 0 then '' else concat(chr(10), 'ES : ', cast(c_custkey % 30 + 1 as string)) end) as t from customer")

    def problem(key: str):
        n = files.info_value(F.col("t"), key)
        return F.when(n.isNull(), "missing").when(n.try_cast("int").isNull(), "not a number").when(n.try_cast("int") < 1, "below 1")

    return t.select("c_custkey", files.info_frame(F.col("t"), "ED").alias("ed"), problem("ED").alias("ed_problem"), files.info_frame(F.col("t"), "ES").alias("es"), problem("ES").alias("es_problem"))


def indexed_masks(spark: SparkSession, d: str) -> DataFrame:
    """Masks of a catalogue with the frame index of their case's manifest, else that of their tag; first path per key."""
    m = sql(spark, d, "select distinct o_custkey % 1000 as pid, case o_orderstatus when 'O' then 'ED' when 'F' then 'ES' else concat('frame', lpad(cast(o_orderkey % 30 as string), 2, '0')) end as tag, concat('m', cast(o_orderkey % 3 as string)) as model, concat('p', cast(o_orderkey as string)) as path from orders")
    cases = sql(spark, d, "select distinct o_custkey % 1000 as pid, 20 as n_frames, o_custkey % 2 = 0 as has_cfg, 3 as ed, 11 as es from orders").withColumn("annotated", F.lit(None).cast("array<int>"))
    frames = fr.frame_manifest(cases, "pid", "ed_es")
    of_tag = F.when(F.col("tag") == "ED", 0).when(F.col("tag") == "ES", 1).otherwise(F.expr("try_cast(substr(tag, 6) as int)"))
    first = m.groupBy("pid", "tag", "model").agg(F.min("path").alias("path"))
    return first.join(frames, ["pid", "tag"], "left").select("pid", "tag", "model", "path", F.coalesce("idx", of_tag).alias("idx"))


def layouts(spark: SparkSession, d: str) -> DataFrame:
    """Two atrial layouts: images and labels of one id, and folders MBAS_###; what has no partner is told."""
    l = sql(spark, d, "select distinct concat(case o_orderkey % 4 when 0 then 'imagesTr/' when 1 then 'labelsTr/' when 2 then 'MBAS_' else 'MBAS_' end, lpad(cast(o_custkey % 90 as string), 3, '0'), case o_orderkey % 4 when 0 then '_0000.nii.gz' when 1 then '.nii.gz' when 2 then '/gt.nii.gz' else '/label.nii.gz' end) as path from orders")
    flat = l.withColumn("id", F.regexp_extract("path", r"(?:Tr/|MBAS_)(\d{3})", 1)).withColumn("layout", F.when(F.col("path").startswith("MBAS"), "folders").otherwise("flat"))
    image = F.col("path").startswith("imagesTr") | F.col("path").endswith("/gt.nii.gz")
    s = flat.groupBy("layout", "id").agg(F.min(F.when(image, F.col("path"))).alias("image"), F.min(F.when(~image, F.col("path"))).alias("label_path"))
    return s.withColumn("warning", F.when(F.col("image").isNull(), "no image").when(F.col("label_path").isNull(), "no label"))


def overlap_sheet(spark: SparkSession, d: str) -> DataFrame:
    """Sheet rows with a constant spacing and whether the duplicate search found the case elsewhere."""
    from .frames import duplicates

    c = sql(spark, d, "select c_custkey as case_id from customer")
    return c.join(duplicates(spark, d).select("case_id", "r"), "case_id", "left").select("case_id", F.lit("0.625,0.625,0.625").alias("spacing"), F.coalesce((F.col("r") >= 0.95).cast("int"), F.lit(0)).alias("overlap"))


QUERIES = {
    "W18_best_slices": best_slices, "J18_ground_truths": ground_truths, "W13_chosen_variants": variants, "W19_picked_examples": examples, "F27_crop_bounds": crop_bounds, "F27_pad_bounds": pad_bounds, "V15_pasted": pasted, "V16_filled_crop": nonzero,
    "V14_regions": regions, "A50_reference_scaled": reference_scaled, "S08_info_problems": info_problems, "S13_indexed_masks": indexed_masks, "S17_two_layouts": layouts, "S18_overlap_sheet": overlap_sheet,
}


def _start(c: str, size: int, limit: int) -> str:
    return f"least(greatest((({c}lo + {c}hi - {size}) - (({c}lo + {c}hi - {size}) % 2 + 2) % 2) // 2, 0), {limit - size})::int"


_boxed = "select case_id, frame_tag, " + ", ".join(f"min({c}) as {c}lo, max({c}) + 1 as {c}hi" for c in "zyx") + " from vox_gt where label > 0 group by case_id, frame_tag"
_bounds = f"select case_id, frame_tag, " + ", ".join(f"{_start(c, s, n)} as {c}0, {_start(c, s, n)} + {s} as {c}1" for c, s, n in (("z", 3, Z), ("y", 8, Y), ("x", 8, X))) + f" from ({_boxed}) b"
_family = f"select split_part(tag, '__', 1) as family, tag as model, case when tag like '%seed2' then 2 end as seed, tag like '%ensemble' or tag like '%seeds5' as ensemble from ({TAGS}) t where tag not like '%@_pp' escape '@'"
from .frames import ORACLES as _frames  # noqa: E402

ORACLES = {
    "S18_overlap_sheet": f"select c_custkey as case_id, '0.625,0.625,0.625' as spacing, coalesce(same_scan::int, 0) as overlap from customer left join ({_frames['J20_duplicate_scans']}) d on d.case_id = c_custkey",
    "W18_best_slices": f"select case_id, frame_tag, model, case when max(changed) > 0 then arg_max(z, changed * 10 - z) when max(pool) > 0 then arg_max(z, pool * 10 - z) else 2 end as z, case when max(changed) > 0 then 'changed' when max(pool) > 0 then 'pool' else 'middle' end as by from ({SLICES}) s group by case_id, frame_tag, model",
    "J18_ground_truths": f"""with w as ({WANTED}), f as ({FILES}), c as (select pid, tag, idx, unnest([concat('gt/', lpad(pid::varchar, 3, '0'), '_', tag, '_gt.nii.gz'), concat('gt/', lpad(pid::varchar, 3, '0'), '_frame', lpad((idx + 1)::varchar, 2, '0'), '_gt.nii.gz'), concat('gt/', pid, '_', tag, '_gt.nii.gz'), concat('gt/', pid, '_frame', lpad((idx + 1)::varchar, 2, '0'), '_gt.nii.gz'), concat('gt/', lpad(pid::varchar, 3, '0'), '_gt_4d.nii.gz')]) as path, unnest([1, 2, 3, 4, 5]) as place from w)
        select c.pid, c.tag, c.idx, arg_min(f.path, place) as path from c left join f on f.path = c.path group by c.pid, c.tag, c.idx""",
    "W13_chosen_variants": f"""with v as ({_family}), e as (select *, row_number() over (partition by family order by case when ensemble then 0 when seed = 0 then 1 else 2 end, model) as a, row_number() over (partition by family order by case when seed = 2 then 0 when seed = 0 then 1 else 2 end, model) as b from v)
        select 'ensemble' as want, family, model from e where a = 1 union all select 'all', family, model from v union all select 'seed2', family, model from e where b = 1 union all select 'explicit', family, model from e where case when family = 'nnformer' then model = 'nnformer__fold0' else a = 1 end""",
    "W19_picked_examples": f"""with s as ({SLICES}), m as (select case_id from s where model = 'model_c' and frame_tag = 'ED' and z = 2 group by case_id having avg(dice) >= 0.7), a as (select case_id, dice from s join m using (case_id) where model = 'model_c' and frame_tag = 'ED' and z = 3 and dice is not null order by dice, case_id, z limit 1),
        o as (select case_id, sum(case when ref = 0 then pred else 0 end) / sum(pred) as share from s where model = 'model_b' group by case_id order by share desc, case_id limit 1) select 'apex' as example, case_id, round(dice, 6) as value from a union all select 'off_heart', case_id, round(share, 6) from o where share > 0""",
    "F27_crop_bounds": _bounds,
    "F27_pad_bounds": f"select case_id, frame_tag, 2 as y_before, 3 as y_after, {_start('x', 9, X)} as x_from, {_start('x', 9, X)} + 9 as x_to from ({_boxed}) b",
    "V15_pasted": f"select case_id, frame_tag, case when z >= z0 and z < z1 and y >= y0 and y < y1 and x >= x0 and x < x1 then label else 0 end as label, count(*) as n from vox_gt join ({_bounds}) b using (case_id, frame_tag) group by 1, 2, 3",
    "V16_filled_crop": """with i as (select case_id, frame_tag, z, y, x, label, label > 0 and not (label = 3 and case_id % 2 = 0) as solid from vox_img), b as (select case_id, frame_tag, min(z) as z0, max(z) as z1, min(y) as y0, max(y) as y1, min(x) as x0, max(x) as x1 from i where solid group by case_id, frame_tag)
        select case_id, frame_tag, count(*) as voxels, count_if(label > 0) as inside, count_if(label = 0) as outside, any_value(x1 - x0) as x_top from i join b using (case_id, frame_tag) where z between z0 and z1 and y between y0 and y1 and x between x0 and x1 group by case_id, frame_tag""",
    "V14_regions": "select case_id, frame_tag, label, count(*) as n from (select case_id, frame_tag, z, y, x, case when max(p) filter (class = 2) > 50 then 2 when max(p) filter (class = 3) > 50 then 3 when max(p) filter (class = 1) > 50 then 1 else 0 end as label from (select case_id, frame_tag, z, y, x, class, avg(p) as p from vox_prob group by all) t group by all) u group by case_id, frame_tag, label",
    "A50_reference_scaled": "select i.case_id, i.frame_tag, i.label, round(avg(100 * intensity / pool), 6) as mean from vox_img i join (select case_id, frame_tag, avg(intensity) filter (label = 3) as pool from vox_img group by case_id, frame_tag) p using (case_id, frame_tag) group by i.case_id, i.frame_tag, i.label",
    "S08_info_problems": "select c_custkey, case when c_custkey % 5 > 1 and c_custkey % 9 > 0 then (c_custkey % 9 - 1)::int end as ed, case when c_custkey % 5 = 0 then 'below 1' when c_custkey % 5 = 1 then 'not a number' when c_custkey % 9 = 0 then 'below 1' end as ed_problem, case when c_custkey % 4 > 0 then (c_custkey % 30)::int end as es, case when c_custkey % 4 = 0 then 'missing' end as es_problem from customer",
    "S13_indexed_masks": """with m as (select distinct o_custkey % 1000 as pid, case o_orderstatus when 'O' then 'ED' when 'F' then 'ES' else concat('frame', lpad((o_orderkey % 30)::varchar, 2, '0')) end as tag, concat('m', o_orderkey % 3) as model, concat('p', o_orderkey) as path from orders)
        select pid, tag, model, min(path) as path, case when tag = 'ED' and pid % 2 = 0 then 3 when tag = 'ES' and pid % 2 = 0 then 11 when tag = 'ED' then 0 when tag = 'ES' then 19 else substr(tag, 6)::int end as idx from m group by pid, tag, model""",
    "S17_two_layouts": """with o as (select distinct o_orderkey % 4 as kind, lpad((o_custkey % 90)::varchar, 3, '0') as id from orders), s as (select case when kind > 1 then 'folders' else 'flat' end as layout, id, max(case kind when 0 then concat('imagesTr/', id, '_0000.nii.gz') when 2 then concat('MBAS_', id, '/gt.nii.gz') end) as image, max(case kind when 1 then concat('labelsTr/', id, '.nii.gz') when 3 then concat('MBAS_', id, '/label.nii.gz') end) as label_path from o group by 1, 2)
        select layout, id, image, label_path, case when image is null then 'no image' when label_path is null then 'no label' end as warning from s""",
}
