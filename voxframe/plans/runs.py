"""Queries on file round trips, the score stream and inference tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inference as inf
from ..sources import files
from ..streaming.scores import score_slices
from ..tables import X, Y, Z, _parts, sql, view, volumes

LONG = "select patient_id, model, structure, round(avg(dice), 4) as dice from (select patient_id, model, 'rv' as structure, dice_rv as dice from frame_metrics union all select patient_id, model, 'myo', dice_myo from frame_metrics union all select patient_id, model, 'lv', dice_lv from frame_metrics) t group by patient_id, model, structure"
# the same scores; noise of the order of summation, which would move means that lie halfway, is cut off first
SCORES = LONG.replace("avg(dice)", "round(avg(dice), 10)")
PICKS = "select patient_id, cast(max_by(frame_index, lv_ml * 1000 - frame_index) as int) as ed, cast(min_by(frame_index, lv_ml * 1000 + frame_index) as int) as es from lv_curve where lv_ml > 0 group by patient_id"


def sheets(spark: SparkSession, d: str) -> DataFrame:
    """Per-model metric sheets written as CSV, one without a column, and read back as one table."""
    at = files.shared_folder(spark, "sheets")
    for name, cols in (("model_a", ["hd95_lv"]), ("model_r", []), ("model_n", ["hd95_lv"])):
        sql(spark, d, f"select patient_id, frame_tag, model, round(dice_lv, 6) as dice_lv, hd95_lv from frame_metrics where model = '{name}'").select("patient_id", "frame_tag", "model", "dice_lv", *cols).write.option("header", True).csv(f"{at}/{name}")
    all_ = files.read_sheets(spark, [f"{at}/{n}" for n in ("model_a", "model_r", "model_n")])
    return all_.select("patient_id", "frame_tag", "model", F.col("dice_lv").try_cast("double").alias("dice_lv"), F.round(F.col("hd95_lv").try_cast("double"), 6).alias("hd95_lv"))


def problems(spark: SparkSession, d: str) -> DataFrame:
    sheet = sql(spark, d, "select nullif(case when o_orderkey % 7 = 0 then '' else cast(o_custkey as string) end, '') as patient_id, concat('scan', cast(o_orderkey as string), case when o_orderkey % 5 = 0 then '.png' else '.nii.gz' end) as image from orders")
    return files.sheet_problems(sheet, ["patient_id", "image", "spacing"], {"image": "[.]nii([.]gz)?$"})


def manifests(spark: SparkSession, d: str) -> DataFrame:
    frames = sql(spark, d, f"select patient_id, 'ED' as tag, ed as idx from ({PICKS}) p union all select patient_id, 'ES', es from ({PICKS}) q")
    at = files.shared_folder(spark, "manifests")
    files.manifest_json(frames, ["patient_id"]).write.json(at)
    back = spark.read.schema("patient_id bigint, manifest string").json(at)
    return files.manifest_frames(back, ["patient_id"])


def info(spark: SparkSession, d: str) -> DataFrame:
    picks = sql(spark, d, f"select patient_id, case when patient_id % 9 = 0 then 0 else ed + 1 end as ed, es + 1 as es from ({PICKS}) p")
    text = picks.select("patient_id", files.info_text({"ED": F.col("ed"), "ES": F.col("es"), "Group": F.concat(F.lit("G"), F.col("patient_id") % 5)}).alias("t"))
    return text.select("patient_id", files.info_frame(F.col("t"), "ED").alias("ed"), files.info_frame(F.col("t"), "ES").alias("es"), files.info_value(F.col("t"), "Group").alias("grp"), files.info_value(F.col("t"), "Height").alias("height"))


def volume_round_trip(spark: SparkSession, d: str) -> DataFrame:
    keys = ["case_id", "frame_tag"]
    return files.unpacked(files.packed(view(spark, d, "vox_gt"), keys, (Z, Y, X)), keys, (Z, Y, X))


def stream(spark: SparkSession, d: str) -> DataFrame:
    """Slices of all frames arrive as files in turn: those of a frame in different ones."""
    at = files.shared_folder(spark, "stream")
    rows = volumes(spark, d, "vox_pred").selectExpr("case_id", "model", "frame_tag", "explode(sequence(0, %d)) as z" % (Z - 1), "labels")
    rows = rows.withColumn("labels", F.expr(f"substring(labels, 1 + z * {Y * X}, {Y * X})"))
    rows.repartition(_parts(spark), "z", F.expr("case_id % 16")).write.parquet(f"{at}/rows")
    # two batches or so, however many files there are
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, _parts(spark) // 2)).parquet(f"{at}/rows")
    score_slices(source, volumes(spark, d, "vox_gt"), ["case_id", "frame_tag"], ["model"], 3, (Z, Y, X), f"{at}/scores", f"{at}/checkpoint")
    scores = spark.read.parquet(f"{at}/scores")
    return scores.groupBy("model").agg(F.count("*").alias("frames"), F.round(F.avg("dice"), 6).alias("dice"))


def bootstrap(spark: SparkSession, d: str) -> DataFrame:
    out = inf.bootstrap_mean(sql(spark, d, "select model, patient_id, frame_tag, round(dice_lv, 6) as dice_lv from frame_metrics"), ["model"], "dice_lv", ["patient_id", "frame_tag"])
    return out.select("model", "n", *(F.round(c, 6).alias(c) for c in ("mean", "low", "high")))


def friedman(spark: SparkSession, d: str) -> DataFrame:
    out = inf.friedman(sql(spark, d, SCORES), ["structure"], "patient_id", "model", "dice", 3)
    return out.select("structure", "n", F.round("chi2", 6).alias("chi2"), F.round("p", 6).alias("p"))


def pairwise(spark: SparkSession, d: str) -> DataFrame:
    """Signed-rank tests of every pair of models with Holm's correction per structure."""
    l = sql(spark, d, SCORES)
    other = l.select("patient_id", "structure", F.col("model").alias("model_b"), F.col("dice").alias("b"))
    pairs = l.withColumnRenamed("model", "model_a").join(other, ["patient_id", "structure"]).filter("model_a < model_b")
    out = inf.holm(inf.signed_rank(pairs, ["structure", "model_a", "model_b"], "dice", "b"), ["structure"], "p", ["model_a", "model_b"])
    return out.select("structure", "model_a", "model_b", "n", *(F.round(c, 6).alias(c) for c in ("median", "w_plus", "p", "p_holm")))


QUERIES = {"S04_metric_sheets": sheets, "S02_sheet_problems": problems, "S06_manifests": manifests, "S08_info_texts": info, "S32_packed_volumes": volume_round_trip, "X01_score_stream": stream, "R01_bootstrap": bootstrap, "R02_friedman": friedman, "R02_pairwise_tests": pairwise}

_mix = "((b * 48271 + k * 69621 + 12345) % 2147483647)"
for _c in (11, 101, 1009):
    _mix = f"(({_mix} * {_mix} + {_c}) % 2147483647)"
# the tail of a normal variable at z standard deviations on both sides: an alternating series near 0, else a continued fraction
_TAIL = """case when z < 4 then 1 - sqrt(2 / pi()) * z * list_sum(list_transform(range(0, 120), lambda k: case when k % 2 = 0 then 1 else -1 end * exp(k * ln(greatest(z * z / 2, 1e-300)) - lgamma(k + 1)) / (2 * k + 1)))
    else sqrt(2 / pi()) * exp(-z * z / 2) / list_reduce(range(100, 0, -1), lambda t, k: z + k / t, z) end"""


def rank_tests(keys: str) -> str:
    """CTEs of a recursive WITH: from d (keys, d) to `tested`: n, median, w (sum of positive ranks) and p of each test."""
    same = " and ".join(f"o.{k.strip()} = d.{k.strip()}" for k in keys.split(","))
    return f"""r as (select *, (select count(*) from d o where {same} and o.d <> 0 and abs(o.d) < abs(d.d)) as below, (select count(*) from d o where {same} and abs(o.d) = abs(d.d)) as tied from d),
        t as (select {keys}, count(*) as total, median(d) as median, count_if(d <> 0) as n, sum(case when d > 0 then below + (tied + 1) / 2.0 else 0 end)::double as w, sum(case when d <> 0 then tied * tied - 1 else 0 end)::double as tc from r group by all),
        sums as (select 0 as k, 0 as w, 1::double as c union all select k + 1, w + b * (k + 1), sum(c) from sums cross join (values (0), (1)) x(b) where k < 50 group by k + 1, w + b * (k + 1)),
        z as (select *, abs(w - n * (n + 1) / 4.0)::double / sqrt((n * (n + 1) * (2 * n + 1) / 24.0 - tc / 48)::double) as z, (select sum(c) from sums where sums.k = t.n and sums.w <= least(t.w, t.n * (t.n + 1) / 2.0 - t.w)) as few from t),
        tested as (select *, case when n = 0 then 1.0::double when n <= 50 and n = total and tc = 0 then least(1.0::double, 2 * few / pow(2.0::double, n)) else {_TAIL} end as p from z)"""


ORACLES = {
    "R02_pairwise_tests": f"""with recursive l as ({LONG}), d as (select a.structure, a.model as model_a, b.model as model_b, round(a.dice - b.dice, 12) as d from l a join l b on a.structure = b.structure and a.patient_id = b.patient_id and a.model < b.model),
        {rank_tests("structure, model_a, model_b")},
        h as (select *, p * (count(*) over (partition by structure) - row_number() over (partition by structure order by p, model_a, model_b) + 1) as up, row_number() over (partition by structure order by p, model_a, model_b) as place from tested)
        select structure, model_a, model_b, n, round(median, 6) as median, round(w, 6) as w_plus, round(p, 6) as p, round(least(1, max(up) over (partition by structure order by place)), 6) as p_holm from h""",
    "S04_metric_sheets": "select cast(patient_id as string) as patient_id, frame_tag, model, round(dice_lv, 6) as dice_lv, round(case when model <> 'model_r' then hd95_lv end, 6) as hd95_lv from frame_metrics",
    "S02_sheet_problems": "select 'spacing' as \"column\", 'missing' as problem, 1 as n union all select 'patient_id', 'empty', count(*) from orders where o_orderkey % 7 = 0 having count(*) > 0 union all select 'image', 'pattern', count(*) from orders where o_orderkey % 5 = 0 having count(*) > 0",
    "S06_manifests": f"select patient_id, 'ED' as tag, ed as idx from ({PICKS}) p union all select patient_id, 'ES', es from ({PICKS}) q",
    "S08_info_texts": f"select patient_id, case when patient_id % 9 <> 0 then ed end as ed, es, concat('G', patient_id % 5) as grp, cast(null as varchar) as height from ({PICKS}) p",
    "S32_packed_volumes": "select case_id, frame_tag, z, y, x, label from vox_gt",
    "X01_score_stream": "select model, count(*) as frames, round(avg(case when s = 0 then 1 else 2 * tp / s::double end), 6) as dice from (select p.case_id, p.frame_tag, p.model, count_if(p.label = 3 and g.label = 3) as tp, count_if(p.label = 3) + count_if(g.label = 3) as s from vox_pred p join vox_gt g on p.case_id = g.case_id and p.frame_tag = g.frame_tag and p.z = g.z and p.y = g.y and p.x = g.x group by p.case_id, p.frame_tag, p.model) t group by model",
    "R01_bootstrap": f"""with v as (select model, row_number() over (partition by model order by v, patient_id, frame_tag) - 1 as i, v from (select model, patient_id, frame_tag, round(dice_lv, 6) as v from frame_metrics) r), s as (select model, count(*) as n, avg(v) as mean from v group by model),
        dr as (select model, n, cast(b as bigint) as b, cast(unnest(range(0, n)) as bigint) as k from s cross join RANGE(b, 2000) b), m as (select dr.model, b, avg(v) as m from dr join v on v.model = dr.model and v.i = {_mix} % n group by dr.model, b)
        select s.model, any_value(n) as n, round(any_value(mean), 6) as mean, round(PCT(m, 0.025), 6) as low, round(PCT(m, 0.975), 6) as high from s join m on s.model = m.model group by s.model""",
    "R02_friedman": f"""with l as (select * from ({LONG}) q), f as (select *, count(*) over (partition by structure, patient_id) as c from l), r as (select *, (select count(*) from f o where o.structure = f.structure and o.patient_id = f.patient_id and o.dice < f.dice) + ((select count(*) from f o where o.structure = f.structure and o.patient_id = f.patient_id and o.dice = f.dice) + 1) / 2.0 as r from f where c = 3),
        t as (select structure, model, sum(r) as s, count(*) as n, sum(r * r) as rr from r group by structure, model), u as (select structure, max(n) as n, sum((s - 2 * n) * (s - 2 * n)) as between_, sum(rr) - 12 * max(n) as spread from t group by structure)
        select structure, n, round(case when spread > 0 then 2 * between_ / spread end, 6) as chi2, round(exp(-between_ / spread), 6) as p from u""",
}
