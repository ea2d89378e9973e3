"""Queries of the report tables S1 to S6, and SQL that writes the same tables from the same scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scores as sc
from ..operators import supplement as sp
from ..tables import sql, stored
from .runs import rank_tests
from .scores import DICE, FAR, KEYS, SPACING, STRUCTURES, _bootstrap

NETS = ["net_a", "net_b", "net_c"]
OWN = {"net_a": "EUROPE", "net_b": "ASIA"}
MEASURES = ["LVEDV", "LVESV", "LVEF", "RVEDV", "RVESV", "RVEF", "LV mass"]
UNITS = {"lvedv": ("LVEDV", "ml"), "lvesv": ("LVESV", "ml"), "lvef": ("LVEF", "%"), "rvedv": ("RVEDV", "ml"), "rvesv": ("RVESV", "ml"), "rvef": ("RVEF", "%"), "mass_g": ("LV mass", "g")}
# scores by frame with the dataset and pathology of their subject, and the net that made them
FRAMES = "select s.vendor as dataset, s.pathology, case m.model when 'model_a' then 'net_a' when 'model_n' then 'net_b' else 'net_c' end as net, m.* from frame_metrics m join subjects s on m.patient_id = s.patient_id"
VARIANTS = f"select *, case model when 'model_a' then 'net_a__seed1' when 'model_r' then 'net_a__ensemble' else 'net_b' end as variant from ({FRAMES}) f"
# two nets, each as it came and cleaned
STATES = " union all ".join(f"select dataset, '{net}' as net, model = 'model_r' as cleaned, patient_id, frame_tag, dice_rv, dice_myo, dice_lv from ({FRAMES}) f where model in ('{raw}', 'model_r')" for net, raw in (("net_a", "model_a"), ("net_b", "model_n")))
CASES = "select c_custkey as case_id, r_name as dataset, c_mktsegment as vendor from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"
VOXEL_NETS = {"model_a": "net_a", "model_b": "net_b", "model_c": "net_c"}


def _cases(spark: SparkSession, d: str) -> DataFrame:
    return sql(spark, d, CASES)


def _net(c: str = "model") -> Column:
    out = F.lit(None).cast("string")
    for m, n in VOXEL_NETS.items():
        out = F.when(F.col(c) == m, n).otherwise(out)
    return out.alias("model")


def all_variants(spark: SparkSession, d: str) -> DataFrame:
    f = sql(spark, d, VARIANTS).drop("model").withColumnRenamed("variant", "model")
    return sp.variants(sc.summarise(f, [["dataset", "model"]], "patient_id", DICE, FAR, resamples=0), STRUCTURES, NETS)


def pairwise_tests(spark: SparkSession, d: str) -> DataFrame:
    f = sql(spark, d, FRAMES).drop("model").withColumnRenamed("net", "model")
    per = sc.patient_level(f, ["dataset", "model", "patient_id"], [*DICE, *FAR])
    cells = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(s).alias("structure"), F.col(f"{m}_{s}").alias("value")) for m in ("dice", "hd95") for s in STRUCTURES))
    return sp.pair_tests(per.select("dataset", "model", "patient_id", F.explode(cells).alias("c")).select("dataset", "model", "patient_id", "c.*"), "patient_id", NETS, ["dice", "hd95"], STRUCTURES)


def cleaning_effect(spark: SparkSession, d: str) -> DataFrame:
    f = sql(spark, d, STATES).withColumnRenamed("net", "model")
    cells = F.array(*(F.struct(F.lit(s).alias("structure"), F.col(f"dice_{s}").alias("dice")) for s in STRUCTURES))
    return sp.effect(f.select("dataset", "model", "cleaned", "patient_id", F.explode(cells).alias("c")).select("dataset", "model", "cleaned", "patient_id", "c.*"), "patient_id", NETS, ["myo", "lv"])


def failure_table(spark: SparkSession, d: str) -> DataFrame:
    f = sql(spark, d, FRAMES).drop("model").withColumnRenamed("net", "model")
    rates = sc.failure_rates(sc.long_scores(f, ["dataset", "model", "patient_id", "frame_tag"], STRUCTURES), ["dataset", "model", "structure"])
    masks = sp.off_heart(stored(spark, d, "vox_pred"), stored(spark, d, "vox_gt"), KEYS, ["model"], [2, 3])
    named = masks.withColumn("model", _net()).join(_cases(spark, d).select("case_id", "dataset"), "case_id")
    return sp.failures(rates, named, STRUCTURES, NETS, OWN)


def pathology_table(spark: SparkSession, d: str) -> DataFrame:
    f = sql(spark, d, FRAMES).drop("model").withColumnRenamed("net", "model")
    return sp.by_pathology(sc.row_means(f, ["dataset", "pathology", "model"], "patient_id", DICE), NETS)


def _measured(slices: DataFrame, keys: list[str], ml: float) -> DataFrame:
    """Clinical measures of packed label volumes; wall thickness stays empty."""

    def of(k: int, name: str) -> Column:
        return (F.sum(F.size(F.filter("labels", lambda v: v == k))) * F.lit(ml)).alias(name)

    v = slices.groupBy(*keys, "frame_tag").agg(of(1, "rv_ml"), of(2, "myo_ml"), of(3, "lv_ml")).withColumn("max_mm", F.lit(None).cast("double"))
    return sc.clinical(v, keys)


def vendor_table(spark: SparkSession, d: str) -> DataFrame:
    """Seven measures by voxels; the greatest wall thickness, which the query of clinical measures has, is not among them."""
    ml = SPACING[0] * SPACING[1] * SPACING[2] / 1000
    cells = F.array(*(F.struct(F.lit(n).alias("measure"), F.lit(u).alias("unit"), F.col(c).alias("value")) for c, (n, u) in UNITS.items()))

    def long(name: str, keys: list[str], value: str) -> DataFrame:
        return _measured(stored(spark, d, name), keys, ml).select(*keys, F.explode(cells).alias("c")).select(*keys, "c.measure", "c.unit", F.col("c.value").alias(value))

    pairs = long("vox_pred", ["case_id", "model"], "a").join(long("vox_gt", ["case_id"], "b"), ["case_id", "measure", "unit"]).join(_cases(spark, d), "case_id").withColumn("model", _net())
    return sp.by_vendor(sp.agreement(pairs, ["dataset", "vendor", "measure", "unit", "model"], "a", "b"), NETS, MEASURES)


QUERIES = {"R05_S1_all_variants": all_variants, "R05_S2_pairwise_tests": pairwise_tests, "R05_S3_cleaning_effect": cleaning_effect, "R05_S4_failures": failure_table, "R05_S5_by_pathology": pathology_table, "R05_S6_by_vendor": vendor_table}


def _fixed(e: str, digits: int) -> str:
    v = f"({e})::double"
    return f"case when {v} is null or isnan({v}) then '–' when isinf({v}) then case when {v} > 0 then 'inf' else '-inf' end else printf('%.{digits}f', round(round({v}, 9), {digits}) + 0.0) end"


def _p(e: str) -> str:
    return f"case when {e} < 0.001 then '<0.001' else {_fixed(e, 3)} end"


def _rank(c: str, values: list[str]) -> str:
    return f"list_position([{', '.join(repr(v) for v in values)}], {c})"


def _place(order: str) -> str:
    return f"row_number() over (partition by dataset order by {order}) as place"


_spread = ", ".join(f"avg(dice_{s}) as m_{s}, stddev_samp(dice_{s}) as sd_{s}, quantile_cont(hd95_{s}, 0.25) as q1_{s}, quantile_cont(hd95_{s}, 0.5) as q2_{s}, quantile_cont(hd95_{s}, 0.75) as q3_{s}" for s in STRUCTURES)
_cells = ", ".join(f"{_fixed(f'm_{s}', 3)} || ' ± ' || {_fixed(f'sd_{s}', 3)} as dice_{s}, {_fixed(f'q2_{s}', 1)} || ' [' || {_fixed(f'q1_{s}', 1)} || '–' || {_fixed(f'q3_{s}', 1)} || ']' as hd95_{s}" for s in STRUCTURES)
_means = ", ".join(f"avg({c}) as {c}" for c in (*DICE, *FAR))
_per = f"select dataset, net, patient_id, {_means} from ({FRAMES}) f group by all"
_tall = " union all ".join(f"select dataset, '{m}' as metric, '{s}' as structure, patient_id, net, case when abs({m}_{s}) < 'Infinity'::double then round({m}_{s}, 6) end as v from per" for m in ("dice", "hd95") for s in STRUCTURES)
_same = "o.dataset = f.dataset and o.metric = f.metric and o.structure = f.structure and o.patient_id = f.patient_id"
_states = " union all ".join(f"select dataset, net, '{s}' as structure, patient_id, round(avg(dice_{s}) filter (not cleaned), 6) as a, round(avg(dice_{s}) filter (cleaned), 6) as r from st group by dataset, net, patient_id" for s in ("myo", "lv"))
_long = " union all ".join(f"select dataset, net, '{s}' as structure, dice_{s} as dice, hd95_{s} as hd95 from fr" for s in STRUCTURES)
_ML = SPACING[0] * SPACING[1] * SPACING[2] / 1000
_volumes = ", ".join(f"count_if(label = {k} and frame_tag = '{t}') * {_ML}::double as {n}{t}" for k, n in ((1, "rv"), (2, "myo"), (3, "lv")) for t in ("ED", "ES"))
_EXPRESSIONS = {"LVEDV": "lvED", "LVESV": "lvES", "LVEF": "case when lvED > 0 then 100 * (lvED - lvES) / lvED end", "RVEDV": "rvED", "RVESV": "rvES", "RVEF": "case when rvED > 0 then 100 * (rvED - rvES) / rvED end", "LV mass": "1.05 * myoED"}


def _measures(table: str, keys: str) -> str:
    units = {n: u for n, u in UNITS.values()}
    return " union all ".join(f"select {keys}, '{n}' as measure, '{units[n]}' as unit, {e} as v from {table}" for n, e in _EXPRESSIONS.items())


ORACLES = {
    "R05_S1_all_variants": f"""with p as (select dataset, variant as id, patient_id, {_means} from ({VARIANTS}) f group by all), s as (select dataset, id, count(*) as n, {_spread} from p group by all)
        select dataset, {_place("id")}, case when id = 'net_b' then id else 'net_a' end as model, case id when 'net_b' then '–' when 'net_a__seed1' then 'seed 1' else 'ensemble' end as variant, n, {_cells}
        from (select dataset, case id when 'net_a__seed1' then 1 when 'net_a__ensemble' then 2 else 3 end as o, * exclude (dataset) from s) s""".replace(_place("id"), _place("o")),
    "R05_S2_pairwise_tests": f"""with recursive per as ({_per}), f as (select * from (select *, count(*) over (partition by dataset, metric, structure, patient_id) as c from ({_tall}) t where v is not null) q where c = 3),
        rk as (select *, (select count(*) from f o where {_same} and o.v < f.v) + ((select count(*) from f o where {_same} and o.v = f.v) + 1) / 2.0 as rank_ from f),
        tt as (select dataset, metric, structure, net, sum(rank_) as s, count(*) as n, sum(rank_ * rank_) as rr from rk group by all), fr as (select dataset, metric, structure, exp(-sum((s - 2 * n) * (s - 2 * n)) / nullif(sum(rr) - 12 * max(n), 0)) as friedman from tt group by all),
        d as (select a.dataset, a.metric, a.structure, a.net as model_a, b.net as model_b, round(a.v - b.v, 12) as d from f a join f b on a.dataset = b.dataset and a.metric = b.metric and a.structure = b.structure and a.patient_id = b.patient_id and a.net < b.net),
        {rank_tests("dataset, metric, structure, model_a, model_b")},
        h as (select *, p * (count(*) over (partition by dataset, metric, structure) - row_number() over w + 1) as up, row_number() over w as step from tested window w as (partition by dataset, metric, structure order by p, model_a, model_b)),
        adj as (select *, least(1, max(up) over (partition by dataset, metric, structure order by step)) as p_holm from h)
        select dataset, {_place("metric, " + _rank("structure", STRUCTURES) + ", model_a, model_b")}, metric, structure, {_p("friedman")} as friedman_p, model_a, model_b, case when metric = 'dice' then {_fixed("median", 3)} else {_fixed("median", 2)} end as median_difference, {_p("p_holm")} as p_holm
        from adj left join fr using (dataset, metric, structure)""",
    "R05_S3_cleaning_effect": f"""with recursive st as ({STATES}), ch as (select *, round(r - a, 6) as c from ({_states}) s where a is not null and r is not null), {_bootstrap("select dataset, net, structure, patient_id as tie, c as v from ch", "dataset, net, structure", 2000)},
        d as (select dataset, net, structure, round(r - a, 12) as d from ch), {rank_tests("dataset, net, structure").replace("r as (select", "rr_ as (select", 1).replace("from r group", "from rr_ group", 1)},
        h as (select dataset, net, structure, p * (count(*) over () - row_number() over w + 1) as up, row_number() over w as step from tested window w as (order by p, dataset, net, structure)), adj as (select *, least(1, max(up) over (order by step)) as p_holm from h),
        x as (select dataset, net, structure, count(*) as n, avg(a) as a, avg(r) as r, avg(c) as c from ch group by all)
        select dataset, {_place("net, " + _rank("structure", ["myo", "lv"]))}, net as model, structure, n, {_fixed("a", 3)} as dice_raw, {_fixed("r", 3)} as dice_cleaned, {_fixed("c", 3)} || ' [' || {_fixed("lo", 3)} || ', ' || {_fixed("hi", 3)} || ']' as change, {_p("p_holm")} as p_holm
        from x join ci using (dataset, net, structure) join adj using (dataset, net, structure)""",
    "R05_S4_failures": f"""with fr as ({FRAMES}), rates as (select dataset, net, structure, count(*) as n, count_if(dice < 0.5 or hd95 is null or hd95 > 20) as bad, count_if(hd95 is null or hd95 = 'Infinity'::double) as missing from ({_long}) l group by all),
        sl as (select p.case_id, p.frame_tag, p.model, p.z, count_if(p.label > 0) as fg, count_if(g.label in (2, 3)) as heart from vox_pred p join vox_gt g using (case_id, frame_tag, z, y, x) group by all),
        m as (select case_id, frame_tag, model, sum(fg) as fg, sum(case when heart = 0 then fg else 0 end) as off, count_if(heart = 0 and fg > 0) as slices from sl group by all),
        o as (select dataset, case model when 'model_a' then 'net_a' when 'model_b' then 'net_b' else 'net_c' end as net, avg(case when slices > 0 then 1.0 else 0.0 end) as with_, avg(off / nullif(fg, 0)) as share from m join ({CASES}) c using (case_id) group by all)
        select dataset, {_place("net")}, net || case when (net = 'net_a' and dataset = 'EUROPE') or (net = 'net_b' and dataset = 'ASIA') then ' †' else '' end as model, max(n) as frames, {", ".join(f"max(case when structure = '{s}' then bad || ' (' || {_fixed('100.0 * bad / n', 1)} || ')' end) as failures_{s}" for s in STRUCTURES)},
        sum(missing)::bigint as missing, {_fixed("100 * any_value(with_)", 0)} as frames_off_heart, {_fixed("100 * any_value(share)", 1)} as foreground_off_heart from rates left join o using (dataset, net) group by dataset, net""",
    "R05_S5_by_pathology": f"""with p as (select dataset, pathology, net, patient_id, avg((dice_rv + dice_myo + dice_lv) / 3) as v from ({FRAMES}) f group by all), q as (select dataset, pathology, net, count(*) as n, avg(v) as v from p group by all)
        select dataset, {_place("n desc, pathology")}, pathology, n, {", ".join(f"{_fixed(f'max(v) filter (net = {chr(39)}{m}{chr(39)})', 3)} as {m}" for m in NETS)} from q group by dataset, pathology, n""",
    "R05_S6_by_vendor": f"""with a as (select case_id, model, {_volumes} from vox_pred group by all), b as (select case_id, {_volumes} from vox_gt group by all), la as ({_measures("a", "case_id, model")}), lb as ({_measures("b", "case_id")}),
        j as (select dataset, vendor, measure, unit, case model when 'model_a' then 'net_a' when 'model_b' then 'net_b' else 'net_c' end as net, la.v as x, lb.v as y from la join lb using (case_id, measure, unit) join ({CASES}) c using (case_id) where la.v is not null and lb.v is not null),
        g as (select *, avg((x + y) / 2) over w as grand, avg(x) over w as mx, avg(y) over w as my, count(*) over w as n from j window w as (partition by dataset, vendor, measure, unit, net)),
        ss as (select dataset, vendor, measure, unit, net, any_value(n) as n, avg(x - y) as bias, stddev_samp(x - y) as sd, 2 * sum(pow((x + y) / 2 - grand, 2)) as of_rows, any_value(n * (pow(mx - grand, 2) + pow(my - grand, 2))) as of_columns, sum(pow(x - grand, 2) + pow(y - grand, 2)) as of_all from g group by all),
        ms as (select *, of_rows / nullif(n - 1, 0) as msr, of_columns as msc, (of_all - of_rows - of_columns) / nullif(n - 1, 0) as mse from ss),
        cell as (select *, {_fixed("bias", 1)} || ' [' || {_fixed("bias - 1.96 * sd", 1)} || ', ' || {_fixed("bias + 1.96 * sd", 1)} || ']; ' || {_fixed("(msr - mse) / nullif(msr + mse + 2 * (msc - mse) / n, 0)", 2)} as t from ms)
        select dataset, {_place("vendor, " + _rank("measure", MEASURES) + ", n")}, vendor, measure || ' (' || unit || ')' as measure, n, {", ".join(f"coalesce(max(t) filter (net = '{m}'), '–') as {m}" for m in NETS)} from cell group by dataset, vendor, cell.measure, unit, n""",
}
