"""Plans over metric tables: summaries, comparisons, agreement, ranking. One text runs in Spark and in the check."""

PATIENT = "select model, patient_id, avg(dice_rv) as rv, avg(dice_myo) as myo, avg(dice_lv) as lv, avg(hd95_lv) as hd from frame_metrics group by model, patient_id"
LONG = "select patient_id, model, frame_tag, 'rv' as structure, dice_rv as dice from frame_metrics union all select patient_id, model, frame_tag, 'myo', dice_myo from frame_metrics union all select patient_id, model, frame_tag, 'lv', dice_lv from frame_metrics"
FINITE = "case when abs(hd95_lv) < cast('Infinity' as double) then hd95_lv end"

PLANS = {
    "S03_row_count": "select count(*) as n from lineitem",
    "S11_subject_metadata": "select lpad(cast(patient_id as string), 3, '0') as patient, case vendor when 'EUROPE' then 'A' when 'ASIA' then 'B' else 'other' end as vendor, pathology, split from subjects where vendor is not null",
    "P06_held_out": "select patient_id, vendor, pathology from subjects where split = 'test'",
    "P07_variants": "select path, case when right(path, 10) = '_pp.nii.gz' then 1 else 0 end as postprocessed, regexp_replace(path, '_pp[.]nii[.]gz$', '.nii.gz') as base from mask_files",
    "P08_failures": "select patient_id, model, frame_tag, dice_lv < 0.93 or hd95_lv > 30 or not (abs(hd95_lv) < cast('Infinity' as double)) as failed from frame_metrics",
    "P11_coercion": "select event_id, try_cast(event_type as double) as bad, try_cast(cast(value as string) as double) as good from events",
    "P18_unpivot": f"select patient_id, model, frame_tag, structure, round(dice, 6) as dice from ({LONG}) t",
    "J05_metrics_metadata": "select m.patient_id, m.model, m.frame_tag, s.vendor, s.split from frame_metrics m left join subjects s on m.patient_id = s.patient_id",
    "J06_pred_ref_suffixes": "select a.patient_id, round(a.dice_lv, 6) as dice_pred, round(b.dice_lv, 6) as dice_ref from frame_metrics a join frame_metrics b on a.patient_id = b.patient_id and a.model = b.model where a.frame_tag = 'ED' and b.frame_tag = 'ES' and a.model = 'model_n'",
    "J08_run_join": "select a.patient_id, a.frame_tag, round(abs(a.dice_lv - b.dice_lv), 6) as diff from frame_metrics a join frame_metrics b on a.patient_id = b.patient_id and a.frame_tag = b.frame_tag where a.model = 'model_a' and b.model = 'model_r'",
    "J12_two_key_semi_join": "select patient_id, model, frame_tag from frame_metrics m where exists (select 1 from frame_metrics w where w.patient_id = m.patient_id and w.model = m.model and w.dice_lv < 0.998)",
    "J13_anti_joins": "select s.patient_id, s.vendor from subjects s where not exists (select 1 from frame_metrics m where m.patient_id = s.patient_id and m.hd95_lv > 27)",
    "A20_patient_means": f"select model, patient_id, round(rv, 6) as rv, round(myo, 6) as myo, round(lv, 6) as lv, round(hd, 6) as hd from ({PATIENT}) p",
    "A21_model_comparison": f"select model, count(*) as n, round(avg(dice_lv), 6) as dice_mean, round(stddev_samp(dice_lv), 6) as dice_std, round(PCT(dice_lv, 0.5), 6) as dice_median, round(avg({FINITE}), 6) as hd95_mean, round(stddev_samp({FINITE}), 6) as hd95_std from frame_metrics group by model",
    "A22_accuracy_quantiles": f"select model, round(PCT(lv, 0.25), 6) as q1, round(PCT(lv, 0.5), 6) as median, round(PCT(lv, 0.75), 6) as q3 from ({PATIENT}) p group by model",
    "A23_vendor_table": "select s.vendor, m.model, count(*) as n, round(avg(m.dice_myo), 6) as dice from frame_metrics m join subjects s on m.patient_id = s.patient_id where s.split = 'test' group by s.vendor, m.model",
    "A24_grouping_sets": "select s.vendor, m.model, count(*) as n, round(avg(m.dice_rv), 6) as dice from frame_metrics m join subjects s on m.patient_id = s.patient_id group by grouping sets ((s.vendor, m.model), (m.model), ())",
    "A25_failure_rate": "select model, round(avg(case when dice_lv < 0.93 or hd95_lv > 30 or not (abs(hd95_lv) < cast('Infinity' as double)) then 1.0 else 0.0 end), 6) as rate, count(distinct patient_id) as patients from frame_metrics group by model",
    "A26_phase_pivot": "select model, patient_id, round(max(case when frame_tag = 'ED' then dice_lv end), 6) as ed, round(max(case when frame_tag = 'ES' then dice_lv end), 6) as es from frame_metrics group by model, patient_id",
    "A36_bland_altman": "select model, count(*) as n, round(avg(d), 6) as bias, round(avg(d) - 1.96 * stddev_samp(d), 6) as low, round(avg(d) + 1.96 * stddev_samp(d), 6) as high, round(avg(abs(d)), 6) as mae, round(avg(case when abs(d) > 5 then 1.0 else 0.0 end), 6) as over_5 from (select a.model, 100 * (a.dice_lv - b.dice_lv) as d from frame_metrics a join frame_metrics b on a.patient_id = b.patient_id and a.model = b.model where a.frame_tag = 'ED' and b.frame_tag = 'ES') t group by model",
    "A39_coefficient_of_variance": "select model, round(sqrt(avg(((x - y) * (x - y) / 2) / (((x + y) / 2) * ((x + y) / 2)))), 6) as cov from (select a.model, a.dice_lv as x, a.dice_myo as y from frame_metrics a) p group by model",
    "A46_composition": "select vendor, split, count(*) as n, count(distinct pathology) as pathologies from subjects group by vendor, split",
    "A47_reproducibility": "select frame_tag, round(greatest(max(abs(a_rv - b_rv)), max(abs(a_lv - b_lv))), 6) as worst from (select a.frame_tag, a.dice_rv as a_rv, b.dice_rv as b_rv, a.dice_lv as a_lv, b.dice_lv as b_lv from frame_metrics a join frame_metrics b on a.patient_id = b.patient_id and a.frame_tag = b.frame_tag where a.model = 'model_a' and b.model = 'model_r') p group by frame_tag",
    "A48_effect": "select count(*) as n, round(avg(b - a), 6) as change from (select patient_id, avg(case when model = 'model_a' then dice_lv end) as a, avg(case when model = 'model_r' then dice_lv end) as b from frame_metrics group by patient_id) p where a is not null and b is not null",
    "A49_subset_summary": f"select s.split = 'train' as overlap, p.model, round(avg(p.lv), 6) as dice, count_if(p.lv < 0.996) as failures from ({PATIENT}) p join subjects s on p.patient_id = s.patient_id group by s.split = 'train', p.model",
    "A55_patient_summary": f"select patient_id, model, round(avg(case when frame_tag = 'ED' then dice_lv end), 6) as ed_dice, round(avg(case when frame_tag = 'ES' then dice_lv end), 6) as es_dice, round(avg({FINITE}), 6) as hd95 from frame_metrics group by patient_id, model",
    "A57_report_summary": f"select model, count(*) as n, concat(cast(round(avg(dice_lv), 3) as string), ' +- ', cast(round(stddev_samp(dice_lv), 3) as string)) as dice, count({FINITE}) as finite from frame_metrics group by model",
    "A58_axis_limit": f"select model, round(case when count({FINITE}) > 5 then PCT({FINITE}, 0.95) else max({FINITE}) end, 6) as top from frame_metrics group by model",
    "A59_variant_counts": "select split_part(path, '/', 1) as family, count(distinct regexp_extract(path, '_([a-z0-9_]+)[.]nii', 1)) as variants from mask_files group by split_part(path, '/', 1)",
    "W10_holm": "select model, structure, p, round(least(1.0, max((m - rank + 1) * p) over (order by p, model, structure rows unbounded preceding)), 6) as adjusted from (select model, structure, p, count(*) over () as m, row_number() over (order by p, model, structure) as rank from (select model, structure, round(avg(1 - dice) / 10, 6) as p from (" + LONG + ") l group by model, structure) a) b",
    "W11_average_ranks": "select patient_id, model, cast(rank() over w + (count(*) over (partition by patient_id, v) - 1) / 2.0 as double) as rank from (select patient_id, model, round(avg(dice_lv), 3) as v from frame_metrics group by patient_id, model) p window w as (partition by patient_id order by v)",
    "W12_signed_rank": "select count(*) as n, cast(sum(case when d > 0 then r else 0 end) as double) as w_plus, round(PCT(d, 0.5), 6) as median from (select d, rank() over (order by abs(d)) + (count(*) over (partition by abs(d)) - 1) / 2.0 as r from (select round(a.lv - b.lv, 6) as d from (" + PATIENT + ") a join (" + PATIENT + ") b on a.patient_id = b.patient_id where a.model = 'model_a' and b.model = 'model_r') p where d <> 0) q",
    "W17_median_case": f"select p.model, min_by(p.patient_id, abs(p.lv - m.mid) * 1000000 + p.patient_id / 1000000.0) as patient_id from ({PATIENT}) p join (select model, PCT(lv, 0.5) as mid from ({PATIENT}) q group by model) m on p.model = m.model group by p.model",
    "T01_fixed_order": "select model, frame_tag, cast(row_number() over (order by case model when 'model_r' then 0 when 'model_n' then 1 else 2 end, frame_tag) as int) as place from (select distinct model, frame_tag from frame_metrics) d",
    "T04_best_model": "select max_by(model, m) as best, round(max(m), 6) as dice from (select model, avg(dice_lv) as m from frame_metrics group by model) t",
    "T05_bag_union": "select model, patient_id from frame_metrics where frame_tag = 'ED' union all select model, patient_id from frame_metrics where frame_tag = 'ES'",
    "T06_tagged_union": "select 'metrics' as dataset, patient_id from frame_metrics union all select 'subjects', patient_id from subjects",
    "T07_distinct": "select distinct patient_id, model from frame_metrics",
    "T08_set_difference": "select patient_id from subjects except select patient_id from frame_metrics where hd95_lv > 27",
    "R04_gap_summary": f"select model, round(max(lv) - min(lv), 6) as gap from ({PATIENT}) p group by model",
    "F19_ejection_fraction": "select patient_id, round(100 * (max(lv_ml) - min(case when lv_ml > 0 then lv_ml end)) / max(lv_ml), 6) as ef, case when 100 * (max(lv_ml) - min(case when lv_ml > 0 then lv_ml end)) / max(lv_ml) <= 40 then 'reduced' when 100 * (max(lv_ml) - min(case when lv_ml > 0 then lv_ml end)) / max(lv_ml) <= 55 then 'mid' else 'normal' end as region from lv_curve group by patient_id",
    "F20_p_text": "select model, case when p < 0.001 then '<0.001' else cast(round(p, 3) as string) end as p_text from (select model, avg(1 - dice_lv) / 2 as p from frame_metrics group by model) t",
    "F31_in_distribution": "select distinct f.model, s.vendor, d.vendor is not null as in_distribution from frame_metrics f join subjects s on f.patient_id = s.patient_id left join (select 'model_a' as model, 'EUROPE' as vendor union all select 'model_r', 'ASIA') d on d.model = f.model and d.vendor = s.vendor",
}
_PAIRS = "select a.lv as x, b.lv as y from (" + PATIENT + ") a join (" + PATIENT + ") b on a.patient_id = b.patient_id where a.model = 'model_a' and b.model = 'model_r'"
PLANS["A37_icc"] = """select n, round((msr - mse) / (msr + mse + 2 * (msc - mse) / n), 6) as icc from (select n, ssr / (n - 1) as msr, ssc as msc, (sst - ssr - ssc) / (n - 1) as mse from (
    select count(*) as n, sum(2 * ((x + y) / 2 - g) * ((x + y) / 2 - g)) as ssr, sum((x - g) * (x - g) + (y - g) * (y - g)) as sst, count(*) * ((avg(x) - avg(g)) * (avg(x) - avg(g)) + (avg(y) - avg(g)) * (avg(y) - avg(g))) as ssc
    from (select x, y, g from (""" + _PAIRS + ") p cross join (select avg((x + y) / 2) as g from (" + _PAIRS + ") m) w) q) r) s"
