"""Plans over catalogues, frame curves, headers and run traces. One text runs in Spark and in the check."""

PARTS = "select path, regexp_extract(path, '([0-9]+)_', 1) as patient_id, regexp_extract(path, '_(ED|ES|frame[0-9]+)_', 1) as tag, regexp_extract(path, '_(?:ED|ES|frame[0-9]+)_(.*)[.]nii', 1) as model from mask_files"
SECONDS = "60.0 * cast(regexp_extract(realtime, '([0-9]+)m', 1) as int) + cast(regexp_extract(realtime, '([0-9]+)s', 1) as int)"
GB = "cast(regexp_extract(peak_rss, '([0-9]+)', 1) as int) / 1024.0"
RUNS = f"select name, status, label, attempt, cpus, {SECONDS} as s, {GB} as gb from trace"


def even_frames(k: int, curves: str = "lv_curve") -> str:
    """k of each patient's n_frames frames at even distances, rounded half to even, first and last kept; all where n_frames <= k.

    One frame is the first. Steps are whole numbers over 2 (k - 1), so that halves are exact.
    """
    d = max(2 * (k - 1), 1)
    at = f"(2 * i * (n - 1) + {k - 1})"
    half = f"case when {at} % {d} = 0 and (({at} - {at} % {d}) / {d}) % 2 = 1 then 1 else 0 end"
    picked = f"select distinct patient_id, cast(({at} - {at} % {d}) / {d} - {half} as int) as frame_index from (select distinct patient_id, n_frames as n from {curves}) c cross join RANGE(i, {k}) i where n > {k}"
    return f"select c.patient_id, c.frame_index from {curves} c left join ({picked}) e on c.patient_id = e.patient_id and c.frame_index = e.frame_index where c.n_frames <= {k} or e.frame_index is not null"


PLANS = {
    "S13_mask_catalogue": f"select patient_id, model, tag, min(path) as path from ({PARTS}) p where path not like 'previews/%' group by patient_id, model, tag",
    "S22_model_variants": f"select model, case when model like '%seed%' then try_cast(regexp_extract(model, 'seed([0-9]+)', 1) as double) end as seed, case when model like '%fold%' then try_cast(regexp_extract(model, 'fold([0-9]+)', 1) as double) end as fold, count(*) as files from ({PARTS}) p group by model",
    "S25_missing_modalities": f"select e.patient_id, e.tag from (select * from (select distinct patient_id from ({PARTS}) a) i cross join (select distinct tag from ({PARTS}) b where tag in ('ED', 'ES')) t) e left join (select distinct patient_id, tag from ({PARTS}) c) f on e.patient_id = f.patient_id and e.tag = f.tag where f.tag is null",
    "P01_branch": "select path, case when path like 'postprocess/%' then 'prepare' else 'ready' end as branch from mask_files",
    "P03_preview_frames": f"select path from ({PARTS}) p where tag in ('ED', 'ES') or tag = 'frame00'",
    "P04_architecture_filter": f"select path, split_part(model, '__', 1) as architecture from ({PARTS}) p where split_part(model, '__', 1) <> 'vsa3l'",
    "P12_series_filter": "select exam, series from (select exam, series, concat('sax_', cast(series as string)) as description from series_headers) h where regexp_extract(description, '(sax)', 1) <> '' and regexp_extract(description, '(_1)', 1) = ''",
    "P16_mask_source": f"select p.patient_id, p.tag, coalesce(q.path, p.path) as path from ({PARTS}) p left join (select patient_id, tag, min(path) as path from ({PARTS}) z where model like '%pp' group by patient_id, tag) q on p.patient_id = q.patient_id and p.tag = q.tag where p.model = 'nnformer__fold0'",
    "P17_bounded_index": "select patient_id, max(least(greatest(frame_index + 3, 0), n_frames - 1)) as last from lv_curve group by patient_id",
    "J01_outer_coalesce": "select s.patient_id, coalesce(m.n, 0) as frames from subjects s left join (select patient_id, count(*) as n from frame_metrics where hd95_lv < 26 group by patient_id) m on s.patient_id = m.patient_id",
    "J02_context_join": f"select p.path, c_nationkey as site from ({PARTS}) p join customer on cast(p.patient_id as bigint) = c_custkey",
    "J03_patients_by_variants": "select s.patient_id, v.model from subjects s cross join (select distinct model from frame_metrics) v",
    "J04_tag_lookup": f"select p.path, coalesce(t.idx, 0) as idx from ({PARTS}) p left join (select 'ED' as tag, 0 as idx union all select 'ES', 11) t on p.tag = t.tag",
    "J10_catalogue_sheet": f"select p.patient_id, p.model, count(*) as n from ({PARTS}) p join (select c_custkey from customer where c_mktsegment <> '') s on cast(p.patient_id as bigint) = s.c_custkey group by p.patient_id, p.model",
    "J11_missing_subjects": "select count(*) as frames, count_if(s.vendor is null) as missing from frame_metrics m left join subjects s on m.patient_id = s.patient_id",
    "J23_geometry_mates": "select exam, max_by(series, mates * 10 - series) as chosen, max(mates) as mates from (select a.exam, a.series, count(*) as mates from series_headers a join series_headers b on a.exam = b.exam and a.n_rows = b.n_rows and a.n_cols = b.n_cols and abs(a.position_mm - b.position_mm) <= 0.001 group by a.exam, a.series) t group by exam",
    "J25_preferred_merge": "select coalesce(a.patient_id, b.patient_id) as patient_id, round(coalesce(a.v, b.v), 6) as v from (select patient_id, avg(dice_lv) as v from frame_metrics where model = 'model_a' group by patient_id) a full outer join (select patient_id, avg(dice_lv) as v from frame_metrics where model = 'model_n' group by patient_id) b on a.patient_id = b.patient_id",
    "W01_ed_es": "select patient_id, max_by(frame_index, lv_ml * 1000 - frame_index) as ed, min_by(frame_index, lv_ml * 1000 + frame_index) as es, round(100 * (max(lv_ml) - min(lv_ml)) / max(lv_ml), 6) as ef, cast(count(*) as bigint) as valid from lv_curve where lv_ml > 0 group by patient_id having count(*) >= 2",
    "W02_local_minima": "select patient_id, cast(sum(case when lv_ml < before and lv_ml < after then 1 else 0 end) as bigint) as minima from (select patient_id, lv_ml, coalesce(lag(lv_ml) over w, last_value(lv_ml) over (partition by patient_id order by frame_index rows between unbounded preceding and unbounded following)) as before, coalesce(lead(lv_ml) over w, first_value(lv_ml) over (partition by patient_id order by frame_index rows between unbounded preceding and unbounded following)) as after from lv_curve where lv_ml > 0 window w as (partition by patient_id order by frame_index)) t group by patient_id",
    "W04_first_per_key": f"select patient_id, model, tag, path from (select *, row_number() over (partition by patient_id, model, tag order by path) as rn from ({PARTS}) p) t where rn = 1",
    "W05_latest_series": "select exam, position_mm, series from (select exam, position_mm, series, dense_rank() over (partition by exam, position_mm order by series_time desc) as r from series_headers) t where r = 1 group by exam, position_mm, series",
    "W06_cine_order": "select exam, series, instance, dense_rank() over (partition by exam, series order by position_mm) as slice, row_number() over (partition by exam, series, position_mm order by trigger_ms, instance) as frame from series_headers",
    "W07_series_choice": "select exam, max_by(series, n * 10 - series) as series, max(n) as files from (select exam, series, count(*) as n from series_headers group by exam, series) t group by exam",
    "W08_even_subsampling": even_frames(4),
    "W13_variant_choice": f"select family, min_by(model, priority) as model from (select distinct split_part(model, '__', 1) as family, model, case when model like '%seed0' then 0 when model like '%seed%' then 1 + try_cast(regexp_extract(model, 'seed([0-9]+)', 1) as int) else 50 + length(model) end as priority from ({PARTS}) p) t group by family",
    "W14_ensembles": f"select dataset, count(*) as seeds from (select distinct regexp_extract(model, '__([a-z]+)_seed', 1) as dataset, regexp_extract(model, 'seed([0-9]+)', 1) as seed from ({PARTS}) p where model like '%seed%') t group by dataset having count(*) > 1",
    "T02_frame_order": f"select tag, cast(row_number() over (order by case tag when 'ED' then 0 when 'ES' then 1 else 2 end, tag) as int) as place from (select distinct tag from ({PARTS}) p) t",
    "T03_top_processes": f"select name, round(sum(s) / 3600, 6) as hours from ({RUNS}) r group by name order by hours desc, name limit 12",
    "F02_name_parts": PARTS,
    "F03_tag_index": f"select path, case tag when 'ED' then 0 when 'ES' then 1 else try_cast(substr(tag, 6) as int) end as idx from ({PARTS}) p",
    "F04_architecture": f"select distinct model, split_part(model, '__', 1) as architecture from ({PARTS}) p",
    "F05_model_tag": f"select distinct model, regexp_extract(model, '__([a-z]+)', 1) as dataset, regexp_extract(model, 'seed([0-9]+)', 1) as seed, regexp_extract(model, 'fold([0-9]+)', 1) as fold from ({PARTS}) p",
    "F07_family_key": f"select distinct model, regexp_replace(model, '_(ensemble|seeds?[0-9]+|fold[0-9]+)(_pp)?$', '') as family from ({PARTS}) p",
    "F13_durations": f"select name, realtime, {SECONDS} as seconds from trace",
    "F14_memory": f"select name, peak_rss, round({GB}, 6) as gb from trace",
    "F17_phase": "select path, case when regexp_extract(path, '_(ED)_', 1) <> '' then 'ED' when regexp_extract(path, '_(ES)_', 1) <> '' then 'ES' else 'frame' end as phase from mask_files",
    "F18_selection_key": f"select patient_id, substr(md5(concat_ws('|', patient_id, 'auto', cast(count(*) as string))), 1, 8) as selection from ({PARTS}) p group by patient_id",
    "A40_execution": f"select count(*) as total, count_if(status = 'COMPLETED') as completed, count_if(status = 'FAILED') as failed, round(avg(case when attempt > 1 then 1.0 else 0.0 end), 6) as retry_rate, round(sum(s * cpus) / 3600, 6) as cpu_h, round(sum(s * gb) / 3600, 6) as gb_h from ({RUNS}) r",
    "A42_task_profile": f"select name, count(*) as n, round(avg(s), 6) as mean_s, round(PCT(cast(s as double), 0.5), 6) as median_s, round(PCT(cast(s as double), 0.95), 6) as p95_s, round(avg(gb), 6) as rss, round(max(gb), 6) as rss_max from ({RUNS}) r group by name",
    "A43_gpu_profile": f"select name, count_if(label = 'process_gpu') as gpu_tasks, round(avg(case when label = 'process_gpu' then 1.0 else 0.0 end), 6) as share, round(sum(case when label = 'process_gpu' then s else 0 end) / 3600, 6) as hours from ({RUNS}) r group by name",
    "A44_scientific": "select count(distinct patient_id) as patients, count(distinct model) as models, round(max(m) - min(m), 6) as spread from (select patient_id, model, avg(dice_lv) over (partition by model) as m from frame_metrics) t",
    "A45_run_comparison": f"select label, round(sum(case when status = 'COMPLETED' then s end) / 3600, 6) as done_h, round(sum(case when status = 'FAILED' then s end) / 3600, 6) as failed_h from ({RUNS}) r group by label",
}
