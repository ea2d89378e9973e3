"""Plans over texts, geometry, listings and slices. One text runs in Spark and in the check."""

from .catalogue import PARTS
from .metrics import PATIENT

HEART = "select case_id, frame_tag, z, count_if(label = 3) as lv from vox_gt group by case_id, frame_tag, z having count_if(label > 0) > 0"
SLICE = "select p.case_id, p.frame_tag, p.model, p.z, count_if(p.label > 0) as pred, count_if(g.label > 0) as ref, count_if(p.label = 3 and g.label = 3) as tp, count_if(p.label = 3) + count_if(g.label = 3) as size, count_if(p.label <> g.label) as changed from vox_pred p join vox_gt g on p.case_id = g.case_id and p.frame_tag = g.frame_tag and p.z = g.z and p.y = g.y and p.x = g.x group by p.case_id, p.frame_tag, p.model, p.z"
SPACING = "select o_orderkey as k, case when o_orderkey % 5 = 0 then '1.25,1.25' when o_orderkey % 3 = 0 then '1.5;1.5;8' else concat(cast(o_orderkey % 4 as string), 'x1.5x10') end as t from orders"
THREE = "select k, t, regexp_replace(t, '[;x]', ',', 'g') as u from (" + SPACING + ") s"
POSITION = "select case_id, frame_tag, z, case when last_z = first_z then 0.5 when first_lv >= last_lv then (z - first_z) * 1.0 / (last_z - first_z) else (last_z - z) * 1.0 / (last_z - first_z) end as pos from (select case_id, frame_tag, z, min(z) over w as first_z, max(z) over w as last_z, first_value(lv) over (partition by case_id, frame_tag order by z) as first_lv, first_value(lv) over (partition by case_id, frame_tag order by z desc) as last_lv from (" + HEART + ") h window w as (partition by case_id, frame_tag)) t"
GATE = "not (abs(hd95_lv) < cast('Infinity' as double))"
# direction of rows and columns and the position of a slice, which lies off the normal's line; the normal is their cross product
ORIENTED = "select *, case when exam % 2 = 0 then 1.0 else 0.0 end as r1, case when exam % 2 = 0 then 0.0 else 0.6 end as r2, case when exam % 2 = 0 then 0.0 else 0.8 end as r3, case when exam % 2 = 0 then 0.0 else 1.0 end as c1, case when exam % 2 = 0 then 0.8 else 0.0 end as c2, case when exam % 2 = 0 then 0.6 else 0.0 end as c3, 12.0 + exam % 5 as p1, -7.0 + position_mm * -0.6 as p2, position_mm * 0.8 as p3 from series_headers"
DISTANCE = "round((r2 * c3 - r3 * c2) * p1 + (r3 * c1 - r1 * c3) * p2 + (r1 * c2 - r2 * c1) * p3, 6)"

PLANS = {
    "A27_off_heart": f"select model, sum(case when ref = 0 then pred else 0 end) as off_heart, sum(pred) as predicted, count(distinct case_id) as cases from ({SLICE}) s group by model",
    "A29_dice_by_third": f"select model, case when pos <= 1.0 / 3 then 'base' when pos <= 2.0 / 3 then 'mid' else 'apex' end as third, count(*) as n, round(avg(case when size > 0 then 2.0 * tp / size end), 6) as dice from ({SLICE}) s join ({POSITION}) p on s.case_id = p.case_id and s.frame_tag = p.frame_tag and s.z = p.z group by model, case when pos <= 1.0 / 3 then 'base' when pos <= 2.0 / 3 then 'mid' else 'apex' end",
    "A32_annotated_frames": "select case_id, z as frame_index, count_if(label <> 0) as voxels from vox_gt where frame_tag = 'ED' group by case_id, z having count_if(label <> 0) > 10",
    "A34_run_agreement": "select a.case_id, count_if(a.label <> b.label) = 0 as identical, round(avg(case when a.label = b.label then 1.0 else 0.0 end), 6) as agreement from vox_pred a join vox_pred b on a.case_id = b.case_id and a.frame_tag = b.frame_tag and a.z = b.z and a.y = b.y and a.x = b.x where a.model = 'model_a' and b.model = 'model_c' group by a.case_id",
    "A52_display_range": "select i.case_id, i.frame_tag, i.label, round(avg(case when hi > lo then least(greatest((intensity - lo) / (hi - lo), 0.0), 1.0) else 0.0 end), 6) as shown from vox_img i join (select case_id, frame_tag, PCT(intensity, 0.01) as lo, PCT(intensity, 0.99) as hi from vox_img group by case_id, frame_tag) r on i.case_id = r.case_id and i.frame_tag = r.frame_tag group by i.case_id, i.frame_tag, i.label",
    "A54_slice_maximum": "select case_id, frame_tag, z, round(avg(case when top > 0 then intensity / top else 0.0 end), 6) as mean from (select case_id, frame_tag, z, intensity, max(intensity) over (partition by case_id, frame_tag, z) as top from vox_img) t group by case_id, frame_tag, z",
    "J07_voxel_join": "select p.model, p.label, coalesce(g.label, 0) as ref, count(*) as n from vox_pred p full outer join (select * from vox_gt where label > 0) g on p.case_id = g.case_id and p.frame_tag = g.frame_tag and p.z = g.z and p.y = g.y and p.x = g.x group by p.model, p.label, coalesce(g.label, 0)",
    "J09_three_way": "select a.case_id, a.frame_tag, round(2.0 * count_if(a.label = 3 and b.label = 3) / nullif(count_if(a.label = 3) + count_if(b.label = 3), 0), 6) as ab, round(2.0 * count_if(a.label = 3 and g.label = 3) / nullif(count_if(a.label = 3) + count_if(g.label = 3), 0), 6) as ag, round(2.0 * count_if(b.label = 3 and g.label = 3) / nullif(count_if(b.label = 3) + count_if(g.label = 3), 0), 6) as bg from vox_pred a join vox_pred b on a.case_id = b.case_id and a.frame_tag = b.frame_tag and a.z = b.z and a.y = b.y and a.x = b.x join vox_gt g on a.case_id = g.case_id and a.frame_tag = g.frame_tag and a.z = g.z and a.y = g.y and a.x = g.x where a.model = 'model_a' and b.model = 'model_b' group by a.case_id, a.frame_tag",
    "J16_frame_match": "select a.case_id, a.frame_tag, b.frame_tag as matched from vox_img a join vox_img b on a.case_id = b.case_id and a.z = b.z and a.y = b.y and a.x = b.x group by a.case_id, a.frame_tag, b.frame_tag having count_if(abs(a.intensity - b.intensity) > 0.00000001 + 0.00001 * abs(b.intensity)) = 0",
    "J18_path_priority": f"select patient_id, tag, min_by(path, place) as path from (select patient_id, tag, path, cast(length(path) * 10 + case when path like '%pp.nii.gz' then 0 else 5 end as double) + row_number() over (partition by patient_id, tag order by path) / 1000000.0 as place from ({PARTS}) p) t group by patient_id, tag",
    "W03_slice_position": f"select case_id, frame_tag, z, round(pos, 6) as position from ({POSITION}) p",
    "W18_best_slice": f"select case_id, frame_tag, model, z, changed from (select *, row_number() over (partition by case_id, frame_tag, model order by changed desc, size desc, z) as r from ({SLICE}) s) t where r = 1",
    "W19_examples": f"select model, max_by(case_id, off * 1000000 - case_id) as case_id, max(off) as off_heart from (select model, case_id, sum(case when ref = 0 then pred else 0 end) as off from ({SLICE}) s group by model, case_id) t group by model having max(off) > 0",
    "F01_comma_list": "select event_id, case when length(a) > 0 then a end as first, case when length(b) > 0 then b end as second from (select event_id, lower(trim(split_part(t, ',', 1))) as a, lower(trim(split_part(t, ',', 2))) as b from (select event_id, concat(' ', upper(event_type), ' , ', case when event_id % 2 = 0 then '' else ' Fold' end) as t from events) s) r",
    "F06_variant_label": f"select distinct model, concat_ws(' ', upper(split_part(model, '__', 1)), case when model like '%seed%' then concat('seed ', regexp_extract(model, 'seed([0-9]+)', 1)) end, case when model like '%fold%' then concat('fold ', regexp_extract(model, 'fold([0-9]+)', 1)) end, case when right(model, 3) = '_pp' then 'post-processed' end) as name from ({PARTS}) p",
    "F08_safe_name": "select p_partkey, trim(both '_' from regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g')) as safe from part",
    "F12_spacing": f"select k, t, case when split_part(u, ',', 3) <> '' and try_cast(split_part(u, ',', 1) as double) > 0 and try_cast(split_part(u, ',', 2) as double) > 0 and try_cast(split_part(u, ',', 3) as double) > 0 then try_cast(split_part(u, ',', 1) as double) end as sx, case when split_part(u, ',', 3) <> '' and try_cast(split_part(u, ',', 1) as double) > 0 then try_cast(split_part(u, ',', 3) as double) end as sz from ({THREE}) s",
    "F15_percent": "select event_id, try_cast(replace(t, '%', '') as double) as share from (select event_id, case when event_id % 9 = 0 then '-' else concat(cast(event_id % 100 as string), '.5%') end as t from events) s",
    "F21_family": f"select distinct model, case when model like '%nnformer%' then 'nnformer' when model like '%cinema%' then 'cinema' when model like '%vsa3l%' then 'vsa3l' else 'other' end as family from ({PARTS}) p",
    "F23_slice_distance": f"select exam, series, instance, {DISTANCE} as distance, n_rows * n_cols as pixels from ({ORIENTED}) h",
    "F24_same_geometry": "select a.exam, count_if(abs(a.position_mm - b.position_mm) <= 0.001 + 0.00001 * abs(b.position_mm) and a.n_rows = b.n_rows and a.n_cols = b.n_cols) as mates from series_headers a join series_headers b on a.exam = b.exam group by a.exam",
    "F26_voxel_to_mm": "select case_id, frame_tag, round(min(10.0 * z - 5.0), 6) as z_mm, round(max(1.25 * y + 2.5), 6) as y_mm, round(avg(1.25 * x - 7.5), 6) as x_mm from vox_gt where label = 3 group by case_id, frame_tag",
    "F27_centre_crop": "select case_id, frame_tag, lo, hi, greatest(0, cast(floor((lo + hi - 8) / 2.0) as int)) as crop_from, least(12, greatest(0, cast(floor((lo + hi - 8) / 2.0) as int)) + 8) as crop_to from (select case_id, frame_tag, min(x) as lo, max(x) + 1 as hi from vox_gt where label > 0 group by case_id, frame_tag) b",
    "F28_anisotropy": f"select k, greatest(a, b, c) / least(a, b, c) > 3 as separate, case greatest(a, b, c) when c then 'z' when b then 'y' else 'x' end as axis from (select k, try_cast(split_part(u, ',', 1) as double) as a, try_cast(split_part(u, ',', 2) as double) as b, try_cast(split_part(u, ',', 3) as double) as c from ({THREE}) s) t where a > 0 and b > 0 and c > 0",
    "F29_one_hot": "select case_id, frame_tag, count_if(label = 1) as rv, count_if(label = 2) as myo, count_if(label = 3) as lv, count_if(label in (2, 3)) as epicardium, count_if(label > 0) as heart from vox_gt group by case_id, frame_tag",
    "F32_variant_name": f"select distinct model, concat(split_part(model, '__', 1), case when split_part(model, '__', 2) = '' then '' else concat(' (', replace(split_part(model, '__', 2), '_', ' '), ')') end) as name, case split_part(model, '__', 1) when 'cinema' then 0 when 'nnformer' then 1 else 2 end as place from ({PARTS}) p",
    "S14_case_sheet": f"select patient_id, max(case when tag = 'ED' then path end) as ed, max(case when tag = 'ES' then path end) as es, count(*) as files from ({PARTS}) p group by patient_id",
    "S15_image_priority": f"select patient_id, min_by(path, place) as image from (select patient_id, path, row_number() over (partition by patient_id order by case tag when 'ED' then 0 when 'ES' then 1 else 2 end, path) as place from ({PARTS}) p) t group by patient_id",
    "S17_layout_join": f"select i.patient_id, i.path as image, l.path as label_path from (select patient_id, min(path) as path from ({PARTS}) p where tag = 'ED' group by patient_id) i left join (select patient_id, min(path) as path from ({PARTS}) q where tag = 'ES' group by patient_id) l on i.patient_id = l.patient_id",
    "S18_overlap_flag": f"select s.patient_id, s.vendor, cast(m.lv >= 0.95 as int) as overlap from subjects s join (select patient_id, max(lv) as lv from ({PATIENT}) p group by patient_id) m on s.patient_id = m.patient_id",
    "S19_complete_cases": f"select patient_id from ({PARTS}) p group by patient_id having count_if(tag = 'ED') > 0 and count_if(tag = 'ES') > 0",
    "S21_gate": "select count(*) as n, count_if(lv_ml <= 0) as problems, count_if(lv_ml <= 0) = 0 as may_write from lv_curve",
    "P02_single_patient": "select * from lv_curve where patient_id = (select min(patient_id) from lv_curve)",
    "P05_with_reference": "select m.patient_id, m.model, m.frame_tag from frame_metrics m left join subjects s on m.patient_id = s.patient_id where s.pathology is not null",
    "P13_slice_gate": "select case_id, frame_tag, z, count_if(label > 0) as pixels from vox_gt group by case_id, frame_tag, z having count_if(label > 0) >= 20",
    "P14_result_filter": f"select model, patient_id, frame_tag, {GATE} as infinite from frame_metrics where dice_lv > 0.9 and frame_tag = 'ES' and model <> 'model_n'",
    "P14_finite_rows": f"select model, patient_id, frame_tag, round(hd95_lv, 6) as hd95_lv from frame_metrics where {GATE.replace('not ', '')} and dice_lv > 0.9 and frame_tag = 'ES' and model in ('model_a', 'model_r')",
    "P19_clean_up": "select case_id, frame_tag, sum(case when label - 2 < -1 then 0 else label - 2 end) as total from vox_gt group by case_id, frame_tag",
    "V16_crop_to_nonzero": "select i.case_id, i.frame_tag, count(*) as voxels, count_if(i.label = 0) as outside, round(avg(case when i.label = 0 then -1.0 else intensity end), 6) as mean from vox_img i join (select case_id, frame_tag, min(z) as z0, max(z) as z1, min(y) as y0, max(y) as y1, min(x) as x0, max(x) as x1 from vox_gt where label > 0 group by case_id, frame_tag) b on i.case_id = b.case_id and i.frame_tag = b.frame_tag where z between z0 and z1 and y between y0 and y1 and x between x0 and x1 group by i.case_id, i.frame_tag",
    "V15_paste_back": "select g.case_id, g.frame_tag, coalesce(p.label, 0) as label, count(*) as n from vox_gt g left join (select case_id, frame_tag, z, y - 2 as y, x - 2 as x, label from vox_gt where y >= 2 and x >= 2) p on g.case_id = p.case_id and g.frame_tag = p.frame_tag and g.z = p.z and g.y = p.y + 2 and g.x = p.x + 2 group by g.case_id, g.frame_tag, coalesce(p.label, 0)",
    "V22_relabel_statistics": "select p.case_id, p.frame_tag, p.model, count_if(p.label = 3) as before, count_if(p.label = 3 and i.intensity > 60) as after, count_if(p.label = 3 and i.intensity <= 60) as moved, round(avg(case when p.label = 3 and i.intensity <= 60 then i.intensity end), 6) as moved_mean from vox_pred p join vox_img i on p.case_id = i.case_id and p.frame_tag = i.frame_tag and p.z = i.z and p.y = i.y and p.x = i.x group by p.case_id, p.frame_tag, p.model",
    "V34_stability": "select case_id, frame_tag, fold, class, round(count_if(m > 8) / nullif(count_if(m > 4), 0), 6) as score from (select case_id, frame_tag, fold, class, p - avg(p) over (partition by case_id, frame_tag, z, y, x, fold) as m from vox_prob) t group by case_id, frame_tag, fold, class",
    "V35_soft_argmax": "select case_id, frame_tag, z, fold, class, round(sum(exp(0.2 * (p - top)) * y) / sum(exp(0.2 * (p - top))), 6) as soft_y, round(sum(exp(0.2 * (p - top)) * x) / sum(exp(0.2 * (p - top))), 6) as soft_x, max_by(y * 12 + x, p * 1000 - (y * 12 + x)) as hard from (select *, max(p) over (partition by case_id, frame_tag, z, fold, class) as top from vox_prob) t group by case_id, frame_tag, z, fold, class",
}
