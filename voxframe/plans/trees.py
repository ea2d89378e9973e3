"""Queries on folder trees that are written, walked with pruning and turned into sheets, and sheets behind a gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files, trees
from ..sources.staging import settled
from ..tables import sql
from .runs import PICKS

# fixed values: folders without masks, and the folders of architectures
BULKY = ["postprocess", "previews", "metrics", "features", "comparison", "pipeline_info", "debug", "preprocessed"]
ARCHITECTURES = ["cinema", "nnformer", "vsa3l", "atrial_nnunet"]
ALLOWED = ["cinema", "nnformer"]

MASKS = "select distinct path from mask_files"
# every second patient has a manifest beside its masks of a model
MANIFESTS = """select distinct concat(regexp_extract(path, '^(.*/)', 1), regexp_extract(path, '([^/]*)_(?:ED|ES|frame[0-9]+)_', 1), '_', regexp_extract(path, '_(?:ED|ES|frame[0-9]+)_(.*)[.]nii', 1), '_manifest.json') as path,
    cast(regexp_extract(path, '([0-9]+)_(?:ED|ES|frame[0-9]+)_', 1) as int) as pid from mask_files"""
FOLDERS = """select concat('training/patient', lpad(cast(c_custkey as string), 6, '0'), '/', case k when 0 then concat('patient', lpad(cast(c_custkey as string), 6, '0'), '_4d.nii.gz') when 1 then 'Info.cfg' else 'notes.txt' end) as path
    from customer cross join RANGE(k, 3) k where (k = 0 and c_custkey % 5 <> 0) or (k = 1 and c_custkey % 3 <> 0) or k = 2"""
# frames that the reference has; of odd patients some miss a frame
ANNOTATED = f"select patient_id, patient_id % 2 as half, ed, es, case when patient_id % 42 = 1 then ed else es end as other from ({PICKS}) p"


def mask_tree(spark: SparkSession, d: str) -> DataFrame:
    """Masks and manifests written as files and found again by a walk that leaves out bulky folders and other architectures."""
    at = files.shared_folder(spark, "tree")
    masks = sql(spark, d, MASKS).select("path", F.lit("").alias("content"))
    manifests = sql(spark, d, MANIFESTS).filter("pid % 2 = 0")
    text = F.format_string('{"frames": [{"tag": "ED", "idx": %d}, {"tag": "ES", "idx": %d}]}', F.col("pid") % 7, F.col("pid") % 7 + 9)
    trees.write_tree(masks.unionByName(manifests.select("path", text.alias("content"))), at)
    found = settled(trees.read_tree(spark, at, BULKY, ARCHITECTURES, ALLOWED, "_manifest.json"), "files")  # one walk for masks and manifests
    return trees.mask_frames(found, ALLOWED)


def case_tree(spark: SparkSession, d: str) -> DataFrame:
    """A folder for each patient, some without an image or an Info.cfg, as a sheet."""
    at = files.shared_folder(spark, "cases")
    trees.write_tree(sql(spark, d, FOLDERS).withColumn("content", F.lit("")), at)
    return trees.case_sheet(trees.read_tree(spark, at))


def manifest_files(spark: SparkSession, d: str) -> DataFrame:
    """A manifest file for each patient, with its text as it lies there."""
    at = files.shared_folder(spark, "manifest-files")
    picked = sql(spark, d, f"select patient_id, 'ED' as tag, ed as idx from ({PICKS}) p union all select patient_id, 'ES', es from ({PICKS}) q")
    texts = files.manifest_json(picked, ["patient_id"]).select(F.concat(F.lit("p"), "patient_id", F.lit("_manifest.json")).alias("path"), F.col("manifest").alias("content"))
    trees.write_tree(texts, at)
    return trees.read_tree(spark, at, content="_manifest.json").select("name", "length", F.col("content").alias("manifest"))


def gated_sheet(spark: SparkSession, d: str) -> DataFrame:
    """Each half's sheet appears with its Info.cfg files only if all of its patients are annotated on the frames they name.

    Rows of a sheet that appeared, with frames read from its Info.cfg; of one that did not, one row with the number of problems.
    """
    at, out = files.shared_folder(spark, "gated"), None
    rows = sql(spark, d, ANNOTATED).withColumn("info_cfg", F.concat(F.lit("p"), "patient_id", F.lit("/Info.cfg")))
    same = F.array_sort(F.array_distinct(F.array("ed", "es"))) == F.array_sort(F.array_distinct(F.array("ed", "other")))
    trees.write_tree(rows.filter(same).select(F.col("info_cfg").alias("path"), files.info_text({"ED": F.col("ed") + 1, "ES": F.col("es") + 1}).alias("content")), f"{at}/cfg")
    cfg = trees.read_tree(spark, f"{at}/cfg", content="Info.cfg").select(F.col("path").alias("info_cfg"), files.info_frame(F.col("content"), "ED").alias("ed"), files.info_frame(F.col("content"), "ES").alias("es"))
    for half in (0, 1):
        bad = trees.publish(rows.filter(F.col("half") == half), f"{at}/sheet{half}", same)
        sheet = files.first_source(spark, [f"{at}/sheet{half}"])
        if sheet is None:
            one = spark.range(1).select(F.lit(half).alias("half"), F.lit(bad).cast("long").alias("problems"), F.lit(None).cast("long").alias("patient_id"), F.lit(None).cast("int").alias("ed"), F.lit(None).cast("int").alias("es"))
        else:
            one = sheet.select("patient_id", "info_cfg").join(cfg, "info_cfg").select(F.lit(half).alias("half"), F.lit(bad).cast("long").alias("problems"), F.col("patient_id").cast("long").alias("patient_id"), "ed", "es")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {"S13_mask_tree": mask_tree, "S14_case_tree": case_tree, "S07_manifest_files": manifest_files, "S21_gated_sheet": gated_sheet}

_named = r"regexp_extract(path, '([^/]*)_(ED|ES|frame[0-9]+)_(.*)[.]nii[.]gz$', N)"
_parts = ", ".join(f"{_named.replace('N', str(n))} as {c}" for n, c in ((1, "patient_id"), (3, "model"), (2, "frame_tag")))
ORACLES = {
    "S13_mask_tree": f"""with m as (select path, {_parts} from mask_files where path like 'cinema/%' or path like 'nnformer/%'),
        k as (select patient_id, model, frame_tag, min(path) as path from m where right(model, 3) <> '_pp' group by all)
        select patient_id, model, regexp_extract(model, '^(cinema|nnformer)', 1) as architecture, frame_tag,
        case when patient_id::int % 2 = 0 and frame_tag = 'ED' then patient_id::int % 7 when patient_id::int % 2 = 0 and frame_tag = 'ES' then patient_id::int % 7 + 9 when frame_tag = 'ED' then 0 when frame_tag = 'ES' then 1 else substr(frame_tag, 6)::int end as frame_idx, path
        from k where model like 'cinema%' or model like 'nnformer%'""",
    "S14_case_tree": """select 'patient' || lpad(c_custkey::varchar, 6, '0') as patient_id, 'training/patient' || lpad(c_custkey::varchar, 6, '0') || '/patient' || lpad(c_custkey::varchar, 6, '0') || '_4d.nii.gz' as image,
        'training/patient' || lpad(c_custkey::varchar, 6, '0') as ground_truth, case when c_custkey % 3 <> 0 then 'training/patient' || lpad(c_custkey::varchar, 6, '0') || '/Info.cfg' else '' end as info_cfg from customer where c_custkey % 5 <> 0""",
    "S07_manifest_files": f"""with f as (select patient_id, 'ED' as tag, ed as idx from ({PICKS}) p union all select patient_id, 'ES', es from ({PICKS}) q),
        t as (select patient_id, '{{"frames":[' || string_agg('{{"idx":' || idx || ',"tag":"' || tag || '"}}', ',' order by idx, tag) || ']}}' as manifest from f group by patient_id)
        select 'p' || patient_id || '_manifest.json' as name, length(manifest) as length, manifest from t""",
    "S21_gated_sheet": f"""with a as ({ANNOTATED}), h as (select half, count_if(other <> es and other <> ed or (other = ed and es <> ed)) as problems from a group by half)
        select h.half, problems, patient_id, ed, es from h join a on h.half = a.half where problems = 0 union all select half, problems, null, null, null from h where problems > 0""",
}
