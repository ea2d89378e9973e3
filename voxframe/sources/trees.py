"""Folder trees as tables and back, and sheets that appear only when all of their rows are sound."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, name string, length long, content string"


def _names(text: str | None) -> set[str]:
    return {n.strip().lower() for n in (text or "").split(",") if n.strip()}


class _Walk(InputPartition):
    """Folders to walk, and folders of which only the own files are wanted, each with whether it is the root."""

    def __init__(self, folders: list[str], own: list[tuple[str, bool]]):
        super().__init__((folders, own))


class _TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.parts = options["path"], int(options.get("partitions", "64"))
        self.skip, self.keep, self.of = _names(options.get("skip")), _names(options.get("allowed")), _names(options.get("among"))
        self.content = options.get("contentsuffix", options.get("contentSuffix", ""))

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def _children(self, system, folder: str, root: bool) -> tuple[list[str], list]:
        """Folders to go into and files of one folder, by name; a pruned folder is never opened."""
        from pyarrow import fs

        found = sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda i: i.base_name)
        names = [(i, i.base_name.lower()) for i in found if i.type == fs.FileType.Directory]
        into = [i.path for i, n in names if n not in self.skip and not (root and self.keep and n in self.of and n not in self.keep)]
        return into, [i for i in found if i.type == fs.FileType.File]

    def partitions(self) -> list[InputPartition]:
        """The upper folders are opened one after the other until there are enough of them to deal out."""
        system, root = self._system()
        todo, opened, first = [root], [], True
        while todo and len(todo) < self.parts and len(opened) < self.parts:
            folder = todo.pop(0)
            into, _ = self._children(system, folder, first)
            opened.append((folder, first))
            todo += into
            first = False
        return [_Walk(todo[i :: self.parts], opened[i :: self.parts]) for i in range(self.parts)]

    def read(self, partition: _Walk) -> Iterator[tuple]:
        system, root = self._system()
        folders, own = partition.value
        for folder, first in own:
            yield from self._rows(system, root, self._children(system, folder, first)[1])
        while folders:
            into, files = self._children(system, folders.pop(), False)
            folders += reversed(into)
            yield from self._rows(system, root, files)

    def _rows(self, system, root: str, files: list) -> Iterator[tuple]:
        for i in files:
            text = None
            if self.content and i.base_name.endswith(self.content):
                with system.open_input_stream(i.path) as f:
                    text = f.read().decode("utf-8", "replace")
            yield i.path[len(root) :].lstrip("/"), i.base_name, i.size, text


class TreeSource(DataSource):
    """Files of a folder tree: path below the root, name, length, and the content of names that end in `contentSuffix`.

    Options: `skip`, names of folders that are never opened at any depth; `among` and `allowed`, top folders of which only those
    in `allowed` are opened (all, if it is empty); `partitions`, over how many tasks the walk is dealt (the driver opens at most so many
    folders to find what to deal). Names are compared without case. The path is one that pyarrow's file systems know, on storage that executors share.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _TreeReader(self.options)


def _written(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    (system, base), made = fs.FileSystem.from_uri(root), set()
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at = f"{base}/{path}"
            folder = at.rpartition("/")[0]
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            with system.open_output_stream(at) as f:
                f.write((content or "").encode())
        yield batch.select([0])


def write_tree(texts: DataFrame, root: str) -> None:
    """One small file per row (path below the root, content; null: empty). Rows are dealt over all partitions; a task run again writes the same."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts.select("path", "content").repartition(parts, "path").mapInArrow(lambda batches: _written(batches, root), "path string").write.format("noop").mode("overwrite").save()


def read_tree(spark: SparkSession, path: str, skip: list[str] = (), among: list[str] = (), allowed: list[str] = (), content: str = "") -> DataFrame:
    """The files of a tree, with folders pruned while it is walked."""
    spark.dataSource.register(TreeSource)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    return spark.read.format("folder_tree").options(skip=",".join(skip), among=",".join(among), allowed=",".join(allowed), contentSuffix=content, partitions=parts).load(path)


def mask_frames(tree: DataFrame, architectures: list[str]) -> DataFrame:
    """Masks `<patient>_<ED|ES|frameNN>_<model>.nii.gz` of a tree: patient_id, model, architecture, frame_tag, frame_idx, path.

    The tree has the content of `<patient>_<model>_manifest.json` files. Raw masks of the architectures only; of several files of one
    patient, model and frame the first by path stays. The index is that of the manifest beside the mask, else
    the number in the tag, else 1 for ES and 0 for others. Manifests that can't be read are passed over.
    """
    pattern = r"^(.*)_(ED|ES|frame\d{2,})_(.+)\.nii\.gz$"
    folder = F.regexp_replace("path", "[^/]*$", "")
    part = lambda n: F.regexp_extract("name", pattern, n)
    known = F.coalesce(*(F.when(part(3).startswith(a), F.lit(a)) for a in architectures))
    masks = tree.filter(F.col("name").rlike(pattern)).select(part(1).alias("patient_id"), part(3).alias("model"), known.alias("architecture"), part(2).alias("frame_tag"), folder.alias("_folder"), "path")
    masks = masks.filter(F.col("architecture").isNotNull() & ~F.col("model").endswith("_pp"))
    first = masks.groupBy("patient_id", "model", "frame_tag").agg(F.min_by(F.struct("architecture", "_folder", "path"), "path").alias("m")).select("patient_id", "model", "m.architecture", "frame_tag", "m._folder", "m.path")
    j = F.from_json("content", "frames array<struct<tag:string,idx:int>>")["frames"]
    listed = tree.filter(F.col("name").endswith("_manifest.json")).select(folder.alias("_folder"), F.regexp_replace("name", "_manifest[.]json$", "").alias("_of"), F.posexplode(j).alias("_at", "f"))
    listed = listed.groupBy("_folder", "_of", F.col("f.tag").alias("frame_tag")).agg(F.min_by("f.idx", "_at").alias("_idx"))
    own = F.coalesce(F.try_to_number(F.regexp_extract("frame_tag", r"^frame(\d+)", 1), F.lit("999999999")).cast("int"), F.when(F.col("frame_tag") == "ES", 1).otherwise(0))
    out = first.withColumn("_of", F.concat_ws("_", "patient_id", "model")).join(listed, ["_folder", "_of", "frame_tag"], "left")
    return out.select("patient_id", "model", "architecture", "frame_tag", F.coalesce("_idx", own).alias("frame_idx"), "path")


def case_sheet(tree: DataFrame) -> DataFrame:
    """Sheet of folders `patient*` that hold `<folder>_4d.nii.gz`: patient_id, image, ground_truth (the folder), info_cfg ('' if none)."""
    case, inside = F.regexp_extract("path", r"^(?:.*/)?(patient[^/]*)/[^/]+$", 1), F.regexp_replace("path", "/[^/]*$", "")
    own = tree.select("path", "name", case.alias("patient_id"), inside.alias("ground_truth")).filter("patient_id <> ''")
    image = F.max(F.when(F.col("name") == F.concat("patient_id", F.lit("_4d.nii.gz")), F.col("path")))
    sheet = own.groupBy("patient_id", "ground_truth").agg(image.alias("image"), F.coalesce(F.max(F.when(F.col("name") == "Info.cfg", F.col("path"))), F.lit("")).alias("info_cfg"))
    return sheet.filter("image is not null").select("patient_id", "image", "ground_truth", "info_cfg")


def publish(df: DataFrame, path: str, sound: Column) -> int:
    """Write a sheet to `path` if every row is sound; else leave nothing there. How many rows are not.

    One pass: rows go to a staged folder beside the target while violations are counted, and the folder is renamed when there are
    none. A null counts as a violation. A target that exists is an error, before anything is written.
    """
    spark = df.sparkSession
    jvm, staged = spark._jvm.org.apache.hadoop.fs, f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    target, source = jvm.Path(path), jvm.Path(staged)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target):
        raise FileExistsError(path)
    seen = Observation()
    try:
        df.observe(seen, F.count_if(~F.coalesce(sound, F.lit(False))).alias("bad")).write.option("header", True).csv(staged)
        bad = int(seen.get["bad"])
        if bad == 0 and not system.rename(source, target):
            raise OSError(f"cannot rename {staged} to {path}")
    finally:
        if system.exists(source):
            system.delete(source, True)
    return bad
