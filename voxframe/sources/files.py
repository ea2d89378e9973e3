"""Readers and writers of the files that a segmentation run leaves: sheets, manifests, key-value texts, packed volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import shared_folder as shared_folder


def read_sheet(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A CSV sheet with a header; all columns are texts, and blank cells are null."""
    raw = spark.read.option("header", True).csv(paths)
    return raw.select(*(F.nullif(F.trim(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns))


def read_sheets(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several sheets as one table; a column that a sheet lacks is null there. One read a sheet, as headers may differ."""
    out = read_sheet(spark, paths[0])
    for path in paths[1:]:
        out = out.unionByName(read_sheet(spark, path), allowMissingColumns=True)
    return out


def sheet_problems(sheet: DataFrame, required: list[str], patterns: dict[str, str]) -> DataFrame:
    """One row (column, problem, n) for every kind of violation; a missing column counts once."""
    missing = [c for c in required if c not in sheet.columns]
    checks = [(c, "empty", F.col(c).isNull()) for c in required if c in sheet.columns]
    checks += [(c, "pattern", F.col(c).isNotNull() & ~F.col(c).rlike(p)) for c, p in patterns.items() if c in sheet.columns]
    entry = lambda c, w, n: F.struct(F.lit(c).alias("column"), F.lit(w).alias("problem"), n.cast("long").alias("n"))
    found = [entry(c, "missing", F.lit(1)) for c in missing] + [entry(c, w, F.count_if(bad)) for c, w, bad in checks] + [entry("", "no rows", F.when(F.count("*") == 0, 1).otherwise(0))]
    return sheet.agg(F.array(*found).alias("a")).select(F.inline("a")).filter("n > 0")


def first_present(sheet: DataFrame, names: list[str], kind: str) -> Column:
    """The first of several spellings of a column that the sheet has; what doesn't parse is null."""
    have = {c.lower().strip(): c for c in sheet.columns}
    hit = next((have[n.lower()] for n in names if n.lower() in have), None)
    return (F.lit(None) if hit is None else F.col(f"`{hit}`").try_cast(kind)).cast(kind)


def manifest_json(frames: DataFrame, keys: list[str]) -> DataFrame:
    """One JSON text a group: its frames (tag, idx) in order of index, then tag."""
    f = F.sort_array(F.collect_list(F.struct(F.col("idx"), F.col("tag"))))
    return frames.groupBy(*keys).agg(F.to_json(F.struct(f.alias("frames"))).alias("manifest"))


def manifest_frames(manifests: DataFrame, keys: list[str]) -> DataFrame:
    """Frames of manifest texts; a null or broken text has none."""
    m = F.from_json("manifest", "frames array<struct<tag:string,idx:int>>")
    return manifests.select(*keys, F.explode(m["frames"]).alias("f")).select(*keys, "f.tag", "f.idx")


def info_text(pairs: dict[str, Column]) -> Column:
    """`key: value` lines."""
    return F.concat_ws("\n", *(F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in pairs.items()))


def info_value(text: Column, key: str) -> Column:
    """The value of a key in `key: value` lines, as text; null if it isn't there."""
    return F.nullif(F.regexp_extract(text, rf"(?m)^\s*{key}\s*:[ \t]*(.*?)\s*$", 1), F.lit(""))


def info_frame(text: Column, key: str) -> Column:
    """A frame number, counted from 1 in the file, as an index from 0; null if missing, not a number, or under 1."""
    n = info_value(text, key).try_cast("int")
    return F.when(n >= 1, n - 1)


def packed(voxels: DataFrame, keys: list[str], size: tuple[int, int, int]) -> DataFrame:
    """One row a slice with its labels as an array in the order y, x: rows stay bounded by the slice, not the volume."""
    at = F.col("y") * size[2] + F.col("x")
    return voxels.groupBy(*keys, "z").agg(F.transform(F.sort_array(F.collect_list(F.struct(at.alias("at"), "label"))), lambda s: s["label"]).alias("labels"))


def unpacked(slices: DataFrame, keys: list[str], size: tuple[int, int, int]) -> DataFrame:
    """Voxel rows of packed slices."""
    rows = slices.select(*keys, "z", F.posexplode("labels").alias("at", "label"))
    return rows.select(*keys, "z", F.floor(F.col("at") / size[2]).cast("int").alias("y"), (F.col("at") % size[2]).alias("x"), "label")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file under a folder, read by executors."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def first_source(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The sheets of the first path (a file or folder) that exists; None if none does. Spark's file system is asked."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(hadoop).exists(at):
            return read_sheet(spark, path)
    return None


def sniffed(spark: SparkSession, path: str) -> DataFrame:
    """A table whose header tells the separator: the one of tab, comma, semicolon and bar that it holds most. Cells as texts."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0].value if head else ""
    sep = max("\t,;|", key=line.count)
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    return raw.select(*(F.nullif(F.trim(f"`{c}`"), F.lit("")).alias(c.strip()) for c in raw.columns))


def key_values(texts: DataFrame, keys: list[str], text: str, names: list[str]) -> DataFrame:
    """One column per name from `key: value` texts; others are left out, missing ones null."""
    return texts.select(*keys, *(info_value(F.col(text), n).alias(n.lower()) for n in names))


def listing_sheet(listing: DataFrame, case: str, kinds: dict[str, list[str]]) -> DataFrame:
    """One row per case of a listing (case, path): for each kind of file the path of its first pattern that some file has.

    Patterns are tried in order; of several files that fit, the first by name. A kind that a case lacks is null.
    """
    def best(patterns: list[str]) -> Column:
        rank = F.when(F.lit(False), 0)
        for i, p in enumerate(patterns):
            rank = rank.when(F.col("path").rlike(p), i)
        return F.min(F.when(rank.isNotNull(), F.struct(rank.alias("r"), F.col("path").alias("p"))))["p"]

    return listing.groupBy(case).agg(*(best(p).alias(k) for k, p in kinds.items()))


def best_folder(folders: DataFrame, name: str, order: list[str]) -> DataFrame:
    """The folder whose name (without case) comes first in `order`; no row if none is listed."""
    rank = F.array_position(F.array(*(F.lit(o) for o in order)), F.lower(name))
    return folders.filter(rank > 0).agg(F.min_by(name, F.struct(rank, F.col(name))).alias(name)).filter(F.col(name).isNotNull())


def registry(texts: DataFrame, text: str = "value") -> DataFrame:
    """Enabled models of a registry's JSON text {name: {enabled, ...}}: name, architecture, folds, weights."""
    models = F.from_json(text, "map<string,struct<enabled:boolean,architecture:string,folds:array<int>,weights:string>>")
    return texts.select(F.explode(models).alias("model", "v")).filter("v.enabled").select("model", "v.architecture", "v.folds", "v.weights")


def looked_up(names: DataFrame, models: DataFrame, name: str = "model") -> DataFrame:
    """Models by name; a name that no enabled model has is an error."""
    found = names.join(models.withColumn("_is", F.lit(True)), name, "left")
    sure = F.when(F.col("_is"), F.col(name)).otherwise(F.raise_error(F.concat(F.lit("no such model: "), F.col(name))))
    return found.withColumn(name, sure).drop("_is")


def write_sheet(df: DataFrame, path: str, by: list[str] | None = None, compressed: bool = False) -> None:
    """A CSV sheet with a header, a folder for each value of `by`, and gzip if asked for."""
    w = df.write.option("header", True).option("compression", "gzip" if compressed else "none")
    (w.partitionBy(*by) if by else w).csv(path)


def markdown_lines(df: DataFrame, order: list[str], note: str = "") -> DataFrame:
    """The lines of a Markdown table, numbered: header, rule, rows in `order`, and a footnote. Columns must be texts."""
    from pyspark.sql import Window

    def line(cells: list) -> Column:
        return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))

    spark = df.sparkSession
    body = df.select((F.row_number().over(Window.orderBy(*order)) + 1).alias("n"), line([F.coalesce(F.col(c), F.lit("")) for c in df.columns]).alias("line"))  # a table for people
    head = [(0, "| " + " | ".join(df.columns) + " |"), (1, "|" + "---|" * len(df.columns))]
    out = spark.createDataFrame(head, "n int, line string").unionByName(body)
    return out.unionByName(spark.createDataFrame([(1 << 30, note)], "n int, line string")) if note else out


def json_summary(df: DataFrame, group: list[str], order: str, fields: list[str]) -> DataFrame:
    """One JSON text per group, its rows in order, with an id of 12 digits that its content gives."""
    rows = F.array_sort(F.collect_list(F.struct(order, *(f for f in fields if f != order))))
    out = df.groupBy(*group).agg(F.to_json(F.struct(*(F.col(g) for g in group), rows.alias("rows"))).alias("json"))
    return out.withColumn("id", F.substring(F.md5("json"), 1, 12))


def digest_of(files: DataFrame, group: list[str]) -> DataFrame:
    """SHA-256 per group over its files' paths and digests in order of path: the same files give the same digest."""
    parts = F.array_sort(F.collect_list(F.struct("path", "sha256")))
    return files.groupBy(*group).agg(F.count("*").alias("files"), F.sha2(F.concat_ws("\n", F.transform(parts, lambda p: F.concat_ws(" ", p["sha256"], p["path"]))), 256).alias("sha256"))


def run_summaries(spark: SparkSession, paths: dict[str, list[str]], references: str = "") -> DataFrame:
    """Summaries (JSON lines) of runs by family, with `mode` run, and of references `label=path,...` with mode reference."""
    shape = "run string, models int, cpu_hours double, patients int"
    parts = [(family, "run", p) for family, ps in paths.items() for p in ps]
    parts += [(e.split("=", 1)[0].strip(), "reference", e.split("=", 1)[1].strip()) for e in references.split(",") if "=" in e]
    out = None
    for family, mode, p in parts:
        one = spark.read.schema(shape).json(p).select(F.lit(family).alias("family"), F.lit(mode).alias("mode"), "run", "models", "cpu_hours", "patients")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], f"family string, mode string, {shape}")


def pruned(paths: DataFrame, bulky: list[str], allowed: list[str]) -> DataFrame:
    """Paths whose first folder is allowed and that lie in no bulky folder."""
    first = F.split_part("path", F.lit("/"), F.lit(1))
    inside = F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(1)))
    return paths.filter(first.isin(allowed) & ~F.arrays_overlap(inside, F.array(*(F.lit(b) for b in bulky))))
