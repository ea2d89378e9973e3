"""Exact deduplication by skew-safe combining, with DataFrame functions alone.

Copies are merged in three steps that all compare the whole text: inside each task (the partial aggregate), per
salt, and over the salt winners. A text that a third of all rows share thus reaches the last step as at most
`salts` rows. Members then look up their class by its fingerprint; the few classes that hold more than a thousandth of
all copies each are broadcast, so their members stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, staged

SALTS = 16


def _salt(id_col: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(salts))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Of equal texts the largest doc_id stays; a null doc_id is smaller than any other,
    and rows that repeat the same doc_id and text are all marked kept. An empty table gives no rows. Other columns are
    ignored, whatever their names. Two different texts with equal SHA-256, xxHash64 and length raise an error.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = d.withColumns({"digest": F.unhex(F.sha2("text", 256)), "check": F.xxhash64("text"), "size": F.length("text")})
    salted = d.groupBy(_salt(F.col("doc_id"), salts).alias("salt"), "digest", "check", "size", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    texts = salted.groupBy("digest", "check", "size", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    # one row per fingerprint unless fingerprints collide: texts were compared whole above
    classes = texts.groupBy("digest", "check", "size").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.count("*").alias("texts"))
    classes = classes.filter(F.when(F.col("texts") > 1, F.raise_error(F.lit("different texts share SHA-256, xxHash64 and length"))).otherwise(F.col("group_size")) > 1).drop("texts")
    held = staged(classes.withColumn("n", F.col("group_size")), "classes")
    members = lookup(d.select("doc_id", "digest", "check", "size"), held, ["digest", "check", "size"], "n", ["doc_id", "digest"], "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return members.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns: of equal texts the row with the largest doc_id.

    Ties in doc_id are broken by the other columns, so repeated rows leave one. Null text counts as empty, and the row
    that stays keeps its null. Columns that can't be ordered (maps) are not supported.
    """
    names = docs.columns
    others = [c for c in names if c not in (id_col, text_col)]
    row = F.struct(F.col(id_col).alias("k0"), F.col(text_col).isNotNull().alias("k1"), *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(others, 2)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"), _salt(F.col(id_col), salts).alias("salt"), row.alias("row"))
    best = d.groupBy("salt", "digest", "text").agg(F.max("row").alias("row")).groupBy("digest", "text").agg(F.max("row").alias("row"))
    place = {id_col: F.col("row.k0"), text_col: F.when(F.col("row.k1"), F.col("text"))} | {c: F.col(f"row.k{i}") for i, c in enumerate(others, 2)}
    return best.select(*(place[c].alias(c) for c in names))
