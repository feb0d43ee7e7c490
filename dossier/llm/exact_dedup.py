"""Exact deduplication by a 128-bit content hash, with a comparison of bytes inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import numbered

#: White space that a normalised text holds as one space.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """The text with every run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE_RUN, " ")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """Group the rows of *docs* by normalised text; of each group the row with the smallest key stays.

    Returns one row per row of *docs*: key, keep_id, group_size, kept, text_sha256. A null text equals the empty one. A null
    key sorts after all others; of repeated rows with the smallest key, all count as kept (they are one row to the key). An empty table
    gives no rows; other columns are ignored.

    Texts meet only once: grouped by (hash, text), which compares the bytes of equal hashes and, combined before the
    shuffle, sends each text once a task however often it occurs. Rows then find their group by the 128-bit hash and, where
    that collides, by the text's SHA-256; were two texts to share both, the count of texts would raise an error rather than
    merge them. *content_hash* is a parameter so that tests can make it collide.
    """
    rows = docs.select(F.col(key).alias("__key"), normalised(text).alias("__text"))
    rows = rows.select("__key", "__text", content_hash(F.col("__text")).alias("__h"), F.sha2("__text", 256).alias("text_sha256"))
    texts = rows.groupBy("__h", "text_sha256", "__text").agg(F.min("__key").alias("__keep"), F.count(F.lit(1)).alias("__n"))
    groups = texts.groupBy("__h", "text_sha256").agg(F.count(F.lit(1)).alias("__texts"), F.min("__keep").alias("__keep"), F.sum("__n").alias("__n"))
    sure = F.when(F.col("__texts") == 1, F.col("__n")).otherwise(F.raise_error(F.lit("two texts share both hashes")).cast("long"))
    groups = groups.select("__h", "text_sha256", "__keep", sure.alias("__n"))
    out = rows.select("__key", "__h", "text_sha256").join(groups, ["__h", "text_sha256"])
    return out.select(F.col("__key").alias(key), F.col("__keep").alias("keep_id"), F.col("__n").alias("group_size"), F.col("__key").eqNullSafe(F.col("__keep")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of *docs* that stay, with all its columns. Of repeated rows (same key, same text) one stays; rows without a
    key are kept only where no row of their group has one. Of repeated rows that differ in other columns, the one with the smallest hash of
    all its columns stays. Columns may bear any names.

    Groups are found first, then rows are told apart by 48 bytes each: only groups of repeated rows are looked at twice.
    """
    names, at, body = docs.columns, f"c{docs.columns.index(key)}", f"c{docs.columns.index(text)}"
    rows = numbered(docs)
    # Maps have no hash; whatever they hold, rows with them are told apart by their other columns.
    told = [c for c, kind in rows.dtypes if "map<" not in kind]
    tagged = rows.withColumn("sha", F.sha2(normalised(body), 256)).withColumn("row", F.xxhash64(*told))
    found = exact_groups(rows.select(at, body), at, body)
    stay = found.where("kept").select(F.col(at).alias("keep"), F.col("text_sha256").alias("keep_sha")).distinct()
    ours = F.col(at).eqNullSafe(F.col("keep")) & (F.col("sha") == F.col("keep_sha"))
    first = tagged.join(stay, ours, "left_semi").groupBy(F.col(at).alias("keep"), F.col("sha").alias("keep_sha")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    out = tagged.join(first, ours & (F.col("row") == F.col("first")))
    alike = [*rows.columns, "sha"]
    once = out.where("n = 1").select(alike).unionByName(out.where("n > 1").select(alike).dropDuplicates([at, "sha"]))
    return once.drop("sha").toDF(*names)
