"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups, keep one row of each text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, joined_groups, lower_ascii


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", digest=content_hash) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. ``keep`` says which id of
    equal texts stays, "smallest" or "largest". Bytes decide, not hashes: texts are grouped by hash *and* bytes (copies
    collapse before the shuffle), and only a hash that stands for one text is joined back by hash alone; colliding
    texts (never seen with ``content_hash``) are joined by their bytes. Rows of very common texts are not sent to one task (see ``joined_groups``).

    Null ids never stay unless all ids of the text are null (then all those rows do, with ``keep_id`` null). Rows that
    repeat id and text are one document: they share the verdict. An empty table gives no rows; other columns are ignored.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"))
    rows = rows.select("__id", "__text", digest(F.col("__text")).alias("__hash"))
    texts = rows.groupBy("__hash", "__text").agg(best("__id").alias("keep_id"), F.count("*").alias("group_size"))
    hashes = checkpointed(
        texts.groupBy("__hash").agg(F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"), F.count("*").alias("__texts"))
    )
    thin = rows.select("__id", "__hash", F.sha2("__text", 256).alias("text_sha256"))
    out = joined_groups(thin, hashes.filter("__texts = 1").drop("__texts"), "__hash", "group_size")
    collided = hashes.filter("__texts > 1").select("__hash")
    if not collided.isEmpty():
        doubtful = rows.join(collided, "__hash", "left_semi")
        settled = doubtful.groupBy("__hash", "__text").agg(best("__id").alias("keep_id"), F.count("*").alias("group_size"))
        again = doubtful.join(settled, ["__hash", "__text"]).withColumn("text_sha256", F.sha2("__text", 256))
        out = out.unionByName(again.drop("__text"))
    return out.select(
        F.col("__id").alias(id_col), "keep_id", "group_size", F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
