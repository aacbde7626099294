"""Exact duplicates by distributed most-significant-first radix partitioning; no digest decides equality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.llm.common import stored, text_key, text_or_empty, without, without_repeats

FIRST_DIGIT = 64
GROWTH = 16
LONGEST_DIGIT = 1 << 20


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id (smallest doc_id of the equal texts), group_size, kept, text_sha256, and text_key.

    Texts are equal when identical after each run of the bytes 20 and 09-0D (hex) became one space. The first digit is the length in
    bytes, the next ones are runs of successive bytes: 64, then 16 times as many each round, up to a megabyte. A round counts each
    digit within each group of the last round; texts alone in their group leave, texts that ended together are equal, and the others go
    on without the bytes that were read. After the first round only texts move that share length and beginning with another one. Counts
    are pre-aggregated and the group names come back by a join, so a group that holds a third of all rows is never gathered. The digest
    is only returned, and tells the caller which text a row had.

    Cases: null counts as empty, so empty texts are equal. A row without doc_id can be a copy but not the row that stays, unless no row
    of its group has a doc_id; then all of them stay. Rows alike in doc_id and text are marked alike. An empty table gives no rows. Other
    columns are not looked at.
    """
    plain = F.regexp_replace(text_or_empty(), r"[\x20\x09-\x0D]+", " ")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), plain.alias("plain"))
    active = rows.select("doc_id", "text_key", F.sha2("plain", 256).alias("text_sha256"), F.octet_length("plain").cast("long").alias("n_bytes"),
                         F.lit(0).cast("long").alias("part"), F.encode("plain", "UTF-8").alias("rest"))
    width, read, parts = FIRST_DIGIT, 0, []
    while True:
        read += width
        digits = active.withColumn("digit", F.expr(f"substring(rest, 1, {width})"))
        by = ["part", "n_bytes", "digit"]
        groups = stored(digits.groupBy(*by).agg(F.count("*").alias("group_size"), F.min("doc_id").alias("keep_id")).where("group_size > 1")
                        .withColumn("next_part", F.monotonically_increasing_id()), "digits")
        done = F.col("group_size").isNull() | (F.col("n_bytes") <= read)
        step = stored(digits.join(groups.hint("merge"), by, "left").select(
            "doc_id", "text_key", "text_sha256", "n_bytes", F.coalesce("next_part", F.lit(0)).alias("part"), "keep_id", "group_size",
            F.when(~done, F.expr(f"substring(rest, {width + 1})")).alias("rest"), done.alias("done")), "radix", partition_by="done")
        parts.append(step.where("done"))
        active = step.where("not done").drop("keep_id", "group_size", "done")
        if active.isEmpty():
            break
        width = min(width * GROWTH, LONGEST_DIGIT)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(size > 1, F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.coalesce(F.col("doc_id") == keep, keep.isNull()).alias("kept"), "text_sha256", "text_key")


def keep_first_copy(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns stay as they are.

    The rows that ``exact_groups`` marks as kept can be several: they repeat their doc_id, or none of the group has one. One of them stays.

    Cases: null texts are empty ones and equal. A row without doc_id goes where its group has a row with one. An empty table stays empty.
    """
    marks = exact_groups(docs)
    several = marks.where("kept and group_size > 1")
    first = several.groupBy("text_sha256").agg(F.min("text_key").alias("first_key"))
    others = several.join(first.hint("merge"), "text_sha256").where("text_key <> first_key")
    gone = marks.where("not kept").select("doc_id", "text_key").union(others.select("doc_id", "text_key"))
    return without(without_repeats(docs), gone)
