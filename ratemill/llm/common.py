"""Helpers of the training-data operators: reading tables, tables in the shared folder, names that cannot clash."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.session import broadcast_if_small, prepare, shared_dir

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Session settings, and the place of this package for the Python workers of a session that was started elsewhere."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", REPOSITORY)
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and address of its file system. Spark resolves a bare path on the default file system, a task would on its own disk."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub(r"^(\w+):/(?!/)", r"\1:///", full)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, below the folder that driver and executors share, with its file system's address."""
    return qualified(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cuts lineage by a table in the shared folder; the rows outlive executors. The schema is passed on, so empty tables can be read."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """Tells rows apart that repeat a doc_id; rows alike in both are the same document."""
    return F.xxhash64(F.col(column).cast("string"))


def free_name(df: DataFrame, wanted: str) -> str:
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text_key) ``removed`` lists, null ids included; columns and every other row stay as they are."""
    key, doc = free_name(docs, "_text_key"), free_name(docs, "_removed_id")
    gone = removed.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key + "_r")).distinct()
    marked = docs.withColumn(key, text_key())
    return marked.join(gone.hint("merge"), marked["doc_id"].eqNullSafe(gone[doc]) & (marked[key] == gone[key + "_r"]), "left_anti").select(*[marked[c] for c in docs.columns])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with one of the rows that are alike in doc_id and text; null ids are alike, and null is another text than an empty one.

    Rows that repeat are found by counts. Of these, copies are dropped before the shuffle as far as a task holds several.
    """
    key, doc = free_name(docs, "_text_key"), free_name(docs, "_repeated_id")
    marked = docs.withColumn(key, text_key())
    again = stored(marked.groupBy(F.col("doc_id").alias(doc), F.col(key).alias(key + "_r")).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeats")
    if again.isEmpty():
        return docs
    again = broadcast_if_small(again)
    same = marked["doc_id"].eqNullSafe(again[doc]) & (marked[key] == again[key + "_r"])
    one = marked.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return marked.join(again, same, "left_anti").unionByName(one).select(*docs.columns)
