"""A numbered log of commits beside a table: each entry is made once, and a reader who keeps a number sees one state.

Entry n is a small JSON document. It is written under another name and renamed without overwriting, so an entry is there as a whole or
not at all, and of two writers who prepared from the same state one gets the number and the other a ``Conflict``. That is as atomic as
the file system's rename that refuses an existing name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "log"


class Conflict(Exception):
    """Another writer has made the entry."""


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _name(root: str, number: int) -> str:
    return f"{root}/{LOG}/{number:020d}.json"


def position(spark: SparkSession, root: str) -> int:
    """Number of the last entry; 0 before the first."""
    folder, fs = _files(spark, f"{root}/{LOG}")
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max([0, *(int(n[:20]) for n in names if n.endswith(".json") and not n.startswith("."))])


def commit(spark: SparkSession, root: str, number: int, entry: dict) -> int:
    """Makes entry ``number`` or raises ``Conflict``."""
    target, fs = _files(spark, _name(root, number))
    beside, _ = _files(spark, f"{root}/{LOG}/.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(target.getParent())
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps({"number": number, **entry}, default=str).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(target), never_over)
    except Py4JJavaError as error:
        fs.delete(beside, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise Conflict(f"entry {number} of {root} is taken") from None
        raise
    return number


def entry(spark: SparkSession, root: str, number: int) -> dict | None:
    """The entry as it was made; None for number 0."""
    if not number:
        return None
    path, fs = _files(spark, _name(root, number))
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def entries(spark: SparkSession, root: str, schema: str, upto: int | None = None) -> DataFrame:
    """All entries up to a number as rows; fields that an entry lacks are null."""
    if not position(spark, root):
        return spark.createDataFrame([], f"number bigint, {schema}")
    rows = spark.read.schema(f"number bigint, {schema}").json(f"{root}/{LOG}")
    return rows if upto is None else rows.where(F.col("number") <= upto)


def committed(spark: SparkSession, root: str, attempt: Callable[[int, dict | None], dict | None]) -> int:
    """Commits what ``attempt(position, last entry)`` returns, asking again after each conflict; None commits nothing."""
    while True:
        at = position(spark, root)
        new = attempt(at, entry(spark, root, at))
        if new is None:
            return at
        try:
            return commit(spark, root, at + 1, new)
        except Conflict:
            continue
