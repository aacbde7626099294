"""Session helpers: checkpoint location and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
TASK_ROWS = 500_000      # rows of a task that sorts or adds up, about


# Runtime settings every job here relies on: joins on a hot key are split even where that costs a shuffle later.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent and Spark runs in local mode (tests) a scratch folder is made.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        conf = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name below the shared one, for what a single run writes."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows are written to the shared folder and survive executor loss."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting at most ``max_rows`` rows; a larger side is joined by shuffle."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` to as many tasks as ``rows`` rows take, where these are more than the session's own number.

    Joins, sums and windows on the keys that follow are not shuffled again, so what a task holds does not grow with the input.
    """
    tasks = -(-rows // TASK_ROWS)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)
