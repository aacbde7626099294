"""Keyed result tables that streams in update mode write to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.sources import commits


class UpsertTable:
    """A table of the last row of each key, fed by numbered batches; a batch that comes again changes nothing.

    A batch is one folder of rows, made visible by one entry of a numbered log that names all folders in order, and the batch. Readers take
    each key's row from the last folder that has it. When ``fold_after`` folders have come together, they are written as one, which costs the
    table's size once in so many batches. A batch that ran again, after a crash or by a second driver, finds its number in the log and is left out.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, fold_after: int = 20):
        self.spark, self.path, self.keys, self.schema, self.fold_after = spark, path, list(keys), schema, fold_after

    def _folders(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{f}").withColumn("_order", F.lit(i)) for i, f in enumerate(folders)]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        columns = [c for c in rows.columns if c not in (*self.keys, "_order")]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*columns), "_order").alias("_r")).select(*self.keys, "_r.*")

    def read(self, position: int | None = None) -> DataFrame:
        at = commits.position(self.spark, self.path) if position is None else position
        return self._folders((commits.entry(self.spark, self.path, at) or {"folders": []})["folders"])

    def upsert(self, batch: DataFrame, batch_id: int) -> bool:
        """Whether the batch was new. Rows of one batch have distinct keys, as those of an aggregate do."""
        new = f"batch-{batch_id:010d}-{uuid.uuid4().hex}"
        written = False

        def attempt(at: int, last: dict | None) -> dict | None:
            nonlocal written
            if last and last["batch_id"] >= batch_id:
                written = False
                return None
            if not written:
                batch.write.parquet(f"{self.path}/{new}")
                written = True
            folders = [*(last["folders"] if last else []), new]
            if len(folders) > self.fold_after:
                folded = f"folded-{uuid.uuid4().hex}"
                self._folders(folders).write.parquet(f"{self.path}/{folded}")
                folders = [folded]
            return {"batch_id": batch_id, "folders": folders}

        commits.committed(self.spark, self.path, attempt)
        return written
