"""Token ids in Parquet list columns: documents in doc_id order, dictionary-coded ids, delta-coded numbers, small pages with an index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratemill.llm.tokens import checksum, encoded
from ratemill.session import broadcast_if_small

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, tokens array<int>"
ROW_GROUP_BYTES = 64 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
SLICE_BYTES = 4 << 20


def _tokenised(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, starts, ids, size = 0, [], [], 0
            done = 0
            for one in encoded(batch["text"].to_pylist(), path, end_id):
                starts.append(before)
                ids.append(one)
                before += len(one) // 4
                size += len(one)
                rows += 1
                if size >= SLICE_BYTES:
                    yield _rows(batch["doc_id"].slice(done, rows), part, starts, ids)
                    done, rows, starts, ids, size = done + rows, 0, [], [], 0
            if rows:
                yield _rows(batch["doc_id"].slice(done, rows), part, starts, ids)
    return run


def _rows(doc_id: pa.Array, part: int, starts: list[int], ids: list[bytes]) -> pa.RecordBatch:
    n = np.array([len(x) // 4 for x in ids], np.int64)
    tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
    return pa.RecordBatch.from_arrays([doc_id, pa.array(np.full(len(n), part, np.int32)), pa.array(starts, pa.int64()), pa.array(n), tokens],
                                      ["doc_id", "part", "part_start", "n_tokens", "tokens"])


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Writes doc_id, part, part_start (ids before it in its part), n_tokens and tokens, in ascending doc_id order.

    Parts are ranges of doc_id (rows that repeat one go by a hash of the text), so part numbers follow that order and only texts are
    shuffled, once, before they are encoded. Ids are dictionary-coded (16 bits and less), the numbers delta-coded; row groups and pages
    are small, and the page index lets readers take some documents or only the numbers.

    Cases: a null or empty text has the end id alone. Rows without doc_id come first. An empty table gives files without rows. Other
    columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    (ordered.mapInArrow(_tokenised(tokenizer_path, end_id), SCHEMA).write
     .option("compression", "zstd").option("parquet.compression.codec.zstd.level", 1).option("parquet.writer.version", "v2")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
     .option("parquet.enable.dictionary", "false").option("parquet.enable.dictionary#tokens.list.element", "true")
     .parquet(folder))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of such files with start, the ids of all documents before each one. Only the columns that are used are read."""
    files = spark.read.schema(SCHEMA).parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))   # one row a part
    ahead = broadcast_if_small(parts.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead")))
    return files.join(ahead, "part").select("doc_id", (F.col("ahead") + F.col("part_start")).alias("start"), "n_tokens", "tokens")


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch["tokens"]
        ends = np.asarray(tokens.offsets)
        ids = np.asarray(tokens.values).astype("<u4")
        crc = [checksum(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(tokens: DataFrame) -> DataFrame:
    return tokens.mapInArrow(_checked, "doc_id long, start long, n_tokens long, ids_crc32 long")
