"""File sources and sinks."""

from __future__ import annotations

import hashlib
import io
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratemill.functions import recode as R
from ratemill.session import broadcast_if_small, cut_lineage

BLOCK_BYTES = 64 << 20
NODE_BLOCKS = 4096
READ_BYTES = 1 << 20
TASK_BYTES = 64 << 20   # read by a task that hashes ranges, about
MIN_TASKS = 32
ROWS_PER_FILE = 5_000_000


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def version_of(spark: SparkSession, path: str) -> str:
    """Time of the last change and size of a file or folder, as its file system reports them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
    return f"{status.getModificationTime()}-{status.getLen()}"


def read_typed_csv(spark: SparkSession, path: str, schema: StructType | str, null: str = "", sep: str = ",") -> DataFrame:
    """Delimited file with a header and a declared schema; a byte-order mark and CRLF are fine."""
    return (spark.read.schema(schema).option("header", True).option("nullValue", null).option("sep", sep)
            .option("encoding", "UTF-8").csv(path))


def read_raw_csv(spark: SparkSession, path: str, cols: Sequence[str], sep: str = ",") -> DataFrame:
    """All columns as text, for rule checks and soft casts."""
    return read_typed_csv(spark, path, ", ".join(f"`{c}` string" for c in cols), sep=sep)


def read_extract_tsv(spark: SparkSession, path: str, cols: Sequence[str], sex: str, code: str, rate: str) -> DataFrame:
    """Tab-separated extract without its total rows, footers and unusable rates."""
    df = read_raw_csv(spark, path, cols, sep="\t")
    return df.where(F.col(sex).isin("M", "F") & ~R.is_blank(code) & F.trim(F.col(rate)).try_cast("double").isNotNull())


def read_text_lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Lines of text files without carriage returns. ``whole`` reads each file as one value first, which only
    suits small files; the default splits large files across tasks."""
    if whole:
        df = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", "\n")).alias("line"))
    else:
        df = spark.read.text(path).select(F.col("value").alias("line"))
    return df.select(F.trim(F.replace("line", F.lit("\r"), F.lit(""))).alias("line"))


def lines_of(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line of a text column, with its position."""
    return df.select(*keep, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn(
        "line", F.trim(F.replace("line", F.lit("\r"), F.lit(""))))


def tokenize(df: DataFrame, line: str, schema: Mapping[str, str], sep: str = ",") -> DataFrame:
    """Positional fields of a delimited line as typed columns; a field that does not parse is null."""
    parts = F.split(line, rf"\Q{sep}\E", -1)
    return df.select("*", *[F.trim(F.get(parts, F.lit(i))).try_cast(t).alias(c) for i, (c, t) in enumerate(schema.items())])


def tokenize_json(df: DataFrame, key: Sequence[str], line: str, schema: Mapping[str, str]) -> DataFrame:
    """The same through a JSON array and a key pivot: one row per key, fields picked by position."""
    arr = F.from_json(F.concat(F.lit('["'), F.replace(line, F.lit(","), F.lit('","')), F.lit('"]')), "array<string>")
    tokens = df.select(*key, F.posexplode(arr).alias("pos", "token"))
    return tokens.groupBy(*key).agg(*[F.max(F.when(F.col("pos") == i, F.col("token"))).try_cast(t).alias(c)
                                      for i, (c, t) in enumerate(schema.items())])


def write_frame(df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_frame(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Parquet; naming columns keeps the scan to them."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def write_by_period(df: DataFrame, path: str, period: str, sort: Sequence[str], mode: str = "overwrite",
                    rows_per_file: int = ROWS_PER_FILE) -> None:
    """One directory per value of ``period`` for partition pruning, sorted inside files for row-group skipping.

    The rows of a period are counted first; as many writers as that takes share them by a hash of the sort key, so a
    large period is split and a small one is one file. The counts are a row a period.
    """
    writers = df.groupBy(F.col(period).alias("_period")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_writers"))
    shared = df.join(broadcast_if_small(writers), F.col(period).eqNullSafe(F.col("_period"))).drop("_period")
    out = shared.withColumn("_part", F.pmod(F.xxhash64(*[F.col(c) for c in sort]), F.col("_writers"))).drop("_writers")
    out = out.repartition(F.col(period), F.col("_part")).drop("_part").sortWithinPartitions(period, *sort)
    out.write.mode(mode).partitionBy(period).parquet(path)


def write_by_year(df: DataFrame, path: str, date_col: str, sort: Sequence[str], mode: str = "overwrite",
                  rows_per_file: int = ROWS_PER_FILE) -> None:
    """Year directories of a dated table."""
    write_by_period(df.withColumn("year", F.year(date_col)), path, "year", sort, mode, rows_per_file)


def read_metrics(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """Metric document, or None where there is none yet."""
    return spark.read.schema(schema).json(path) if path_exists(spark, path) else None


def write_metrics(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def typed_load(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Raw text to typed columns: trailing blanks dropped, blank as null, unparsable as null."""
    return raw.select(*[R.blank_to_null(c).try_cast(t).alias(c) for c, t in types.items()])


def file_order_identity(df: DataFrame, out: str) -> DataFrame:
    """1..N in the order rows were read.

    The per-partition position is frozen by a checkpoint; then each partition's offset, one number per
    partition, is added.
    """
    pos = cut_lineage(df.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    sizes = pos.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_o"))
    inner = F.col("_m").bitwiseAND((1 << 33) - 1)
    return pos.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn(
        out, F.col("_o") + inner + 1).drop("_p", "_o", "_m")


def assert_identity(df: DataFrame, key: str) -> DataFrame:
    """Raises unless the key runs 1..count; returns the frame."""
    f = df.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if f["n"] and (f["lo"], f["hi"]) != (1, f["n"]):
        raise ValueError(f"{key} runs {f['lo']}..{f['hi']} over {f['n']} rows")
    return df


def full_refresh(df: DataFrame, path: str) -> None:
    """Replaces the whole staging table, also by rows that come from it. The new content is written beside the old and
    then takes its name, so a write that fails leaves the old table as it was."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    beside, before = f"{path}.new-{name}", f"{path}.old-{name}"
    df.write.parquet(beside)
    place = spark._jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(place(path))
    if had and not fs.rename(place(path), place(before)):
        raise OSError(f"{path} could not be replaced")
    if not fs.rename(place(beside), place(path)):
        if had:
            fs.rename(place(before), place(path))
        raise OSError(f"{path} could not be replaced")
    if had:
        fs.delete(place(before), True)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def load_plan(spark: SparkSession, steps: Sequence[tuple[str, DataFrame, str, int]], target: str,
              resume_from: str | None = None) -> DataFrame:
    """Loads tables in order and verifies each before the next.

    A step is (table, frame, key, expected rows) with the key expected to run 1..n; the first mismatch
    stops the load. ``resume_from`` skips the tables before it. Returns the manifest of loaded tables.
    """
    names = [s[0] for s in steps]
    todo = steps[names.index(resume_from):] if resume_from else steps
    done = []
    for table, frame, key, expected in todo:
        path = f"{target}/{table}"
        frame.write.mode("overwrite").parquet(path)
        f = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.min(key).cast("long").alias("lo"),
                                         F.max(key).cast("long").alias("hi")).first()
        if (f["n"], f["lo"], f["hi"]) != (expected, 1, expected):
            raise ValueError(f"{table}: expected 1..{expected}, found {f['lo']}..{f['hi']} over {f['n']} rows; resume from here")
        done.append((table, f["n"], f["lo"], f["hi"]))
    return spark.createDataFrame(done, "table_name string, row_count bigint, min_key bigint, max_key bigint")


def backfill(df: DataFrame, col: str, value: Column, key: str, lo: int, hi: int) -> DataFrame:
    """Fills a child key for a key range; other rows keep what they have."""
    return df.withColumn(col, F.when(F.col(key).between(lo, hi), value).otherwise(F.col(col)))


def _hash_ranges(block: int):
    """Reads runs of byte ranges through the file system of each file's address, a megabyte at a time, and opens a file once a run."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        for batch in batches:
            for path, size, first, past in zip(*[batch[c].to_pylist() for c in ("source_path", "byte_size", "first", "past")]):
                system, name = fs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", path), safe=":/"))
                found = []
                with system.open_input_file(name) as f:
                    f.seek(first * block)
                    data = io.BufferedReader(f, READ_BYTES)
                    for no in range(first, past):
                        value, left = hashlib.sha256(), min(block, size - no * block)
                        while left and (piece := data.read(min(left, READ_BYTES))):
                            value.update(piece)
                            left -= len(piece)
                        if left:
                            raise OSError(f"{path} is shorter than its listing said")
                        found.append(value.hexdigest())
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([size] * n, pa.int64()), pa.array(range(first, past), pa.int64()), pa.array(found)],
                                                 ["source_path", "byte_size", "block_no", "block_hash"])
    return hashed


def block_hashes(files: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """(source_path, byte_size, block_no, block_hash) per byte range of ``block`` bytes of files given by path and size.

    Consecutive ranges of a file are runs, and runs are dealt to tasks: as many as ``TASK_BYTES`` of bytes or ``NODE_BLOCKS`` ranges each take, and
    ``MIN_TASKS`` where there are that many ranges. So one large file is read side by side, and short ranges or files share a task. An empty file
    has one empty range; a file that shrinks while it is read raises.
    """
    blocks = F.greatest(F.expr(f"(byte_size + {block - 1}) div {block}"), F.lit(1).cast("bigint"))
    total, size = files.agg(F.coalesce(F.sum(blocks), F.lit(1)), F.coalesce(F.sum("byte_size"), F.lit(0))).first()
    tasks = min(total, max(MIN_TASKS, -(-size // TASK_BYTES), -(-total // NODE_BLOCKS)))
    run = total // tasks
    runs = files.select("source_path", "byte_size", blocks.alias("n"), F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1, F.lit(run).cast("bigint"))).alias("first"))
    runs = runs.withColumn("past", F.least(F.col("first") + run, F.col("n"))).drop("n")
    return runs.repartition(int(tasks), "source_path", "first").mapInArrow(
        _hash_ranges(block), "source_path string, byte_size bigint, block_no bigint, block_hash string")


def hash_files(files: DataFrame, block: int = BLOCK_BYTES, node: int = NODE_BLOCKS) -> DataFrame:
    """(source_path, content_hash, byte_size) of files of any size, given by path and size.

    The hash is a tree of SHA-256 values: of each range of ``block`` bytes, of each ``node`` range hashes in a row, and of those in order.
    No task holds more than ``node`` hashes of one file at the first level. It is the same however the ranges are dealt to tasks, and
    differs from a plain SHA-256 of the bytes.
    """
    def joined(no: str) -> Column:
        return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(no, "block_hash"))), lambda s: s["block_hash"]), ""), 256)

    nodes = block_hashes(files, block).groupBy("source_path", "byte_size", F.expr(f"block_no div {node}").alias("node_no")).agg(
        joined("block_no").alias("block_hash"))
    return nodes.groupBy("source_path", "byte_size").agg(joined("node_no").alias("content_hash")).select("source_path", "content_hash", "byte_size")


def source_state(spark: SparkSession, path: str, block: int = BLOCK_BYTES, node: int = NODE_BLOCKS) -> DataFrame:
    """(source_path, content_hash, byte_size, observed_at) per file of any size, hashed by ``hash_files``. Spark lists no empty files."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_path"), F.col("length").alias("byte_size"))
    return hash_files(listed, block, node).withColumn("observed_at", F.current_timestamp())


def frame_fingerprint(df: DataFrame, source_path: str) -> DataFrame:
    """Row-order-free fingerprint of a table of any size: counts and sums of row hashes, hashed once more. ``byte_size`` counts
    the bytes of all values as text."""
    cols = [F.col(c).cast("string") for c in sorted(df.columns)]
    row = F.sha2(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])), 256)
    size = F.lit(0).cast("bigint")
    for c in cols:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    rows = df.select(row.alias("row"), size.alias("b"))
    parts = [F.conv(F.substring("row", 1 + 15 * i, 15), 16, 10).cast("bigint") for i in range(4)]
    thirds = [(i, j, F.shiftright(f"h{i}", 20 * j).bitwiseAND((1 << 20) - 1)) for i in range(4) for j in range(3)]      # sums of 20 bits each stay plain integers
    sums = rows.select(*[h.alias(f"h{i}") for i, h in enumerate(parts)], "b").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("byte_size"), *[F.sum(t).alias(f"t{i}{j}") for i, j, t in thirds])
    def total(i: int) -> Column:
        return sum((F.col(f"t{i}{j}").cast("decimal(19,0)") * F.lit(1 << 20 * j).cast("decimal(14,0)") for j in (1, 2)), F.col(f"t{i}0").cast("decimal(19,0)"))
    sums = sums.select("n", "byte_size", *[total(i).cast("string").alias(f"s{i}") for i in range(4)])
    return sums.select(F.lit(source_path).alias("source_path"),
                       F.sha2(F.concat_ws("|", F.col("n").cast("string"), *[F.col(f"s{i}") for i in range(4)]), 256).alias("content_hash"),
                       "byte_size", F.current_timestamp().alias("observed_at"))


def write_result(df: DataFrame, path: str, single: bool = False) -> None:
    """A result table as CSV with a header; ``single`` asks for one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def markdown(df: DataFrame, digits: int = 3) -> str:
    """A result table for reading, as Markdown, row by row."""
    def show(v):
        return f"{v:.{digits}f}" if isinstance(v, float) else "" if v is None else str(v)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(show(v) for v in r) + " |" for r in df.toLocalIterator()])


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
