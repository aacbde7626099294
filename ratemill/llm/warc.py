"""WARC records in seekable Zstandard bundles: independent frames, a seek table at the end, an index of records by frame and offset."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.llm.common import new_folder

FRAME_BYTES = 512 << 10
BUNDLE_BYTES = 64 << 20
RESPONSE, REVISIT = "response", "revisit"
SHORTEST_REVISIT = 1000
# Fixed values of the seekable format: a skippable frame's number, the mark at the end of the file, and the field sizes.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, bundle string, frame int, offset long, length long"


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest (hex SHA-1), record_type, refers_to; the payload of a revisit is left out.

    Of records whose payloads are equal and have 1000 bytes or more, the one with the largest page_id is the response. Equality is length
    and SHA-256. A copied payload's rows are counted before the shuffle and meet only as a join key.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    copies = (rows.where(F.col("payload_bytes") >= SHORTEST_REVISIT).groupBy("same", "payload_bytes")
              .agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1").drop("n"))
    again = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(copies, ["same", "payload_bytes"], "left").select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes", F.sha1("payload").alias("payload_digest"),
        F.when(again, REVISIT).otherwise(RESPONSE).alias("record_type"), F.when(again, F.col("newest")).alias("refers_to"))


def record_name(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, payload_bytes: int, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http + (payload or b"") if kind == RESPONSE else http
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: <{record_name(page_id)}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if kind == REVISIT:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_name(refers_to)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Bundle:
    """One file: frames as they fill up, then the seek table. It gets its name when it is complete, so a lost task leaves no half file."""

    def __init__(self, files, folder: str, name: str, attempt: str, level: int):
        import zstandard
        self.files, self.target, self.name, self.path = files, f"{folder}/{name}", name, f"{folder}/.{name}.{attempt}"
        self.out, self.packer = files.open_output_stream(self.path), zstandard.ZstdCompressor(level=level)
        self.frames, self.open, self.size, self.written = [], bytearray(), 0, 0

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        if self.open and len(self.open) + len(record) > FRAME_BYTES:
            self.flush()
        at = self.name, len(self.frames), len(self.open), len(record)
        self.open += record
        self.size += len(record)
        return at

    def flush(self) -> None:
        if self.open:
            frame = self.packer.compress(bytes(self.open))
            self.out.write(frame)
            self.frames.append((len(frame), len(self.open)))
            self.open = bytearray()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        self.files.move(self.path, self.target)


def _file_system(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _written(folder: str, date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, path = _file_system(folder)
        files.create_dir(path, recursive=True)
        bundle, number = None, 0
        for batch in batches:
            rows = []
            for x in zip(*[batch[c].to_pylist() for c in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")]):
                if bundle is None:
                    name = f"part-{task.partitionId():06d}-{number:04d}-{uuid.uuid4().hex}.warc.zst"     # of one attempt; the index lists the bundles of those that ended
                    bundle = _Bundle(files, path, name, "open", level)
                rows.append((record_name(x[0]), *bundle.add(record_bytes(*x, date))))
                if bundle.size >= BUNDLE_BYTES:
                    bundle.close()
                    bundle, number = None, number + 1
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["record_id", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()
    return run


def write_bundles(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Writes the records to bundles in ``folder``/bundles and returns the index, stored in ``folder``/index.

    The index maps each record to its bundle, frame, and offset and length within the decompressed frame. A bundle closes at 64 MB.
    """
    index = records.mapInArrow(_written(f"{folder}/bundles", date, level), INDEX)
    index.write.parquet(f"{folder}/index")
    return records.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def seek_table(file) -> list[tuple[int, int, int]]:
    """(place, compressed size, size) of each frame, from the end of the file alone."""
    end = file.size()
    n, _, mark = struct.unpack("<IBI", file.read_at(9, end - 9))
    if mark != SEEKABLE:
        raise ValueError("no seek table")
    place, out = 0, []
    for packed, size in struct.iter_unpack("<II", file.read_at(8 * n, end - 9 - 8 * n)):
        out.append((place, packed, size))
        place += packed
    return out


def parsed(data: bytes, at: int = 0) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and payload of the records from ``at`` on."""
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        fields = dict(line.split(": ", 1) for line in data[at:body - 4].decode().split("\r\n")[1:])
        end = body + int(fields["Content-Length"])
        http = data.index(b"\r\n\r\n", body) + 4
        fields["Payload-Length"] = re.search(rb"Content-Length: (\d+)", data[body:http])[1].decode()
        yield fields, data[http:end]
        at = end + 4


def _page(name: str | None) -> int | None:
    number = name.strip("<>").rpartition(":")[2] if name else ""
    return int(number) if number else None


OUT = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _rows(found: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*found)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in OUT.split(", ")])


def record_row(fields: dict[str, str], payload: bytes) -> tuple:
    """A response's length and digest are those of its payload, which must agree with the header; a revisit has the header's."""
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, size = fields["WARC-Type"], int(fields["Payload-Length"])
    if kind == RESPONSE:
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), payload if kind == RESPONSE else None, size, digest, kind, _page(fields.get("WARC-Refers-To"))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        files, path = _file_system(folder)
        for batch in batches:
            for name in batch["bundle"].to_pylist():
                with files.open_input_file(f"{path}/{name}") as file:
                    for place, packed, size in seek_table(file):
                        data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, place), max_output_size=size)
                        yield _rows([record_row(*x) for x in parsed(data)])
    return run


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the bundles in ``folder``, a bundle a row of work."""
    bundles = spark.read.schema(INDEX).parquet(f"{folder}/index").select("bundle").distinct()
    return bundles.repartition(max(1, bundles.count())).mapInArrow(_read(f"{folder}/bundles"), OUT)


def _picked(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        files, path = _file_system(folder)
        for batch in batches:
            for name, frame, offset in zip(*[batch[c].to_pylist() for c in ("bundle", "frame", "offset")]):
                with files.open_input_file(f"{path}/{name}") as file:
                    place, packed, size = seek_table(file)[frame]
                    data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, place), max_output_size=size)
                yield _rows([record_row(*next(parsed(data, offset)))])
    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Only the records of the given index rows; each costs one frame."""
    return index.select("bundle", "frame", "offset").mapInArrow(_picked(f"{folder}/bundles"), OUT)


def archived(pages: DataFrame) -> DataFrame:
    """``pages`` written as bundles in the shared folder and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Cases: null html is an empty payload. A null url has no target field; control characters in one are percent-coded. Records without
    page_id have an identifier without number and are read back with null; where a larger page_id has the same payload they revisit it.
    Rows that repeat the largest page_id are responses all. An empty table gives no rows and no bundle. Other columns are not looked at.
    """
    folder = new_folder(pages.sparkSession, "warc")
    write_bundles(with_record_types(pages), folder)
    return read_bundles(pages.sparkSession, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
