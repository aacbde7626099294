"""Web archives: round trip, format, index."""

import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from ratemill.llm import common, warc
from ratemill.llm.common import new_folder, ready

SCHEMA = "page_id long, url string, html string, record_type string, same string, n int, refers_to string"
LONG = "<p>" + "é text " * 40_000


@pytest.fixture(scope="module")
def llm(spark):
    return ready(spark)


def rows():
    copy = "<html>" + "x" * 1000
    pages = [(1, "http://a/1", copy), (2, None, copy), (9, "http://a/9\r\nX: y", copy), (3, "u", None), (4, "u", ""), (5, "u", "s" * 999), (6, "u", "s" * 999), (7, "u", LONG), (8, "u", "line\r\n\r\nWARC/1.1\r\n\r\n" * 60),
             (None, "u", copy), (None, None, None), (9, "http://a/9\r\nX: y", copy), (12, "u", "é" * 500), (11, "u", "é" * 500)]
    return [(*p, None, "k", i, "r") for i, p in enumerate(pages)]


def test_round_trip(llm):
    docs = llm.createDataFrame(rows(), SCHEMA)
    got = [tuple(r) for r in warc.archived(docs).collect()]
    want = []
    for page_id, _, html, *_ in rows():
        payload = (html or "").encode()
        ids = [r[0] for r in rows() if (r[2] or "").encode() == payload and r[0] is not None]
        again = len(payload) >= 1000 and ids and page_id != max(ids)
        want.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert warc.archived(llm.createDataFrame([], SCHEMA)).count() == 0


def test_frames_and_index(llm, folder):
    docs = llm.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 3000, *[None] * 4) for i in range(400)], SCHEMA).coalesce(2)
    index = warc.write_bundles(warc.with_record_types(docs), folder)
    found = {r.record_id: r for r in index.collect()}
    assert len(found) == 400 and {r.frame for r in found.values()} != {0}
    name = found["urn:page:17"].bundle
    data = open(f"{folder}/bundles/{name}", "rb").read()
    n, flags, mark = struct.unpack("<IBI", data[-9:])
    assert mark == 0x8F92EAB1 and flags == 0 and struct.unpack("<II", data[-9 - 8 * n - 8:-9 - 8 * n]) == (0x184D2A5E, 8 * n + 9)
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read().count(b"WARC-Type: response") == sum(r.bundle == name for r in found.values())
    some = warc.read_records(index.where(F.col("record_id").isin("urn:page:17", "urn:page:333")), folder).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in some} == {i: f"page {i} " * 3000 for i in (17, 333)}
    assert {r.url for r in some} == {"http://h/17", "http://h/333"}


def test_damaged_payload_is_noticed():
    record = warc.record_bytes(1, "u", b"abc", 3, hashlib.sha1(b"abd").hexdigest(), "response", None, "2000-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc.record_row(*next(warc.parsed(record)))


def test_bare_folder_gets_its_address(spark, monkeypatch, tmp_path):
    """Tasks must not take a folder without a scheme for one of their own disk."""
    monkeypatch.setattr(common, "shared_dir", lambda s: str(tmp_path))
    assert common.new_folder(spark, "x").startswith(f"file://{tmp_path}/x-")
    monkeypatch.setattr(common, "shared_dir", lambda s: f"file://{tmp_path}")
    assert common.new_folder(spark, "x").startswith(f"file://{tmp_path}/x-")


def test_a_second_attempt_writes_other_bundles(spark, folder):
    """The index of one attempt names its own bundles; what another attempt of the same task wrote beside them is not read."""
    pages = warc.with_record_types(spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 300) for i in range(20)], "page_id long, url string, html string")).coalesce(1)
    first = {r.bundle for r in warc.write_bundles(pages, f"file://{folder}").collect()}
    again = pages.mapInArrow(warc._written(f"file://{folder}/bundles", "1970-01-01T00:00:00Z", 3), warc.INDEX)
    assert not first & {r.bundle for r in again.collect()}
    assert sorted(r.page_id for r in warc.read_bundles(spark, f"file://{folder}").collect()) == list(range(20))
