"""Token files and packed sequences against whole-text encoding."""

import glob
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratemill.llm.common import new_folder, ready
from ratemill.llm.packing import balanced, pack, piece_cost, powers_of_two
from ratemill.llm.registry import QUERIES
from ratemill.llm.token_files import read_tokens, token_digests, write_tokens
from ratemill.llm.tokens import byte_bpe, encoder

SF = "/root/testdata/sf0.001"
SPACES = ["", " ", "  a", "a  b", "a b ", " a b", "a\n b", "a \nb", "a\n\n  b", "a  b", "a  b c", "it's  we'll x", "a   b", "12 345  6", "\n", "tab\t x", "a <|endoftext|> b", "x\n<|endoftext|>y", "é è\u0085 ê"]


@pytest.fixture(scope="module")
def llm(spark):
    import ratemill.llm.queries  # noqa: F401
    return ready(spark)


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(byte_bpe())
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def documents():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]


def test_words_are_encoded_as_in_whole_texts(whole):
    own = encoder(byte_bpe())
    for text in [*SPACES, *[t for _, t, *_ in odd_rows()], *[t for _, t in documents()[:40]], *[a + " " + b for a in SPACES for b in SPACES]]:
        assert own.ids(text, 0) == whole(text).tobytes(), repr(text)[:80]


def test_token_files(llm, whole):
    want, start = [], 0
    for d, t in sorted(documents()):
        ids = whole(t)
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = QUERIES["op4_token_files"](llm, SF)
    assert sorted(map(tuple, got.collect())) == want


def test_token_file_format(llm, whole):
    folder = new_folder(llm, "tokens").removeprefix("file://")
    docs = llm.createDataFrame(documents(), "doc_id long, text string")
    write_tokens(docs, folder, byte_bpe())
    files = [pq.ParquetFile(f) for f in glob.glob(f"{folder}/*.parquet")]
    for f in files:
        columns = {f.metadata.row_group(0).column(i).path_in_schema: f.metadata.row_group(0).column(i) for i in range(f.metadata.num_columns)}
        assert "RLE_DICTIONARY" in columns["tokens.list.element"].encodings and "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert all(c.has_offset_index and c.compression == "ZSTD" for c in columns.values()) and columns["doc_id"].has_column_index
    ids = dict(documents())
    some = read_tokens(llm, folder).where("doc_id between 20 and 29")
    assert {r.doc_id: list(r.tokens) for r in some.collect()} == {d: whole(ids[d]).tolist() for d in range(20, 30)}
    plan = read_tokens(llm, folder).select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan
    rows = sorted(read_tokens(llm, folder).select("doc_id", "start", "n_tokens").collect())
    assert [r.start for r in rows[1:]] == [r.start + r.n_tokens for r in rows[:-1]]


def test_token_cases(llm, whole):
    folder = new_folder(llm, "tokens")
    write_tokens(odd_docs(llm), folder, byte_bpe())
    got = token_digests(read_tokens(llm, folder)).collect()
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(str((d, len(whole(t)), zlib.crc32(whole(t).tobytes()))) for d, t, *_ in odd_rows())
    got.sort(key=lambda r: r.start)
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got) and got[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    empty = new_folder(llm, "tokens")
    write_tokens(no_docs(llm), empty, byte_bpe())
    assert token_digests(read_tokens(llm, empty)).count() == 0


def held(pieces, texts, whole, length=1024):
    """Every id in just one piece, sequences without gaps, no padding but in the last ones."""
    cover, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        cover[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(cover) == set(texts)
    for d, parts in cover.items():
        ids, at = whole(texts[d]), 0
        for start, n, crc, all_ids in sorted(parts):
            assert start == at and all_ids == len(ids) and crc == zlib.crc32(ids[start:start + n].tobytes())
            at += n
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        sizes.append(at)
    assert all(s <= length and s & (s - 1) == 0 for s in sizes)
    return sequences


def test_packing(llm, whole):
    sequences = held(QUERIES["op8_cost_balanced_packing"](llm, SF).collect(), dict(documents()), whole)
    cost = [sum(piece_cost(n) for _, n in parts) for parts in sequences.values() if sum(n for _, n in parts) == 1024]
    assert max(cost) <= piece_cost(1024) + 1e-9


def test_packing_cases(llm, whole):
    rows = [(i, t) for i, (_, t, *_) in enumerate(odd_rows())]
    docs = llm.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).repartition(3)
    held(pack(docs, byte_bpe(), window=8).withColumn("ids_crc32", F.crc32("ids")).collect(), dict(rows), whole)
    assert pack(no_docs(llm), byte_bpe()).count() == 0
    assert pack(odd_docs(llm), byte_bpe()).agg(F.sum("length")).first()[0] == sum(len(whole(t)) for _, t, *_ in odd_rows())


def test_longest_go_to_the_cheapest():
    out = list(balanced([700, 600, 300, 324, 124], [1024, 1024]))
    assert [o[0] for o in out[:2]] == [0, 1] and out[0][3] != out[1][3]
    assert sum(o[2] for o in out) == 2048 and out[2][:3] == (3, 0, 324) and out[2][3] == out[1][3]
    assert powers_of_two(700) == [512, 128, 32, 16, 8, 4]
