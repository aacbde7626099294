"""Near and exact duplicates against brute force."""

import hashlib
import re

import pyarrow.parquet as pq
import pytest
from helpers import SPACE, near_components, no_docs, odd_docs, odd_rows, shingles

from ratemill.llm.common import ready
from ratemill.llm.components import components
from ratemill.llm.exact import exact_groups, keep_first_copy
from ratemill.llm.minhash import keep_one_of_each, near_duplicates, signature
from ratemill.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def llm(spark):
    import ratemill.llm.queries  # noqa: F401
    return ready(spark)


def test_near_query_against_brute_force(llm):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = near_components(rows)
    got = QUERIES["op1_minhash_near_dedup"](llm, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {d: (len(shingles(t)), want[d], want[d] == d) for d, t in rows}
    assert len(got) == len(rows) and sum(not r.kept for r in got) > 20


def test_near_cases(llm):
    rows = odd_rows()
    want = near_components([r[:2] for r in rows])
    got = near_duplicates(odd_docs(llm)).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == want.get(r.doc_id) and r.kept == (r.component_id == r.doc_id or r.doc_id is None) for r in got)
    assert sorted((r.doc_id or 0, r.n_shingles) for r in got) == sorted((d or 0, len(shingles(t))) for d, t, *_ in rows)
    assert want[13] == 12 and want[3] == 1 and want[14] == 14 and want[15] == 14
    assert near_duplicates(no_docs(llm)).count() == 0


def test_links_that_the_centre_does_not_have(llm):
    """Chains: each text is near the next one only, and all share a passage, so buckets hold several components."""
    base = [f"s{i}" for i in range(200)]
    rows = [(i, " ".join(base[4 * i:150 + 4 * i] + [f"t{i}"])) for i in range(12)] + [(100 + i, " ".join(base[:60] + [f"own{i}x{j}" for j in range(25)])) for i in range(40)]
    got = near_duplicates(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    want = near_components(rows)
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) == 41


def test_one_of_each_stays(llm):
    docs = odd_docs(llm)
    for keep, nameless in ((keep_one_of_each, 1), (keep_first_copy, 0)):     # an empty text is a copy of others but not near them
        left = keep(docs)
        assert left.columns == docs.columns
        ids = [r.doc_id for r in left.collect()]
        assert 1 in ids and 2 not in ids and 10 in ids and ids.count(None) == nameless
        assert keep(no_docs(llm)).count() == 0


def test_repeated_rows_stay_once(llm):
    """A batch that was loaded three times, copies among rows without doc_id, and one doc_id with equal texts in other white space."""
    batch = [(i, f"own text {i} " + "x y z " * i) for i in range(1, 6)]
    rows = 3 * batch + [(None, "no id"), (None, "no  id"), (None, "no id"), (9, "one  two"), (9, "one two"), (9, "one two")]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    exact = keep_first_copy(docs).collect()
    assert sorted((r.doc_id or 0, re.sub(SPACE, " ", r.text)) for r in exact) == sorted([(0, "no id"), (9, "one two"), *[(d, re.sub(SPACE, " ", t)) for d, t in batch]])
    near = [(r.doc_id, r.text) for r in keep_one_of_each(docs).collect()]
    assert len(near) == len(set(near)) and {d for d, _ in near} == {None, 1, 2, 3, 4, 5, 9}


def test_signature_estimates_similarity():
    import numpy as np
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (600, 200, 200))
    same = (signature(np.concatenate([common, a]), 512) == signature(np.concatenate([common, b]), 512)).mean()
    assert abs(same - 0.6) < 0.08


def test_exact_cases(llm):
    rows = odd_rows()
    plain = [re.sub(SPACE, " ", t or "") for _, t, *_ in rows]
    got = exact_groups(odd_docs(llm)).collect()
    want = []
    for (d, *_), p in zip(rows, plain):
        same = [r[0] for r, q in zip(rows, plain) if q == p]
        ids = [x for x in same if x is not None]
        keep = (min(ids) if ids else None) if len(same) > 1 else d
        want.append((d, keep, len(same), keep is None or d == keep, hashlib.sha256(p.encode()).hexdigest()))
    key = str
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got], key=key) == sorted(want, key=key)
    assert exact_groups(no_docs(llm)).count() == 0


def test_exact_reads_to_the_last_byte(llm):
    """Texts of one length that differ in their last byte, past several digits."""
    text = "abcdefgh " * 40_000
    rows = [(i, text + "xyz"[i % 3]) for i in range(9)]
    got = exact_groups(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {i: (i % 3, 3) for i in range(9)}


def test_components_of_a_long_chain(llm):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 103), (103, 101), (7, 7)]
    got = {r.node: r.root for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 103: 100}


def near_of(llm, rows):
    return sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(llm.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)


def test_a_doc_id_is_linked_by_all_its_texts(llm):
    a, b, c = ("\n".join(f"{x}{i}" for i in range(60)) for x in "abc")
    assert near_of(llm, [(3, a), (5, a), (5, b), (9, b)]) == [(3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False)]
    rows = [(20, a), (11, b), (11, ""), (20, b + " tail"), (30, c), (30, c + " x"), (12, c), (40, None), (None, a), (7, a + " end")]
    got = near_of(llm, rows)
    roots = near_components([r for r in rows])
    assert got == sorted(((d, roots.get(d), roots.get(d) == d if d else True) for d, _ in rows), key=str)


def test_rows_without_doc_id_are_copies_too(llm):
    """A row without doc_id goes where another row has its text, or one near it; of several such rows one stays."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, "x y z"), (None, "x y z"), (2, a), (None, a + " tail"), (None, b), (None, b + " tail"), (None, "other"), (None, None), (None, "")]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in keep_first_copy(docs).collect()) == sorted([(0, ""), (0, "other"), (0, b), (0, b + " tail"), (0, a + " tail"), (1, "x y z"), (2, a)])
    near = [(r.doc_id, r.text) for r in keep_one_of_each(keep_first_copy(docs)).collect()]
    assert {(1, "x y z"), (2, a)} <= set(near) and len(near) == 5 and sum((t or "").startswith("b0") for _, t in near) == 1 and (None, a + " tail") not in near
