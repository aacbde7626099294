"""Periodic runs against a plain search for every start and period."""

import hashlib
import itertools
import random
import zlib

import numpy as np
from helpers import no_docs, odd_docs, odd_rows

from ratemill.llm.periodic import _block, collapse_runs, maximal_runs
from ratemill.llm.queries import op12_periodic_runs

SF = "/root/testdata/sf0.01"


def plain_runs(w, least=12):
    """Every maximal stretch with a period, the smallest one of each stretch."""
    found, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def as_list(numbers, least):
    return [tuple(int(x) for x in r) for r in zip(*maximal_runs(np.array(numbers, np.int64), least))]


def plain_words(text):
    return [x.decode() for x in (text or "").encode().split()]


def plant(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def test_every_short_sequence():
    for n, letters in ((12, 2), (8, 3)):
        for w in itertools.product(range(letters), repeat=n):
            if w[0] == 0:
                assert as_list(w, 2) == plain_runs(w, 2), w


def test_periodic_roots_meet_themselves():
    for t in range(3, 9):
        for root in ((0, 1) * t + (0,), (0, 0, 1) * t + (0,), (0, 0, 0, 1) * t + (0,), (0, 1, 0, 0, 1) * t + (0, 1, 0)):
            for around in ((9,), (1,), (0,), (0, 1), (1, 0)):
                w = around + root + root + around
                assert as_list(w, 2) == plain_runs(w, 2), w


def test_random_sequences():
    rng = random.Random(5)
    for _ in range(400):
        w = [rng.randrange(rng.choice((2, 3, 6))) for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 4)):
            a, q = rng.randrange(len(w) + 1), rng.randrange(1, 12)
            w[a:a] = (w[a:a + q] or [7]) * rng.randrange(2, 6) + w[a:a + rng.randrange(0, q)]
        assert as_list(w, 2) == plain_runs(w, 2), w
        assert as_list(w, 12) == plain_runs(w, 12), w


def test_texts_of_a_block_do_not_meet():
    texts = [[b"a"] * 13, [b"a"] * 5, [], [b"a", b"b"] * 6, [b"a", b"b"] * 5]
    found = list(_block(texts, 12))
    assert [[tuple(r.values()) for r in runs] for runs, _ in found] == [[(0, 13, 1)], [], [], [(0, 12, 2)], []]
    assert [c for _, c in found] == [b"a", b"a a a a a", b"", b"a b", b" ".join(texts[4])]


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        w = plant(doc_id, plain_words(text))
        if len(w) > 2500:     # the plain search is quadratic; long texts are in the tests above and below
            continue
        runs, r = plain_runs(w), got[doc_id]
        longest = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *longest), doc_id
        assert r.exponent_milli == (1000 * longest[1] // longest[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
        planted += bool(runs)
    assert planted > 50


def test_long_text_in_one_run():
    w = [i % 1000 for i in range(200_000)]
    assert as_list(w, 12) == [(0, 200_000, 1000)]
    assert as_list([0] * 100_000 + [1] + [0] * 50_000, 12) == [(0, 100_000, 1), (100_001, 50_000, 1)]


def test_odd_rows(spark):
    rows = odd_rows()
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in collapse_runs(odd_docs(spark)).collect()), key=str)
    want = []
    for r in rows:
        w = plain_words(r[1])
        runs = plain_runs(w) if len(w) < 2500 else [tuple(x) for x in as_list(np.unique(w, return_inverse=True)[1], 12)]
        want.append((r[0], len(w), runs, collapsed(w, runs)))
    assert got == sorted(want, key=str)
    assert collapse_runs(no_docs(spark)).collect() == []
