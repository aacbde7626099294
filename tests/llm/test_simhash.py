"""SimHash groups against fingerprints and links worked out one by one."""

import random

import pytest
import xxhash
from helpers import no_docs, odd_docs, odd_rows, words

from ratemill.llm.queries import op11_simhash_near_dedup
from ratemill.llm.simhash import ball, fingerprint, near_fingerprints, simhash_groups

SF = "/root/testdata/sf0.01"


def plain_print(text):
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """(doc_id, hex, component) of each row, by comparing every two fingerprints."""
    prints = [(d, plain_print(t)) for d, t in rows]
    distinct = sorted({p for _, p in prints})
    parent = {p: p for p in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    first = {}
    for d, p in prints:
        if d is not None:
            parent[find(p)] = find(first.setdefault(d, p))
    smallest = {}
    for d, p in prints:
        if d is not None:
            smallest[find(p)] = min(d, smallest.get(find(p), d))
    return [(d, f"{p:016x}", smallest.get(find(p))) for d, p in prints]


def plainly(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = plainly(op11_simhash_near_dedup(spark, SF))
    assert got == sorted(plain_groups([tuple(r) for r in docs]), key=str)
    assert len({c for _, _, c in got}) < len(got)


def test_odd_rows(spark):
    assert plainly(simhash_groups(odd_docs(spark))) == sorted(plain_groups([r[:2] for r in odd_rows()]), key=str)
    assert simhash_groups(no_docs(spark)).collect() == []


def test_repeated_ids_reach_through_all_their_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(3, a), (5, a), (5, b), (9, b), (None, b), (None, "alone")]
    got = plainly(simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted(plain_groups(rows), key=str)
    assert {c for d, _, c in got if d} == {3}


def test_fingerprint_sees_whole_long_texts():
    text = " ".join(f"w{i % 7919}" for i in range(150_000))
    assert fingerprint(text.encode()) == plain_print(text)
    assert fingerprint(b"ONE two") == plain_print("one  TWO") == xxhash.xxh64_intdigest(b"one two", 42)


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_have_the_components_of_all_pairs(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {0, (1 << 64) - 1}
    for x in base:     # chains and dense clusters around each
        for _ in range(12):
            prints.add(x)
            x ^= 1 << rng.randrange(64) ^ (1 << rng.randrange(64) if rng.random() < 0.5 else 0)
        prints |= {x ^ 1 << i for i in range(0, 64, 3)}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    links = near_fingerprints(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), radius).collect()
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= radius
        parent[find(r.a)] = find(r.b)
    got = {p: find(p) for p in signed}
    for a in signed:
        for b in signed:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius:
                assert got[a] == got[b]


def test_ball():
    assert len(ball(1)) == 65 and len(ball(2)) == 65 + 64 * 63 // 2
    with pytest.raises(ValueError):
        near_fingerprints(None, 3)
