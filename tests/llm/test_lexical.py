"""Ranked search against sums worked out item by item."""

import math
import re
from collections import Counter

from compare import compare, duck
from helpers import no_docs, odd_docs, odd_rows

from ratemill.llm import llm_queries, llm_sql
from ratemill.llm.lexical import ranked_search

SF = "/root/testdata/sf0.01"


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=10):
    counted = [(d, Counter(t)) for d, text in docs if (t := plain_terms(text))]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(plain_terms(text))
    out = []
    for item, own in asked.items():
        scores = []
        for d, c in counted:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in own.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def plainly(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_query_against_sql_and_plain_version(spark):
    search = llm_queries()["op13_ranked_search"]
    assert compare(spark, duck(SF), SF, search, llm_sql()["op13_ranked_search"]) is None
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert plainly(search(spark, SF)) == plain_search(docs, items)


ITEMS = [(1, "one two THREE"), (2, "w1 w2 w3 apache apache"), (3, None), (4, ""), (5, "nothing-like-it"), (None, "Ünïcode w5"), (2, "one"), (6, "x")]


def test_odd_rows_small_shards_and_bundles(spark):
    rows = [r[:2] for r in odd_rows()]
    items = spark.createDataFrame([(i, t, None, 1, 2) for i, t in ITEMS], "item_id long, text string, doc_id string, score int, shard int")
    for how in ({}, {"shard_docs": 3, "bundle_items": 2, "owners": 3}, {"owners": 1}):
        assert plainly(ranked_search(odd_docs(spark), items, **how)) == plain_search(rows, ITEMS), how


def test_ties_across_shards(spark):
    rows = [(i, "same words here") for i in range(100, 0, -1)] + [(None, "same words here")] * 3 + [(i, "other text") for i in range(200, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([("q", "words")], "item_id string, text string")
    got = [(r["rank"], r.doc_id) for r in ranked_search(docs, items, shard_docs=5).orderBy("rank").collect()]
    assert got == [(i, i) for i in range(1, 11)]
    got = [r.doc_id for r in ranked_search(docs, items, top=103, shard_docs=5).orderBy("rank").collect()]
    assert got == [*range(1, 101), None, None, None]


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search(no_docs(spark), items).collect() == []
    assert ranked_search(odd_docs(spark), items.limit(0)).collect() == []
