"""Quality rules with a language model, and ranked quality, against plain versions and held-out labels."""

import math
import re
import statistics
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import no_docs, odd_docs, odd_rows, words
from pyspark.sql import functions as F

from ratemill.llm.common import ready, table
from ratemill.llm.perplexity import LOWER_BAND, SMALLEST_SPREAD, START, UPPER_BAND, base_counts, quality_rules
from ratemill.llm.ranking import features, fit_pairs, keep_good, quality_scores
from ratemill.llm.registry import QUERIES

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def llm(spark):
    import ratemill.llm.queries  # noqa: F401
    return ready(spark)


def plain_counts(text):
    w, lines = words(text, lower=False), (text or "").split("\n")
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    dup = sum(bool(words(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_base_counts():
    texts = [t for _, t, *_ in odd_rows() if t is None or len(t) < 9999] + ["a b c a b c a b", "a a a a", "x\n\nx\n x\nx\n", "é # é | <>&\x0b%", "a b c d a b c"]
    texts += [r["text"] for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()][:80]
    assert [base_counts(t or "") for t in texts] == [plain_counts(t) for t in texts]


def plain_model(rows, order):
    """Modified Kneser-Ney by definition, over dictionaries."""
    flat = {x: re.sub(rb"[\x09-\x0D]", b" ", x) for _, x in rows}
    by = defaultdict(Counter)
    for lang, x in rows:
        data = bytes([START]) * (order - 1) + flat[x]
        by[lang].update(data[i:i + order] for i in range(len(flat[x])))
    out = {}
    for lang, top in by.items():
        counts = {order: top}
        for n in range(order - 1, 0, -1):
            counts[n] = Counter(g[1:] for g in counts[n + 1])
        p = {(): None}
        for n in range(1, order + 1):
            times = Counter(counts[n].values())
            y = times[1] / (times[1] + 2 * times[2]) if times[1] + times[2] else None
            d = {}
            for i in (1, 2, 3):
                raw = i - (i + 1) * y * times[i + 1] / times[i] if y is not None and times[i] else 0.5 * i
                d[i] = max(0.05, min(i - 0.05, raw))
            cut = {g: d[c] if c < 3 else min(d[3], c - 0.05) for g, c in counts[n].items()}
            total, off = Counter(), Counter()
            for g, c in counts[n].items():
                total[g[:-1]] += c
                off[g[:-1]] += cut[g]
            for g, c in counts[n].items():
                p[g] = (c - cut[g]) / total[g[:-1]] + off[g[:-1]] / total[g[:-1]] * (p[g[1:]] if n > 1 else 1 / 256)
        out[lang] = p
    return {(lang, x): -sum(math.log(out[lang][(bytes([START]) * (order - 1) + flat[x])[i:i + order]]) for i in range(len(x))) / len(x) for lang, x in rows if x}


def test_perplexity_and_bands(llm):
    rows = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    want = plain_model([(r["lang"], r["text"].encode()) for r in rows], 3)
    got = {r.doc_id: r for r in QUERIES["op6_quality_rules"](llm, SMALL).collect()}
    assert len(got) == len(rows)
    value = {r["doc_id"]: want[r["lang"], r["text"].encode()] for r in rows}
    off = [abs(got[d].log_perplexity - v) for d, v in value.items()]
    assert np.mean(off) < 0.01 and max(off) < 0.1          # slots that grams share move a few
    band = {}
    for lang in {r["lang"] for r in rows}:
        v = sorted(got[r["doc_id"]].log_perplexity for r in rows if r["lang"] == lang and got[r["doc_id"]].n_words >= 50)
        centre = statistics.median_low(v)
        far = max(1.4826 * statistics.median_low([abs(x - centre) for x in v]), SMALLEST_SPREAD)
        band[lang] = centre - LOWER_BAND * far, centre + UPPER_BAND * far
    for r in rows:
        g = got[r["doc_id"]]
        counts = plain_counts(r["text"])
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert g.base_failed == failed and g.kept == (not failed and band[r["lang"]][0] <= g.log_perplexity <= band[r["lang"]][1])


def test_every_gram_has_its_own_probability(llm, monkeypatch):
    """Also where texts are binary junk in many languages, and the model takes several files."""
    from ratemill.llm import perplexity
    monkeypatch.setattr(perplexity, "PART_ROWS", 5_000, raising=False)
    rng = np.random.default_rng(5)
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()[:60]]
    rows += [(1_000 + i, f"l{i % 7}", "".join(map(chr, rng.integers(33, 0x2FFF, 4_000)))) for i in range(35)]
    want = plain_model([(lang, x.encode()) for _, lang, x in rows], 3)
    got = {r.doc_id: r.log_perplexity for r in quality_rules(llm.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert all(math.isclose(got[d], want[lang, x.encode()], rel_tol=1e-9) for d, lang, x in rows if x)


def test_languages_and_starts_are_told_apart(llm):
    """Languages whose checksums meet have models of their own, and a control character in a text is not taken for the start of one."""
    seen, pair = {}, None
    for name in (f"{i * 0x9E3779B97F4A7C15 % 2 ** 64:x}" for i in range(200_000)):
        if (other := seen.setdefault(zlib.crc32(name.encode()) >> 8, name)) != name:
            pair = other, name
            break
    rows = [(i, pair[i % 2], f"{'abc cab' if i % 2 else 'xyz abz'} {i}") for i in range(8)]
    rows += [(10 + i, "en", x) for i, x in enumerate(["\x02\x02b", "abab", "ab \x02\x02ba", "b\x02\x02a"])]
    want = plain_model([(lang, x.encode().replace(b"\x02", b"\xFE")) for _, lang, x in rows], 3)      # a byte that is no mark
    got = {r.doc_id: r.log_perplexity for r in quality_rules(llm.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert all(math.isclose(got[d], want[lang, x.encode().replace(b"\x02", b"\xFE")], rel_tol=1e-9) for d, lang, x in rows)
    with pytest.raises(ValueError, match="order"):
        quality_rules(odd_docs(llm), order=6)


def test_clean_documents_are_kept(llm):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = [r for r in QUERIES["op6_quality_rules"](llm, SF).collect() if r.doc_id in labels and not r.base_failed]
    kept = {q: np.mean([r.kept for r in rows if labels[r.doc_id] == q]) for q in (0, 1)}
    assert kept[1] > 0.97 and kept[0] < 0.5


def test_rule_cases(llm):
    got = quality_rules(odd_docs(llm)).collect()
    assert len(got) == len(odd_rows()) and quality_rules(no_docs(llm)).count() == 0
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50) and all(r.log_perplexity is None for r in got if r.doc_id in (4, 5))


def test_ranking_on_held_out_labels(llm):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = QUERIES["op7_quality_ranking"](llm, SF).collect()
    assert len(rows) == 10_000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.98


def test_scores_depend_on_text_alone(llm):
    docs, labels = table(llm, SMALL, "documents"), table(llm, SMALL, "labels")
    moved = docs.selectExpr("doc_id", "text", "'xx' as lang", "'s' as source", "1 as score", "true as held_out", "2 as predicted")
    one, two = (sorted((r.doc_id, r.held_out, r.score, r.predicted) for r in quality_scores(d, labels).collect()) for d in (docs, moved))
    assert one == two
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    assert one == sorted((r.doc_id, r.held_out, r.score, r.predicted) for r in quality_scores(docs, flipped).collect())


def test_ranking_cases(llm):
    labels = llm.createDataFrame([(i, i % 2, 0) for i in range(1, 17)] + [(2, None, 0), (None, 1, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(odd_docs(llm), labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    none = quality_scores(odd_docs(llm), labels.where("quality = 1")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)} and quality_scores(no_docs(llm), labels).count() == 0
    assert keep_good(odd_docs(llm), labels).columns == odd_docs(llm).columns
    assert features(b"") == tuple([0.0] * 14)


def test_rejected_rows_without_doc_id_go(llm):
    docs, labels = table(llm, SMALL, "documents"), table(llm, SMALL, "labels")
    bad = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 0").collect()}
    nameless = docs.where(docs.doc_id.isin(sorted(bad)[:5])).selectExpr("cast(null as bigint) as doc_id", *docs.columns[1:])
    left = keep_good(docs.unionByName(nameless), labels).collect()
    assert len(bad) >= 5 and {r.doc_id for r in left}.isdisjoint({None, *bad}) and len(left) == docs.count() - len(bad)


def test_pairs_recover_an_order():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4))
    good = x @ np.array([2, -1, 0.5, 0]) + 0.3 * rng.normal(size=600) > 0.4
    model = fit_pairs(x, good)
    assert ((model.scores(x) >= 0.5) == good).mean() > 0.9 and (model.scores(x) >= 0.5).sum() == good.sum()


def test_sample_holds_a_document_once(llm, monkeypatch):
    """A doc_id that repeats in documents and labels gives one feature row, so the driver's rows are bounded by ``sample_rows``."""
    from ratemill.llm import ranking
    seen = []
    monkeypatch.setattr(ranking, "fit_pairs", lambda x, good: seen.append(len(x)) or fit_pairs(x, good))
    docs, labels = llm.read.parquet(f"{SF}/documents.parquet"), llm.read.parquet(f"{SF}/labels.parquet")
    other = docs.withColumn("text", F.concat("text", F.lit(" again")))
    many = docs.unionByName(docs).unionByName(other)
    ranking.learned(many, labels.unionByName(labels).unionByName(labels.withColumn("quality", 1 - F.col("quality"))), 50)
    ranking.learned(many, labels.unionByName(labels), 100)
    assert len(seen) <= 2 and max(seen) <= 100 and seen[-1] == 100


def test_fit_takes_every_labelled_row(llm, monkeypatch):
    """All rows in one bucket give the plain fit; in many buckets, with a rare side, every row still counts and the model is close to it."""
    from ratemill.llm import ranking
    monkeypatch.setattr(ranking, "fit_pairs", None)
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(30_000, 14)), 3)
    good = x @ np.linspace(-1, 1, 14) + rng.normal(size=30_000) > 3
    schema = "doc_id long, text_key long, features array<double>"
    docs = llm.createDataFrame([(3 * i, 0, v) for i, v in enumerate(x.tolist())], schema)
    labels = llm.createDataFrame([(3 * i, int(g)) for i, g in enumerate(good.tolist())], "doc_id long, quality int")
    own = np.array([zlib.crc32(str(3 * i).encode()) % 3 != 1 for i in range(30_000)])
    order = np.lexsort([3 * np.flatnonzero(own), *x[own].T, good[own]])
    plain = fit_pairs(x[own][order], good[own][order])
    for rows, tolerance in ((50_000, 1e-7), (1_000, 0.1)):
        monkeypatch.setattr(ranking, "BUCKET_ROWS", rows, raising=False)
        model = ranking.learned(docs, labels)
        assert np.allclose(model.mean, plain.mean) and np.allclose(model.scale, plain.scale) and np.allclose(model.weights, plain.weights, atol=tolerance)
        assert (model.scores(x[own]) >= 0.5).sum() == good[own].sum()


def test_fit_and_scores_against_plain_descent(llm):
    """The pairwise fit against gradient steps on the same loss, and the query's scores against that model worked out text by text."""
    from ratemill.llm import ranking
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3)) @ np.diag([1.0, 3.0, 0.5])
    good = x @ np.array([1.0, 0.4, -2.0]) + rng.normal(size=60) > 0
    model = fit_pairs(x, good)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    best, rest, n = z[good], z[~good], ranking.PAIRS_PER_ROW * max(good.sum(), (~good).sum())
    draw = np.random.default_rng(11)
    a, b = (np.concatenate([draw.permutation(len(side)) for _ in range(-(-n // len(side)))])[:n] for side in (best, rest))
    d, w = best[a] - rest[b], np.zeros(3)
    for _ in range(20_000):
        w += 0.3 * (d.T @ (1 / (1 + np.exp(d @ w))) / n - ranking.RIDGE * w)
    assert np.allclose(model.weights, w, atol=1e-4)
    docs, labels = llm.read.parquet(f"{SF}/documents.parquet"), llm.read.parquet(f"{SF}/labels.parquet")
    learned = ranking.learned(docs, labels)
    got = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    for doc_id, text in docs.select("doc_id", "text").limit(200).collect():
        f = (np.array(features((text or "").encode())) - learned.mean) / learned.scale
        assert abs(got[doc_id] - 1 / (1 + math.exp(-max(-40, min(40, float(f @ learned.weights) - learned.threshold))))) < 1e-9
