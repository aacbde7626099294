"""Quality scores of documents from preference pairs: a Bradley-Terry model over text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.llm.common import stored, text_key, without
from ratemill.session import broadcast_if_small

BUCKET_ROWS = 20_000     # labelled rows of a bucket, about
LENT_ROWS = 500          # of a rare side in a bucket, about
QUANTILE_ACCURACY = 10_000
PAIRS_PER_ROW = 8
RIDGE = 1e-3
UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
SYMBOLS, STOPS, BARS = b"#*$%&<>@^~=+_{}[]\\/", b".,;:'\"()-", b"|"
FEATURES = ["words", "word_bytes", "upper", "lower", "digits", "symbols", "stops", "exclamations", "bars", "distinct", "same_as_last", "repeated_lines", "line_words", "other_bytes"]


def features(text: bytes) -> tuple[float, ...]:
    """Shape of a text: sizes, shares of kinds of characters, repetition. An empty text has zeros."""
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(text))
    kinds = [(len(text) - len(text.translate(None, x))) / size for x in (UPPER, LOWER, DIGITS, SYMBOLS, STOPS, b"!", BARS)]
    return (np.log1p(len(words)), len(text) / n, *kinds, len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
            (len(lines) - len(set(lines))) / max(1, len(lines)), np.log1p(len(words) / max(1, len(lines))), 1 - sum(kinds) if text else 0.0)


@dataclass
class Ranking:
    """Weights of the standardised features, and the latent score that parts good from bad."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        latent = _products((x - self.mean) / self.scale, self.weights) - self.threshold
        return 1 / (1 + np.exp(-np.clip(latent, -40, 40)))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([features(t or b"") for t in batch["text"].to_pylist()], float).reshape(-1, len(FEATURES))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], lists], ["doc_id", "text_key", "features"])


def shapes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and features of every row, from its whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_featured, "doc_id long, text_key long, features array<double>")


def paired(best: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Differences of preferred and other documents: every one of the larger side meets ``PAIRS_PER_ROW`` of the other side."""
    n = PAIRS_PER_ROW * max(len(best), len(rest))
    rng = np.random.default_rng(11)
    return best[np.concatenate([rng.permutation(len(best)) for _ in range(-(-n // len(best)))])[:n]] - rest[np.concatenate([rng.permutation(len(rest)) for _ in range(-(-n // len(rest)))])[:n]]


def _slopes(difference: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over pairs for a Newton step: the loss's second and first derivatives, without the ridge."""
    p = 1 / (1 + np.exp(np.clip(difference @ w, -40, 40)))     # chance given to the wrong order
    return (difference * (p * (1 - p))[:, None]).T @ difference, difference.T @ p


def _newton(slopes, size: int, rounds: int) -> np.ndarray:
    """The weights at which the ridge loss is least; ``slopes(w)`` sums up all pairs, and their number."""
    w = np.zeros(size)
    for _ in range(rounds):
        second, first, n = slopes(w)
        step = np.linalg.solve(second / n + RIDGE * np.eye(size), first / n - RIDGE * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_pairs(x: np.ndarray, good: np.ndarray, rounds: int = 30) -> Ranking:
    """Logistic loss on differences of preferred and other documents, by Newton steps; all rows at hand.

    The threshold is the quantile of all scores at the share of documents that are not good, halfway between the scores on either side.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    difference = paired(z[good], z[~good])
    w = _newton(lambda w: (*_slopes(difference, w), len(difference)), x.shape[1], rounds)
    s = np.sort(_products(z, w))
    cut = int((~good).sum())
    return Ranking(mean, scale, w, float((s[cut - 1] + s[cut]) / 2))


def _marked(docs: DataFrame, labels: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """doc_id, quality and features of labelled documents that are not held out. A doc_id counts once: with its smallest label, and of several
    texts the one with the smallest hash."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null").where(~held_out())
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    if sample_rows is not None:
        marks = marks.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(sample_rows)
    rows = docs.withColumn("text_key", F.coalesce("text_key", F.lit(0))).join(broadcast_if_small(marks), "doc_id")
    return rows.groupBy("doc_id", "quality").agg(F.min_by("features", "text_key").alias("features"))


def _bucket_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, marks and whether it is the row's own bucket, in an order that does not depend on how rows arrive."""
    good = np.asarray(table["quality"]) == 1
    x = np.array(table["features"].to_pylist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort([np.asarray(table["doc_id"]), *x.T, good])
    return x[order], good[order], np.asarray(table["own"])[order]


def _totals(rows: DataFrame, work) -> np.ndarray:
    """Sums of the arrays that ``work(x, good, own)`` gives for each bucket, added up in the buckets' order; a row a bucket reaches the driver."""
    def run(key, table):
        return pa.table({"bucket": [key[0].as_py()], "value": pa.array([work(*_bucket_arrays(table)).ravel().tolist()], pa.list_(pa.float64()))})

    found = rows.groupBy("bucket").applyInArrow(run, "bucket long, value array<double>").toArrow().sort_by("bucket")
    return np.sum(np.array(found["value"].to_pylist(), float), axis=0)


def fit_all(marked: DataFrame, rounds: int = 30) -> Ranking | None:
    """``fit_pairs`` over all rows of a table, which stay where they are.

    Rows are dealt to buckets of about ``BUCKET_ROWS`` by a hash of doc_id; pairs are made within a bucket, so each document of its larger
    side meets ``PAIRS_PER_ROW`` of the other. Of a rare side each row is lent to as many further buckets as it takes for about ``LENT_ROWS`` in each.
    Sums of moments and of a Newton step's derivatives are all that leaves a bucket. The threshold is found exactly: scores near the quantile are
    counted value by value, after an approximate one said where to look.
    """
    size = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}     # two rows
    if len(size) < 2:
        return None
    n = sum(size.values())
    buckets = -(-n // BUCKET_ROWS)
    lent = {q: min(buckets, max(1, -(-buckets * LENT_ROWS // c))) for q, c in size.items()}
    home = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(buckets))
    turns = F.sequence(F.lit(0), F.when(F.col("quality") == 1, lent[1]).otherwise(lent[0]) - 1)
    rows = stored(marked.select("doc_id", "quality", "features", home.alias("home"), F.explode(turns).alias("turn")).select(
        "doc_id", "quality", "features", F.pmod(F.col("home") + F.col("turn"), F.lit(buckets)).alias("bucket"), (F.col("turn") == 0).alias("own")), "marked")
    k = len(FEATURES)
    mean = _totals(rows, lambda x, good, own: x[own].sum(axis=0)) / n
    scale = np.sqrt(_totals(rows, lambda x, good, own: ((x[own] - mean) ** 2).sum(axis=0)) / n)
    scale[scale < 1e-9] = 1

    def slopes(w: np.ndarray):
        def work(x, good, own):
            z = (x - mean) / scale
            if good.all() or not good.any():
                return np.zeros(k * k + k + 1)
            difference = paired(z[good], z[~good])
            second, first = _slopes(difference, w)
            return np.concatenate([second.ravel(), first, [len(difference)]])
        found = _totals(rows, work)
        return found[:k * k].reshape(k, k), found[k * k:-1], found[-1]

    w = _newton(slopes, k, rounds)

    def latent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch["features"].to_pylist(), float).reshape(-1, k)
            yield pa.RecordBatch.from_arrays([pa.array(_products((x - mean) / scale, w))], ["s"])

    s = stored(rows.where("own").select("features").mapInArrow(latent, "s double"), "latent")
    cut = size[0]
    return Ranking(mean, scale, w, (_nth(s, n, cut - 1) + _nth(s, n, cut)) / 2)


def _products(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Each row's product with the weights, the same in whatever batch it comes."""
    return (z * w).sum(axis=1)


def _nth(s: DataFrame, n: int, rank: int) -> float:
    """The value at ``rank`` (from 0) of the sorted column: counted exactly between two approximate quantiles around it."""
    near = 4 / QUANTILE_ACCURACY
    ends = [float(min(1.0, max(0.0, (rank + 0.5) / n + d))) for d in (-near, near)]
    found = s.agg(F.percentile_approx("s", ends, QUANTILE_ACCURACY).alias("q"), F.min("s").alias("lo"), F.max("s").alias("hi")).first()
    for lo, hi in (found["q"], (found["lo"], found["hi"])):
        below = s.where(F.col("s") < lo).count()
        counts = s.where(F.col("s").between(lo, hi)).groupBy("s").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0))     # of the few values between
        at = counts.select("s", (upto + below).alias("upto")).where(F.col("upto") > rank).agg(F.min("s")).first()[0]
        if below <= rank and at is not None:
            return float(at)
    raise ValueError("no such rank")


def learned(docs: DataFrame, labels: DataFrame, sample_rows: int | None = None) -> Ranking | None:
    """The model from all labelled documents that are not held out, or from ``sample_rows`` of them by a hash of doc_id, fitted on the
    driver. None without both labels. ``docs`` are documents or their ``shapes``."""
    marked = _marked(docs if "features" in docs.columns else shapes(docs), labels, sample_rows)
    if sample_rows is None:
        return fit_all(stored(marked, "marked"))
    found = marked.select("quality", "features").toArrow()      # at most sample_rows
    good = np.asarray(found["quality"]) == 1
    if good.all() or not good.any():
        return None
    x = np.array(found["features"].to_pylist(), float)
    order = np.lexsort([*x.T, good])      # the same order however rows arrive
    return fit_pairs(x[order], good[order])


def _scored(model: Ranking | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch["features"].to_pylist(), float).reshape(-1, len(FEATURES))
            score = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(score)], ["doc_id", "text_key", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, text_key.

    Scores come from the text alone. Preference pairs are good and bad documents among all labelled rows whose crc32(doc_id as text) mod 3 is
    not 1 (with ``sample_rows``, that many of them); sums over buckets of them reach the driver. Texts are read once, for their features, which
    are kept as a table that the fit and the scores read.

    Cases: a null or empty text is scored by its (zero) features. Without labels of both kinds every score is 0.5. Rows that repeat a doc_id
    are scored each by its own text; a doc_id with several labels or texts counts once in the fit. A row without doc_id is scored
    and not held out. An empty table gives no rows. Other columns are not looked at.
    """
    rows = stored(shapes(docs), "features")
    scored = rows.mapInArrow(_scored(learned(rows, labels, sample_rows)), "doc_id long, text_key long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_key")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected documents; columns stay as they are."""
    return without(docs, quality_scores(docs, labels).where("predicted = 0"))
