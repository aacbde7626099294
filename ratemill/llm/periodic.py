"""Runs of periodic words in documents, found with a dictionary of basic factors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.llm.common import text_key

MIN_LENGTH = 12
BLOCK_WORDS = 1 << 18
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def proposals(at: np.ndarray, name: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from m to 2m - 1 that the occurrences of factors of m words propose. ``at`` is sorted within each name.

    Occurrences that follow one another by m/2 words or less are an arithmetic progression (its step is the factor's period) and stand in
    one periodic stretch; other successors start a new progression, more than m/2 words on. In a run of period q, m <= q < 2m, the factor
    at the run's start returns q words later in another progression. Either the ends of both stretches lie in the run, then
    the last occurrences are q apart; or the returning one is the first of its progression. So each occurrence proposes its distance to the first ones
    of the next progressions, and each progression the distance of its last occurrence to theirs; there are few within 2m words.
    """
    starts = np.concatenate([[True], (name[1:] != name[:-1]) | (2 * (at[1:] - at[:-1]) > m)])
    group = np.cumsum(starts) - 1
    first, last, kind = at[starts], at[np.concatenate([starts[1:], [True]])], name[starts]
    places, periods = [], []
    for t in count(1):
        later = np.minimum(group + t, len(first) - 1)
        d = first[later] - at
        near = (group + t < len(first)) & (kind[later] == name) & (d < 2 * m)
        e = last[t:] - last[:-t]
        near_last = (kind[t:] == kind[:-t]) & (e < 2 * m)
        if not near.any() and not near_last.any():
            break
        near &= d >= m
        near_last &= e >= m
        places += [at[near], last[:-t][near_last]]
        periods += [d[near], e[near_last]]
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _agreement(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from a and b on (step 1) or before them (step -1); a < b. Longer factors first, each level once."""
    n, out = len(levels[0]), np.zeros(len(a), np.int64)
    for k in reversed(range(len(levels))):
        m, name = 1 << k, levels[k]
        x, y = (a + out, b + out) if step > 0 else (a - out - m, b - out - m)
        inside = (x >= 0) & (y < n)
        x, y = x[inside], y[inside]
        same = inside.copy()
        same[inside] = (name[x] > 0) & (name[x] == name[y])
        out += m * same
    return out


def maximal_runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, smallest period) of all runs of word numbers, by start and period: at least two periods and ``min_length`` words.

    Level k names the factors of 2**k words from two names of the level before; only those that occur again have one. The last
    level is the one before none does, so memory is the words times the logarithm of the longest repeat.
    """
    n, m = len(words), 1
    at, key = np.arange(n), words
    levels, places, periods = [], [], []
    while len(at):
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        name = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
        again = np.bincount(name)[name] > 1
        at, name = at[again], name[again]
        if not len(at):
            break
        level = np.zeros(n, np.int32 if n < 1 << 31 else np.int64)
        level[at] = name
        levels.append(level)
        for all_, new in zip((places, periods), proposals(at, name, m)):
            all_.append(new)
        at = np.flatnonzero((level[:-m] > 0) & (level[m:] > 0)) if m < n else at[:0]
        key = level[at].astype(np.int64) * (n + 1) + level[at + m]
        m *= 2
    place, period = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, periods))
    order = np.lexsort([place, period])
    place, period = place[order], period[order]
    if len(place):    # neighbours with one period are one stretch
        alone = np.concatenate([[True], (period[1:] != period[:-1]) | (place[1:] - place[:-1] > 1)])
        place, period = place[alone], period[alone]
        start = place - _agreement(levels, place, place + period, -1)
        end = place + period + _agreement(levels, place, place + period, 1)
        order = np.lexsort([period, end, start])
        start, end, period = start[order], end[order], period[order]
        new = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])    # the smallest period of each stretch
        new &= end - start >= np.maximum(min_length, 2 * period)
        start, end, period = start[new], end[new], period[new]
        order = np.lexsort([period, start])
        return start[order], (end - start)[order], period[order]
    return place, place, period


def _block(texts: list[list[bytes]], min_length: int) -> Iterator[tuple[list[dict], bytes]]:
    """Runs and kept words of each text. Words are numbered by text and a number of its own stands after each text, so no run crosses."""
    numbers, begins = [], []
    for words in texts:
        base, own = len(numbers), {}
        begins.append(base)
        numbers += [own.setdefault(w, base + len(own)) for w in words]
        numbers.append(base + len(words))
    start, length, period = maximal_runs(np.array(numbers, np.int64), min_length)
    edge = np.searchsorted(start, [*begins, len(numbers)])
    for words, base, a, b in zip(texts, begins, edge, edge[1:]):
        if a == b:
            yield [], b" ".join(words)
            continue
        own, size, q = start[a:b] - base, length[a:b], period[a:b]
        change = np.bincount(own + q, minlength=len(words) + 1) - np.bincount(own + size, minlength=len(words) + 1)
        kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
        yield [{"start": int(s), "length": int(n), "period": int(p)} for s, n, p in zip(own, size, q)], b" ".join([words[i] for i in kept])


def _collapsed(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").split() for t in batch["text"].to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo + 1, len(texts[lo])
                while hi < len(texts) and size + len(texts[hi]) < BLOCK_WORDS:
                    size += len(texts[hi])
                    hi += 1
                found = list(_block(texts[lo:hi], min_length))
                part = batch.slice(lo, hi - lo)
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["text_key"], pa.array([len(t) for t in texts[lo:hi]], pa.int64()), pa.array([r for r, _ in found], kind), pa.array([c.decode() for _, c in found], pa.string())],
                    ["doc_id", "text_key", "n_words", "runs", "collapsed"])
                lo = hi
    return run


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, runs (start, length, period; by start, then period) and collapsed (the text without
    what its runs repeat, words joined by one space).

    Words are runs of bytes other than 20 and 09-0D (hex). A run is a stretch of words with smallest period q, at least two periods and
    ``min_length`` words long, that no neighbouring word extends; a word goes where some run has it after its first q words. Each document
    is worked on alone, in blocks of about 260,000 words; there is no shuffle.

    Cases: a null or empty text has no words, no run and an empty collapsed text. Rows without doc_id, or alike, are treated like any other. An
    empty table gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_collapsed(min_length), f"doc_id long, text_key long, n_words long, runs {RUNS}, collapsed string")


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            h = zlib.crc32(str(doc_id).encode())
            words = (text or "").encode().split() if doc_id is not None and h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)]).decode()
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "text"])


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents (by crc32 of doc_id) go on from some word with a period; null ids are left alone."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_planted, "doc_id long, text string")


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) with its exponent, and digests of all runs and of the rest."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("run"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", (-F.col("run.start")).alias("start"), F.col("run.length").alias("length"), (-F.col("run.period")).alias("period"),
                       F.expr("1000 * run.length div -run.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
