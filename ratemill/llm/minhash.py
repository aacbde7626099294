"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.llm.common import stored, text_key, without, without_repeats
from ratemill.llm.components import components
from ratemill.llm.words import mix, shingle_sets
from ratemill.session import broadcast_if_small

DIMENSIONS = 1 << 22
WINDOW_ROWS = 2048
PARITY_LONGS = 32
_permutations: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def permutations(length: int) -> tuple[np.ndarray, np.ndarray]:
    """The two permutations of the hashed dimensions: one scatters shingles, the other, read as a ring, gives every coordinate.

    Coordinate k of a shingle at place p is the second permutation at p + k, so the coordinates of a shingle are one window of the ring.
    """
    if length not in _permutations:
        rng = np.random.default_rng(4_099)
        scatter = rng.permutation(DIMENSIONS).astype(np.uint32)
        ring = rng.permutation(DIMENSIONS).astype(np.uint32)
        ring = np.concatenate([ring, ring[:length]])
        _permutations[length] = scatter, np.lib.stride_tricks.sliding_window_view(ring, length)
    return _permutations[length]


def signature(shingles: np.ndarray, length: int) -> np.ndarray:
    scatter, windows = permutations(length)
    place = scatter[(mix(shingles) & np.uint64(DIMENSIONS - 1)).astype(np.int64)]
    out = windows[place[:WINDOW_ROWS]].min(axis=0)
    for i in range(WINDOW_ROWS, len(place), WINDOW_ROWS):
        np.minimum(out, windows[place[i:i + WINDOW_ROWS]].min(axis=0), out=out)
    return out


def parity(shingles: np.ndarray) -> np.ndarray:
    """One bit a cell of the hashed shingles: whether their number there is odd. Two sets differ in as many shingles as bits, or more."""
    cells = 64 * PARITY_LONGS
    odd = np.bincount((mix(shingles) >> np.uint64(32) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketches(k: int, bands: int, rows: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            sizes, sums, mixed, keys, odd, ends, odd_ends = [], [], [], [], [], [0], [0]
            for s in shingle_sets(batch["text"], k):
                sizes.append(len(s))
                sums.append(s.sum(dtype=np.uint64))
                mixed.append(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                if len(s) >= least:
                    coordinates = signature(s, bands * rows).astype(np.uint64).reshape(bands, rows)
                    key = numbers.copy()
                    for j in range(rows):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + coordinates[:, j])
                    keys.append(key)
                    odd.append(parity(s))
                ends.append(bands * len(keys))
                odd_ends.append(PARITY_LONGS * len(keys))
            flat, odd = [np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (keys, odd)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array(sizes, pa.int64()), pa.array(np.array(sums, np.uint64).view(np.int64)), pa.array(np.array(mixed, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.ListArray.from_arrays(pa.array(odd_ends, pa.int32()), pa.array(odd))],
                ["doc_id", "text_key", "n_shingles", "sum_1", "sum_2", "bands", "parity"])
    return run


def _linked(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(shingle_sets(batch["text_a"], k), shingle_sets(batch["text_b"], k)):
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(len(x) > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep)], ["a", "b"])
    return run


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are alike enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_linked(k, percent), "a long, b long")


def _mixed(placed: DataFrame, bucket: list[str]) -> DataFrame:
    """The buckets that hold several components, and the largest one of each."""
    parts = placed.groupBy(*bucket, "root").agg(F.count("*").alias("n")).groupBy(*bucket)
    return parts.agg(F.count("*").alias("parts"), F.max_by("root", F.struct("n", "root")).alias("largest")).where("parts > 1").drop("parts")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75, bands: int = 32, rows: int = 4) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept, and text_key.

    Documents are linked where 100 * shared >= percent * united over their full sets of distinct k-word shingles. Documents with equal
    sets are one class with its smallest doc_id as representative. Of bands * rows coordinates, agreement in all rows of a band makes a
    bucket. A bucket's members are first compared with its smallest one; where these links leave a bucket with several components, its
    members outside the largest component are compared with all members of other components, as far as the parities of their hashed
    shingles allow: a bound of the likeness that excludes no link, but nearly all pairs that only have a passage in common. No pair within a component is needed, so a bucket of near copies costs its size, not
    its square, and no bucket is cut. At similarity 0.75 a pair misses every one of 32
    bands of 4 with a chance of 5 in a million.

    Cases: a null or empty text, or one without words, has 0 shingles and is linked with nothing. Rows that repeat a doc_id are one
    document: what any of its texts is linked with, it is, and all its rows have one component. A row without doc_id is not compared: its component_id is null and it is kept. An empty table
    gives no rows. Other columns are not looked at.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62   # smaller sets can only be linked with equal ones
    sketch = stored(source.withColumn("text_key", text_key()).mapInArrow(
        _sketches(k, bands, rows, least), "doc_id long, text_key long, n_shingles long, sum_1 long, sum_2 long, bands array<long>, parity array<long>"), "sketches")
    same_set = ["sum_1", "sum_2", "n_shingles"]
    whole = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = stored(whole.groupBy(*same_set).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("parity").alias("parity")), "classes")

    bucket = ["band", "key"]
    entries = classes.select("rep", "n_shingles", F.posexplode("bands").alias(*bucket))
    shared = (entries.groupBy(*bucket).agg(F.min(F.struct("rep", "n_shingles")).alias("centre"), F.max("rep").alias("last"))
              .where(F.col("centre.rep") < F.col("last")).drop("last"))
    members = stored(entries.join(shared, bucket), "members")
    near = f"100 * least({{0}}, {{1}}) >= {int(percent)} * greatest({{0}}, {{1}})"   # sets of other sizes cannot be alike enough
    stars = stored(members.where("rep <> centre.rep").where(near.format("n_shingles", "centre.n_shingles"))
                   .select(F.col("centre.rep").alias("a"), F.col("rep").alias("b")).distinct(), "stars")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = stored(source.where("doc_id is not null").join(broadcast_if_small(wanted, 1_000_000), "doc_id", "left_semi"), "texts")
    several = sketch.where("doc_id is not null").groupBy("doc_id").agg(F.min("text_key").alias("a"), F.max("text_key").alias("z")).where("a <> z").select("doc_id")
    several = broadcast_if_small(stored(several, "several"))
    own = stored(whole.join(several, "doc_id").select("doc_id", *same_set).join(classes.select(*same_set, "rep"), same_set).select("doc_id", "rep"), "own")
    first = own.groupBy("doc_id").agg(F.min("rep").alias("a"))
    same_doc = stored(own.join(first.hint("merge"), "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct(), "same")
    links = stored(verified(stars, texts, k, percent), "verified").union(same_doc)
    roots = stored(components(links), "roots")

    placed = (members.drop("centre").join(roots, members["rep"] == roots["node"], "left")
              .select(*bucket, "rep", "n_shingles", F.coalesce("root", "rep").alias("root")))
    split = stored(placed.join(_mixed(placed, bucket), bucket).join(classes.select("rep", "parity"), "rep"), "mixed")
    x = split.where("root <> largest").select(*bucket, F.col("rep").alias("x"), F.col("n_shingles").alias("nx"), F.col("parity").alias("px"), F.col("root").alias("root_x"))
    y = split.select(*bucket, F.col("rep").alias("y"), F.col("n_shingles").alias("ny"), F.col("parity").alias("py"), F.col("root").alias("root_y"), "largest")
    differing = " + ".join(f"bit_count(px[{i}] ^ py[{i}])" for i in range(PARITY_LONGS))
    more = (x.join(y, bucket).where("root_x <> root_y and (root_y = largest or x < y)").where(near.format("nx", "ny"))
            .where(f"{100 + int(percent)} * ({differing}) <= {100 - int(percent)} * (nx + ny)")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(stars, ["a", "b"], "left_anti"))
    extra = stored(verified(more, texts, k, percent), "verified")
    if not extra.isEmpty():
        roots = stored(components(extra.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))), "roots")

    found = classes.drop("bands", "parity").join(roots, classes["rep"] == roots["node"], "left").select(*same_set, "rep", F.coalesce("root", "rep").alias("root"))
    rows_ = sketch.drop("bands", "parity").join(found.drop("rep"), same_set, "left")
    told = stored(own.join(found.select("rep", "root"), "rep").groupBy("doc_id").agg(F.min("root").alias("doc_root")), "told")
    rows_ = rows_.join(broadcast_if_small(told), "doc_id", "left")     # the empty texts of a doc_id follow its others
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("doc_root", "root", "doc_id"))
    return rows_.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "text_key")


def keep_one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each group of near copies, once if its row is repeated; columns stay as they are.

    Cases: a row without doc_id is compared like any other, under a number beyond 2**62 that its text gives it, so a document with an id
    stays in its place. Texts without words are linked with nothing and stay. Rows of one doc_id with several texts stay or go together.
    An empty table stays empty.
    """
    stand_in = F.lit(1 << 62) + F.pmod(text_key(), F.lit(1 << 61))
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("doc_id"), F.col("text").cast("string").alias("text"))
    gone = near_duplicates(named, **how).where("not kept")
    gone = gone.select(F.when(F.col("doc_id") < F.lit(1 << 62), F.col("doc_id")).alias("doc_id"), "text_key")
    return without(without_repeats(docs), gone)
