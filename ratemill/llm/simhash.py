"""Near-duplicate documents by SimHash fingerprints, found by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratemill.llm.common import stored, text_key
from ratemill.llm.components import components
from ratemill.session import broadcast_if_small

SEED = 42
BLOCK = 1 << 16
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, k: int = 3) -> int:
    """64 bits, each set where more than half of the text's k-word shingles, repeats included, have it in their XXH64."""
    words = text.lower().split()
    k = min(k, len(words))
    if not k:
        return 0
    shingles = map(b" ".join, zip(*[islice(words, j, None) for j in range(k)]))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    n, left = np.zeros(64, np.int64), len(words) - k + 1
    total = left
    while left > 0:
        block = np.fromiter(hashes, "<u8", min(left, BLOCK)).view(np.uint8).reshape(-1, 8)
        n += np.concatenate([np.bincount(block[:, j], minlength=256) @ _BITS for j in range(8)])
        left -= BLOCK
    return int(np.packbits(2 * n > total, bitorder="little").view("<u8")[0])


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t or b"", k) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(prints.view(np.int64))], ["doc_id", "text_key", "fingerprint"])
    return run


def ball(half: int) -> list[int]:
    """The masks of at most ``half`` bits, as signed 64-bit numbers."""
    masks = [sum(1 << i for i in bits) for n in range(half + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_fingerprints(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints that differ in at most ``radius`` bits. ``prints``: distinct.

    Every fingerprint emits its variants within half the radius. Two within the radius share a variant, and all that share one are within
    the radius, so each is linked with the smallest of its variant: no pair is lost to the components and a variant costs its size. A
    variant has at most as many fingerprints as the ball has points, 65 at radius 2, whatever the table holds.
    """
    if radius % 2:
        raise ValueError("the radius must be even: variants reach half of it")
    masks = F.explode(F.array(*[F.lit(m) for m in ball(radius // 2)])).alias("mask")
    variants = prints.select("fingerprint", masks).select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"))
    smallest = F.min("fingerprint").over(Window.partitionBy("variant"))
    met = variants.select(smallest.alias("a"), F.col("fingerprint").alias("b")).where("a <> b").distinct()
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def simhash_groups(docs: DataFrame, k: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), and text_key.

    Words are runs of bytes other than 20 and 09-0D (hex) after A-Z became a-z; shingles are k words with single spaces, fewer words are
    one shingle. Documents with equal fingerprints are one class, so copies never meet in a group; links are between classes.

    Cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other. Rows that repeat a doc_id are one
    document: all their fingerprints are linked, and every row has the document's component. A row without doc_id links others
    like any text; its component_id is null only where nothing it reaches has a doc_id. An empty table gives no rows. Other columns are not
    looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").cast("binary").alias("text"))
    prints = stored(rows.mapInArrow(_fingerprints(k), "doc_id long, text_key long, fingerprint long"), "fingerprints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes")

    several = (prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("z"))
               .where("a <> z").select("doc_id", "a"))
    several = broadcast_if_small(stored(several, "several"))
    same_id = prints.join(several, "doc_id").select("a", F.col("fingerprint").alias("b")).where("a <> b").distinct()
    roots = components(near_fingerprints(classes.select("fingerprint"), radius).union(same_id))

    linked = stored(classes.join(roots.withColumnRenamed("node", "fingerprint").hint("merge"), "fingerprint"), "linked")
    first = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    grouped = linked.join(first.hint("merge"), "root").select("fingerprint", "component_id")
    found = classes.join(grouped.hint("merge"), "fingerprint", "left").select("fingerprint", F.coalesce("component_id", "first_id").alias("component_id"))
    out = prints.join(found.hint("merge"), "fingerprint")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "text_key")
