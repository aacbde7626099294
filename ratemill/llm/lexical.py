"""Ranked lexical search by pipelined term partitioning: accumulators of items pass from one owner of terms to the next."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratemill.llm.common import stored
from ratemill.session import broadcast_if_small

SHARD_DOCS = 2048      # documents of an index shard
BUNDLE_ITEMS = 128     # items that share a bundle, about
OWNERS = 4             # parts of the terms, one stage each
FILTER_BITS = 1 << 20
SCALE = 1_000_000_000
LENGTH_PERCENT = 75
DOCUMENTS = -1         # the part of the index that lists documents, not terms
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
ACCUMULATORS = "shard long, bundle int, cells array<int>, scores array<long>"
INDEX = "shard long, term string, owner int, doc_ids array<long>, places array<int>, tf array<long>, n array<long>"


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z as a-z."""
    return text.translate(_TERM).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch["item_id"], batch["text"].to_pylist()):
            found = Counter(terms(text)) if text else {}
            yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(found), batch["item_id"].type), pa.array([t.decode() for t in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                                             ["item_id", "term", "times"])


def _indexed(wanted: bytes, shard_docs: int, owners: int):
    def shard(number: int, docs: list[tuple]) -> pa.RecordBatch:
        docs.sort(key=lambda d: (d[0] is None, d[0]))
        lists = defaultdict(list)
        for place, (_, n, found) in enumerate(docs):
            for term, tf in found:
                lists[term].append((place, tf, n))
        rows = [(number, "", DOCUMENTS, [d[0] for d in docs], [], [], [d[1] for d in docs])]
        for term, entries in lists.items():
            places, tf, n = zip(*entries)
            rows.append((number, term.decode(), zlib.crc32(term) % owners, [], places, tf, n))
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in INDEX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, known = TaskContext.get().partitionId() << 33, [], {}
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                all_terms = terms(text) if text else []
                if not all_terms:
                    continue
                found = []
                for term, tf in Counter(all_terms).items():
                    own = known.get(term)
                    if own is None:
                        bit = zlib.crc32(term) % FILTER_BITS
                        own = known[term] = bool(wanted[bit >> 3] >> (bit & 7) & 1)
                        if len(known) > 1 << 18:
                            known.clear()
                    if own:
                        found.append((term, tf))
                waiting.append((doc_id, len(all_terms), found))
                if len(waiting) == shard_docs:
                    yield shard(number, waiting)
                    number, waiting = number + 1, []
        if waiting:
            yield shard(number, waiting)
    return run


def term_index(docs: DataFrame, vocabulary: DataFrame, shard_docs: int = SHARD_DOCS, owners: int = OWNERS) -> DataFrame:
    """Stored index of all documents by shard, owner and term: places in the shard, tf and n; and a row a shard that lists its documents.

    Shards are made where documents are read, so nothing is shuffled. Terms outside ``vocabulary`` (column term) are left out by a
    bitmap of fixed size; what passes it by chance finds no item later.
    """
    bits = vocabulary.select((F.crc32(F.col("term").cast("binary")) % FILTER_BITS).alias("bit")).distinct().collect()   # at most FILTER_BITS
    marks = np.zeros(FILTER_BITS, np.uint8)
    marks[[r.bit for r in bits]] = 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return stored(rows.mapInArrow(_indexed(np.packbits(marks, bitorder="little").tobytes(), shard_docs, owners), INDEX), "index", partition_by="owner")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column end to end, and the sizes of its lists."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False), flat.value_lengths().to_numpy(zero_copy_only=False)


def _added(n_docs: int, n_terms: int, shard_docs: int):
    def run(key: tuple, carried: pa.Table, posted: pa.Table) -> pa.Table:
        if not posted.num_rows:
            return carried
        items, n_items = _lists(posted["items"])
        times, _ = _lists(posted["times"])
        places, sizes = _lists(posted["places"])
        tf, _ = _lists(posted["tf"])
        n, _ = _lists(posted["n"])
        if (LENGTH_PERCENT * int(n.max())) * n_docs >> 63:
            raise OverflowError("75 * n * N leaves 64 bits")
        m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * n_docs) // n_terms
        share = (SCALE * tf) // (1000 * tf + 8 * m)
        cells, scores = (_lists(carried[c])[0] for c in ("cells", "scores")) if carried.num_rows else (np.zeros(0, np.int64),) * 2
        width = 1 + max(int(items.max()), int(cells.max()) // shard_docs if len(cells) else 0)
        total = np.zeros((width, shard_docs), np.int64)
        total.reshape(-1)[cells] = scores
        a = b = 0
        for w, i, p in zip(posted["w"].to_pylist(), n_items, sizes):
            total[np.ix_(items[a:a + i], places[b:b + p])] += (w * times[a:a + i])[:, None] * share[b:b + p]
            a, b = a + i, b + p
        total = total.reshape(-1)
        cells = np.flatnonzero(total)
        out = [pa.array([k.as_py()], t) for k, t in zip(key, (pa.int64(), pa.int32()))]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), pa.array(x)) for x in (cells.astype(np.int32), total[cells])]
        return pa.Table.from_arrays(out + lists, ["shard", "bundle", "cells", "scores"])
    return run


def _selected(top: int, shard_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                cells, scores = (batch[c][r].values.to_numpy(zero_copy_only=False) for c in ("cells", "scores"))
                item, place = cells // shard_docs, cells % shard_docs
                order = np.lexsort([place, -scores, item])
                item, place, scores = item[order], place[order], scores[order]
                first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
                best = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item)))) < top
                n = int(best.sum())
                yield pa.RecordBatch.from_arrays([pa.array([batch[c][r].as_py()] * n, t) for c, t in (("shard", pa.int64()), ("bundle", pa.int32()))]
                                                 + [pa.array(x[best], t) for x, t in ((item, pa.int32()), (place, pa.int32()), (scores, pa.int64()))], ["shard", "bundle", "item", "place", "score"])
    return run


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 10, shard_docs: int = SHARD_DOCS, bundle_items: int = BUNDLE_ITEMS, owners: int = OWNERS) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score, by score and then ascending doc_id; scores are above 0.

    N counts documents with a term, L all their terms, df the documents with a term; an item's term adds, for each time it stands there,
    w * ((10**9 * tf) div (1000 * tf + 8 * m)) with w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 25 + (75 n N) div L, all integers.

    Documents are indexed by shards of ``shard_docs``, terms dealt to ``owners``. For each shard, a bundle of items starts without
    accumulators and passes the owners one after another: a stage cogroups the accumulators, sparse (item, document) cells, with the
    postings of that owner's terms and adds their contributions. After the last owner each shard keeps its best ``top`` of each item, which is
    exact, and a window over these ranks them. A group holds one shard's postings of one owner and at most bundle_items * shard_docs
    sums, however large the corpus or common a term is.

    Cases: a null text, or one without terms, is no document, and an item without terms has no rows. Rows that repeat a doc_id are
    documents of their own, and can be listed each; rows without doc_id are listed after others of equal score. Rows that repeat an item_id
    are one item with all their terms; a null item_id is an item. Empty tables give no rows. Other columns are not looked at.
    """
    each = items.select(F.col("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    kind = each.schema["item_id"].dataType.simpleString()
    counted = each.mapInArrow(_counted, f"item_id {kind}, term string, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))
    counted = stored(counted, "items")
    index = term_index(docs, counted.select("term"), shard_docs, owners)
    lengths = index.where(F.col("owner") == DOCUMENTS)
    n_docs, n_terms = lengths.agg(F.sum(F.size("n")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    if not n_docs:
        return counted.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    weight = F.floor(1000 * F.log(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1)))
    weights = index.where(F.col("owner") != DOCUMENTS).groupBy("term").agg(F.sum(F.size("places")).alias("df")).select("term", weight.cast("long").alias("w")).where("w > 0")

    bundles = -(-max(1, counted.select("item_id").distinct().count()) // bundle_items)
    named = counted.select("item_id").distinct().withColumn("bundle", F.pmod(F.xxhash64("item_id", F.lit(13)), F.lit(bundles)).cast("int"))
    named = stored(named.withColumn("item", (F.row_number().over(Window.partitionBy("bundle").orderBy("item_id")) - 1).cast("int")), "bundles")
    same = counted["item_id"].eqNullSafe(named["item_id"])
    asked = (counted.join(named, same).join(weights, "term").groupBy("term", "bundle", "w")
             .agg(F.array_sort(F.collect_list(F.struct("item", "times"))).alias("of")).select("term", "bundle", "w", F.col("of.item").alias("items"), F.col("of.times").alias("times")))
    asked = broadcast_if_small(stored(asked, "asked"))

    by, spark = ["shard", "bundle"], docs.sparkSession
    carried = spark.createDataFrame([], ACCUMULATORS)
    for owner in range(owners):
        posted = index.where(F.col("owner") == owner).select("shard", "term", "places", "tf", "n").join(asked, "term").drop("term")
        carried = carried.groupBy(*by).cogroup(posted.groupBy(*by)).applyInArrow(_added(n_docs, n_terms, shard_docs), ACCUMULATORS)
    best = carried.mapInArrow(_selected(top, shard_docs), "shard long, bundle int, item int, place int, score long")
    ids = lengths.select("shard", F.posexplode("doc_ids").alias("place", "doc_id"))
    best = best.join(ids, ["shard", "place"]).join(broadcast_if_small(named), ["bundle", "item"])
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "place")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
