"""Packs token ids into sequences of equal length and nearly equal attention cost."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.llm.tokens import encoded

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
LINEAR = 1.0
QUADRATIC = 1.0 / (6 * 1024)   # attention against the other work of a token, at a model width of 1024


def piece_cost(length: int) -> float:
    return LINEAR * length + QUADRATIC * length * length


def balanced(lengths: list[int], rooms: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Assigns pieces, longest first, to the cheapest sequence with room for them; yields (piece, start in it, length, sequence, offset).

    ``rooms`` hold as many ids as all pieces together. A piece that fits nowhere is cut: the cheapest sequence with any room takes what it
    can, the rest waits its turn by its new length.
    """
    room, cost, filled = np.array(rooms), np.zeros(len(rooms)), np.zeros(len(rooms), np.int64)
    waiting = [(-n, i, 0) for i, n in enumerate(lengths)]
    heapq.heapify(waiting)
    while waiting:
        n, piece, start = heapq.heappop(waiting)
        n = -n
        fits = room >= n
        if not fits.any():
            fits = room > 0
        s = int(np.where(fits, cost, np.inf).argmin())
        take = min(n, int(room[s]))
        yield piece, start, take, s, int(filled[s])
        room[s] -= take
        filled[s] += take
        cost[s] += piece_cost(take)
        if take < n:
            heapq.heappush(waiting, (take - n, piece, start + take))


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


class _Window:
    """Pieces of at most one sequence each, until there is enough to pack."""

    def __init__(self, length: int):
        self.length, self.pieces, self.total, self.sequence = length, [], 0, TaskContext.get().partitionId() << 33

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        for a in range(0, n, self.length):
            self.pieces.append((doc_id, a, ids[4 * a:4 * (a + self.length)], n))
        self.total += n

    def packed(self, last: bool) -> pa.RecordBatch:
        full, tail = divmod(self.total, self.length)
        kept = []
        if not last and tail:     # ids beyond whole sequences wait for the next window
            left = tail
            while left:
                doc_id, start, ids, n = self.pieces.pop()
                cut = max(0, len(ids) // 4 - left)
                kept.append((doc_id, start + cut, ids[4 * cut:], n))
                left -= len(ids) // 4 - cut
                if cut:
                    self.pieces.append((doc_id, start, ids[:4 * cut], n))
        rooms = [self.length] * full + (powers_of_two(tail) if last else [])
        rows = []
        for piece, a, n, s, offset in balanced([len(p[2]) // 4 for p in self.pieces], rooms):
            doc_id, start, ids, all_ids = self.pieces[piece]
            rows.append((doc_id, start + a, n, ids[4 * a:4 * (a + n)], all_ids, self.sequence + s, offset))
        self.pieces, self.total, self.sequence = kept[::-1], 0 if last else tail, self.sequence + len(rooms)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def _packed(path: str, end_id: int, length: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Window(length)
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoded(batch["text"].to_pylist(), path, end_id)):
                own.add(doc_id, ids)
                if own.total >= window * length:
                    yield own.packed(last=False)
        if own.pieces:
            yield own.packed(last=True)
    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, length: int = 1024, window: int = 256) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id and offset there.

    A document is its ids and the end id. Each partition packs its own documents as they come, in windows of about ``window`` sequences:
    whole sequences first, then the rest longest first to the cheapest sequence with room, where a piece costs linear plus quadratic
    attention work. What does not fill a sequence goes on into the next window; a partition's last ids become sequences whose lengths are
    powers of two, so nothing is padded. There is no shuffle, and a task holds one window. Sequence numbers name the partition in their
    upper bits.

    Cases: a null or empty text is the end id alone. Rows without doc_id, or that repeat one, are packed like any other. An empty table
    gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_packed(tokenizer_path, end_id, length, window), SCHEMA)
