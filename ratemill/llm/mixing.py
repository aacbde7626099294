"""Interleaves sources by target weights: proportionate-fair scheduling of blocks, earliest deadline first."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.llm.common import free_name, text_key

BUCKET_ROWS = 1_000
BLOCK_ROWS = 16
# Target shares of the registered query; a source that is not named has share 1.
TARGETS = {f"src{i}": 8 if i < 5 else 5 if i < 15 else 2 for i in range(20)}


def period(shares: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) for the sum of all shares in slots; after that, every source has had just its share and all repeats.

    Block i of a source with weight w is released at floor(i / w) and due by ceil((i + 1) / w). Each slot takes the released block that is
    due first. At any time a source has had more than its weight's part of the slots less one block, and less than that part and one.
    """
    total = sum(shares.values())
    waiting = [(0, s, 0) for s in shares]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // shares[s]), s, i))
        _, s, i = heapq.heappop(ready)
        out.append((s, i, slot))
        if i + 1 < shares[s]:
            heapq.heappush(waiting, ((i + 1) * total // shares[s], s, i + 1))
    return out


def mixed(docs: DataFrame, targets: dict[str, int] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with block (of its source), slot (in the mixture), place (in the block) and on_target; every row stays, once.

    A source's rows are ordered by a hash of doc_id and text and cut into blocks of ``block_rows``. The schedule of one period is a table of as many
    rows as the shares sum up to; block b takes the slot of its equal in the period, so no schedule of the whole corpus is made anywhere.
    Rows are numbered within hash ranges of about 1000 rows a source, so a source with a third of all rows is spread; only counts of ranges
    are summed up in order. ``on_target`` marks the slots before the first source has run out: there every prefix is less than one block
    off each target. Later slots keep the other sources' order. Names that ``docs`` has already get a leading underscore.

    The driver has a row a source and a slot for each share of a period, so sources are to be some thousands at most, such as crawls or
    collections, not host names.

    Cases: a null source is a source of its own. Rows without doc_id, or that repeat one, are spread by their texts; rows alike in doc_id and
    text follow one another. An empty table gives no rows.
    """
    targets = targets or {}
    names = {n: free_name(docs, n) for n in ("block", "slot", "place", "on_target")}
    own = {n: free_name(docs, f"_{n}") for n in ("name", "order", "key", "bucket", "n", "ahead", "turn", "at", "share")}
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    counts = {r[0]: r[1] for r in docs.groupBy(name.alias("s")).agg(F.count("*").alias("n")).collect()}   # a row a source
    spark = docs.sparkSession
    if not counts:
        return docs.select("*", *[F.lit(None).cast(t).alias(names[n]) for n, t in (("block", "long"), ("slot", "long"), ("place", "long"), ("on_target", "boolean"))])
    shares = {s: targets.get(s[1:], 1) if s else 1 for s in counts}
    total, slots = sum(shares.values()), period(shares)
    at = {(s, i): slot for s, i, slot in slots}
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    horizon = min(total * (b // shares[s]) + at[s, b % shares[s]] for s, b in blocks.items())

    def digest(c: str) -> Column:
        return F.md5(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))

    hexes = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest("text")).cast("binary"))
    ranges = spark.createDataFrame([(s, max(1, n // BUCKET_ROWS), shares[s]) for s, n in counts.items()], f"`{own['name']}` string, `{own['n']}` long, `{own['share']}` long")
    rows = docs.withColumns({own["name"]: name, own["order"]: hexes, own["key"]: text_key()})
    rows = rows.join(F.broadcast(ranges), own["name"])   # a row a source, made from the counts above
    rows = rows.withColumn(own["bucket"], (F.conv(F.substring(own["order"], 1, 8), 16, 10).cast("long") * F.col(own["n"]) / F.lit(1 << 32)).cast("long")).drop(own["n"])
    by = [own["name"], own["bucket"]]
    sums = rows.groupBy(*by).agg(F.count("*").alias(own["n"]))
    before = Window.partitionBy(own["name"]).orderBy(own["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select(*by, F.coalesce(F.sum(own["n"]).over(before), F.lit(0)).alias(own["ahead"]))
    within = Window.partitionBy(*by).orderBy(own["order"], F.col("doc_id"), own["key"])
    number = F.row_number().over(within) - 1 + F.col(own["ahead"])
    rows = rows.join(ahead.hint("merge"), by).withColumn(own["turn"], number)
    rows = rows.withColumn(names["block"], F.expr(f"`{own['turn']}` div {int(block_rows)}")).withColumn(names["place"], F.col(own["turn"]) % block_rows)
    table = spark.createDataFrame(slots, f"`{own['name']}` string, `{own['turn']}` long, `{own['at']}` long")
    rows = rows.withColumn(own["turn"], F.col(names["block"]) % F.col(own["share"])).join(F.broadcast(table), [own["name"], own["turn"]])   # one row a slot of the period
    rows = rows.withColumn(names["slot"], F.lit(total) * F.expr(f"`{names['block']}` div `{own['share']}`") + F.col(own["at"]))
    rows = rows.withColumn(names["on_target"], F.col(names["slot"]) < F.lit(horizon))
    return rows.select(*docs.columns, names["block"], names["slot"], names["place"], names["on_target"])


def in_mixed_order(docs: DataFrame, targets: dict[str, int] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs``, columns as they are, with its rows in the order of the mixture; written, the files follow one another in that order."""
    rows = mixed(docs, targets, block_rows)
    order = rows.columns[-3:-1]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
