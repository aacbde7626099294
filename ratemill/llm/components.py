"""Connected components by alternating large and small stars; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of each linked node. ``links``: (a, b) longs. Returns (node, root), nodes without links are left out.

    A round moves every larger neighbour of a node to its smallest one, then every smaller neighbour likewise, until the links are stars.
    Minima are pre-aggregated, so a node that a third of all rows link to is never gathered; its rows are one hot join key, which
    adaptive execution splits. The driver sees a count and a checksum a round.
    """
    star = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(star)
    while mark[0]:
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stored(rest.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        last, mark = mark, _mark(star)
        if mark == last:
            break
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(star: DataFrame) -> tuple[int, int]:
    row = star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0
