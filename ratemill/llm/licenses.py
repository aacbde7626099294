"""License scans: ordered signature rules over numbered words, in built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.llm.common import stored, text_or_empty
from ratemill.llm.license_rules import ANCHORS, FORMS, PHRASES, rules_json

RULES = "array<struct<rank: int, priority: int, label: string, weight: double, keyword: string, pattern: string>>"
FOUND = "array<struct<first: long, last: long, rank: int, priority: int, label: string, weight: double>>"


def _number(match: Column, pattern: str) -> Column:
    return F.regexp_extract(match, pattern, 1).cast("long")


def detections(docs: DataFrame) -> DataFrame:
    """Row by row: row (a number), doc_id, n_words, base (label and start of each place of a phrase) and found (all rules' places)."""
    low = F.translate(text_or_empty(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    flat = F.regexp_replace(F.concat(F.lit(" "), low, F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), flat.alias("flat"))
    rows = rows.withColumn("n_words", (F.octet_length("flat") - F.octet_length(F.replace("flat", F.lit(" "), F.lit(""))) - 1).cast("long"))
    seen = reduce(lambda a, b: a | b, [F.contains("flat", F.lit(x)) for x in ANCHORS])
    words = F.transform(F.split(F.trim("flat"), " "), lambda w, i: F.concat(w, F.lit("@"), i.cast("string")))
    rows = rows.withColumn("numbered", F.when(seen, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))))
    places = []
    for phrase, label in PHRASES:
        first, *rest = phrase.split()
        pattern = rf"(?<= ){first}@(\d+) " + "".join(rf"{w}@\d+ " for w in rest)
        starts = F.when(F.contains("flat", F.lit(f" {phrase} ")), F.regexp_extract_all("numbered", F.lit(pattern), 1)).otherwise(F.array().cast("array<string>"))
        places.append(F.transform(starts, lambda s: F.struct(F.lit(label).alias("label"), s.cast("long").alias("first"))))
    rules = F.filter(F.from_json(F.lit(rules_json()), RULES), lambda r: F.contains("flat", F.concat(F.lit(" "), r["keyword"], F.lit(" "))))
    found = F.flatten(F.transform(rules, lambda r: F.transform(F.regexp_extract_all("numbered", r["pattern"], F.lit(0)), lambda m: F.struct(
        _number(m, r"@(\d+) ").alias("first"), _number(m, r"@(\d+) $").alias("last"), r["rank"].alias("rank"), r["priority"].alias("priority"), r["label"].alias("label"), r["weight"].alias("weight")))))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", F.concat(*places).alias("base"),
                       F.when(seen, found).otherwise(F.array().cast(FOUND)).cast(FOUND).alias("found"))


def surviving(found: DataFrame) -> DataFrame:
    """Detections (row, first, last, rank, priority, label, weight) without those within one of better rank.

    A detection is suppressed by another one that contains it and has better priority, or the same priority and either more words or, over
    just the same words, a lower rank. All such containers stand before it in the order below, so running maxima of ends find them in one
    sort of a document's detections.
    """
    before = Window.partitionBy("row").orderBy("first", F.desc("last"), "priority", "rank").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({p for p, _, _ in FORMS})
    reach = found.select("*", *[F.max(F.when(F.col("priority") <= p, F.col("last"))).over(before).alias(f"reach_{p}") for p in levels])
    own = F.coalesce(*[F.when(F.col("priority") == p, F.col(f"reach_{p}")) for p in levels], F.lit(-1))
    return reach.where(own < F.col("last")).drop(*[f"reach_{p}" for p in levels])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_found.

    Words are runs of the digits, a-z and everything beyond ASCII, after A-Z became a-z. Base counts the places of the fixed phrases. The
    rules (a few hundred, in ``license_rules``) run over numbered words, in texts that have one of their anchors, and each one only where
    its keyword is a word of the text. Priority and containment decide between overlapping detections. ``score`` is the largest weight of a
    surviving detection, at least 0.5 with a base place, else 0.

    Everything of a document is found in its own row; only detections are shuffled, and their numbers joined back.

    Cases: null is an empty text: no words, no labels, empty label texts, score 0. Rows without doc_id, or rows alike, are scanned each.
    An empty table gives no rows. Other columns are not looked at.
    """
    rows = stored(detections(docs), "licenses")
    found = surviving(rows.select("row", F.explode("found").alias("d")).select("row", "d.*"))
    kept = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("weight").alias("weight"), F.count("*").alias("n_found"))
    base = F.col("base.label")
    starts = F.col("base.first")
    none = F.array().cast("array<string>")
    return rows.join(kept.hint("merge"), "row", "left").select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.coalesce("more", none)))), ",").alias("labels"),
        F.greatest(F.coalesce("weight", F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"), F.coalesce("n_found", F.lit(0)).alias("n_found"))
