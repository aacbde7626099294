"""Drops lines whose template recurs across documents: a log-template tree of fixed depth, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill.llm.common import stored, text_key, text_or_empty, without_repeats
from ratemill.session import broadcast_if_small

DEPTH = 3
ANY = "<*>"


def _lines(text: Column) -> Column:
    """Lines with one space for each run of other white space."""
    return F.split(F.when(text.rlike(r"[\x09\x0B-\x0D]|  "), F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(text), "\n")


def _masked(line: Column) -> Column:
    """The line's tokens by single spaces, those with a digit as a variable field."""
    tokens = F.trim(line)
    return F.when(tokens.rlike("[0-9]"), F.regexp_replace(tokens, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", ANY)).otherwise(tokens)


def _size(masked: Column) -> Column:
    return F.when(masked == "", 0).otherwise(F.octet_length(masked) - F.octet_length(F.replace(masked, F.lit(" "), F.lit(""))) + 1)


def _leaf(masked: Column, depth: int) -> Column:
    """The tree's leaf of a line: its token count and leading tokens."""
    return F.xxhash64(_size(masked), F.substring_index(masked, " ", depth))


def drop_recurring_lines(docs: DataFrame, min_docs: int = 10, min_tokens: int = 1, similarity: float = 0.5, depth: int = DEPTH, min_share: float = 0.05) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_text (the other lines).

    Lines are \\n-split; tokens are runs other than the bytes 20 and 09-0D (hex); a token with a digit is a variable field. A line falls to
    the leaf of its token count and first ``depth`` tokens. Beyond these, a token at a position is fixed if at least ``min_docs`` documents
    of the leaf, and at least the share ``min_share`` of them, have it there, or if the line itself, but for fields with digits, stands in
    ``min_docs`` documents; else it is a variable field too. The line with variable fields blotted out is its template if

    * it has no more than ``depth`` tokens and no variable field,
    * or at least the share ``similarity`` of its tokens beyond the first ``depth`` is fixed (the first ones are alike in any leaf and prove nothing),
    * or the line itself stands in ``min_docs`` documents and at least that share of its tokens has no digit.

    Lines whose template at least ``min_docs`` documents have are dropped, in all of them. Blank lines, and lines of fewer than
    ``min_tokens`` tokens, are kept. ``min_docs`` says from how many documents on a line is no longer one's own; ``min_share`` follows the size of a leaf,
    so that words which are merely common do not become fixed as the corpus grows.

    Leaves are counted from each row's own distinct ones, before any shuffle; later steps take only the lines of leaves that recur, and
    equal lines are one row there. Documents with a token are bounded by the sums over lines; only where that bound and the largest line
    disagree are they counted one by one. A line that a third of all documents have is counted in part first and otherwise is one join key.

    Cases: null is an empty text, of one blank line. Rows that are alike in doc_id and text count as one document and are changed alike;
    rows that repeat a doc_id with another text, or have none, are told apart by their text. An empty table gives no rows. Other columns are
    not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), text_or_empty().alias("text"))
    once = without_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    lines = once.select("doc_id", text_key().alias("text_key"), _lines(text_or_empty()).alias("lines"))
    masked = F.transform(F.filter("lines", lambda x: F.trim(x) != ""), lambda x: _masked(x))
    if min_tokens > 1:
        masked = F.filter(masked, lambda x: _size(x) >= min_tokens)
    leaves = lines.select(F.explode(F.array_distinct(F.transform(masked, lambda x: _leaf(x, depth)))).alias("leaf"))
    reached = stored(leaves.groupBy("leaf").agg(F.count("*").alias("leaf_docs")).where(F.col("leaf_docs") >= min_docs), "leaves")

    each = (lines.select("doc_id", "text_key", F.posexplode("lines").alias("line_no", "line")).where(F.trim("line") != "").select("doc_id", "text_key", "line_no", _masked(F.col("line")).alias("masked"))
            .withColumn("n_tokens", _size(F.col("masked"))).withColumn("leaf", _leaf(F.col("masked"), depth)))     # no filter here: it would mask each line once more
    found = each.join(broadcast_if_small(reached, 1_000_000), "leaf")
    found = stored(found.where(F.col("n_tokens") >= min_tokens) if min_tokens > 1 else found, "lines")

    kind = ["leaf", "masked", "n_tokens", "leaf_docs"]
    kinds = found.groupBy(*kind, "doc_id", "text_key").agg(F.lit(1).alias("one")).groupBy(*kind).agg(F.count("*").alias("docs"))
    kinds = stored(kinds.withColumn("kind_id", F.monotonically_increasing_id()), "kinds")     # tokens go by this number, not by their line's text
    at = ["leaf", "position", "token"]
    tokens = kinds.where(F.col("n_tokens") > depth).select("kind_id", "leaf", "leaf_docs", "docs", F.posexplode(F.split("masked", " ")).alias("position", "token"))
    beyond = F.col("position") >= depth
    needed = F.greatest(F.lit(min_docs), F.ceil(F.lit(min_share) * F.col("leaf_docs")))
    bound = (tokens.where(beyond & (F.col("token") != ANY)).groupBy(*at).agg(F.sum("docs").alias("most"), F.max("docs").alias("least"), F.max(needed).alias("needed"))
             .where("most >= needed"))
    bound = stored(bound, "tokens")
    unsure = bound.where("least < needed").select(*at, "needed")
    told = found.where(F.col("n_tokens") > depth).join(broadcast_if_small(unsure.select("leaf").distinct()), "leaf", "left_semi").select(
        "leaf", "doc_id", "text_key", F.posexplode(F.split("masked", " ")).alias("position", "token")).where(beyond)
    told = told.join(broadcast_if_small(unsure), at).groupBy(*at, "needed", "doc_id", "text_key").agg(F.lit(1).alias("one"))
    counted = told.groupBy(*at, "needed").agg(F.count("*").alias("docs")).where("docs >= needed")
    fixed = bound.where("least >= needed").select(*at).union(counted.select(*at)).withColumn("fixed", F.lit(True))

    own = F.col("docs") >= min_docs      # the template of such a line is the line itself
    marked = tokens.where(~own).select("kind_id", *at).join(fixed.hint("merge"), at, "left")
    stays = (F.col("token") != ANY) & (~beyond | F.coalesce("fixed", F.lit(False)))
    shape = F.array_sort(F.collect_list(F.struct("position", F.when(stays, F.col("token")).otherwise(ANY).alias("token"))))
    shapes = (marked.groupBy("kind_id").agg(shape.alias("shape"), F.count_if(stays & beyond).alias("n_fixed"), F.count("*").alias("n"))
              .where(F.col("n_fixed") >= F.lit(similarity) * (F.col("n") - depth)).select("kind_id", F.array_join("shape.token", " ").alias("template")))
    shaped = kinds.select("kind_id", "leaf", "masked").join(shapes.hint("merge"), "kind_id").select("leaf", "masked", "template")
    words = F.filter(F.split("masked", " "), lambda x: x != ANY)
    leading = F.filter(F.slice(F.split("masked", " "), 1, depth), lambda x: x != ANY)
    enough = (F.size(words) - F.size(leading) >= F.lit(similarity) * (F.col("n_tokens") - depth)) | (F.size(words) >= F.lit(similarity) * F.col("n_tokens"))
    long = shaped.union(kinds.where((F.col("n_tokens") > depth) & own & enough).select("leaf", "masked", F.col("masked").alias("template")))
    short = kinds.where((F.col("n_tokens") <= depth) & ~F.array_contains(F.split("masked", " "), ANY)).select("leaf", "masked", F.col("masked").alias("template"))
    placed = stored(found.join(long.union(short).hint("merge"), ["leaf", "masked"]).select("doc_id", "text_key", "line_no", "template"), "templates")
    recurring = placed.select("template", "doc_id", "text_key").distinct().groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("template")
    recurring = stored(recurring, "recurring")
    gone = (placed.join(recurring.hint("merge"), "template").groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("gone"))
            .select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "gone"))

    same = rows["doc_id"].eqNullSafe(gone["gone_id"]) & (F.coalesce(rows["text_key"] == gone["gone_key"], F.lit(False)))
    result = rows.join(gone.hint("merge"), same, "left").withColumn("n_lines", (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long"))
    original = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(original) - 1), "gone")
    return result.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                         F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(original, i)), "\n")).alias("kept_text"))


def template_sql(min_docs: int = 10, min_tokens: int = 1, similarity: float = 0.5, depth: int = DEPTH, min_share: float = 0.05) -> str:
    """The same in SQL, over a table with distinct doc_id."""
    return rf"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
masked AS (
  SELECT *, string_split(regexp_replace(trim(regexp_replace(line, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '{ANY}', 'g'), ' ') AS tokens FROM lines),
leaves AS (SELECT *, len(tokens) AS n_tokens, tokens[1:{depth}] AS lead FROM masked WHERE len(tokens) >= {max(1, min_tokens)} AND tokens <> ['']),
reached AS (SELECT n_tokens, lead, count(DISTINCT doc_id) AS leaf_docs FROM leaves GROUP BY n_tokens, lead HAVING count(DISTINCT doc_id) >= {min_docs}),
kinds AS (SELECT tokens, count(DISTINCT doc_id) AS docs FROM leaves GROUP BY tokens),
found AS (SELECT l.*, r.leaf_docs, k.docs FROM leaves l JOIN reached r ON l.n_tokens = r.n_tokens AND l.lead = r.lead JOIN kinds k ON k.tokens = l.tokens),
tokens AS (SELECT doc_id, line_no, n_tokens, lead, leaf_docs, docs, unnest(range(len(tokens))) AS position, unnest(tokens) AS token FROM found),
fixed AS (SELECT n_tokens, lead, position, token FROM tokens WHERE token <> '{ANY}' AND position >= {depth} GROUP BY n_tokens, lead, position, token, leaf_docs
  HAVING count(DISTINCT doc_id) >= greatest({min_docs}, ceil({min_share} * leaf_docs))),
marked AS (
  SELECT t.*, t.token <> '{ANY}' AND (t.position < {depth} OR t.docs >= {min_docs} OR f.token IS NOT NULL) AS stays
  FROM tokens t LEFT JOIN fixed f ON t.n_tokens = f.n_tokens AND t.lead = f.lead AND t.position = f.position AND t.token = f.token),
templates AS (
  SELECT doc_id, line_no, string_agg(CASE WHEN stays THEN token ELSE '{ANY}' END, ' ' ORDER BY position) AS template
  FROM marked GROUP BY doc_id, line_no, n_tokens, docs
  HAVING CASE WHEN n_tokens <= {depth} THEN count(*) FILTER (WHERE token <> '{ANY}') = n_tokens
    ELSE count(*) FILTER (WHERE stays AND position >= {depth}) >= {similarity} * (n_tokens - {depth})
      OR (docs >= {min_docs} AND count(*) FILTER (WHERE token <> '{ANY}') >= {similarity} * n_tokens) END),
recurring AS (SELECT template FROM templates GROUP BY template HAVING count(DISTINCT doc_id) >= {min_docs}),
gone AS (SELECT doc_id, line_no FROM templates WHERE template IN (SELECT template FROM recurring))
SELECT l.doc_id, count(*) AS n_lines, count(g.line_no) AS n_dropped, coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL), '') AS kept_text
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no GROUP BY l.doc_id"""
