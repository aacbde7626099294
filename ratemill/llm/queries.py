"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.llm.common import new_folder, table
from ratemill.llm.exact import exact_groups
from ratemill.llm.lexical import ranked_search
from ratemill.llm.licenses import scan
from ratemill.llm.minhash import near_duplicates
from ratemill.llm.mixing import BLOCK_ROWS, TARGETS, mixed, period
from ratemill.llm.packing import pack
from ratemill.llm.periodic import collapse_runs, run_digests, with_planted_runs
from ratemill.llm.perplexity import quality_rules
from ratemill.llm.ranking import quality_scores
from ratemill.llm.registry import query
from ratemill.llm.simhash import simhash_groups
from ratemill.llm.token_files import read_tokens, token_digests, write_tokens
from ratemill.llm.templates import drop_recurring_lines, template_sql
from ratemill.llm.tokens import byte_bpe
from ratemill.llm.warc import archived


@query()
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY plain)""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("text_key")


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, byte_bpe())
    return token_digests(read_tokens(spark, folder))


def mixing_sql(targets: dict[str, int], block_rows: int) -> str:
    """The schedule of one period as a list of values, the rest in SQL; for tables with just the sources of ``targets``."""
    values = ", ".join(f"('{s}', {i}, {slot})" for s, i, slot in period(targets))
    total = sum(targets.values())
    return f"""
WITH period(source, turn, due) AS (VALUES {values}),
shares AS (SELECT source, count(*) AS share FROM period GROUP BY source),
numbered AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR) || '|' || md5(coalesce(text, ''))), doc_id) - 1 AS number FROM documents),
blocks AS (SELECT doc_id, source, number // {block_rows} AS block, number % {block_rows} AS place FROM numbered),
out_of_rows AS (SELECT b.source, (b.n + {block_rows} - 1) // {block_rows} AS block FROM (SELECT source, count(*) AS n FROM documents GROUP BY source) b),
horizon AS (SELECT min({total} * (o.block // s.share) + p.due) AS slot FROM out_of_rows o JOIN shares s ON o.source = s.source JOIN period p ON p.source = o.source AND p.turn = o.block % s.share)
SELECT b.doc_id, b.source, b.block, {total} * (b.block // s.share) + p.due AS slot, b.place, {total} * (b.block // s.share) + p.due < h.slot AS on_target
FROM blocks b JOIN shares s ON b.source = s.source JOIN period p ON p.source = b.source AND p.turn = b.block % s.share CROSS JOIN horizon h"""


@query(mixing_sql(TARGETS, BLOCK_ROWS))
def op5_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), TARGETS).select("doc_id", "source", "block", "slot", "place", "on_target")


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query()
def op7_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")


@query()
def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), byte_bpe())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query(template_sql())
def op9_template_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(table(spark, sf_dir, "documents"))


@query(r"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
named AS (SELECT *, octet_length(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS newest FROM payloads)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM named""")
def op10_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


@query()
def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).drop("text_key")


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(collapse_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


@query(r"""
WITH listed AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM listed GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
counted AS (SELECT doc_id, term, count(*) AS tf FROM listed WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * t.docs + 2) / (2 * c.df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM counted GROUP BY term) c CROSS JOIN totals t),
scored AS (
  SELECT a.item_id, c.doc_id, CAST(sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * l.n * t.docs) // t.terms)))) AS BIGINT) AS score
  FROM asked a JOIN counted c ON a.term = c.term JOIN weights w ON w.term = c.term JOIN lengths l ON l.doc_id = c.doc_id CROSS JOIN totals t
  GROUP BY a.item_id, c.doc_id)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10""")
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
