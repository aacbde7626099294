"""File round trips, loads, expectations and windows of a stream, each over whole given tables.

Every query writes a given table into a folder of its own below the shared one and reads it back through the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.catalog import star
from ratemill.catalog.registry import query
from ratemill.catalog.star import table
from ratemill.functions import recode as R
from ratemill.operators import joins as J
from ratemill.operators import quality as Q
from ratemill.plans import models as M
from ratemill.session import run_folder
from ratemill.sources import files as S
from ratemill.streaming import checkins as T
from ratemill.streaming.sinks import UpsertTable

_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_typed_read(spark, sf):
    path = run_folder(spark, "csv")
    S.write_result(table(spark, sf, "customer"), path)
    return S.read_typed_csv(spark, path, _CUSTOMER)


@query("""SELECT CASE l_linestatus WHEN 'O' THEN 'M' ELSE 'F' END AS sex, CAST(l_partkey AS VARCHAR) AS code, count(*) AS n,
  CAST(sum(round(l_discount*100)) AS BIGINT) AS cents FROM lineitem
WHERE l_returnflag <> 'R' AND l_linenumber <> 7 AND round(l_tax*100) <> 0 GROUP BY 1, 2""")
def extract_tsv(spark, sf):
    """Line items as an extract with total rows, blank codes and rates that are words."""
    path = run_folder(spark, "tsv")
    line = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", "Total").when(F.col("l_linestatus") == "O", "M").otherwise("F").alias("sex"),
        F.when(F.col("l_linenumber") != 7, F.col("l_partkey").cast("string")).alias("code"),
        F.when(star.pct("l_tax") == 0, "Unreliable").otherwise(F.col("l_discount").cast("string")).alias("rate"))
    line.write.option("header", True).option("sep", "\t").csv(path)
    read = S.read_extract_tsv(spark, path, ["sex", "code", "rate"], "sex", "code", "rate").withColumn("rate", F.col("rate").cast("double"))
    return read.groupBy("sex", "code").agg(F.count(F.lit(1)).alias("n"), F.sum(star.pct("rate")).alias("cents"))


@query("SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer")
def text_file_lines(spark, sf):
    """A text file with carriage returns and padded lines, back to typed fields."""
    path = run_folder(spark, "text")
    line = F.concat(F.lit("  "), F.concat_ws(",", "c_custkey", "c_name", "c_nationkey"), F.lit(" "))
    table(spark, sf, "customer").select(line.alias("value")).write.option("lineSep", "\r\n").text(path)
    return S.tokenize(S.read_text_lines(spark, path), "line", {"id": "bigint", "name": "string", "nation": "int"}).drop("line")


@query("SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS p_size FROM part")
def frame_roundtrip(spark, sf):
    path = run_folder(spark, "frame")
    S.write_frame(table(spark, sf, "part"), path)
    return S.read_frame(spark, path, ["p_partkey", "p_brand", "p_size"])


@query("SELECT c_mktsegment, count(*) AS n_rows, round(avg(c_acctbal), 6) AS mean_balance FROM customer GROUP BY 1")
def metrics_roundtrip(spark, sf):
    path = run_folder(spark, "metrics")
    if S.read_metrics(spark, path, "n_rows bigint") is not None:
        raise AssertionError("a metric document before the first was written")
    m = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("c_acctbal").alias("mean_balance"))
    S.write_metrics(m, path)
    return S.read_metrics(spark, path, "c_mktsegment string, n_rows bigint, mean_balance double")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def refresh_and_append(spark, sf):
    """A staging table that is replaced as a whole, then appended to."""
    path = run_folder(spark, "staging")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    S.full_refresh(o, path)
    S.full_refresh(S.read_frame(spark, path).where("o_orderstatus = 'O'"), path)
    S.append(o.where("o_orderstatus not in ('F', 'O')"), path)
    return S.read_frame(spark, path)


_LOADS = (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, min({k}) + 1 AS min_key, max({k}) + 1 AS max_key FROM {t}" for t, k in _LOADS))
def load_manifest(spark, sf):
    """Tables loaded in order, each verified to run 1..n."""
    steps = []
    for name, key in _LOADS:
        t = table(spark, sf, name)
        steps.append((name, t.withColumn(key, F.col(key) + 1), key, t.count()))
    return S.load_plan(spark, steps, run_folder(spark, "loads"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN 100 AND 5000 THEN o_custkey * 10
  WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS child_key FROM orders""")
def backfilled_keys(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("child_key"))
    return S.backfill(o, "child_key", F.col("o_custkey") * 10, "o_orderkey", 100, 5000).drop("o_custkey")


@query("""WITH s AS (SELECT CAST(sum(strlen(CAST(o_orderkey AS VARCHAR)) + strlen(CAST(o_custkey AS VARCHAR)) + strlen(o_orderstatus)) AS BIGINT) AS byte_size FROM orders)
SELECT 'reordered' AS source_path, byte_size, 1::BIGINT AS same_hash FROM s UNION ALL SELECT 'edited', byte_size, 0 FROM s""")
def fingerprint_changes(spark, sf):
    """The fingerprint of a table against the same rows in another order, and with one value changed."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    edited = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == 7, F.reverse(F.lower("o_orderstatus"))).otherwise(F.col("o_orderstatus")))
    base = S.frame_fingerprint(o, "base").select(F.col("content_hash").alias("base_hash"))
    out = S.frame_fingerprint(o.repartitionByRange("o_custkey"), "reordered").unionByName(S.frame_fingerprint(edited, "edited"))
    return out.join(F.broadcast(base)).select("source_path", "byte_size", (F.col("content_hash") == F.col("base_hash")).alias("same_hash"))


def verdict(name: str, check: Callable[[], None]) -> tuple[str, bool]:
    try:
        check()
    except Q.ExpectationError:
        return name, False
    return name, True


@query("""WITH orders_facts AS (SELECT count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) AS odd, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS odder,
  avg(o_totalprice) AS mean FROM orders),
cells AS (SELECT l_returnflag AS f, count(DISTINCT (l_linenumber, l_linestatus)) AS n FROM lineitem GROUP BY 1),
columns AS (SELECT count(*) FILTER (WHERE column_name IN ('o_orderkey', 'o_custkey')) AS have, count(*) FILTER (WHERE column_name = 'o_clerk') AS clerk FROM (DESCRIBE SELECT * FROM orders))
SELECT 'columns' AS check_name, CAST(have = 2 AS BIGINT) AS passed FROM columns UNION ALL SELECT 'columns_missing', CAST(clerk > 0 AS BIGINT) FROM columns
UNION ALL SELECT 'values', CAST(odd = 0 AS BIGINT) FROM orders_facts UNION ALL SELECT 'values_outside', CAST(odder = 0 AS BIGINT) FROM orders_facts
UNION ALL SELECT 'range', CAST(mean BETWEEN 1000 AND 500000 AS BIGINT) FROM orders_facts UNION ALL SELECT 'range_outside', CAST(mean BETWEEN 0 AND 10 AS BIGINT) FROM orders_facts
UNION ALL SELECT 'count', CAST(count(DISTINCT c_mktsegment) = 5 AS BIGINT) FROM customer UNION ALL SELECT 'count_other', CAST(count(DISTINCT c_mktsegment) = 4 AS BIGINT) FROM customer
UNION ALL SELECT 'one_active', 1 UNION ALL SELECT 'none_active', 0
UNION ALL SELECT 'same_groups', CAST(min(n) = 14 AS BIGINT) FROM cells UNION ALL SELECT 'lacking_group', 0""")
def expectation_verdicts(spark, sf):
    """Each expectation on tables that meet it, and on tables that do not."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    segments = c.select("c_mktsegment").distinct()
    v = star.versions(spark, sf)
    line = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_linenumber").cast("string").alias("grp"), F.when(F.col("l_linestatus") == "O", "M").otherwise("F").alias("sex"))
    extracts = {f: line.where(F.col("l_returnflag") == f).drop("l_returnflag") for f in ("A", "N", "R")}
    numbers = [str(i) for i in range(1, 8)]
    cut = extracts | {"A": extracts["A"].where("grp <> '3' or sex = 'M'")}
    mean = F.avg("o_totalprice")
    checks = [
        verdict("columns", lambda: Q.expect_columns(o, ["o_orderkey", "o_custkey"])), verdict("columns_missing", lambda: Q.expect_columns(o, ["o_orderkey", "o_clerk"])),
        verdict("values", lambda: Q.expect_values(o, "o_orderstatus", ["F", "O", "P"])), verdict("values_outside", lambda: Q.expect_values(o, "o_orderstatus", ["F", "O"])),
        verdict("range", lambda: Q.expect_range(o, mean, 1000, 500_000, "mean price")), verdict("range_outside", lambda: Q.expect_range(o, mean, 0, 10, "mean price")),
        verdict("count", lambda: Q.expect_count(segments, 5)), verdict("count_other", lambda: Q.expect_count(segments, 4)),
        verdict("one_active", lambda: Q.expect_one_active(v)), verdict("none_active", lambda: Q.expect_one_active(v.where(~R.same_text("status", F.lit("active"))))),
        verdict("same_groups", lambda: Q.expect_same_groups(extracts, "grp", "sex", numbers, same=[("A", "N", "R")])),
        verdict("lacking_group", lambda: Q.expect_same_groups(cut, "grp", "sex", numbers, suppressed=[("A", "3", "F")])),
    ]
    return spark.createDataFrame(checks, "check_name string, passed boolean")


@query("""WITH b AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity)::DOUBLE AS q FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey, n, q FROM orders LEFT JOIN b ON l_orderkey = o_orderkey""")
def one_to_one_checked(spark, sf):
    b = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    return J.join_one_to_one(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), b, ["o_orderkey"])


@query("WITH" + star.RECORDS + """,
observed AS (SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, count(*) AS records, avg((diabetes_status = 'yes')::INT) AS empirical FROM records
  WHERE age_band IS NOT NULL AND gender IS NOT NULL AND smoking_status IS NOT NULL AND bmi_band IS NOT NULL AND exercise_freq IS NOT NULL AND diabetes_status IS NOT NULL GROUP BY ALL)
SELECT age_band, gender, smoking_status, bmi_band, exercise_freq, records, round(empirical, 6) AS empirical, CAST(""" + star.band_no("age_band") + """ AS DOUBLE) / 20 AS probability
FROM observed ORDER BY records, {profile} LIMIT 5""".format(profile=", ".join(fixed.PROFILE)))
def sparse_vs_predicted(spark, sf):
    """The five smallest observed cells beside a prediction that rises with age."""
    levels = {"age_band": fixed.AGE_LABELS, "gender": fixed.GENDERS, "smoking_status": fixed.SMOKING_LEVELS, "bmi_band": fixed.BMI_LEVELS, "exercise_freq": fixed.EXERCISE_LEVELS}
    predicted = J.profile_grid(spark, levels).withColumn("probability", R.ordinal("age_band", fixed.AGE_LABELS) / 20)
    return M.sparse_vs_predicted(M.observed_profiles(star.records(spark, sf)), predicted)[0]


DELAY = "2 days"


def arrivals(spark, sf) -> list[DataFrame]:
    """The check-ins in the order they arrive, ten days each. The second part comes again at the end, and with the third one come new
    check-ins of the first day, long after its windows have ended."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("activity_id"), F.col("user_id").alias("enrollment_id"), F.col("ts").cast("timestamp").alias("activity_ts"),
                                          F.col("event_type").alias("activity_type"), F.lit("Y").alias("verified_flag"))
    day = F.dayofmonth("activity_ts")
    late = e.where(day == 1).withColumn("activity_id", -1 - F.col("activity_id"))
    return [e.where(day <= 10), e.where(day.between(11, 20)), e.where(day > 20).unionByName(late), e.where(day.between(11, 20))]


def streamed(spark, sf, shape: Callable[[DataFrame], DataFrame], keys: list[str], schema: str) -> DataFrame:
    """The windows of a running aggregate over the arriving check-ins, each check-in once, kept by batch in an upsert table."""
    root = run_folder(spark, "windows")
    kept = UpsertTable(spark, f"{root}/out", keys, schema, fold_after=2)
    for part in arrivals(spark, sf):
        part.write.mode("append").parquet(f"{root}/in")
        once = T.dedupe(T.read_checkins(spark, f"{root}/in"), "40 days")
        once.writeStream.option("checkpointLocation", f"{root}/cp-once").trigger(availableNow=True).format("parquet").start(f"{root}/once").awaitTermination()
        T.upserted(shape(T.read_checkins(spark, f"{root}/once")), kept, f"{root}/cp").awaitTermination()
    return kept.read().withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, user_id AS enrollment_id, count(*) AS qualifying_activity_count FROM events GROUP BY 1, 2""")
def stream_running_counts(spark, sf):
    """Late and repeated check-ins change nothing: the former come after their windows ended, the latter are told by their id."""
    return streamed(spark, sf, lambda s: T.running_counts(s, delay=DELAY), ["window_start", "enrollment_id"],
                    "window_start timestamp, enrollment_id bigint, qualifying_activity_count bigint")


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS events FROM events GROUP BY 1 HAVING count(*) >= 5""")
def stream_threshold_alarm(spark, sf):
    return streamed(spark, sf, lambda s: T.threshold_alarm(s, 5, delay=DELAY), ["window_start"], "window_start timestamp, events bigint")


@query("""WITH f AS (SELECT c_nationkey AS source, string_agg(c_name || chr(10), '' ORDER BY c_custkey) AS content FROM customer GROUP BY 1),
i AS (SELECT source, content, unnest(generate_series(0, (strlen(content) + 255)//256 - 1)) AS block_no FROM f),
b AS (SELECT source, block_no, sha256(substr(content, 1 + block_no*256, 256)) AS h FROM i),
n AS (SELECT source, block_no//4 AS node_no, sha256(string_agg(h, '' ORDER BY block_no)) AS h FROM b GROUP BY 1, 2),
t AS (SELECT source, sha256(string_agg(h, '' ORDER BY node_no)) AS content_hash FROM n GROUP BY 1)
SELECT CAST(t.source AS BIGINT) AS source, content_hash, CAST(strlen(content) AS BIGINT) AS byte_size FROM t JOIN f ON f.source = t.source""")
def source_block_hashes(spark, sf):
    """Customers written as a file a nation; each file's hash from its ranges of 256 bytes, four ranges a node."""
    root = run_folder(spark, "blocks")
    names = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name").repartition("c_nationkey")
    names.sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "c_name").write.partitionBy("c_nationkey").text(root)
    state = S.source_state(spark, f"{root}/*/*.txt", 256, 4)
    return state.select(F.regexp_extract("source_path", r"c_nationkey=(\d+)", 1).cast("bigint").alias("source"), "content_hash", "byte_size")


@query("""SELECT 'customer' AS source, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS byte_size FROM customer
UNION ALL SELECT 'part', CAST(sum(strlen(p_name) + 1) AS BIGINT) FROM part""")
def source_watch_changes(spark, sf):
    """Three sources, one of them known already; the watch passes the files of the other two."""
    root = run_folder(spark, "watch")
    for name, col in (("customer", "c_name"), ("part", "p_name"), ("supplier", "s_name")):
        table(spark, sf, name).select(col).write.text(f"{root}/{name}")
    known = S.source_state(spark, f"{root}/supplier/*.txt").withColumn("source_state_id", F.lit(1))

    def keep(changed: DataFrame, batch_id: int) -> None:
        changed.select("source_path", "byte_size").write.mode("append").parquet(f"{root}-changed")

    T.source_watch(spark, f"{root}/*/*.txt", lambda: known, keep, f"{root}-cp").awaitTermination()
    source = F.element_at(F.split("source_path", "/"), -2)
    return spark.read.parquet(f"{root}-changed").groupBy(source.alias("source")).agg(F.sum("byte_size").alias("byte_size"))
