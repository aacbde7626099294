"""File sources and sinks."""

import hashlib
import os
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ratemill import schemas
from ratemill.operators.filters import half_open, with_source_file
from ratemill.plans import pricing, staging
from ratemill.sources import files as S


def put(folder, name, data):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


LIFE = "﻿age,male_death_probability,male_lives,male_life_expectancy,female_death_probability,female_lives,female_life_expectancy\r\n" + "".join(
    f"{a},0.00{a:02d}00,{1000 - a},{80 - a}.50,0.00{a:02d}50,{1000 + a},{82 - a}.25\r\n" for a in range(18, 30))


def test_typed_csv_with_bom_and_crlf(spark, folder):
    df = S.read_typed_csv(spark, put(folder, "life.csv", LIFE), schemas.LIFE_TABLE)
    assert df.count() == 12
    first = df.orderBy("age").first()
    assert first["age"] == 18 and first["female_life_expectancy"] == D("64.25")
    bands = {(r["age_band"], r["gender"]): r for r in pricing.life_table_baseline(df).collect()}
    lives = [1000 - a for a in range(18, 25)]
    want = sum(D(n) * D(f"0.00{a:02d}00") for n, a in zip(lives, range(18, 25))) / sum(lives)
    assert bands[("18-24", "M")]["mortality_rate"] == want.quantize(D("0.000001"), rounding="ROUND_HALF_UP")


TSV = ('"Notes"\t"Ten-Year Age Groups"\t"Ten-Year Age Groups Code"\t"Sex"\t"Sex Code"\t"Deaths"\t"Population"\t"Crude Rate"\n'
       '\t"15-24 years"\t"15-24"\t"Female"\t"F"\t100\t1000000\t10.0\n\t"15-24 years"\t"15-24"\t"Male"\t"M"\t100\t1000000\t0.04\n'
       '"Total"\t"15-24 years"\t"15-24"\t\t\t200\t2000000\t10.0\n\t"Not Stated"\t"NS"\t"Male"\t"M"\t1\tNot Applicable\tNot Applicable\n"---"\n"Dataset: x"\n')
HEAD = ["Notes", "Ten-Year Age Groups", "Ten-Year Age Groups Code", "Sex", "Sex Code", "Deaths", "Population", "Crude Rate"]


def test_extract(spark, folder):
    path = put(folder, "x.tsv", TSV)
    df = S.read_extract_tsv(spark, path, HEAD, "Sex Code", "Ten-Year Age Groups Code", "Crude Rate")
    assert df.count() == 2
    raw = S.read_raw_csv(spark, path, HEAD, sep="\t")
    out = staging.mortality_extract(raw, 2023, "ALLCAUSE", "x.tsv").orderBy("gender").collect()
    assert [(r["gender"], r["mortality_rate"], r["source_year"]) for r in out] == [("F", D("0.000100"), 2023), ("M", D("0.000000"), 2023)]


def test_text_lines_and_tokens(spark, folder):
    put(folder, "a.csv", "age,p\r\n45,0.5\r\n46,x\r\n")
    for whole in (False, True):
        lines = S.read_text_lines(spark, folder, whole).where("line <> '' and line not like 'age,%'")
        out = S.tokenize(lines, "line", {"age": "int", "p": "decimal(4,2)", "gone": "string"}).orderBy("age").collect()
        assert [(r["age"], r["p"], r["gone"]) for r in out] == [(45, D("0.50"), None), (46, None, None)]
    pivot = S.tokenize_json(lines, ["line"], "line", {"age": "int", "p": "decimal(4,2)"}).orderBy("age").collect()
    assert [(r["age"], r["p"]) for r in pivot] == [(45, D("0.50")), (46, None)]
    kept = S.tokenize(spark.createDataFrame([("a|b|",)], "line string"), "line", {"x": "string", "y": "string", "z": "string"}, "|").first()
    assert (kept["x"], kept["y"], kept["z"]) == ("a", "b", "")


def test_frames_metrics_and_source_file(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    S.write_frame(df, f"{folder}/f")
    assert S.read_frame(spark, f"{folder}/f", ["v"]).columns == ["v"]
    S.append(df, f"{folder}/f")
    assert S.read_frame(spark, f"{folder}/f").count() == 4
    S.full_refresh(S.read_frame(spark, f"{folder}/f").where("k = 1"), f"{folder}/f")
    assert S.read_frame(spark, f"{folder}/f").count() == 2
    named = with_source_file(spark.read.parquet(f"{folder}/f")).select("source_file").distinct().collect()
    assert all(r[0].endswith(".parquet") for r in named)
    schema = "logistic_regression struct<auc: double>"
    assert S.read_metrics(spark, f"{folder}/m", schema) is None
    S.write_metrics(spark.createDataFrame([(0.76,)], "auc double").select(F.struct("auc").alias("logistic_regression")), f"{folder}/m")
    assert S.read_metrics(spark, f"{folder}/m", schema).first()["logistic_regression"]["auc"] == 0.76
    S.write_result(df, f"{folder}/r", single=True)
    assert S.read_typed_csv(spark, f"{folder}/r", "k int, v string").count() == 2
    assert S.markdown(spark.createDataFrame([(1, 0.12345)], "k int, x double")) == "| k | x |\n|---|---|\n| 1 | 0.123 |"


def test_typed_load(spark):
    raw = spark.createDataFrame([("1 ", "2024-01-01", "x "), ("", "  ", ""), ("q", "2024-13-01", None)], "a string, b string, c string")
    got = [tuple(r) for r in S.typed_load(raw, {"a": "int", "b": "date", "c": "string"}).collect()]
    assert got == [(1, date(2024, 1, 1), "x"), (None, None, None), (None, None, None)]


def test_file_order_identity(spark, folder):
    put(folder, "rows.csv", "v\n" + "".join(f"r{i}\n" for i in range(5000)))
    df = S.file_order_identity(spark.read.option("header", True).csv(f"{folder}/rows.csv").repartition(1), "id")
    assert [r["v"] for r in df.orderBy("id").limit(3).collect()] == ["r0", "r1", "r2"]
    many = S.file_order_identity(spark.range(0, 1000, 1, 7).withColumnRenamed("id", "x"), "id")
    assert S.assert_identity(many, "id").where("id <> x + 1").count() == 0
    with pytest.raises(ValueError):
        S.assert_identity(spark.createDataFrame([(2,), (3,)], "id int"), "id")


def test_load_plan_stops_and_resumes(spark, folder):
    a, b = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1,), (3,)], "id int")
    with pytest.raises(ValueError, match="b: expected 1..2"):
        S.load_plan(spark, [("a", a, "id", 2), ("b", b, "id", 2)], folder)
    out = S.load_plan(spark, [("a", a, "id", 2), ("b", a, "id", 2)], folder, resume_from="b")
    assert [tuple(r) for r in out.collect()] == [("b", 2, 1, 2)]


def test_backfill_and_literals(spark):
    df = S.literal_rows(spark, [(1, None), (2, None), (9, 5)], "id int, app int")
    got = [tuple(r) for r in S.backfill(df, "app", F.col("id"), "id", 1, 2).orderBy("id").collect()]
    assert got == [(1, 1), (2, 2), (9, 5)]


def tree_hash(data, block=S.BLOCK_BYTES, node=S.NODE_BLOCKS):
    def joined(hashes):
        return hashlib.sha256("".join(hashes).encode()).hexdigest()
    blocks = [hashlib.sha256(data[i:i + block]).hexdigest() for i in range(0, max(len(data), 1), block)]
    return joined(joined(blocks[i:i + node]) for i in range(0, len(blocks), node))


def test_fingerprints(spark, folder):
    data = os.urandom(5000)
    put(folder, "x.bin", data)
    put(folder, "with space%.bin", b"abc")
    got = {r["source_path"].rsplit("/", 1)[1]: (r["content_hash"], r["byte_size"]) for r in S.source_state(spark, f"{folder}/*.bin").collect()}
    assert got == {"x.bin": (tree_hash(data), 5000), "with space%.bin": (tree_hash(b"abc"), 3)}
    small = S.source_state(spark, f"{folder}/x.bin", block=700, node=3)
    assert small.first()["content_hash"] == tree_hash(data, 700, 3)
    files = spark.read.format("binaryFile").load(f"{folder}/x.bin").select(F.col("path").alias("source_path"), F.col("length").alias("byte_size"))
    blocks = S.block_hashes(files, 700)
    assert blocks.rdd.getNumPartitions() == blocks.count() == 8                # the file is not read by one task
    put(folder, "many.bin", data * 20)
    many = S.block_hashes(spark.createDataFrame([(f"file:{folder}/many.bin", 100_000), (f"file:{folder}/x.bin", 5000)], "source_path string, byte_size bigint"), 16)
    assert many.rdd.getNumPartitions() == S.MIN_TASKS and many.count() == 6250 + 313      # short ranges share tasks
    assert S.source_state(spark, f"{folder}/many.bin", block=16, node=5).first()["content_hash"] == tree_hash(data * 20, 16, 5)
    with pytest.raises(Exception, match="shorter"):
        S.hash_files(files.withColumn("byte_size", F.lit(6000).cast("bigint"))).collect()
    assert S.hash_files(files.limit(0)).count() == 0
    put(folder, "empty", b"")
    empty = spark.createDataFrame([(f"file:{folder}/empty", 0)], "source_path string, byte_size bigint")
    assert S.hash_files(empty).first()["content_hash"] == tree_hash(b"")
    df = spark.createDataFrame([(i, str(i % 3)) for i in range(100)], "k int, v string")
    one = S.frame_fingerprint(df, "t").first()["content_hash"]
    assert one == S.frame_fingerprint(df.orderBy(F.desc("k")).repartition(5), "t").first()["content_hash"]
    assert one != S.frame_fingerprint(df.withColumn("v", F.when(F.col("k") == 4, "z").otherwise(F.col("v"))), "t").first()["content_hash"]
    assert one != S.frame_fingerprint(df.unionByName(df.limit(1)), "t").first()["content_hash"]


def test_year_layout_prunes(spark, folder):
    df = spark.range(0, 3000).select(F.col("id"), F.date_add(F.lit(date(2021, 1, 1)), (F.col("id") % 1400).cast("int")).alias("d"))
    S.write_by_year(df, f"{folder}/y", "d", ["id"])
    q = half_open(spark.read.parquet(f"{folder}/y"), "d", date(2022, 1, 1), date(2023, 1, 1), year_partition="year")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(d)" in plan
    assert q.count() == df.where("d >= date'2022-01-01' and d < date'2023-01-01'").count()


def test_periods_get_writers_by_their_rows(spark, folder):
    df = spark.range(0, 1100).select(F.col("id"), F.when(F.col("id") < 1000, 1).otherwise(2).alias("p")).unionByName(spark.range(3).select("id", F.lit(None).cast("int").alias("p")))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"     # would write tables as small as this one in a single task
    spark.conf.set(merge, "false")
    S.write_by_period(df, f"{folder}/p", "p", ["id"], rows_per_file=250)
    spark.conf.unset(merge)
    named = spark.read.parquet(f"{folder}/p").select("p", F.input_file_name().alias("file"))
    found = {r["p"]: (r["files"], r["n"]) for r in named.groupBy("p").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n")).collect()}
    assert {p: n for p, (_, n) in found.items()} == {1: 1000, 2: 100, None: 3}
    assert 1 < found[1][0] <= 4 and found[2][0] == found[None][0] == 1      # two of the four shares may meet in a task


def test_refresh_that_fails_keeps_the_old_table(spark, folder):
    S.full_refresh(spark.range(5), f"{folder}/t")
    with pytest.raises(Exception, match="no more"):
        S.full_refresh(spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no more")).cast("long")).otherwise(F.col("id")).alias("id")), f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 5
    S.full_refresh(spark.read.parquet(f"{folder}/t").where("id < 2"), f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 2


def test_exam_staging(spark):
    raw = spark.createDataFrame([(1.0, "5.397605346934028e-79", 1.0, 2.0, "18.235"), (2.0, "18", 2.0, 3.0, "22.345"), (3.0, "80", 1.0, 9.0, ""), (4.0, "", 1.0, 1.0, "3")],
                                "respondent_id double, age string, sex_code double, diabetes_code double, bmi string")
    staged, report = staging.exam_records(raw)
    assert tuple(report.first()) == (4, 2, 2)
    got = [(r["age_band"], r["gender"], r["diabetes_biomarker"], r["bmi_measured"]) for r in staged.orderBy("respondent_id").collect()]
    assert got == [("18-24", "F", "borderline", D("22.35")), ("80-99", "M", "unknown", None)]
    with pytest.raises(Exception, match="no gender"):
        staging.exam_records(raw.withColumn("sex_code", F.lit(7.0)))[0].collect()


def test_survey_staging_keeps_unknown_rows(spark):
    raw = spark.createDataFrame([(9.0, 9.0, 9.0, None, None, 14.0, 2.0), (1.0, 2.0, 1.0, 2834.0, 3.0, 13.0, 1.0)],
                                "diabetes_code double, smoker_code double, activity_code double, bmi_implied double, bmi_code double, age_code double, sex_code double")
    a, b = staging.survey_records(raw).orderBy("diabetes_code").collect()[::-1]
    assert [a[c] for c in ("age_band", "gender", "smoking_status", "diabetes_status", "bmi_band", "exercise_freq", "bmi_value")] == [None, "F", None, None, None, None, None]
    assert [b[c] for c in ("age_band", "gender", "smoking_status", "diabetes_status", "bmi_band", "exercise_freq", "bmi_value")] == [
        "80-99", "M", "current", "yes", "over", "yes", D("28.34")]
    with pytest.raises(Exception, match="not a whole number"):
        staging.survey_records(raw.withColumn("sex_code", F.lit(1.5))).collect()
