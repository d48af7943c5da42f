from datetime import datetime

from pyspark.sql import functions as F

from tarmac.functions.text import (
    destination_path, null_tokens, period_month, period_problem, period_year,
    record_filename, reporting_period_from_text, safe_filename,
)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_title_period_cases(spark):
    cases = {
        "Full Analysis 202605": "202605",
        "Full Analysis 202705": "",
        "Full Analysis 202513": "",
        "Full Analysis 199912": "",
        "ref 209901 then 201104": "",
    }
    for text, expected in cases.items():
        assert one(spark, reporting_period_from_text("v", 2026), text) == expected, text


def test_title_period_uses_current_year_by_default(spark):
    year = datetime.now().year
    assert one(spark, reporting_period_from_text("v"), f"Punctuality Full Analysis {year}05") == f"{year}05"
    assert one(spark, reporting_period_from_text("v"), f"Punctuality Full Analysis {year + 1}05") == ""


def test_safe_and_record_filenames(spark):
    df = spark.createDataFrame([
        ("201104 FullAnalysis (CSV document)", "201104", "201104_full_analysis.csv"),
        ("202502 Punctuality Statistics Full Analysis (CSV document)", "202502",
         "202502_punctuality_statistics_full_analysis.csv"),
        ("Full Analysis 201104", "201104", "201104_full_analysis_201104.csv"),
        ("201104 x csv", "201104", "201104_x_csv"),
    ], "t string, p string, e string")
    got = df.select(record_filename("t", "p").alias("r"), "e").collect()
    assert [r.r for r in got] == [r.e for r in got]
    assert one(spark, safe_filename("v"), "  --Hello,  World!!__ ") == "hello_world"


def test_destination_path(spark):
    df = spark.createDataFrame([("201104", "a.csv")], "p string, f string")
    assert df.select(destination_path("p", "f", "raw/")).first()[0] == "raw/2011/a.csv"
    assert df.select(destination_path("p", "f", "raw//")).first()[0] == "raw/2011/a.csv"
    assert df.select(destination_path("p", "f", "")).first()[0] == "2011/a.csv"


def test_period_parsing_and_rejection(spark):
    df = spark.createDataFrame(
        [("201104",), (" 2011-04 ",), ("2011/04",), ("201113",), ("201104.0",), (None,)], "p string")
    rows = df.select("p", period_year("p").alias("y"), period_month("p").alias("m"),
                     period_problem("p").alias("why")).collect()
    assert [(r.y, r.m, r.why) for r in rows[:2]] == [(2011, 4, None), (2011, 4, None)]
    assert [r.why for r in rows[2:]] == ["format", "month", "format", "format"]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("",), ("x",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(null_tokens("v")).collect()] == [None, None, None, "x", None, None]
    assert df.select(F.count_if(null_tokens("v").isNull())).first()[0] == 5
