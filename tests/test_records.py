"""Strict load with rejects (problem 2), against the csv rules on small cases."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from workloom.operators import records

SCHEMA = "line_id bigint, file_name string, year_month string, line_no int, raw_line string"
HEAD = "﻿Job Title,NOC21 Code,Vacancy Count,First Posting Date"


def load(spark, lines, head=HEAD):
    rows = [(1, "a.csv", "2023-01", 1, head)] + [(k, "a.csv", "2023-01", k, x) for k, x in enumerate(lines, 2)]
    loaded, rejected = records.load_records(spark.createDataFrame(rows, SCHEMA))
    return {r.line_id: r for r in loaded.collect()}, {r.line_id: r.reason for r in rejected.collect()}


def test_reasons(spark):
    lines = [
        'Cook,12345,1,2023/01/02', '"Cook, chief",12345.0,1,x', '"Cook ""A"" crew",,two,', '"line\nbreak",00012,1,', '"",123,1,',  # 2-6
        'Co"ok,12345,1,', '"Cook" x,12345,1,', '"Cook,12345,1,', 'Cook"",12345,1,',  # 7-10
        'Cook,12345,1', 'Cook,12345,1,,', '', None,  # 11-14
        'Cook,123456,1,', 'Cook,12-345,1,', '12/05,12345,1,', 'Cook, 12345,1,', 'é,1.0,1,',  # 15-19
    ]
    loaded, rejected = load(spark, lines)
    assert {k for k in loaded} == {2, 3, 4, 5, 19}
    assert rejected == {6: "values", 7: "quoting", 8: "quoting", 9: "quoting", 10: "quoting", 11: "columns", 12: "columns", 13: "columns", 14: "columns", 15: "values", 16: "values", 17: "values", 18: "values"}
    assert loaded[3].job_title == "Cook, chief" and loaded[3].noc21_code == "12345"
    assert loaded[4].job_title == 'Cook "A" crew' and loaded[4].noc21_code is None and loaded[4].vacancy_count is None
    assert loaded[5].job_title == "line\nbreak" and loaded[5].noc21_code == "00012"
    assert str(loaded[2].first_posting_date) == "2023-01-02" and loaded[2].city is None


def test_tabs_marks_and_missing_header(spark):
    loaded, rejected = load(spark, ["Cook\t12345\t1\t\x01\x011", '"a\tb"\t1\t1\t'], HEAD.replace(",", "\t"))
    assert set(loaded) == {2, 3} and loaded[3].job_title == "a\tb" and not rejected
    lone = spark.createDataFrame([(5, "b.csv", "2023-01", 2, "Cook,1,1,")], SCHEMA)
    loaded, rejected = records.load_records(lone)
    assert loaded.isEmpty() and [r.reason for r in rejected.collect()] == ["columns"]


def test_empty_repeated_and_further_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    loaded, rejected = records.load_records(empty)
    assert loaded.isEmpty() and rejected.isEmpty()
    rows = [(1, "a.csv", "m", 1, HEAD), (2, "a.csv", "m", 2, "x,y"), (2, "a.csv", "m", 2, "x,y"), (None, "a.csv", "m", None, "Cook,1,1,")]
    raw = spark.createDataFrame(rows, SCHEMA).withColumn("reason", F.lit("clash")).withColumn("delimiter", F.lit("clash"))
    loaded, rejected = records.load_records(raw)
    assert [r.reason for r in rejected.collect()] == ["columns"] * 2 and loaded.count() == 1


def test_long_record(spark):
    loaded, rejected = load(spark, ['"' + 'a""' * 200_000 + '",1,1,', '"' + "a" * 500_000])
    assert set(loaded) == {2} and len(loaded[2].job_title) == 400_000 and rejected == {3: "quoting"}


def reference(line):
    """(well quoted, fields) by reading letter by letter."""
    fields, at = [], 0
    while True:
        if line[at : at + 1] == '"':
            at, text = at + 1, ""
            while True:
                if at >= len(line):
                    return False, []
                if line[at] == '"':
                    if line[at + 1 : at + 2] == '"':
                        text, at = text + '"', at + 2
                        continue
                    at += 1
                    break
                text, at = text + line[at], at + 1
            if at < len(line) and line[at] != ",":
                return False, []
        else:
            end = line.find(",", at)
            end = len(line) if end < 0 else end
            text, at = line[at:end], end
            if '"' in text:
                return False, []
        fields.append(text)
        if at >= len(line):
            return True, fields
        at += 1


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='",a\x01', max_size=9), min_size=40, max_size=60))
def test_quoting_like_a_reader(spark, lines):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, x string")
    comma = F.lit(",")
    got = df.select("x", records.well_quoted(F.col("x"), comma).alias("ok"), records.field_count(F.col("x"), comma).alias("n"), records.fields(F.col("x"), comma).alias("f")).collect()
    for r in got:
        ok, fields = reference(r.x)
        assert r.ok == ok, r.x
        if ok:
            assert (r.n, r.f) == (len(fields), fields), r.x
