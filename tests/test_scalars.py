"""Scalar functions on the examples of the fixtures."""

import hashlib

import pytest
from pyspark.sql import functions as F

from workloom.functions import scalars as S


def value(spark, column, **inputs):
    row = [tuple(v[0] for v in inputs.values())]
    schema = ", ".join(f"{k} {v[1]}" for k, v in inputs.items()) or "x int"
    return spark.createDataFrame(row or [(1,)], schema).select(column).first()[0]


@pytest.mark.parametrize("unit,amount,hourly", [("Hour", 25.0, 25.0), ("Day", 200.0, 25.0), ("Week", 1000.0, 25.0), ("Bi-weekly", 2000.0, 25.0), ("Month", 4333.25, 25.0), ("Year", 52000.0, 25.0), (None, 25.0, None), ("Moon", 25.0, None)])
def test_hourly(spark, unit, amount, hourly):
    got = value(spark, S.hourly(F.col("a"), F.col("u")), a=(amount, "double"), u=(unit, "string"))
    assert got == (None if hourly is None else pytest.approx(hourly, abs=0.01))


@pytest.mark.parametrize("amount,kept", [(5.0, False), (9.99, False), (501.0, False), (1000.0, False), (10.0, True), (500.0, True), (None, False)])
def test_outliers(spark, amount, kept):
    assert (value(spark, S.without_outliers(F.col("a")), a=(amount, "double")) is not None) == kept


@pytest.mark.parametrize("code,number", [("00010", 10), ("10", 10), ("10.0", 10), (" 12345 ", 12345), ("x", None), (None, None), ("1e300", None)])
def test_codes(spark, code, number):
    assert value(spark, S.code_number(F.col("c")), c=(code, "string")) == number


@pytest.mark.parametrize("level,title,tier,method", [
    ("Entry level", "Senior Engineer", "entry_level", "csv"), ("Mid-Senior level", "Senior Software Engineer", "senior", "csv_refined"), ("Mid-Senior level", "Software Engineer", "mid_level", "csv"), (None, "Senior Developer", "senior", "title_keyword"),
    (None, "Software Engineer", None, None), ("Internship", "Senior Intern Manager", "intern", "csv"), ("", "Sr. Cook", "senior", "title_keyword"), ("unknown", "Co-op student", "intern", "title_keyword"), (None, None, None, None),
    (None, "Israel Market Analyst", None, None), (None, "Leading Edge Technology Specialist", None, None), (None, "Development Process Engineer", None, None), (None, "Junior Vice President", "executive", "title_keyword"),
])
def test_seniority(spark, level, title, tier, method):
    got = value(spark, S.seniority(F.col("l"), F.col("t")), l=(level, "string"), t=(title, "string"))
    assert (got.tier, got.method) == (tier, method)


@pytest.mark.parametrize("url,month", [("https://x/job-bank-en-january2023.csv", "2023-01"), ("https://x/may/feb2025-en.csv", "2025-02"), ("sept-2024", None), ("https://x/june-2024-en.csv", "2024-06"), ("https://x/DECEMBER2023.csv", "2023-12"), (None, None)])
def test_year_month(spark, url, month):
    assert value(spark, S.year_month(F.col("u")), u=(url, "string")) == month


def test_hash_names_and_masks(spark):
    want = hashlib.md5(b"9,10,100").hexdigest()[:12]
    assert value(spark, S.content_hash(F.col("i")), i=([100, 9, 10], "array<bigint>")) == want
    assert value(spark, S.safe_name(F.col("n")), n=("Café & Co", "string")) == "Café___Co"
    assert value(spark, S.safe_name(F.col("n")), n=(None, "string")) == "unknown"
    assert value(spark, S.mask_secret(F.col("n")), n=("postgresql://me:pw@h/db password=x", "string")) == "postgresql://me:***@h/db password=***"


def test_nan_counts_as_the_default(spark):
    for given, want in ((float("nan"), 7.0), (None, 7.0), (2.5, 2.5)):
        assert value(spark, S.not_nan(F.col("n"), F.lit(7.0)), n=(given, "double")) == want


@pytest.mark.parametrize("name,single", [("communications", "communication"), ("strategies", "strategy"), ("sales", "sales"), ("boxes", "box"), ("analysis", "analysis"), ("css", "css"), ("process", "process"), (None, None), ("data analyses", "data analysis"), ("team people", "team person"), ("criteria", "criterion"), ("shelves", "shelf"), ("knives", "knife"), ("potatoes", "potato"), ("matrices", "matrix"), ("viruses", "virus"), ("movies", "movie"), ("databases", "database"), ("news", "news"), ("craftsmen", "craftsman"), ("machines", "machine"), ("shoes", "shoe")])
def test_singular(spark, name, single):
    assert value(spark, S.singular(F.col("n")), n=(name, "string")) == single
