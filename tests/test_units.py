"""Pay units (problem 4)."""

import pytest
from pyspark.sql import functions as F

from workloom.operators import units

UNITS = [("HOUR", 1.0, 1.0), ("DAY", 8.0, 1.0), ("WEEK", 40.0, 1.0), ("BIWEEK", 80.0, 1.0), ("MONTH", 173.33, 1.0), ("YEAR", 2080.0, 1.0), ("KYEAR", 2080.0, 1000.0), ("KMONTH", 173.33, 1000.0), ("CENTHOUR", 1.0, 0.01)]
SCHEMA = "row_id bigint, salary_minimum string, salary_maximum string, salary_per string, noc21_code string, employment_type string, province_territory string"


def run(spark, rows, **more):
    df = spark.createDataFrame([(k, a, b, c, "12345", "Full time", "Quebec") for k, (a, b, c) in enumerate(rows)], SCHEMA)
    lookup = spark.createDataFrame(UNITS, "unit_code string, hours_per_unit double, dollars_per_amount double")
    return {(r.row_id, r.amount_field): r for r in units.to_hourly(df, lookup, **more).collect()}


@pytest.mark.parametrize("text,amount", [("$1,000.18", 1000.18), ("134,15", 134.15), ("1 018,17 par an", 1018.17), ("CAD 49,5", 49.5), ("101,800", 101800.0), ("1450¢/hr", 1450.0), ("TBD", None), ("", None), (None, None), ("1160.00/2 weeks", 1160.0), ("1 234 567,8", 1234567.8), ("52\u202f000\u00a0$ / an", 52000.0), ("c$ 1,234.50 weekly", 1234.5)])
def test_amounts(spark, text, amount):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(units.read_amount(units.plain_text(F.col("x")))).first()[0] == amount


@pytest.mark.parametrize("text,unit", [
    ("14.5 $/heure", "HOUR"), ("an hour", "HOUR"), ("1450c an hour", "CENTHOUR"), ("¢ per hour", "CENTHOUR"), ("Hour (cents)", "CENTHOUR"), ("k$/an", "KYEAR"), ("Year (000s)", "KYEAR"), ("101.40k par an", "KYEAR"), ("thousands/month", "KMONTH"),
    ("Month (x1000)", "KMONTH"), ("BI-WKLY", "BIWEEK"), ("aux deux semaines", "BIWEEK"), ("1160/2 weeks", "BIWEEK"), ("hebdomadaire", "WEEK"), ("Jour", "DAY"), ("Mo.", "MONTH"), ("An", "YEAR"), ("p.a.", "YEAR"), ("per annum", "YEAR"), ("other", None), ("see amount", None), ("N/A", None), (None, None),
])
def test_units(spark, text, unit):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(units.read_unit(units.plain_text(F.col("x")))).first()[0] == unit


def test_signs_of_currency_are_no_cents(spark):
    got = run(spark, [("c$52,000 a year", "CAD 25 / hour", None), ("c$1,200", None, "weekly")])
    assert [got[k].unit_code for k in ((0, "minimum"), (0, "maximum"), (1, "minimum"))] == ["YEAR", "HOUR", "WEEK"]


def test_precedence_and_conversion(spark):
    got = run(spark, [("2000 weekly", "100", "Year"), ("100", "52000 per annum", "other"), ("1450c an hour", None, None), ("TBD", "-", "Hour"), ("25", None, None)])
    assert (got[0, "minimum"].unit_code, got[0, "minimum"].assigned_by, got[0, "minimum"].hourly) == ("WEEK", "amount", 50.0)
    assert (got[0, "maximum"].unit_code, got[0, "maximum"].assigned_by) == ("YEAR", "salary_per")
    assert (got[1, "minimum"].unit_code, got[1, "minimum"].assigned_by) == ("YEAR", "other_amount")
    assert got[2, "minimum"].hourly == 14.5
    assert (3, "minimum") not in got and (3, "maximum") not in got
    assert (got[4, "minimum"].assigned_by, got[4, "minimum"].hourly) == ("review", None)


def test_prediction_is_calibrated(spark):
    rows = [(f"{20 + k % 30}.5", f"{30 + k % 30}.5", "Hour") for k in range(300)] + [(f"{40000 + 500 * (k % 60)}", None, "Year") for k in range(300)] + [("33.5", "41.5", None), ("52000", None, "other")] * 20
    got = run(spark, rows)
    told = [r for (k, f), r in got.items() if k >= 600]
    right = [r for r in told if r.unit_code == ("HOUR" if r.amount < 100 else "YEAR")]
    assert len(right) == len(told) and all(r.assigned_by == "predicted" and r.confidence >= 0.9 for r in told)


def test_empty_and_further_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    lookup = spark.createDataFrame(UNITS, "unit_code string, hours_per_unit double, dollars_per_amount double")
    assert units.to_hourly(empty, lookup).isEmpty()
    clash = spark.createDataFrame([(1, "10 weekly", None, None, None, None, None), (1, "10 weekly", None, None, None, None, None)], SCHEMA).withColumn("amount", F.lit("x")).withColumn("unit_code", F.lit("x"))
    assert [r.unit_code for r in units.to_hourly(clash, lookup).collect()] == ["WEEK", "WEEK"]
    assert [r.assigned_by for r in units.to_hourly(clash, lookup.limit(0)).collect()] == ["review", "review"]
