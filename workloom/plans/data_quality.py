"""Queries p2 (failing records) and p4 (pay units), and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloom.operators import records, units
from workloom.runtime import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of job_bank_raw that are no valid rows, with the reason."""
    return records.rejects(table(spark, sf_dir, "job_bank_raw")).select("line_id", "reason").distinct()


def p2_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conforming records as typed rows."""
    return records.strict_load(table(spark, sf_dir, "job_bank_raw"))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.to_hourly(table(spark, sf_dir, "job_bank_csv"), table(spark, sf_dir, "pay_units"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts whose written unit isn't dollars per hour."""
    written = F.col("assigned_by").isin("amount", "salary_per", "other_amount")
    return _hourly(spark, sf_dir).where(written & (F.col("unit_code") != "HOUR")).select("row_id", "amount_field", "unit_code").distinct()


def p4_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The amounts with a written unit, in dollars per hour: the rows of p4_hourly that SQL can give."""
    written = F.col("assigned_by").isin("amount", "salary_per", "other_amount")
    return _hourly(spark, sf_dir).where(written).select("row_id", "amount_field", "amount", "unit_code", "assigned_by", F.round("hourly", 6).alias("hourly"))


def p4_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every amount in dollars per hour, units predicted where none is written, uncertain ones for review."""
    return _hourly(spark, sf_dir).select("row_id", "amount_field", "amount", "unit_code", "assigned_by", F.round("confidence", 4).alias("confidence"), F.round("hourly", 4).alias("hourly"))


P2_SQL = r"""
WITH header AS (
  SELECT file_name, CASE WHEN contains(raw_line, chr(9)) THEN chr(9) ELSE ',' END AS d,
    length(raw_line) - length(replace(raw_line, CASE WHEN contains(raw_line, chr(9)) THEN chr(9) ELSE ',' END, '')) + 1 AS n
  FROM job_bank_raw WHERE line_no = 1),
lines AS (SELECT line_id, raw_line, d, n FROM job_bank_raw JOIN header USING (file_name) WHERE line_no <> 1),
quoted AS (
  SELECT *, CASE WHEN d = ',' THEN regexp_full_match(raw_line, '(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*')
    ELSE regexp_full_match(raw_line, '(?s)(?:"(?:[^"]|"")*"|[^"\t]*)(?:\t(?:"(?:[^"]|"")*"|[^"\t]*))*') END AS well,
    regexp_replace(raw_line, '"[^"]*"', '', 'g') AS bare,
    CASE WHEN d = ',' THEN '((?:"(?:[^"]|"")*")|[^",]*)' ELSE '((?:"(?:[^"]|"")*")|[^"\t]*)' END AS f
  FROM lines),
judged AS (
  SELECT *, length(bare) - length(replace(bare, d, '')) + 1 AS found,
    CASE WHEN d = ',' THEN regexp_extract(raw_line, '(?s)^((?:"(?:[^"]|"")*")|[^",]*),((?:"(?:[^"]|"")*")|[^",]*)', 1) ELSE regexp_extract(raw_line, '(?s)^((?:"(?:[^"]|"")*")|[^"\t]*)\t((?:"(?:[^"]|"")*")|[^"\t]*)', 1) END AS title,
    CASE WHEN d = ',' THEN regexp_extract(raw_line, '(?s)^((?:"(?:[^"]|"")*")|[^",]*),((?:"(?:[^"]|"")*")|[^",]*)', 2) ELSE regexp_extract(raw_line, '(?s)^((?:"(?:[^"]|"")*")|[^"\t]*)\t((?:"(?:[^"]|"")*")|[^"\t]*)', 2) END AS code
  FROM quoted),
reasons AS (
  SELECT line_id, CASE WHEN NOT well THEN 'quoting' WHEN found <> n THEN 'columns'
    WHEN NOT regexp_full_match(trim(code, '"'), '(?:[0-9]{1,5}(?:\.0)?)?') OR NOT regexp_matches(title, '\p{L}') THEN 'values' END AS reason
  FROM judged)
SELECT line_id, reason FROM reasons WHERE reason IS NOT NULL
"""

_LOADED = (
    ("job_title", "Job Title", "{}"), ("noc21_code", "NOC21 Code", "lpad(regexp_extract({}, '^[0-9]{{1,5}}'), 5, '0')"), ("noc21_code_name", "NOC21 Code Name", "{}"),
    ("noc_2016_code", "NOC 2016 Code", "{}"), ("noc_2016_code_name", "NOC 2016 Code Name", "{}"), ("vacancy_count", "Vacancy Count", "CASE WHEN regexp_full_match({0}, '[+-]?[0-9]+') THEN TRY_CAST({0} AS INT) END"),
    ("first_posting_date", "First Posting Date", "try_strptime({}, '%Y/%m/%d')::DATE"), ("salary_minimum", "Salary Minimum", "TRY_CAST({} AS DOUBLE)"), ("salary_maximum", "Salary Maximum", "TRY_CAST({} AS DOUBLE)"), ("salary_per", "Salary Per", "{}"),
    ("province_territory", "Province/Territory", "{}"), ("city", "City", "{}"), ("employment_type", "Employment Type", "{}"), ("naics", "NAICS", "{}"),
)
_FIELDS_SQL = r"""CASE WHEN d = ',' THEN regexp_extract_all(',' || {0}, ',("(?:[^"]|"")*"|[^",]*)', 1) ELSE regexp_extract_all(chr(9) || {0}, '\t("(?:[^"]|"")*"|[^"\t]*)', 1) END"""
_VALUE_SQL = """nullif(trim(CASE WHEN starts_with(fields[at_{0}], '"') THEN replace(fields[at_{0}][2:-2], '""', '"') ELSE fields[at_{0}] END), '')"""
P2_LOADED_SQL = (
    P2_SQL.replace("SELECT line_id, reason FROM reasons WHERE reason IS NOT NULL", "").replace("SELECT file_name, CASE", "SELECT file_name, raw_line AS head, CASE")
    + f""", named AS (SELECT file_name, d, list_transform({_FIELDS_SQL.format("replace(head, chr(65279), '')")}, lambda x: trim(replace(x, '"', ''))) AS names FROM header),
places AS (SELECT file_name, d, {", ".join(f"list_position(names, '{name}') AS at_{column}" for column, name, _ in _LOADED)} FROM named),
split AS (SELECT r.*, p.* EXCLUDE (file_name, d), {_FIELDS_SQL.format("raw_line")} AS fields FROM job_bank_raw r JOIN reasons USING (line_id) JOIN places p USING (file_name) WHERE reason IS NULL),
texts AS (SELECT line_id, file_name, year_month, line_no, {", ".join(f"{_VALUE_SQL.format(column)} AS {column}" for column, _, _ in _LOADED)} FROM split)
SELECT line_id, file_name, year_month, line_no, {", ".join(f"{sql.format(column)} AS {column}" for column, _, sql in _LOADED)} FROM texts"""
)

_UNIT_SQL = r"""CASE
  WHEN regexp_matches({x}, 'hour|\bhrs?\b|heure|/ ?h\b') THEN CASE WHEN regexp_matches({x}, '¢|\bcents?\b|[0-9]c\b') THEN 'CENTHOUR' ELSE 'HOUR' END
  WHEN regexp_matches({x}, 'bi-?we?e?kl?y?|two weeks|2 weeks|fortnight|deux semaines') THEN 'BIWEEK'
  WHEN regexp_matches({x}, 'week|\bwk\b|semaine|hebdo') THEN 'WEEK'
  WHEN regexp_matches({x}, '\bday|daily|\bjour') THEN 'DAY'
  WHEN regexp_matches({x}, 'month|\bmo\b|\bmois\b|mensuel') THEN CASE WHEN regexp_matches({x}, 'thousand|000s|x1000|[0-9]k\b') THEN 'KMONTH' ELSE 'MONTH' END
  WHEN regexp_matches({x}, 'year|\byr\b|\bannu|\ban\b|p\.a\.') THEN CASE WHEN regexp_matches({x}, 'thousand|000s|x1000|k\$|[0-9]k\b') THEN 'KYEAR' ELSE 'YEAR' END
END"""

_RUN_SQL = "regexp_extract({x}, '[0-9][0-9 ,.]*')"
_WHOLE_SQL = f"regexp_extract({_RUN_SQL}, '^[0-9]{{{{1,3}}}}(?:[ ,][0-9]{{{{3}}}})+')"
#: Thousands that a blank or comma groups, with what follows as decimals, else the first number as it is.
_AMOUNT_SQL = f"""TRY_CAST(CASE WHEN {_WHOLE_SQL} <> '' THEN regexp_replace({_WHOLE_SQL}, '[ ,]', '', 'g') || replace(regexp_extract(substr({_RUN_SQL}, length({_WHOLE_SQL}) + 1), '^[.,][0-9]+'), ',', '.')
  ELSE replace(regexp_extract({_RUN_SQL}, '^[0-9]+(?:[.,][0-9]+)?'), ',', '.') END AS DOUBLE)"""

P4_SQL = f"""
WITH texts AS (
  SELECT row_id, lower(trim(salary_minimum)) AS low, lower(trim(salary_maximum)) AS high, lower(trim(salary_per)) AS per FROM job_bank_csv),
read AS (
  SELECT row_id, regexp_matches(low, '[0-9]') AS has_low, regexp_matches(high, '[0-9]') AS has_high,
    {_UNIT_SQL.format(x="low")} AS u_low, {_UNIT_SQL.format(x="high")} AS u_high, {_UNIT_SQL.format(x="per")} AS u_per FROM texts),
known AS (
  SELECT row_id, 'minimum' AS amount_field, coalesce(CASE WHEN has_low THEN u_low END, u_per, CASE WHEN has_high THEN u_high END) AS unit_code FROM read WHERE has_low
  UNION ALL
  SELECT row_id, 'maximum', coalesce(CASE WHEN has_high THEN u_high END, u_per, CASE WHEN has_low THEN u_low END) FROM read WHERE has_high)
SELECT DISTINCT row_id, amount_field, unit_code FROM known WHERE unit_code <> 'HOUR'
"""

P4_WRITTEN_SQL = f"""
WITH texts AS (
  SELECT row_id, lower(trim(salary_minimum)) AS low, lower(trim(salary_maximum)) AS high, lower(trim(salary_per)) AS per FROM job_bank_csv),
read AS (
  SELECT row_id, {_AMOUNT_SQL.format(x="low")} AS low, {_AMOUNT_SQL.format(x="high")} AS high,
    {_UNIT_SQL.format(x="low")} AS u_low, {_UNIT_SQL.format(x="high")} AS u_high, {_UNIT_SQL.format(x="per")} AS u_per FROM texts),
sides AS (
  SELECT row_id, 'minimum' AS amount_field, low AS amount, u_low AS own, u_per, CASE WHEN high IS NOT NULL THEN u_high END AS other FROM read WHERE low IS NOT NULL
  UNION ALL
  SELECT row_id, 'maximum', high, u_high, u_per, CASE WHEN low IS NOT NULL THEN u_low END FROM read WHERE high IS NOT NULL)
SELECT row_id, amount_field, amount, unit_code, CASE WHEN own IS NOT NULL THEN 'amount' WHEN u_per IS NOT NULL THEN 'salary_per' ELSE 'other_amount' END AS assigned_by,
  round(amount * dollars_per_amount / hours_per_unit, 6) AS hourly
FROM (SELECT *, coalesce(own, u_per, other) AS unit_code FROM sides) JOIN pay_units USING (unit_code)
"""

QUERIES = {f.__name__: f for f in (p2_found, p2_loaded, p4_found, p4_written, p4_hourly)}
SQL = {"p2_found": P2_SQL, "p2_loaded": P2_LOADED_SQL, "p4_found": P4_SQL, "p4_written": P4_WRITTEN_SQL}
