"""Loading of delimited records that are kept one per row, with the failing records set apart.

A strict load takes only the records that conform; what it took is subtracted from all records by their
offsets, and the remainder is diagnosed. Everything runs as built-in expressions; quoting is judged by the
segments between quotes, in time linear in the length of a record, however long.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.runtime import cut, small_side

DELIMITERS = ("\t", ",", ";", "|")
_MARK, _KEPT_MARK, _KEPT_DELIMITER = "\x01", "\x010", "\x011"


def _count(text: Column, what: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, what, F.lit("")))


def guess_delimiter(header: Column) -> Column:
    """The delimiter that occurs most often in the header; at a tie the first of DELIMITERS."""
    best = F.array_max(F.array(*(F.struct(_count(header, F.lit(d)).alias("n"), F.lit(-k).alias("k"), F.lit(d).alias("d")) for k, d in enumerate(DELIMITERS))))
    return best["d"]


def well_quoted(line: Column, delimiter: Column) -> Column:
    """Whether each field is wholly in double quotes, with inner quotes doubled, or has no double quote."""
    parts = F.split(line, '"', -1)
    last = F.size(parts) - 1

    def fits(part: Column, at: Column) -> Column:
        opens, closes = F.endswith(part, delimiter), F.startswith(part, delimiter)
        return (at % 2 == 1) | (part == "") | F.when(at == 0, opens).when(at == last, closes).otherwise(opens & closes)

    bad = F.exists(F.transform(parts, lambda part, at: ~fits(part, at)), lambda x: x)
    return F.when(~F.contains(line, F.lit('"')), F.lit(True)).otherwise((F.size(parts) % 2 == 1) & ~bad)


def field_count(line: Column, delimiter: Column) -> Column:
    """Number of fields of a well-quoted line."""
    outside = F.array_join(F.filter(F.split(line, '"', -1), lambda part, at: at % 2 == 0), "")
    return 1 + _count(F.when(F.contains(line, F.lit('"')), outside).otherwise(line), delimiter)


def fields(line: Column, delimiter: Column) -> Column:
    """The fields of a well-quoted line, without their quotes."""
    pattern = F.concat(F.lit("\\Q"), delimiter, F.lit("\\E"))
    safe = F.replace(line, F.lit(_MARK), F.lit(_KEPT_MARK))
    hidden = F.array_join(F.transform(F.split(safe, '"', -1), lambda part, at: F.when(at % 2 == 1, F.replace(part, delimiter, F.lit(_KEPT_DELIMITER))).otherwise(part)), '"')

    def plain(field: Column) -> Column:
        inner = F.when(F.startswith(field, F.lit('"')), F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))).otherwise(field)
        return F.replace(F.replace(inner, F.lit(_KEPT_DELIMITER), delimiter), F.lit(_KEPT_MARK), F.lit(_MARK))

    quoted = F.transform(F.split(hidden, pattern, -1), plain)
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, pattern, -1))


def headers_of(raw: DataFrame) -> DataFrame:
    """file_name, delimiter, names: of the records that are line 1 of their file (the first, if there are several)."""
    first = raw.where("line_no = 1 and raw_line is not null and file_name is not null").groupBy("file_name").agg(F.min_by("raw_line", "line_id").alias("header"))
    clean = F.regexp_replace("header", "^﻿", "")
    first = first.select("file_name", clean.alias("header"), guess_delimiter(clean).alias("delimiter"))
    return first.select("file_name", "delimiter", F.transform(fields(F.col("header"), F.col("delimiter")), lambda x: F.trim(x)).alias("names"))


def judged(raw: DataFrame, headers: DataFrame) -> DataFrame:
    """raw without header lines, with the header of each file and reason: the first that holds, null for conforming records.

    quoting: see well_quoted. columns: another number of fields than the header; also for null lines and for
    files without a header. values: NOC21 Code is neither empty nor one to five digits with or without .0, or
    Job Title has no letter (a missing column counts as empty).
    """
    data = raw.where("line_no is null or line_no <> 1").join(small_side(headers), "file_name", "left")
    line, delimiter = F.col("raw_line"), F.col("delimiter")
    quoting = well_quoted(line, delimiter)
    columns = field_count(line, delimiter) == F.size("names")
    # the costly fields are split only where the cheap conditions hold
    values = fields(line, delimiter)
    code = F.get(values, F.array_position("names", "NOC21 Code").cast("int") - 1)
    title = F.get(values, F.array_position("names", "Job Title").cast("int") - 1)
    valid = F.coalesce(code, F.lit("")).rlike(r"\A(?:|[0-9]{1,5}(?:\.0)?)\z") & F.coalesce(title, F.lit("")).rlike(r"\p{L}")
    reason = F.when(line.isNull() | delimiter.isNull(), "columns").when(~quoting, "quoting").when(~columns, "columns").when(~valid, "values")
    return data.withColumn("reason", reason)


def typed(conforming: DataFrame) -> DataFrame:
    """Typed columns of conforming records; columns that a file doesn't have, and values of another type, are null."""
    split = conforming.withColumn("values", fields(F.col("raw_line"), F.col("delimiter")))

    def named(name: str) -> Column:
        return F.nullif(F.trim(F.get("values", F.array_position("names", name).cast("int") - 1)), F.lit(""))

    return split.select(
        "line_id", "file_name", "year_month", "line_no",
        named("Job Title").alias("job_title"),
        F.lpad(F.regexp_extract(named("NOC21 Code"), r"^([0-9]{1,5})", 1), 5, "0").alias("noc21_code"),
        named("NOC21 Code Name").alias("noc21_code_name"),
        named("NOC 2016 Code").alias("noc_2016_code"),
        named("NOC 2016 Code Name").alias("noc_2016_code_name"),
        named("Vacancy Count").try_cast("int").alias("vacancy_count"),
        F.try_to_date(named("First Posting Date"), "yyyy/MM/dd").alias("first_posting_date"),
        named("Salary Minimum").try_cast("double").alias("salary_minimum"),
        named("Salary Maximum").try_cast("double").alias("salary_maximum"),
        named("Salary Per").alias("salary_per"),
        named("Province/Territory").alias("province_territory"),
        named("City").alias("city"),
        named("Employment Type").alias("employment_type"),
        named("NAICS").alias("naics"),
    )


_OFFSET = ("line_id", "file_name", "line_no")


def _given(raw: DataFrame) -> DataFrame:
    return raw.select("line_id", "file_name", "year_month", "line_no", "raw_line")


def _matched(rows: DataFrame, offsets: DataFrame, how: str) -> DataFrame:
    """The semi or anti join of rows with offsets; null offsets are equal."""
    r, t = rows.alias("r"), offsets.alias("t")
    return r.join(t, reduce(lambda x, y: x & y, (F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in _OFFSET)), how)


def strict_load(raw: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """The typed rows of the records that conform, of raw records as in load_records."""
    given = _given(raw)
    return typed(judged(given, headers or cut(headers_of(given))).where("reason is null"))


def rejects(raw: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """line_id, file_name, line_no, raw_line, reason of the records whose offsets the strict load doesn't take, as in load_records.

    Only offsets are subtracted; the lines that are left are fetched afterwards and diagnosed.
    """
    given = _given(raw)
    headers = headers or cut(headers_of(given))  # one row a file
    taken = judged(given, headers).where("reason is null")
    left = _matched(given.where("line_no is null or line_no <> 1").select(*_OFFSET), taken.select(*_OFFSET), "left_anti")
    remainder = _matched(given, small_side(cut(left.distinct())), "left_semi")
    return judged(remainder, headers).select("line_id", "file_name", "line_no", "raw_line", "reason")


def load_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected) of raw records: line_id, file_name, year_month, line_no, raw_line.

    loaded: the typed rows that a strict load takes. rejected: line_id, file_name, line_no, raw_line, reason
    of the records whose offsets the load didn't take. Header lines are in neither. An offset is line_id,
    file_name and line_no together; repeated rows of one offset are alike in both results.
    """
    headers = cut(headers_of(_given(raw)))
    return strict_load(raw, headers), rejects(raw, headers)
