"""Preparation of postings: required columns, projections, lookups of occupations, minimum lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.functions import scalars as S
from workloom.runtime import small_side


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with these columns, in this order; an error that names the missing ones."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def normalise_pay(df: DataFrame, minimum: str = "salary_minimum", maximum: str = "salary_maximum", per: str = "salary_per") -> DataFrame:
    """df with salary_min_hourly and salary_max_hourly, outliers as null."""
    made = {out: S.without_outliers(S.hourly(S.number(F.col(c)), F.col(per))) for c, out in ((minimum, "salary_min_hourly"), (maximum, "salary_max_hourly"))}
    return df.withColumns(made)


def lookup_occupation(df: DataFrame, occupations: DataFrame, code: str = "noc21_code", out: str = "noc_id", five_digit_only: bool = False) -> DataFrame:
    """df with the id of its occupation code, null for unknown codes; of ids that share a code, the last."""
    known = occupations.where(F.length("noc21_code") == 5) if five_digit_only else occupations
    side = known.groupBy(S.code_number(F.col("noc21_code")).alias("_code")).agg(F.max("id").alias(out)).where("_code is not null")
    return df.drop(out).withColumn("_code", S.code_number(F.col(code))).join(small_side(side), "_code", "left").drop("_code")


def prepare_postings(df: DataFrame) -> DataFrame:
    """The eight columns of job_postings. Rows with any null occupation column, title, province or city are dropped."""
    kept = df.dropna(how="any", subset=["noc21_code", "noc21_code_name", "noc_2016_code", "noc_2016_code_name"]).dropna(subset=["job_title"]).dropna(subset=["province_territory", "city"])
    return kept.select(
        "noc_id", F.col("job_title").alias("normalized_title"), "vacancy_count", F.col("province_territory").alias("province"), "city",
        S.posting_date(F.col("first_posting_date")).alias("first_posting_date"), *(F.col(c).cast("decimal(6,2)").alias(c) for c in ("salary_min_hourly", "salary_max_hourly")),
    )


def unit_groups(df: DataFrame, level: str = "level", code: str = "code", name: str = "name", wanted: int = 5) -> DataFrame:
    """Occupation titles of one level of a hierarchy, without null codes."""
    return df.where(F.col(level) == wanted).select(F.col(code).alias("noc21_code"), F.col(name).alias("noc21_name")).dropna(subset=["noc21_code"])


def long_enough(df: DataFrame, column: str = "description", least: int = 50) -> DataFrame:
    return df.where(F.length(column) >= least)


def split_matched(df: DataFrame, by: str = "noc_id") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(by).isNotNull()), df.where(F.col(by).isNull())


def complete(df: DataFrame, occupation: str, skills: str, tier: str) -> DataFrame:
    """Rows with an occupation, at least one skill and a real seniority."""
    return df.where(F.col(occupation).isNotNull() & (F.coalesce(F.size(skills), F.lit(0)) > 0) & S.real(F.col(tier)).isNotNull())
