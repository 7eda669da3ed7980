"""Data-quality gates and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.functions import scalars as S


class GateError(ValueError):
    """A gate isn't passed."""


def value_counts(df: DataFrame, column: str, dropna: bool = False) -> DataFrame:
    return (df.where(F.col(column).isNotNull()) if dropna else df).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def duplicated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    if not duplicated_keys(df, key).isEmpty():
        raise GateError(f"{key} isn't unique")
    return df


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key the parent doesn't have."""
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def assert_foreign_key(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    if not orphans(df, key, parent, parent_key).isEmpty():
        raise GateError(f"{key} has values that {parent_key} lacks")
    return df


def outside(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows whose non-null value is none of values."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def assert_domain(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    if not outside(df, column, values).isEmpty():
        raise GateError(f"{column} has values outside of {values}")
    return df


def assert_not_null(df: DataFrame, column: str) -> DataFrame:
    if not df.where(F.col(column).isNull()).isEmpty():
        raise GateError(f"{column} has nulls")
    return df


def at_least(df: DataFrame, n: int, what: str = "rows") -> DataFrame:
    found = df.limit(n).count()
    if found < n:
        raise GateError(f"{found} {what}, at least {n} are needed")
    return df


def _rate(part, whole):
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def match_stats(df: DataFrame, noc: str = "noc_id", score: str = "noc_match_score") -> DataFrame:
    """total, matched, unmatched, match_rate (0 if empty), mean_score (of the non-null ones, 0 if none)."""
    total, matched = F.count(F.lit(1)), F.count(noc)
    return df.agg(total.alias("total"), matched.alias("matched"), (total - matched).alias("unmatched"), _rate(matched, total).alias("match_rate"), F.coalesce(F.avg(F.col(score).cast("double")), F.lit(0.0)).alias("mean_score"))


def enrich_stats(df: DataFrame, noc: str = "noc_id", tier: str = "seniority", n_skills: str = "n_skills") -> DataFrame:
    """Occupations mapped and not, seniority valid, null and invalid, postings with and without skills, average skills."""
    n, skills = F.count(F.lit(1)), F.coalesce(n_skills, F.lit(0))
    valid = F.col(tier).isin(*S.TIERS)
    return df.agg(
        n.alias("total"), F.count(noc).alias("noc_mapped"), (n - F.count(noc)).alias("noc_unmapped"), _rate(F.count(noc), n).alias("noc_rate"),
        F.count_if(valid).alias("seniority_valid"), F.count_if(F.col(tier).isNull()).alias("seniority_null"), F.count_if(~valid).alias("seniority_invalid"),
        F.count_if(skills > 0).alias("with_skills"), F.count_if(skills == 0).alias("empty_skills"), F.coalesce(F.avg(skills), F.lit(0.0)).alias("avg_skills"),
    )


def quality_breakdown(df: DataFrame, noc: str = "noc_id", tier: str = "seniority", n_skills: str = "n_skills") -> DataFrame:
    """How many rows lack an occupation, a seniority or skills, and how many are left out for any of it."""
    no_noc, no_tier, no_skills = F.col(noc).isNull(), S.real(F.col(tier)).isNull(), F.coalesce(n_skills, F.lit(0)) == 0
    excluded = F.count_if(no_noc | no_tier | no_skills)
    n = F.count(F.lit(1))
    return df.agg(n.alias("total"), F.count_if(no_noc).alias("missing_noc"), F.count_if(no_tier).alias("missing_seniority"), F.count_if(no_skills).alias("missing_skills"), excluded.alias("excluded"), F.round(100 * _rate(excluded, n), 4).alias("excluded_pct"))


def reconciled(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """n_before, n_after, lost, gained: distinct keys on both sides of a migration."""
    sides = before.select(key, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(key, F.lit(0).alias("b"), F.lit(1).alias("a")))
    each = sides.groupBy(key).agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return each.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("n_before"), F.coalesce(F.sum("a"), F.lit(0)).alias("n_after"), F.count_if((F.col("b") == 1) & (F.col("a") == 0)).alias("lost"), F.count_if((F.col("b") == 0) & (F.col("a") == 1)).alias("gained"))
