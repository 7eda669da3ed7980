"""The star schema: dimensions with surrogate ids, facts with looked-up keys, and inserts that repeat safely."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from workloom.functions import scalars as S
from workloom.runtime import exists, ranked, small_side


def numbered(names: DataFrame, key: str, start: int = 0) -> DataFrame:
    """id and the columns of names, numbered from start + 1 in the order of key, without one window over all rows."""
    return ranked(names, key).select((F.col("rank") + start).cast("int").alias("id"), *names.columns)


def dim_seniority(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(S.TIERS, 1)), "id int, level string")


def dim_of(rows: DataFrame, column: str, name: str = "name") -> DataFrame:
    """id, name: the distinct real names of a column."""
    return numbered(rows.select(S.real(F.col(column)).alias(name)).where(F.col(name).isNotNull()).distinct(), name)


def fact_postings(rows: DataFrame, companies: DataFrame, tiers: DataFrame) -> DataFrame:
    """job_id, company_id, noc_id, seniority_id, raw_title, noc_match_score, noc_match_method, description; unknown names give null keys."""
    company = small_side(companies.select(F.col("id").alias("company_id"), F.col("name").alias("company_name")))
    tier = small_side(tiers.select(F.col("id").alias("seniority_id"), F.col("level").alias("seniority")))
    joined = rows.join(company, "company_name", "left").join(tier, "seniority", "left")
    return joined.select("job_id", "company_id", "noc_id", "seniority_id", F.col("title").alias("raw_title"), F.col("noc_match_score").cast("decimal(4,3)").alias("noc_match_score"), "noc_match_method", "description")


def fact_skills(rows: DataFrame, skills: DataFrame) -> DataFrame:
    """job_id, skill_id: distinct, without unknown skills."""
    known = small_side(skills.select(F.col("id").alias("skill_id"), F.col("name").alias("skill")))
    return rows.join(known, "skill").select("job_id", "skill_id").dropDuplicates(["job_id", "skill_id"])


def insert_absent(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """target and those of rows whose key it doesn't have, each key once."""
    return target.unionByName(rows.join(target.select(key), key, "left_anti").dropDuplicates([key]).select(*target.columns))


def seed_once(spark: SparkSession, rows: DataFrame, target: str) -> bool:
    """Writes rows to target unless it has rows already; whether it wrote."""
    if exists(spark, target) and not spark.read.parquet(target).isEmpty():
        return False
    rows.write.mode("overwrite").parquet(target)
    return True


def split_checkpoints(rows: DataFrame, key: str = "job_id", order: str = "file", method: str = "noc_match_method") -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) of old checkpoint rows: the last of each key counts, matched are those that the embeddings matched."""
    last = first_wins(rows.where(F.col(key).isNotNull()), key, F.desc(order))
    is_matched = F.col(method).eqNullSafe(F.lit("sentence_transformer"))
    return last.where(is_matched), last.where(~is_matched)


def first_wins(rows: DataFrame, key: str, *order) -> DataFrame:
    """One row per key: the first in the order."""
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def demand_summary(skill_demand: DataFrame, postings: DataFrame, skills: DataFrame, occupations: DataFrame, tiers: DataFrame) -> DataFrame:
    """Postings that ask for a skill, by occupation, seniority and skill; occupation and seniority may be null."""
    joined = (
        skill_demand.join(postings.select("job_id", "noc_id", "seniority_id"), "job_id")
        .join(small_side(skills.select(F.col("id").alias("skill_id"), F.col("name").alias("skill"), "category")), "skill_id")
        .join(small_side(occupations.select(F.col("id").alias("noc_id"), "noc21_code", "noc21_name")), "noc_id", "left")
        .join(small_side(tiers.select(F.col("id").alias("seniority_id"), F.col("level").alias("seniority"))), "seniority_id", "left")
    )
    return joined.groupBy("noc21_code", "noc21_name", "seniority", "skill", "category").agg(F.count(F.lit(1)).alias("demand_count"))
