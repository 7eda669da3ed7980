"""Skills of postings: exploded, deduplicated, in the singular, with the category that most rows give."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.functions import scalars as S
from workloom.runtime import small_side


def explode_skills(df: DataFrame, job: str = "job_id", skills: str = "skills", position: bool = False) -> DataFrame:
    """job_id, skill, category: distinct, trimmed, both non-empty; position: with the first place of each in its lists too."""
    each = df.select(F.col(job).alias("job_id"), F.posexplode(skills).alias("position", "s"))
    clean = each.select("job_id", F.trim("s.name").alias("skill"), F.trim("s.category").alias("category"), "position").where("skill <> '' and category <> ''")
    key = ("job_id", "skill", "category")
    return clean.groupBy(*key).agg(F.min("position").alias("position")) if position else clean.select(*key).distinct()


def majority_category(rows: DataFrame, skill: str = "skill", category: str = "category", ordinal: str = "ordinal") -> DataFrame:
    """skill, category, votes, n_categories, total_votes: the category of most rows, the one seen first at ties; total_votes are those of all categories.

    ordinal: a number or a struct of numbers by which rows come; where even the first ones tie, the lesser category wins.
    """
    votes = rows.groupBy(F.col(skill).alias("skill"), F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("votes"), F.min(ordinal).alias("first"))
    best = F.min_by(F.struct("category", "votes"), F.struct(-F.col("votes"), F.col("first"), F.col("category")))
    found = votes.groupBy("skill").agg(best.alias("best"), F.count(F.lit(1)).alias("n_categories"), F.sum("votes").alias("total_votes"))
    return found.select("skill", F.col("best.category").alias("category"), F.col("best.votes").alias("votes"), "n_categories", "total_votes")


def singular_names(rows: DataFrame, skill: str = "skill") -> DataFrame:
    """rows with their skills in the singular; the rule runs on distinct names only."""
    names = rows.select(F.col(skill).alias("_name")).distinct().withColumn("_singular", S.singular(F.col("_name")))
    return rows.join(small_side(names), rows[skill] == F.col("_name"), "left").withColumn(skill, F.col("_singular")).drop("_name", "_singular")


def normalise_skills(rows: DataFrame) -> DataFrame:
    """job_id, skill, category of rows (job_id, skill, category, ordinal): singular names with their majority category."""
    single = singular_names(rows)
    return single.drop("category").join(majority_category(single).select("skill", "category"), "skill").dropDuplicates(["job_id", "skill"]).select("job_id", "skill", "category")
