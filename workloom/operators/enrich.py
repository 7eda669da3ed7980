"""Enrichment by a completion function: prompts, the call, parsing and validation of its answers, merging.

Only the call itself runs in Python, by Arrow batches; the rest are built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.functions import scalars as S
from workloom.runtime import small_side

ANSWER = "results array<struct<job_id:bigint,noc_title:string,seniority:string,skills:string>>"
SKILLS = "array<struct<name:string,category:string>>"


def job_block(row: Column) -> Column:
    """The text about one posting: struct(job_id, title, description, seniority)."""
    known = F.when(row["seniority"].isNotNull(), F.concat(F.lit("Seniority is known: "), row["seniority"])).otherwise(F.lit("Give the seniority."))
    return F.concat_ws("\n", F.format_string("Job %s", row["job_id"].cast("string")), F.concat(F.lit("Title: "), row["title"]), known, F.concat(F.lit("Text: "), S.truncated(row["description"])))


def prompts(rows: DataFrame, occupations: DataFrame | None = None) -> DataFrame:
    """batch_id, prompt of rows (batch_id, job_id, title, description, company, seniority); occupations (name) to choose from."""
    each = F.struct("job_id", "title", "description", "seniority", "company")
    grouped = rows.groupBy("batch_id").agg(F.array_sort(F.collect_list(each)).alias("rows"))
    blocks = F.array_join(F.transform("rows", job_block), "\n\n")
    head = F.concat(F.lit("Extract the skills of these postings of "), F.coalesce(F.get("rows", F.lit(0))["company"], F.lit("unknown")), F.lit(". Answer in JSON."))
    if occupations is None:
        return grouped.select("batch_id", F.concat_ws("\n\n", head, blocks).alias("prompt"))
    names = occupations.agg(F.array_join(F.transform(F.array_sort(F.collect_list("name")), lambda x: F.concat(F.lit("- "), x)), "\n").alias("choice"))
    return grouped.crossJoin(F.broadcast(names)).select("batch_id", F.concat_ws("\n\n", head, F.lit("Occupations:"), F.col("choice"), blocks).alias("prompt"))


def complete(asked: DataFrame, completion: Callable[[str], str]) -> DataFrame:
    """batch_id, response: the completion of each prompt; an error of the function gives a null response, to be tried again."""

    def safe(prompt: str) -> str | None:
        try:
            return completion(prompt)
        except Exception:
            return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"batch_id": frame["batch_id"], "response": [safe(p) for p in frame["prompt"]]})

    return asked.select("batch_id", "prompt").mapInPandas(run, "batch_id string, response string")


def parse(response: Column) -> Column:
    """The results of a response: from its first { to its last }; null for blank text and broken JSON."""
    return F.from_json(F.regexp_extract(response, r"(?s)\{.*\}", 0), ANSWER, {"mode": "PERMISSIVE"})["results"]


def valid_skills(skills: Column) -> Column:
    """Skills with a name and one of the categories, names in lower case and trimmed; empty for anything else."""
    read = F.from_json(skills, SKILLS)
    clean = F.transform(read, lambda x: F.struct(F.lower(F.trim(x["name"])).alias("name"), x["category"].alias("category")))
    return F.coalesce(F.filter(clean, lambda x: x.isNotNull() & x["category"].isin(*S.CATEGORIES) & (x["name"] != "")), F.array().cast(SKILLS))


def validated(answers: DataFrame) -> DataFrame:
    """batch_id, job_id, position, noc_title, seniority, skills of answers (batch_id, response), one row per result with a job id; position is its place in the response."""
    each = answers.select("batch_id", F.posexplode(parse(F.col("response"))).alias("position", "r")).where("r.job_id is not null")
    tier = F.when(F.col("r.seniority").isin(*S.TIERS), F.col("r.seniority"))
    return each.select("batch_id", F.col("r.job_id").alias("job_id"), "position", F.when(F.col("r.noc_title") != "null", F.col("r.noc_title")).alias("noc_title"), tier.alias("seniority"), valid_skills(F.col("r.skills")).alias("skills"))


def merge(rows: DataFrame, results: DataFrame, occupations: DataFrame, matched: bool, respect_existing: bool = False) -> DataFrame:
    """rows (batch_id, job_id, noc_id, noc_match_method, seniority) with the results' occupation, seniority and skills.

    Batches without any result are left out, to be run again; a single row without one keeps what it has, with
    no skills. Of several results of a posting in its batch the last counts, as a whole (of several responses of
    a batch, the one with the greatest content at the last place). Matched rows keep their occupation. The
    result's seniority counts first, unless respect_existing. occupations: id, name; of ids that share a name,
    the last.
    """
    known = occupations.where("name is not null").groupBy(F.col("name").alias("noc_title")).agg(F.max("id").alias("new_noc"))
    last = F.max_by(F.struct("noc_title", "seniority", "skills"), F.struct("position", "noc_title", "seniority", F.to_json("skills"))).alias("r")
    found = results.groupBy("batch_id", "job_id").agg(last).select("batch_id", "job_id", "r.noc_title", F.col("r.seniority").alias("new_tier"), "r.skills").join(small_side(known), "noc_title", "left").drop("noc_title")
    answered = rows.join(results.select("batch_id").distinct(), "batch_id", "left_semi").join(found, ["batch_id", "job_id"], "left")
    tier = F.coalesce("seniority", "new_tier") if respect_existing else F.coalesce("new_tier", "seniority")
    noc = F.col("noc_id") if matched else F.coalesce("new_noc", "noc_id")
    method = F.col("noc_match_method") if matched else F.when(F.col("new_noc").isNotNull(), "llm_noc_match").otherwise(F.col("noc_match_method"))
    return answered.select("batch_id", "job_id", noc.alias("noc_id"), method.alias("noc_match_method"), tier.alias("seniority"), F.coalesce("skills", F.array().cast(SKILLS)).alias("skills"))


def progress(merged: DataFrame, matched: bool) -> DataFrame:
    """name, type, rows, matched, with_skills: a record of each merged batch, as sessions leave them behind."""
    kind = F.lit("matched" if matched else "unmatched").alias("type")
    return merged.groupBy(F.col("batch_id").alias("name")).agg(F.count(F.lit(1)).alias("rows"), F.count("noc_id").alias("matched"), F.count_if(F.size("skills") > 0).alias("with_skills")).select("name", kind, "rows", "matched", "with_skills")


def progress_sums(records: DataFrame) -> DataFrame:
    """type, batches, rows, matched, with_skills: the sums of progress records by type."""
    sums = (F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "matched", "with_skills"))
    return records.groupBy("type").agg(F.count(F.lit(1)).alias("batches"), *sums)
