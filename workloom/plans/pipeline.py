"""The two pipelines end to end: monthly pay files to postings, and raw postings to the star schema."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from workloom.functions import scalars as S
from workloom.operators import enrich, matching, packing, postings, quality, skills, warehouse
from workloom.runtime import cut, exists
from workloom.sources import files

#: Columns of raw postings that the skill pipeline uses.
RAW_COLUMNS = ["job_id", "company_name", "title", "description", "formatted_experience_level"]
#: Columns of raw monthly files under the names of the engine.
MONTHLY = {
    "Job Title": "job_title", "NOC21 Code": "noc21_code", "NOC21 Code Name": "noc21_code_name", "NOC 2016 Code": "noc_2016_code", "NOC 2016 Code Name": "noc_2016_code_name", "Vacancy Count": "vacancy_count",
    "First Posting Date": "first_posting_date", "Salary Minimum": "salary_minimum", "Salary Maximum": "salary_maximum", "Salary Per": "salary_per", "Province/Territory": "province_territory", "City": "city",
}


@dataclass(frozen=True)
class Config:
    """Parameters of the skill pipeline."""

    threshold: float = 0.75
    least_description: int = 50
    matched_batch: int = 10
    unmatched_batch: int = 5
    batches_per_session: int = 800
    #: 0: until all batches are done.
    max_sessions: int = 0
    partitions: int = 16
    #: Seconds between sessions.
    cooldown_s: float = 0

    def __post_init__(self) -> None:
        if not 0 <= self.threshold <= 1:
            raise ValueError("threshold must be from 0 to 1")
        for name in ("matched_batch", "unmatched_batch", "batches_per_session", "partitions"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")


def monthly_postings(raw: DataFrame, occupations: DataFrame) -> DataFrame:
    """job_postings of raw monthly rows, with the columns of the files: one stage besides the lookup."""
    named = raw.select(*(F.col(f"`{a}`").alias(b) for a, b in MONTHLY.items())).withColumn("vacancy_count", S.number(F.col("vacancy_count")).cast("int"))
    return postings.prepare_postings(postings.lookup_occupation(postings.normalise_pay(named), occupations))


def market_trend(spark: SparkSession, paths: dict[str, str], occupations: DataFrame, target: str) -> int:
    """Appends the postings of the monthly files (year_month: path) to target; returns their number."""
    seen = Observation("postings")
    monthly_postings(files.read_months(spark, paths), occupations).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(target)
    return seen.get["n"]


def extracted(raw: DataFrame, config: Config) -> DataFrame:
    """Step 1: required columns, no null titles and descriptions, descriptions long enough."""
    return postings.long_enough(postings.require_columns(raw, RAW_COLUMNS).dropna(subset=["title", "description"]), least=config.least_description)


def encoded(df: DataFrame, text: str, encoder: Callable[[list[str]], np.ndarray], out: str = "embedding") -> DataFrame:
    """df with the encoder's vectors of a text column, by Arrow batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors = np.asarray(encoder(frame[text].fillna("").tolist()), "f4") if len(frame) else np.zeros((0, 1), "f4")
            yield frame.assign(**{out: list(vectors)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != out)
    return df.drop(out).mapInPandas(run, f"{fields}, `{out}` array<float>")


def normalised(df: DataFrame, occupations: DataFrame, encoder: Callable[[list[str]], np.ndarray], config: Config) -> DataFrame:
    """Step 2: the nearest occupation of each title and the seniority by label and title."""
    references = encoded(occupations.where(F.length("noc21_code") == 5).select("id", "noc21_name"), "noc21_name", encoder)
    spread = encoded(df.repartition(config.partitions), "title", encoder)
    matched = matching.nearest_reference(spread, references, "job_id", "embedding", "id", "embedding", config.threshold)
    told = S.seniority(F.col("formatted_experience_level"), F.col("title"))
    return matched.select("job_id", "company_name", "title", "description", F.col("match_id").cast("int").alias("noc_id"), F.col("match_score").alias("noc_match_score"), F.when(F.col("match_id").isNotNull(), "sentence_transformer").alias("noc_match_method"), told["tier"].alias("seniority"))


def enriched(spark: SparkSession, df: DataFrame, occupations: DataFrame, completion: Callable[[str], str], store: str, config: Config) -> DataFrame:
    """Step 3: occupations, seniority and skills by the completion, in batches of similar postings.

    Results are appended to store session by session; a later run asks only for batches with open postings, so
    a run that broke off, or a batch without a usable answer, is taken up again. Of several results of a
    posting the first session's counts. A record of each batch goes to progress_store(store).
    """
    named = occupations.select("id", F.col("noc21_name").alias("name"))
    schema = "session_no int, job_id bigint, noc_id int, noc_match_method string, seniority string, skills array<struct<name:string,category:string>>"
    done_before = _stored(spark, store, schema)
    first_session = done_before.agg(F.coalesce(F.max("session_no") + 1, F.lit(0))).first()[0]
    keyed = cut(df.select(F.col("company_name").alias("company"), F.col("noc_id").alias("noc"), F.col("job_id").alias("ord"), F.col("job_id").alias("id")))
    done_ids = done_before.select(F.col("job_id").alias("id"))
    for matched, size in ((True, config.matched_batch), (False, config.unmatched_batch)):
        own = keyed.where(F.col("noc").isNotNull() if matched else F.col("noc").isNull())
        made = cut(packing.batches(packing.pack_matched(own, size) if matched else packing.pack_unmatched(own, size)))
        open_batches = packing.sessions(packing.undone(made, done_ids), config.batches_per_session)
        # the postings are laid out by session once, so that a session reads its own files only
        waiting = cut(open_batches.select("session_no", "batch_id", F.explode("ids").alias("job_id")).join(df, "job_id"), "session_no")
        n_sessions = waiting.agg(F.coalesce(F.max("session_no") + 1, F.lit(0))).first()[0]
        for session in range(n_sessions if not config.max_sessions else min(n_sessions, config.max_sessions)):
            rows = waiting.where(F.col("session_no") == session)
            asked = enrich.prompts(rows.withColumnRenamed("company_name", "company"), None if matched else named)
            answers = cut(enrich.complete(asked.repartition(config.partitions), completion))
            merged = cut(enrich.merge(rows.select("batch_id", "job_id", "noc_id", "noc_match_method", "seniority"), enrich.validated(answers), named, matched))
            merged.select(F.lit(first_session + session).alias("session_no"), *[c.split()[0] for c in schema.split(", ")[1:]]).write.mode("append").parquet(store)
            enrich.progress(merged, matched).select(F.lit(first_session + session).alias("session_no"), "*").write.mode("append").parquet(progress_store(store))
            if config.cooldown_s and session + 1 < n_sessions:
                time.sleep(config.cooldown_s)
        first_session += n_sessions
    results = warehouse.first_wins(_stored(spark, store, schema), "job_id", "session_no").drop("session_no")
    return df.drop("noc_id", "noc_match_method", "seniority").join(results, "job_id")


def progress_store(store: str) -> str:
    """Where the progress records of a store are: session_no, name, type, rows, matched, with_skills."""
    return store.rstrip("/") + "-progress"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def star_schema(df: DataFrame, occupations: DataFrame) -> dict[str, DataFrame]:
    """Step 4: the tables of the star schema of complete enriched postings, checked by the gates."""
    kept = cut(postings.complete(quality.assert_unique(df, "job_id"), "noc_id", "skills", "seniority"))
    rows = skills.explode_skills(kept, position=True).withColumn("ordinal", F.struct("job_id", "position"))
    clean = cut(skills.normalise_skills(rows))
    companies, tiers = warehouse.dim_of(kept, "company_name"), warehouse.dim_seniority(df.sparkSession)
    names = warehouse.numbered(clean.select(F.col("skill").alias("name"), "category").distinct(), "name")
    facts = cut(warehouse.fact_postings(kept, companies, tiers))
    demand = cut(warehouse.fact_skills(clean, names))
    quality.assert_foreign_key(demand, "job_id", facts, "job_id")
    quality.assert_foreign_key(facts, "noc_id", occupations, "id")
    quality.assert_domain(names, "category", S.CATEGORIES)
    return {"dim_companies": companies, "dim_skills": quality.assert_unique(names, "name"), "dim_seniority": tiers, "fact_job_postings": facts, "fact_job_skill_demand": demand, "skill_demand_summary": warehouse.demand_summary(demand, facts, names, occupations, tiers)}


def load(tables: dict[str, DataFrame], targets: list[str]) -> None:
    """Writes the tables to every target folder, anew; each table is computed once."""
    for name, df in tables.items():
        made = cut(df) if len(targets) > 1 else df
        for target in targets:
            made.write.mode("overwrite").parquet(f"{target}/{name}.parquet")


def skill_demand(spark: SparkSession, raw: DataFrame, occupations: DataFrame, encoder: Callable[[list[str]], np.ndarray], completion: Callable[[str], str], store: str, targets: list[str], config: Config = Config()) -> dict[str, DataFrame]:
    """The skill pipeline from raw postings to loaded tables."""
    matched = cut(normalised(extracted(raw, config), occupations, encoder, config))
    tables = star_schema(enriched(spark, matched, occupations, completion, store, config), occupations)
    load(tables, targets)
    return tables
