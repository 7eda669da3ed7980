"""The pN_ queries of the llm problems, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloom.llm import encodings, mixture, names, pairs, subjects, termfreq, titles, tokens
from workloom.runtime import table

PAIR_MIN_COUNT = 5
PAIR_MIN_LIFT = 4


def _skill_pairs(spark: SparkSession, sf_dir: str, min_count: int = 1) -> DataFrame:
    return pairs.cooccurrence(table(spark, sf_dir, "fact_job_skill_demand"), "job_id", "skill_id", table(spark, sf_dir, "dim_skills"), "id", min_count=min_count)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills asked for together in at least five postings and at least four times as often as by chance."""
    strong = F.col("n_ab") * F.col("n_baskets") >= PAIR_MIN_LIFT * F.col("n_a") * F.col("n_b")
    return _skill_pairs(spark, sf_dir, PAIR_MIN_COUNT).where(strong).select(F.col("item_a").alias("skill_a"), F.col("item_b").alias("skill_b"))


def p1_pmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, lift and PMI of every pair of skills that any posting asks for together."""
    return _skill_pairs(spark, sf_dir).select(F.col("item_a").alias("skill_a"), F.col("item_b").alias("skill_b"), "n_ab", "n_a", "n_b", F.round("lift", 6).alias("lift"), F.round("pmi", 6).alias("pmi"))


def _garbled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired job titles and cities; the pools are the months of the files and the provinces."""
    titles = table(spark, sf_dir, "job_bank_csv").select(F.col("row_id").alias("record_id"), F.lit("job_bank_csv").alias("field"), F.col("year_month").alias("source"), F.col("job_title").alias("value"))
    cities = table(spark, sf_dir, "job_postings").select(F.col("id").cast("long").alias("record_id"), F.lit("job_postings").alias("field"), F.col("province").alias("source"), F.col("city").alias("value"))
    return encodings.repair(titles.unionByName(cities))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose job title or city was damaged by a wrong encoding."""
    return _garbled(spark, sf_dir).select(F.col("field").alias("table_name"), "record_id")


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged records with their restored text."""
    return _garbled(spark, sf_dir).select(F.col("field").alias("table_name"), "record_id", "original", "restored", "chain", F.round("probability", 4).alias("probability"), "status")


def _skill_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return termfreq.term_frequencies(table(spark, sf_dir, "fact_job_skill_demand"), "job_id", "skill_id", table(spark, sf_dir, "dim_skills"), "id", "name")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill terms too rare or too common to be useful."""
    return _skill_terms(spark, sf_dir).where("mark is not null").select("term", "mark")


def p6_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and postings of every skill term."""
    return _skill_terms(spark, sf_dir).select("term", "occurrences", "records", "mark")


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles.map_titles(table(spark, sf_dir, "fact_job_postings"), table(spark, sf_dir, "noc_titles"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry of noc_titles that each posting's title stands for."""
    return _titles(spark, sf_dir).where("status = 'matched'").select("job_id", F.col("entry_id").cast("int").alias("noc_id"))


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that stand for no single entry, with the number of their postings."""
    return _titles(spark, sf_dir).where("status <> 'matched'").groupBy("raw_title", "status").agg(F.count(F.lit(1)).alias("n_postings"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of companies that are one organisation."""
    linked = names.link_names(table(spark, sf_dir, "dim_companies"))
    return names.linked_pairs(linked, "id_a", "id_b").select(F.col("id_a").cast("int").alias("id_a"), F.col("id_b").cast("int").alias("id_b"))


def p7_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every company with its organisation and the number of its other spellings."""
    return names.link_names(table(spark, sf_dir, "dim_companies"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as ids of byte_bpe_50k."""
    return tokens.encode_corpus(table(spark, sf_dir, "documents"), keep=["doc_id"])


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", mixture.quality_weight("text").alias("weight"), "text")
    return mixture.mix(tokens.count_tokens(documents), table(spark, sf_dir, "mix_targets"), weight="weight")


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture, with the number of times each is used."""
    return _mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of the mixture's sources."""
    return _mixture(spark, sf_dir)[1]


def _subjects(spark: SparkSession, sf_dir: str, unassigned: bool = False) -> DataFrame:
    return subjects.assign_subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels"), unassigned=unassigned)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject areas of the invention of each document."""
    return _subjects(spark, sf_dir).select("doc_id", "subject")


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and share of the corpus by subject; a document with several subjects counts for each in part.

    The shares are of the documents with a subject. Those with known terms but no subject are the row without
    subject and share, if there are any.
    """
    each = _subjects(spark, sf_dir, unassigned=True)
    parts = each.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    assigned = F.col("subject").isNotNull()
    whole = each.join(parts, "doc_id").groupBy("subject").agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.when(assigned, 1 / F.col("n"))).alias("weight"))
    return whole.crossJoin(F.broadcast(whole.agg(F.sum("weight").alias("all_weight")))).select("subject", "n_documents", F.round(F.col("weight") / F.col("all_weight"), 6).alias("corpus_share"))


_PAIRS_SQL = """
WITH rows AS (SELECT DISTINCT job_id, skill_id FROM fact_job_skill_demand WHERE skill_id IN (SELECT id FROM dim_skills)),
single AS (SELECT skill_id, count(*) AS n FROM rows GROUP BY skill_id),
total AS (SELECT count(DISTINCT job_id) AS n FROM fact_job_skill_demand),
both_asked AS (
  SELECT x.skill_id AS skill_a, y.skill_id AS skill_b, count(*) AS n_ab
  FROM rows x JOIN rows y ON x.job_id = y.job_id AND x.skill_id < y.skill_id GROUP BY 1, 2),
counted AS (
  SELECT skill_a, skill_b, n_ab, a.n AS n_a, b.n AS n_b, total.n AS n_jobs
  FROM both_asked JOIN single a ON a.skill_id = skill_a JOIN single b ON b.skill_id = skill_b CROSS JOIN total)
"""

_TERMS_SQL = r"""
WITH terms AS (SELECT id, trim(regexp_replace(lower(name), '\s+', ' ', 'g')) AS term FROM dim_skills),
total AS (SELECT count(DISTINCT job_id) AS n FROM fact_job_skill_demand),
counted AS (
  SELECT term, count(f.job_id) AS occurrences, count(DISTINCT f.job_id) AS records
  FROM terms LEFT JOIN fact_job_skill_demand f ON f.skill_id = terms.id GROUP BY term),
marked AS (
  SELECT term, occurrences, records,
    CASE WHEN records < 5 THEN 'rare' WHEN records > 0.05 * total.n THEN 'common' END AS mark
  FROM counted CROSS JOIN total)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_pmi, p3_found, p3_repaired, p5_found, p5_unmatched, p6_found, p6_frequencies, p7_found, p7_entities, p8_ids, p9_mixture, p9_shares, p10_found, p10_composition)}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _PAIRS_SQL + "SELECT skill_a, skill_b FROM counted WHERE n_ab >= 5 AND n_ab * n_jobs >= 4 * n_a * n_b",
        "p1_pmi": _PAIRS_SQL + """SELECT skill_a, skill_b, n_ab, n_a, n_b,
          round(n_ab::DOUBLE * n_jobs / (n_a::DOUBLE * n_b), 6) AS lift,
          round(log2(n_ab::DOUBLE * n_jobs / (n_a::DOUBLE * n_b)), 6) AS pmi FROM counted""",
        "p6_found": _TERMS_SQL + "SELECT term, mark FROM marked WHERE mark IS NOT NULL",
        "p6_frequencies": _TERMS_SQL + "SELECT term, occurrences, records, mark FROM marked",
    }
