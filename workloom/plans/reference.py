"""Queries of the engine's own operators over the tables, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workloom.functions import scalars as S
from workloom.operators import enrich, matching, packing, postings, quality, skills, warehouse
from workloom.plans import analytics
from workloom.runtime import shared_dir, small_side, table
from workloom.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_HOURS_SQL = "CASE salary_per WHEN 'Hour' THEN 1.0 WHEN 'Day' THEN 8.0 WHEN 'Week' THEN 40.0 WHEN 'Bi-weekly' THEN 80.0 WHEN 'Month' THEN 173.33 WHEN 'Year' THEN 2080.0 END::DOUBLE"
_LOW_SQL, _HIGH_SQL = (f"TRY_CAST(trim({c}) AS DOUBLE) / {_HOURS_SQL}" for c in ("salary_minimum", "salary_maximum"))


@query(f"SELECT row_id, round({_LOW_SQL}, 7) AS low, round({_HIGH_SQL}, 7) AS high FROM job_bank_csv")
def salary_hourly(spark, sf):
    """pay by unit to pay per hour."""
    return table(spark, sf, "job_bank_csv").select("row_id", *(F.round(S.hourly(S.number(F.col(c)), F.col("salary_per")), 7).alias(a) for c, a in (("salary_minimum", "low"), ("salary_maximum", "high"))))


@query(f"WITH h AS (SELECT row_id, {_LOW_SQL} AS low, {_HIGH_SQL} AS high FROM job_bank_csv) SELECT row_id, round(CASE WHEN low BETWEEN 10 AND 500 THEN low END, 7) AS low, round(CASE WHEN high BETWEEN 10 AND 500 THEN high END, 7) AS high FROM h")
def outlier_null(spark, sf):
    """hourly pay outside of the bounds is nulled."""
    paid = postings.normalise_pay(table(spark, sf, "job_bank_csv"))
    return paid.select("row_id", F.round("salary_min_hourly", 7).alias("low"), F.round("salary_max_hourly", 7).alias("high"))


_NOC_SQL = "(SELECT TRY_CAST(noc21_code AS INT) AS code, max(id) AS noc_id FROM noc_titles GROUP BY 1)"
_CODE_SQL = "CASE WHEN TRY_CAST(trim(noc21_code) AS DOUBLE) BETWEEN -2147483648 AND 2147483647 THEN trunc(TRY_CAST(trim(noc21_code) AS DOUBLE))::INT END"


@query(f"SELECT row_id, n.noc_id FROM (SELECT row_id, {_CODE_SQL} AS code FROM job_bank_csv) j LEFT JOIN {_NOC_SQL} n ON j.code = n.code")
def noc_lookup(spark, sf):
    """Occupation codes in any writing to ids."""
    return postings.lookup_occupation(table(spark, sf, "job_bank_csv"), table(spark, sf, "noc_titles")).select("row_id", "noc_id")


@query(f"SELECT p_partkey, n.noc_id FROM (SELECT p_partkey, p_size AS code FROM part) p LEFT JOIN (SELECT TRY_CAST(c AS INT) AS code, max(p_partkey) AS noc_id FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN lpad(p_size::VARCHAR, 5, '0') ELSE p_size::VARCHAR END AS c FROM part) WHERE length(c) = 5 GROUP BY 1) n ON n.code = p.code")
def noc_lookup_five_digits(spark, sf):
    """Of a list with codes of several lengths, those with five digits only."""
    part = table(spark, sf, "part")
    codes = part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 2 == 0, F.lpad(F.col("p_size").cast("string"), 5, "0")).otherwise(F.col("p_size").cast("string")).alias("noc21_code"))
    return postings.lookup_occupation(part.select("p_partkey", F.col("p_size").cast("string").alias("noc21_code")), codes, five_digit_only=True).select("p_partkey", "noc_id")


@query(f"""
WITH j AS (SELECT *, {_CODE_SQL} AS code, {_LOW_SQL} AS low, {_HIGH_SQL} AS high FROM job_bank_csv)
SELECT n.noc_id, job_title AS normalized_title, vacancy_count, province_territory AS province, city, strptime(first_posting_date, '%Y/%m/%d')::DATE AS first_posting_date,
  (CASE WHEN low BETWEEN 10 AND 500 THEN round(low, 6) END)::VARCHAR::DECIMAL(6,2)::DOUBLE AS salary_min_hourly, (CASE WHEN high BETWEEN 10 AND 500 THEN round(high, 6) END)::VARCHAR::DECIMAL(6,2)::DOUBLE AS salary_max_hourly
FROM j LEFT JOIN {_NOC_SQL} n ON j.code = n.code
WHERE noc21_code IS NOT NULL AND noc21_code_name IS NOT NULL AND noc_2016_code IS NOT NULL AND noc_2016_code_name IS NOT NULL AND job_title IS NOT NULL AND province_territory IS NOT NULL AND city IS NOT NULL""")
def posting_prepare(spark, sf):
    """Raw rows to the columns of job_postings."""
    paid = postings.normalise_pay(table(spark, sf, "job_bank_csv"))
    rounded = paid.withColumns({c: F.round(c, 6) for c in ("salary_min_hourly", "salary_max_hourly")})
    made = postings.prepare_postings(postings.lookup_occupation(rounded, table(spark, sf, "noc_titles")))
    return made.withColumns({c: F.col(c).cast("double") for c in ("salary_min_hourly", "salary_max_hourly")})


@query("SELECT p_brand AS noc21_code, p_name AS noc21_name FROM part WHERE p_size = 5 AND p_brand IS NOT NULL")
def hierarchy_filter(spark, sf):
    """Titles of one level of a hierarchy."""
    return postings.unit_groups(table(spark, sf, "part"), "p_size", "p_brand", "p_name")


@query("SELECT job_id, raw_title, description FROM fact_job_postings WHERE raw_title IS NOT NULL AND description IS NOT NULL AND length(description) >= 50")
def extract_min_length(spark, sf):
    """Required columns, null rule and least length."""
    return postings.long_enough(postings.require_columns(table(spark, sf, "fact_job_postings"), ["job_id", "raw_title", "description"]).dropna(subset=["raw_title", "description"]))


@query("SELECT *  FROM (SELECT row_id, salary_per FROM job_bank_csv) WHERE salary_per IS NOT NULL AND salary_per NOT IN ('', '#N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')")
def na_tokens(spark, sf):
    """Text that a scan reads as null."""
    return table(spark, sf, "job_bank_csv").select("row_id", S.scanned(F.col("salary_per")).alias("salary_per")).where("salary_per is not null")


_LABELS = ("Internship", "Entry level", "Associate", "Mid-Senior level", "Director", "Executive", "Other", "")
_LABEL_SQL = "CASE job_id % 9 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_LABELS)) + " END"
_LABEL_TIER_SQL = "CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.LABEL_TIERS.items()) + " END"
_KEYWORD_SQL = "CASE " + " ".join(f"WHEN regexp_matches(raw_title, '(?i)\\b(?:{'|'.join(words)})\\b') THEN '{tier}'" for tier, words in S.TIER_WORDS.items()) + " END"
_SENIOR_SQL = f"regexp_matches(raw_title, '(?i)\\b(?:{'|'.join(S.TIER_WORDS['senior'])})\\b')"


def _label():
    """An experience label for each posting, as the tables have none."""
    return F.get(F.array(*map(F.lit, _LABELS)), F.pmod("job_id", F.lit(9)).cast("int"))


@query(f"SELECT job_id, {_LABEL_TIER_SQL.format(x=_LABEL_SQL)} AS tier FROM fact_job_postings")
def label_tier(spark, sf):
    """F8: experience labels to tiers."""
    return table(spark, sf, "fact_job_postings").select("job_id", S.label_tier(_label()).alias("tier"))


@query(f"SELECT job_id, {_KEYWORD_SQL} AS tier FROM fact_job_postings")
def keyword_tier(spark, sf):
    """tiers by words of the title."""
    return table(spark, sf, "fact_job_postings").select("job_id", S.keyword_tier(F.col("raw_title")).alias("tier"))


@query(f"""
WITH x AS (SELECT job_id, raw_title, {_LABEL_TIER_SQL.format(x=_LABEL_SQL)} AS a, {_KEYWORD_SQL} AS b FROM fact_job_postings)
SELECT job_id, CASE WHEN a = 'mid_level' AND {_SENIOR_SQL} THEN 'senior' ELSE coalesce(a, b) END AS tier,
  CASE WHEN a = 'mid_level' AND {_SENIOR_SQL} THEN 'csv_refined' WHEN a IS NOT NULL THEN 'csv' WHEN b IS NOT NULL THEN 'title_keyword' END AS method FROM x""")
def seniority_combined(spark, sf):
    """label and title together."""
    return table(spark, sf, "fact_job_postings").select("job_id", S.seniority(_label(), F.col("raw_title")).alias("s")).select("job_id", "s.tier", "s.method")


_MONTH_NAMES = list(S.MONTHS)[:12]


@query("SELECT DISTINCT year_month FROM job_bank_raw")
def year_month_parse(spark, sf):
    """Months of addresses such as .../job-bank-en-january2023.csv."""
    months = table(spark, sf, "job_bank_raw").select("year_month").distinct()
    name = F.get(F.array(*map(F.lit, _MONTH_NAMES)), F.substring("year_month", 6, 2).cast("int") - 1)
    urls = months.select(F.concat(F.lit("https://data.example/x/job-bank-en-"), name, F.substring("year_month", 1, 4), F.lit(".csv")).alias("url"), F.lit(0).alias("ord"))
    return files.months_of(urls.where(S.is_english_address(F.col("url")))).select("year_month")


def _catalogue(spark, sf):
    """A JSON catalogue of each month: an English and a French address of every raw file, and its English address under the month's short name."""
    names = table(spark, sf, "job_bank_raw").select("file_name", "year_month").distinct()
    month = F.substring("year_month", 6, 2).cast("int") - 1
    long, year = F.get(F.array(*map(F.lit, _MONTH_NAMES)), month), F.substring("year_month", 1, 4)
    base = F.concat(F.lit("https://data.example/"), F.regexp_replace("file_name", r"[^A-Za-z0-9]+", "_"))
    urls = F.array(F.concat(base, F.lit("/x-en-"), long, year, F.lit(".csv")), F.concat(base, F.lit("/x-fr-"), long, year, F.lit(".csv")), F.concat(base, F.lit("/x-en-"), F.substring(long, 1, 3), F.lit("-"), year, F.lit(".csv")), F.concat(base, F.lit("/x-en-"), long, year, F.lit(".xlsx")))
    each = names.select("year_month", F.explode(urls).alias("url"))
    resources = F.array_sort(F.collect_list(F.struct("url", F.lit("CSV").alias("format"))))
    return each.groupBy("year_month").agg(F.to_json(F.struct(F.struct(resources.alias("resources")).alias("result"))).alias("value"))


_CATALOGUE_SQL = """WITH files AS (SELECT DISTINCT file_name, year_month, strftime((year_month || '-01')::DATE, '%B') AS m FROM job_bank_raw),
each AS (
  SELECT year_month, unnest(['/x-en-' || lower(m) || y || '.csv', '/x-fr-' || lower(m) || y || '.csv', '/x-en-' || lower(substr(m, 1, 3)) || '-' || y || '.csv', '/x-en-' || lower(m) || y || '.xlsx']) AS tail, base
  FROM (SELECT *, substr(year_month, 1, 4) AS y, 'https://data.example/' || regexp_replace(file_name, '[^A-Za-z0-9]+', '_', 'g') AS base FROM files)),
numbered AS (SELECT year_month, base || tail AS url, row_number() OVER (PARTITION BY year_month ORDER BY base || tail) - 1 AS ord FROM each),
english AS (SELECT year_month, ord, url FROM numbered WHERE url LIKE '%.csv' AND (url LIKE '%-en-%' OR url LIKE '%-en.%'))
"""


@query(_CATALOGUE_SQL + "SELECT ord::INT AS ord, url FROM english")
def catalogue_scan(spark, sf):
    """English CSV addresses of JSON catalogues, with their places."""
    return files.catalogue_urls(_catalogue(spark, sf))


@query(_CATALOGUE_SQL + "SELECT year_month, arg_max(url, ord) AS url FROM english GROUP BY 1")
def catalogue_months(spark, sf):
    """The last address of each month."""
    return files.months_of(files.catalogue_urls(_catalogue(spark, sf)))


@query("SELECT year_month FROM (SELECT DISTINCT year_month FROM job_bank_csv) WHERE year_month NOT IN (SELECT year_month FROM job_bank_raw)")
def download_plan(spark, sf):
    """Months that aren't there yet."""
    return files.download_plan(table(spark, sf, "job_bank_csv").select("year_month").distinct(), table(spark, sf, "job_bank_raw"))


@query("""SELECT count(*) AS total, count(noc_id) AS matched, count(*) - count(noc_id) AS unmatched, round(count(noc_id) / count(*), 6) AS match_rate,
  round(coalesce(avg(noc_match_score::DOUBLE), 0.0), 6) AS mean_score FROM fact_job_postings""")
def match_stats(spark, sf):
    """A1."""
    return quality.match_stats(table(spark, sf, "fact_job_postings")).withColumns({c: F.round(c, 6) for c in ("match_rate", "mean_score")})


_ENRICHED_SQL = """WITH s AS (SELECT job_id, count(*) AS n_skills FROM fact_job_skill_demand WHERE skill_id IS NOT NULL GROUP BY job_id),
e AS (SELECT p.*, d.level AS seniority, s.n_skills FROM fact_job_postings p LEFT JOIN dim_seniority d ON p.seniority_id = d.id LEFT JOIN s ON p.job_id = s.job_id)
"""


def _enriched(spark, sf):
    per_job = table(spark, sf, "fact_job_skill_demand").where("skill_id is not null").groupBy("job_id").agg(F.count(F.lit(1)).alias("n_skills"))
    tiers = table(spark, sf, "dim_seniority").select(F.col("id").alias("seniority_id"), F.col("level").alias("seniority"))
    return table(spark, sf, "fact_job_postings").join(small_side(tiers), "seniority_id", "left").join(per_job, "job_id", "left")


@query(_ENRICHED_SQL + """SELECT count(*) AS total, count(noc_id) AS noc_mapped, count(*) - count(noc_id) AS noc_unmapped, round(count(noc_id) / count(*), 6) AS noc_rate,
  count(seniority) AS seniority_valid, count(*) - count(seniority) AS seniority_null, 0::BIGINT AS seniority_invalid, count(*) FILTER (n_skills > 0) AS with_skills,
  count(*) FILTER (coalesce(n_skills, 0) = 0) AS empty_skills, round(avg(coalesce(n_skills, 0)), 6) AS avg_skills FROM e""")
def enrich_stats(spark, sf):
    """A2."""
    return quality.enrich_stats(_enriched(spark, sf)).withColumns({c: F.round(c, 6) for c in ("noc_rate", "avg_skills")})


@query("SELECT noc_match_method, count(*) AS n FROM fact_job_postings GROUP BY 1")
def value_counts_null(spark, sf):
    """A3: nulls keep their group."""
    return quality.value_counts(table(spark, sf, "fact_job_postings"), "noc_match_method")


@query("SELECT skill_id AS key, count(*) AS n FROM fact_job_skill_demand GROUP BY 1 HAVING count(*) > 1 AND skill_id IS NOT NULL")
def duplicate_keys(spark, sf):
    """Keys that occur more than once."""
    return quality.duplicated_keys(table(spark, sf, "fact_job_skill_demand").where("skill_id is not null"), "skill_id").withColumnRenamed("skill_id", "key")


@query("SELECT row_id, salary_per FROM job_bank_csv WHERE salary_per NOT IN ('Hour', 'Day', 'Week', 'Bi-weekly', 'Month', 'Year')")
def domain_violations(spark, sf):
    """Values outside of a domain."""
    return quality.outside(table(spark, sf, "job_bank_csv").select("row_id", "salary_per"), "salary_per", tuple(S.UNIT_HOURS))


@query("SELECT skill_id, job_id FROM fact_job_skill_demand WHERE skill_id IS NOT NULL AND skill_id NOT IN (SELECT id FROM dim_skills)")
def foreign_key_orphans(spark, sf):
    """Rows whose key the parent lacks."""
    return quality.orphans(table(spark, sf, "fact_job_skill_demand"), "skill_id", table(spark, sf, "dim_skills"), "id").select("skill_id", "job_id")


@query(_ENRICHED_SQL + """SELECT count(*) AS total, count(*) FILTER (noc_id IS NULL) AS missing_noc, count(*) FILTER (seniority IS NULL) AS missing_seniority,
  count(*) FILTER (n_skills IS NULL) AS missing_skills, count(*) FILTER (noc_id IS NULL OR seniority IS NULL OR n_skills IS NULL) AS excluded,
  round(100.0 * count(*) FILTER (noc_id IS NULL OR seniority IS NULL OR n_skills IS NULL) / count(*), 4) AS excluded_pct FROM e""")
def quality_breakdown(spark, sf):
    """A18, P10."""
    return quality.quality_breakdown(_enriched(spark, sf))


@query("""SELECT (SELECT count(DISTINCT job_id) FROM fact_job_postings) AS n_before, (SELECT count(DISTINCT job_id) FROM fact_job_skill_demand) AS n_after,
  (SELECT count(DISTINCT job_id) FROM fact_job_postings WHERE job_id NOT IN (SELECT job_id FROM fact_job_skill_demand)) AS lost,
  (SELECT count(DISTINCT job_id) FROM fact_job_skill_demand WHERE job_id NOT IN (SELECT job_id FROM fact_job_postings)) AS gained""")
def reconciliation(spark, sf):
    """Distinct ids on both sides."""
    return quality.reconciled(table(spark, sf, "fact_job_postings"), table(spark, sf, "fact_job_skill_demand"), "job_id")


@query("SELECT job_id, noc_id FROM fact_job_postings WHERE noc_id IS NOT NULL")
def split_matched(spark, sf):
    """P9."""
    return postings.split_matched(table(spark, sf, "fact_job_postings").select("job_id", "noc_id"))[0]


@query("SELECT job_id FROM fact_job_postings WHERE noc_id IS NULL")
def split_unmatched(spark, sf):
    """P9."""
    return postings.split_matched(table(spark, sf, "fact_job_postings"))[1].select("job_id")


@query("""
WITH firsts AS (SELECT label, min(vec_id) AS rid FROM embeddings GROUP BY label),
refs AS (SELECT rid, embedding AS v FROM firsts JOIN embeddings ON vec_id = rid),
scored AS (
  SELECT vec_id, rid, list_sum(list_transform(list_zip(embedding, v), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))
    / ((sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-10) * (sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-10)) AS score
  FROM embeddings CROSS JOIN refs),
best AS (SELECT vec_id, rid, score FROM scored QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, rid) = 1)
SELECT vec_id, CASE WHEN score >= 0.65 THEN rid END AS match_id, round(score, 4) AS match_score FROM best""")
def nearest_reference(spark, sf):
    """The first vector of each label is a reference."""
    vectors = table(spark, sf, "embeddings")
    firsts = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("rvec"), F.min("vec_id").alias("rid"))
    return matching.nearest_reference(vectors, firsts, "vec_id", "embedding", "rid", "rvec", 0.65).select("vec_id", "match_id", "match_score")


@query("""
WITH refs AS (SELECT vec_id AS rid, embedding AS v FROM embeddings WHERE label < 5),
scored AS (
  SELECT vec_id, label, rid, list_sum(list_transform(list_zip(embedding, v), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))
    / ((sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-10) * (sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-10)) AS score
  FROM embeddings CROSS JOIN refs),
best AS (SELECT vec_id, label, rid, score FROM scored QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 12) DESC, rid) = 1)
SELECT vec_id, label, CASE WHEN score >= 0.5 THEN rid END AS match_id, round(CASE WHEN score >= 0.5 THEN score END, 4) AS match_score FROM best""")
def nearest_reference_blocks(spark, sf):
    """Rows with repeated ids against a list of several blocks, scores kept only for matches."""
    vectors = table(spark, sf, "embeddings")
    return matching.nearest_reference(vectors, vectors.where("label < 5"), "label", "embedding", "vec_id", "embedding", 0.5, keep_scores=False, block_rows=64).select("vec_id", "label", "match_id", "match_score")


def _to_pack(spark, sf, matched: bool):
    rows = table(spark, sf, "fact_job_postings").where(F.col("noc_id").isNotNull() if matched else F.col("noc_id").isNull())
    named = table(spark, sf, "dim_companies").select(F.col("id").alias("company_id"), F.col("name").alias("company"))
    return rows.select("job_id", "company_id", "noc_id").join(small_side(named), "company_id", "left").select("company", F.col("noc_id").alias("noc"), F.col("job_id").alias("ord"), F.col("job_id").alias("id"))


def _stage_sql(name: str, source: str, group: str, order: str, size: int) -> str:
    return f"""{name}_n AS (SELECT company, noc, id, (row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1) // {size} AS chunk, count(*) OVER (PARTITION BY {group}) AS n FROM {source}),
{name}_full AS (SELECT company, noc, id, chunk FROM {name}_n WHERE (chunk + 1) * {size} <= n),
{name}_left AS (SELECT company, noc, id FROM {name}_n WHERE (chunk + 1) * {size} > n)"""


_MATCHED_SQL = f"""WITH base AS (SELECT coalesce(c.name, '') AS company, noc_id AS noc, job_id AS id FROM fact_job_postings LEFT JOIN dim_companies c ON c.id = company_id WHERE noc_id IS NOT NULL),
{_stage_sql("a", "base", "company, noc", "id", 10)}, {_stage_sql("b", "a_left", "noc", "company, id", 10)},
packed AS (
  SELECT 'co_noc' AS kind, company, noc, id, chunk FROM a_full UNION ALL SELECT 'noc', company, noc, id, chunk FROM b_full
  UNION ALL SELECT 'rem', company, noc, id, (row_number() OVER (ORDER BY noc, company, id) - 1) // 10 FROM b_left)
"""
_UNMATCHED_SQL = f"""WITH base AS (SELECT coalesce(c.name, '') AS company, 0 AS noc, job_id AS id FROM fact_job_postings LEFT JOIN dim_companies c ON c.id = company_id WHERE noc_id IS NULL),
{_stage_sql("a", "base", "company", "id", 5)},
packed AS (
  SELECT 'co' AS kind, company, noc, id, chunk FROM a_full
  UNION ALL SELECT 'rem', company, noc, id, (row_number() OVER (ORDER BY company, id) - 1) // 5 FROM a_left)
"""
_BATCHES_SQL = r""", batches AS (
  SELECT kind, CASE WHEN kind IN ('co_noc', 'co') THEN company ELSE '' END AS c, CASE WHEN kind IN ('co_noc', 'noc') THEN noc ELSE 0 END AS k, count(*) AS n_rows, substr(md5(string_agg(id::VARCHAR, ',' ORDER BY id)), 1, 12) AS h
  FROM packed GROUP BY kind, c, k, chunk),
named AS (
  SELECT kind, n_rows, CASE kind WHEN 'co_noc' THEN 'co_noc_' || CASE c WHEN '' THEN 'unknown' ELSE safe END WHEN 'noc' THEN 'noc_' || k WHEN 'co' THEN 'co_' || CASE c WHEN '' THEN 'unknown' ELSE safe END ELSE 'rem' END || '_' || h AS batch_id
  FROM (SELECT *, substr(regexp_replace(c, '[^\p{L}\p{M}\p{N}_\-]', '_', 'g'), 1, 50) AS safe FROM batches))
"""


@query(_MATCHED_SQL + "SELECT kind, company, noc, id, chunk::INT AS chunk FROM packed")
def pack_matched(spark, sf):
    """B1, W3, W4."""
    return packing.pack_matched(_to_pack(spark, sf, True)).select("kind", "company", "noc", "id", "chunk")


@query(_UNMATCHED_SQL + "SELECT kind, company, id, chunk::INT AS chunk FROM packed")
def pack_unmatched(spark, sf):
    """B2."""
    return packing.pack_unmatched(_to_pack(spark, sf, False)).select("kind", "company", "id", "chunk")


@query(_MATCHED_SQL + _BATCHES_SQL + "SELECT batch_id, kind, n_rows::INT AS n_rows FROM named")
def batch_ids(spark, sf):
    """Ids from the content of the batches."""
    return packing.batches(packing.pack_matched(_to_pack(spark, sf, True))).drop("ids")


@query(_UNMATCHED_SQL + _BATCHES_SQL + "SELECT kind, count(*) AS n_batches, sum(n_rows)::BIGINT AS n_rows FROM named GROUP BY kind")
def batch_plan(spark, sf):
    """A15."""
    return packing.batch_plan(packing.batches(packing.pack_unmatched(_to_pack(spark, sf, False))))


@query(_MATCHED_SQL + _BATCHES_SQL + "SELECT count(*) AS n_calls, ceil(count(*) / 800)::BIGINT AS sessions, round(count(*) * 11 / 3600 + (ceil(count(*) / 800) - 1) * 90 / 60, 6) AS hours FROM named")
def capacity_estimate(spark, sf):
    """A16."""
    plan = packing.batch_plan(packing.batches(packing.pack_matched(_to_pack(spark, sf, True)))).agg(F.sum("n_batches").alias("n_calls"))
    return plan.select("n_calls", packing.capacity(F.col("n_calls")).alias("c")).select("n_calls", "c.sessions", F.round("c.hours", 6).alias("hours"))


@query(_MATCHED_SQL + _BATCHES_SQL + "SELECT batch_id, ((row_number() OVER (ORDER BY batch_id) - 1) // 50)::INT AS session_no FROM named")
def session_plan(spark, sf):
    """W7, U7."""
    return packing.sessions(packing.batches(packing.pack_matched(_to_pack(spark, sf, True))), 50).select("batch_id", "session_no")


@query(r"""WITH rows AS (SELECT p.job_id, p.job_id // 10 AS batch, p.raw_title, p.description, d.level, c.name AS company FROM fact_job_postings p LEFT JOIN dim_seniority d ON d.id = p.seniority_id LEFT JOIN dim_companies c ON c.id = p.company_id),
blocks AS (SELECT batch, string_agg('Job ' || job_id || chr(10) || 'Title: ' || raw_title || chr(10) || coalesce('Seniority is known: ' || level, 'Give the seniority.') || chr(10) || 'Text: ' || substr(coalesce(description, ''), 1, 1500), chr(10) || chr(10) ORDER BY job_id) AS body, arg_min(coalesce(company, 'unknown'), job_id) AS company FROM rows GROUP BY batch),
choice AS (SELECT string_agg('- ' || level, chr(10) ORDER BY level) AS names FROM dim_seniority)
SELECT batch::VARCHAR AS batch_id, md5('Extract the skills of these postings of ' || company || '. Answer in JSON.' || chr(10) || chr(10) || 'Occupations:' || chr(10) || chr(10) || names || chr(10) || chr(10) || body) AS prompt_md5 FROM blocks CROSS JOIN choice""")
def prompt_texts(spark, sf):
    """The prompts of batches of ten, with a list to choose from."""
    tiers = table(spark, sf, "dim_seniority").select(F.col("id").alias("seniority_id"), F.col("level").alias("seniority"))
    companies = table(spark, sf, "dim_companies").select(F.col("id").alias("company_id"), F.col("name").alias("company"))
    rows = table(spark, sf, "fact_job_postings").join(small_side(tiers), "seniority_id", "left").join(small_side(companies), "company_id", "left")
    rows = rows.select(F.floor(F.col("job_id") / 10).cast("string").alias("batch_id"), "job_id", F.col("raw_title").alias("title"), "description", "seniority", "company")
    return enrich.prompts(rows, tiers.select(F.col("seniority").alias("name"))).select("batch_id", F.md5("prompt").alias("prompt_md5"))


@query("SELECT event_id, TRY_CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_parse(spark, sf):
    """Fields of JSON text, null for broken text."""
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint", {"mode": "PERMISSIVE"})["k"].alias("k"))


@query("SELECT event_id AS job_id, event_type AS noc_title, CASE event_id % 5 WHEN 1 THEN 'senior' ELSE NULL END AS seniority FROM events WHERE event_id % 5 IN (1, 2)")
def response_parse(spark, sf):
    """fenced and bare responses are read from their first to their last brace; broken, blank and other ones give nothing."""
    body = F.concat(F.lit('{"results": [{"job_id": '), F.col("event_id").cast("string"), F.lit(', "noc_title": "'), F.col("event_type"), F.lit('"'), F.when(F.col("event_id") % 5 == 1, ', "seniority": "senior"').otherwise(""), F.lit("}]}"))
    forms = {0: F.lit("  "), 1: F.concat(F.lit("```json\n"), body, F.lit("\n```\nDone.")), 2: F.concat(F.lit("Sure: "), body), 3: F.substring(body, 1, 25), 4: F.concat(F.lit('{"results": "'), F.col("event_type"), F.lit('"}'))}
    response = F.coalesce(*(F.when(F.col("event_id") % 5 == k, x) for k, x in forms.items()))
    each = table(spark, sf, "events").select(F.explode(enrich.parse(response)).alias("r"))
    return each.select("r.job_id", "r.noc_title", "r.seniority")


_ANSWER_SQL = """WITH d AS (SELECT DISTINCT job_id, skill_id FROM fact_job_skill_demand WHERE skill_id IS NOT NULL),
skills AS (SELECT job_id, lower(trim(name)) AS name, category FROM d JOIN dim_skills s ON s.id = d.skill_id WHERE trim(name) <> ''),
agg AS (SELECT job_id, count(*) AS n_skills FROM skills GROUP BY job_id)
"""


def _answers(spark, sf):
    """A response for each posting that asks for skills, as a completion would give it."""
    named = small_side(table(spark, sf, "dim_skills").select(F.col("id").alias("skill_id"), "name", "category"))
    wanted = table(spark, sf, "fact_job_skill_demand").where("skill_id is not null").distinct().join(named, "skill_id")
    results = wanted.groupBy("job_id").agg(F.collect_list(F.struct("name", "category")).alias("skills"))
    tier = F.get(F.array(*map(F.lit, (*S.TIERS, "wizard"))), F.pmod("job_id", F.lit(6)).cast("int"))
    body = F.to_json(F.struct(F.array(F.struct("job_id", F.lit("null").alias("noc_title"), tier.alias("seniority"), "skills")).alias("results")))
    return results.select(F.col("job_id").cast("string").alias("batch_id"), F.concat(F.lit("```json\n"), body, F.lit("\n```")).alias("response"))


@query(_ANSWER_SQL + "SELECT job_id, CASE job_id % 6 WHEN 0 THEN 'intern' WHEN 1 THEN 'entry_level' WHEN 2 THEN 'mid_level' WHEN 3 THEN 'senior' WHEN 4 THEN 'executive' END AS seniority, n_skills::INT AS n_skills FROM agg")
def response_validation(spark, sf):
    """fenced responses parsed and validated."""
    return enrich.validated(_answers(spark, sf)).select("job_id", "seniority", F.size("skills").alias("n_skills"))


_TIER_SQL = "CASE p.job_id % 6 WHEN 0 THEN 'intern' WHEN 1 THEN 'entry_level' WHEN 2 THEN 'mid_level' WHEN 3 THEN 'senior' WHEN 4 THEN 'executive' END"
_MERGE_SQL = _ANSWER_SQL + f"""SELECT p.job_id, {{noc}}, coalesce({_TIER_SQL}, d.level) AS seniority, n_skills::INT AS n_skills
FROM fact_job_postings p JOIN agg USING (job_id) LEFT JOIN dim_seniority d ON d.id = p.seniority_id
LEFT JOIN (SELECT asked.id AS asked_id, max(other.id) AS new_noc FROM noc_titles asked JOIN noc_titles other ON other.noc21_name = asked.noc21_name GROUP BY 1) n ON n.asked_id = p.job_id % 700 WHERE {{which}}"""


def _merged(spark, sf, matched: bool):
    """Postings merged with responses of two results each: the last one counts, with a title of the list, or an unknown one."""
    named = small_side(table(spark, sf, "dim_skills").select(F.col("id").alias("skill_id"), "name", "category"))
    titles = table(spark, sf, "noc_titles").select(F.col("id").alias("at"), "noc21_name")
    wanted = table(spark, sf, "fact_job_skill_demand").where("skill_id is not null").distinct().join(named, "skill_id").groupBy("job_id").agg(F.collect_list(F.struct("name", "category")).alias("skills"))
    asked = wanted.withColumn("at", F.pmod("job_id", F.lit(700)).cast("int")).join(small_side(titles), "at", "left")
    tier = F.get(F.array(*map(F.lit, (*S.TIERS, "wizard"))), F.pmod("job_id", F.lit(6)).cast("int"))
    result = lambda title, level, skills: F.struct("job_id", title.alias("noc_title"), level.alias("seniority"), skills.alias("skills"))
    both = F.array(result(F.lit("null"), F.lit("executive"), F.slice("skills", 1, 1)), result(F.coalesce("noc21_name", F.lit("no such work")), tier, F.col("skills")))
    answers = asked.select(F.col("job_id").cast("string").alias("batch_id"), F.to_json(F.struct(both.alias("results"))).alias("response"))
    tiers = table(spark, sf, "dim_seniority").select(F.col("id").alias("seniority_id"), F.col("level").alias("seniority"))
    rows = table(spark, sf, "fact_job_postings").where(F.col("noc_id").isNotNull() if matched else F.col("noc_id").isNull()).join(small_side(tiers), "seniority_id", "left")
    occupations = table(spark, sf, "noc_titles").select("id", F.col("noc21_name").alias("name"))
    return enrich.merge(rows.select(F.col("job_id").cast("string").alias("batch_id"), "job_id", "noc_id", "noc_match_method", "seniority"), enrich.validated(answers), occupations, matched)


@query(_MERGE_SQL.format(noc="n.new_noc AS noc_id, CASE WHEN n.new_noc IS NOT NULL THEN 'llm_noc_match' ELSE p.noc_match_method END AS noc_match_method", which="p.noc_id IS NULL"))
def merge_enriched(spark, sf):
    """The last result of each posting merged into those without an occupation; batches without a result are left out."""
    return _merged(spark, sf, False).select("job_id", "noc_id", "noc_match_method", "seniority", F.size("skills").alias("n_skills"))


@query(_MERGE_SQL.format(noc="p.noc_id, p.noc_match_method", which="p.noc_id IS NOT NULL"))
def merge_matched(spark, sf):
    """the same for postings with an occupation, which they keep."""
    return _merged(spark, sf, True).select("job_id", "noc_id", "noc_match_method", "seniority", F.size("skills").alias("n_skills"))


def _skill_rows(spark, sf):
    named = small_side(table(spark, sf, "dim_skills").select(F.col("id").alias("skill_id"), "name", "category"))
    return table(spark, sf, "fact_job_skill_demand").join(named, "skill_id")


@query("SELECT DISTINCT job_id, trim(name) AS skill, category FROM fact_job_skill_demand d JOIN dim_skills s ON s.id = d.skill_id WHERE trim(name) <> ''")
def explode_dedup(spark, sf):
    """Lists of skills to distinct rows."""
    lists = _skill_rows(spark, sf).groupBy("job_id").agg(F.collect_list(F.struct("name", "category")).alias("skills"))
    return skills.explode_skills(lists)


_VOTES_SQL = r"""WITH v AS (SELECT trim(regexp_replace(lower(name), '\s+', ' ', 'g')) AS skill, category, count(*) AS votes, min(job_id * 100000 + skill_id) AS first FROM fact_job_skill_demand d JOIN dim_skills s ON s.id = d.skill_id GROUP BY 1, 2),
b AS (SELECT skill, category, votes, count(*) OVER (PARTITION BY skill) AS n_categories, sum(votes) OVER (PARTITION BY skill)::BIGINT AS total_votes FROM v QUALIFY row_number() OVER (PARTITION BY skill ORDER BY votes DESC, first) = 1)
"""


def _votes(spark, sf):
    rows = _skill_rows(spark, sf).select(F.trim(F.regexp_replace(F.lower("name"), r"\s+", " ")).alias("skill"), "category", (F.col("job_id") * 100000 + F.col("skill_id")).alias("ordinal"))
    return skills.majority_category(rows)


@query(_VOTES_SQL + "SELECT skill, category, votes, n_categories FROM b")
def majority_vote(spark, sf):
    """A4: the category of most rows, first seen at ties."""
    return _votes(spark, sf).drop("total_votes")


@query(_VOTES_SQL + "SELECT skill, category, votes, n_categories FROM b WHERE n_categories > 1 ORDER BY total_votes DESC, skill LIMIT 5")
def multi_category(spark, sf):
    """A5: the five skills of several categories with most votes, those of all their categories."""
    return _votes(spark, sf).where("n_categories > 1").orderBy(F.desc("total_votes"), "skill").limit(5).drop("total_votes")


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def checkpoint_first_wins(spark, sf):
    """S27, W2."""
    return warehouse.first_wins(table(spark, sf, "events"), "user_id", "event_id").select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def checkpoint_last_wins(spark, sf):
    """W6."""
    return warehouse.first_wins(table(spark, sf, "events"), "user_id", F.desc("event_id")).select("event_id", "user_id", "event_type")


@query("SELECT job_id, CASE WHEN noc_id IS NOT NULL AND job_id % 3 <> 0 THEN 'matched' ELSE 'unmatched' END AS kind FROM fact_job_postings")
def reclassify_checkpoints(spark, sf):
    """Old checkpoints split by the method of each posting's last row; every third posting lost its method in a later file."""
    rows = table(spark, sf, "fact_job_postings").select("job_id", F.when(F.col("noc_id").isNotNull(), "sentence_transformer").alias("noc_match_method"), F.lit("a.json").alias("file"))
    later = rows.where("job_id % 3 = 0").select("job_id", F.lit(None).cast("string").alias("noc_match_method"), F.lit("b.json").alias("file"))
    matched, unmatched = warehouse.split_checkpoints(rows.unionByName(later))
    return matched.select("job_id", F.lit("matched").alias("kind")).unionByName(unmatched.select("job_id", F.lit("unmatched").alias("kind")))


@query("SELECT job_id, noc_id FROM fact_job_postings")
def checkpoint_files(spark, sf):
    """JSON checkpoints in files, a corrupt one among them, read back; of a posting's rows the first in the order of the files counts."""
    path = f"{shared_dir(spark)}/checkpoints-{uuid.uuid4().hex}"
    rows = table(spark, sf, "fact_job_postings").select("job_id", "noc_id")
    rows.write.json(f"{path}/a")
    rows.where("noc_id is null").select("job_id", F.lit(-1).alias("noc_id")).write.json(f"{path}/b")
    spark.range(1).select(F.lit('{"job_id": 1, "noc_id":').alias("value")).write.text(f"{path}/c")
    read, _ = files.read_checkpoints(spark, f"{path}/*", T.StructType([T.StructField("job_id", T.LongType()), T.StructField("noc_id", T.IntegerType())]))
    return warehouse.first_wins(read, "job_id", "file").select("job_id", "noc_id")


@query("SELECT DISTINCT job_id FROM fact_job_postings WHERE job_id NOT IN (SELECT job_id FROM fact_job_skill_demand)")
def resume_antijoin(spark, sf):
    """Ids that aren't done."""
    return table(spark, sf, "fact_job_postings").select("job_id").distinct().join(table(spark, sf, "fact_job_skill_demand"), "job_id", "left_anti")


@query("SELECT DISTINCT job_id FROM fact_job_postings WHERE job_id IN (SELECT job_id FROM fact_job_skill_demand)")
def new_rows_semi(spark, sf):
    """J10."""
    return table(spark, sf, "fact_job_postings").select("job_id").distinct().join(table(spark, sf, "fact_job_skill_demand"), "job_id", "left_semi")


@query(_MATCHED_SQL + """, hashed AS (SELECT kind, CASE WHEN kind = 'co_noc' THEN company ELSE '' END AS c, CASE WHEN kind IN ('co_noc', 'noc') THEN noc ELSE 0 END AS k, chunk, count(*) AS n_rows, bool_and(id IN (SELECT job_id FROM fact_job_skill_demand GROUP BY job_id HAVING count(*) >= 8)) AS done FROM packed GROUP BY ALL)
SELECT kind, count(*) AS n_batches FROM hashed WHERE NOT done GROUP BY kind""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4"))
def undone_batches(spark, sf):
    """Batches with any open id are run again whole; a posting is done here when it has eight rows of skills."""
    made = packing.batches(packing.pack_matched(_to_pack(spark, sf, True)))
    done = table(spark, sf, "fact_job_skill_demand").groupBy(F.col("job_id").alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n >= 8")
    return packing.undone(made, done).groupBy("kind").agg(F.count(F.lit(1)).alias("n_batches"))


@query("SELECT id, level FROM dim_seniority")
def dim_seniority(spark, sf):
    """S20."""
    return warehouse.dim_seniority(spark)


@query("SELECT (row_number() OVER (ORDER BY city))::INT AS id, city AS name FROM (SELECT DISTINCT city FROM job_postings WHERE city IS NOT NULL AND city NOT IN ('NaN', 'nan', 'None', ''))")
def dim_build(spark, sf):
    """Distinct real names, numbered in their order."""
    return warehouse.dim_of(table(spark, sf, "job_postings"), "city")


@query("SELECT p.job_id, p.company_id, p.noc_id, p.seniority_id, p.raw_title, p.noc_match_score::DOUBLE AS noc_match_score FROM fact_job_postings p LEFT JOIN dim_companies c ON c.id = p.company_id")
def fact_postings_build(spark, sf):
    """Keys looked up by name."""
    companies, tiers = table(spark, sf, "dim_companies"), table(spark, sf, "dim_seniority")
    rows = table(spark, sf, "fact_job_postings").join(small_side(companies.select(F.col("id").alias("company_id"), F.col("name").alias("company_name"))), "company_id", "left").join(small_side(tiers.select(F.col("id").alias("seniority_id"), F.col("level").alias("seniority"))), "seniority_id", "left")
    made = warehouse.fact_postings(rows.withColumnRenamed("raw_title", "title").drop("company_id", "seniority_id"), companies, tiers)
    return made.select("job_id", "company_id", "noc_id", "seniority_id", "raw_title", F.col("noc_match_score").cast("double").alias("noc_match_score"))


@query("SELECT DISTINCT job_id, skill_id FROM fact_job_skill_demand WHERE skill_id IN (SELECT id FROM dim_skills)")
def fact_skills_build(spark, sf):
    """S24, J4."""
    return warehouse.fact_skills(_skill_rows(spark, sf).select("job_id", F.col("name").alias("skill")), table(spark, sf, "dim_skills"))


@query("""WITH new AS (SELECT DISTINCT noc21_code FROM job_bank_csv WHERE regexp_full_match(noc21_code, '[0-9]{5}') AND noc21_code NOT IN (SELECT noc21_code FROM noc_titles))
SELECT noc21_code FROM noc_titles UNION ALL SELECT noc21_code FROM new""")
def insert_if_absent(spark, sf):
    """Codes are inserted once."""
    rows = table(spark, sf, "job_bank_csv").where(F.col("noc21_code").rlike("^[0-9]{5}$")).select("noc21_code")
    return warehouse.insert_absent(table(spark, sf, "noc_titles").select("noc21_code"), rows, "noc21_code")


@query(_ANSWER_SQL + """SELECT CASE WHEN noc_id IS NULL THEN 'unmatched' ELSE 'matched' END AS type, count(*) AS batches, count(*) AS rows,
  count(CASE WHEN noc_id IS NOT NULL OR job_id % 700 IN (SELECT id FROM noc_titles) THEN 1 END) AS matched, count(*) FILTER (n_skills > 0) AS with_skills
FROM fact_job_postings JOIN agg USING (job_id) GROUP BY 1""")
def progress_sums(spark, sf):
    """Sums of the progress records of merged batches by type."""
    records = enrich.progress(_merged(spark, sf, True), True).unionByName(enrich.progress(_merged(spark, sf, False), False))
    return enrich.progress_sums(records)


@query()
def random_sample(spark, sf):
    """L4: ten rows at random."""
    return table(spark, sf, "fact_job_postings").select("job_id", "raw_title").orderBy(F.rand(7)).limit(10)


@query("SELECT n_regionkey, 'postgresql://' || lower(n_name) || ':***@db.example/x' AS masked FROM nation WHERE n_name IS NOT NULL")
def mask_secrets(spark, sf):
    """F25."""
    url = F.concat(F.lit("postgresql://"), F.lower("n_name"), F.lit(":s3cret@db.example/x"))
    return table(spark, sf, "nation").where("n_name is not null").select("n_regionkey", S.mask_secret(url).alias("masked"))


@query("SELECT year_month, count(*) AS n, sum(vacancy_count)::BIGINT AS vacancies FROM job_bank_csv WHERE year_month IS NOT NULL GROUP BY 1")
def monthly_files(spark, sf):
    """Rows written in a folder for each month and read again."""
    path = f"{shared_dir(spark)}/months-{uuid.uuid4().hex}"
    files.write_months(table(spark, sf, "job_bank_csv").where("year_month is not null"), path)
    return spark.read.schema("year_month string, vacancy_count int").parquet(path).groupBy("year_month").agg(F.count(F.lit(1)).alias("n"), F.sum("vacancy_count").alias("vacancies"))


@query("""SELECT year_month, count(*) AS n, sum(vacancy_count)::BIGINT AS vacancies, count(raw_line) AS raw_lines
FROM (SELECT year_month, vacancy_count FROM job_bank_csv UNION ALL BY NAME SELECT year_month, raw_line FROM job_bank_raw) GROUP BY 1""")
def monthly_union(spark, sf):
    """Frames of different columns in one table."""
    frames = [table(spark, sf, "job_bank_csv").select("year_month", "vacancy_count"), table(spark, sf, "job_bank_raw").select("year_month", "raw_line")]
    return files.union_frames(frames).groupBy("year_month").agg(F.count(F.lit(1)).alias("n"), F.sum("vacancy_count").alias("vacancies"), F.count("raw_line").alias("raw_lines"))


QUERIES |= analytics.QUERIES
SQL |= analytics.SQL
