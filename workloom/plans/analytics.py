"""The analytical query catalogue over the star schema, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from workloom.functions import scalars as S
from workloom.operators import warehouse
from workloom.runtime import small_side, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_VIEW = """WITH view AS (
  SELECT n.noc21_code, n.noc21_name, y.level AS seniority, s.name AS skill, s.category, count(*) AS demand_count
  FROM fact_job_skill_demand d JOIN fact_job_postings p ON p.job_id = d.job_id JOIN dim_skills s ON s.id = d.skill_id
  LEFT JOIN noc_titles n ON n.id = p.noc_id LEFT JOIN dim_seniority y ON y.id = p.seniority_id GROUP BY 1, 2, 3, 4, 5)
"""


def _view(spark, sf):
    return warehouse.demand_summary(*(table(spark, sf, t) for t in ("fact_job_skill_demand", "fact_job_postings", "dim_skills", "noc_titles", "dim_seniority")))


def _facts(spark, sf):
    """Skill rows with their posting, skill, occupation and seniority."""
    named = lambda t, key, **c: small_side(table(spark, sf, t).select(F.col("id").alias(key), *(F.col(a).alias(b) for b, a in c.items())))
    rows = table(spark, sf, "fact_job_skill_demand").join(table(spark, sf, "fact_job_postings").select("job_id", "noc_id", "seniority_id"), "job_id")
    rows = rows.join(named("dim_skills", "skill_id", skill="name", category="category"), "skill_id")
    return rows.join(named("noc_titles", "noc_id", occupation="noc21_name"), "noc_id", "left").join(named("dim_seniority", "seniority_id", seniority="level"), "seniority_id", "left")


_FACTS = """WITH facts AS (
  SELECT p.job_id, d.skill_id, p.noc_id, s.name AS skill, s.category, n.noc21_name AS occupation, y.level AS seniority
  FROM fact_job_skill_demand d JOIN fact_job_postings p ON p.job_id = d.job_id JOIN dim_skills s ON s.id = d.skill_id
  LEFT JOIN noc_titles n ON n.id = p.noc_id LEFT JOIN dim_seniority y ON y.id = p.seniority_id)
"""
def _n():
    return F.count(F.lit(1))



@query(_VIEW + "SELECT * FROM view")
def demand_summary(spark, sf):
    """Demand by occupation, seniority and skill."""
    return _view(spark, sf)


@query(_VIEW + "SELECT noc21_name, seniority, skill, demand_count FROM view WHERE noc21_name ILIKE '%network%' AND category = 'hard_skill' ORDER BY demand_count DESC, noc21_name, seniority NULLS FIRST, skill LIMIT 20")
def top_hard_skills(spark, sf):
    """From the view, by a pattern."""
    wanted = _view(spark, sf).where(F.col("noc21_name").ilike("%network%") & (F.col("category") == "hard_skill"))
    return wanted.select("noc21_name", "seniority", "skill", "demand_count").orderBy(F.desc("demand_count"), "noc21_name", F.asc_nulls_first("seniority"), "skill").limit(20)


@query("""SELECT (SELECT count(*) FROM fact_job_postings) AS postings, (SELECT count(*) FROM fact_job_skill_demand) AS skill_rows, (SELECT count(*) FROM dim_skills) AS skills,
  (SELECT count(*) FROM dim_companies) AS companies, (SELECT count(DISTINCT noc_id) FROM fact_job_postings) AS occupations, (SELECT count(*) FROM fact_job_postings WHERE noc_id IS NOT NULL) AS with_occupation,
  (SELECT count(DISTINCT s.category) FROM fact_job_skill_demand d JOIN dim_skills s ON s.id = d.skill_id) AS categories,
  (SELECT round(avg(n), 1) FROM (SELECT count(*) AS n FROM fact_job_skill_demand GROUP BY job_id)) AS avg_skills""")
def overview_scalars(spark, sf):
    """Scalar subqueries of one row."""
    names = ("fact_job_postings", "fact_job_skill_demand", "dim_skills", "dim_companies")
    posts, demand, skills, companies = (table(spark, sf, n) for n in names)
    parts = [
        posts.agg(_n().alias("postings"), F.countDistinct("noc_id").alias("occupations"), F.count("noc_id").alias("with_occupation")), demand.agg(_n().alias("skill_rows")), skills.agg(_n().alias("skills")), companies.agg(_n().alias("companies")),
        demand.join(small_side(skills.select(F.col("id").alias("skill_id"), "category")), "skill_id").agg(F.countDistinct("category").alias("categories")),
        demand.groupBy("job_id").agg(_n().alias("n")).agg(F.round(F.avg("n"), 1).alias("avg_skills")),
    ]
    result = parts[0]
    for part in parts[1:]:  # each has one row
        result = result.crossJoin(F.broadcast(part))
    return result


@query("SELECT category, count(*) AS n FROM dim_skills GROUP BY 1")
def skills_per_category(spark, sf):
    """Q4, A9."""
    return table(spark, sf, "dim_skills").groupBy("category").agg(_n().alias("n"))


@query("SELECT y.level AS seniority, count(*) AS n FROM fact_job_postings p JOIN dim_seniority y ON y.id = p.seniority_id GROUP BY 1")
def postings_per_seniority(spark, sf):
    """Q4, A9."""
    tiers = small_side(table(spark, sf, "dim_seniority").select(F.col("id").alias("seniority_id"), F.col("level").alias("seniority")))
    return table(spark, sf, "fact_job_postings").join(tiers, "seniority_id").groupBy("seniority").agg(_n().alias("n"))


@query("SELECT name AS skill, category, count(*) AS n FROM fact_job_skill_demand d JOIN dim_skills s ON s.id = d.skill_id GROUP BY s.id, 1, 2 ORDER BY n DESC, skill LIMIT 20")
def topk_global(spark, sf):
    """Q5, L1."""
    counted = table(spark, sf, "fact_job_skill_demand").groupBy("skill_id").agg(_n().alias("n"))
    named = small_side(table(spark, sf, "dim_skills").select(F.col("id").alias("skill_id"), F.col("name").alias("skill"), "category"))
    return counted.join(named, "skill_id").select("skill", "category", "n").orderBy(F.desc("n"), "skill").limit(20)


_DIFF = _FACTS + """, counted AS (SELECT skill, count(*) FILTER (seniority = 'senior') AS senior_n, count(*) FILTER (seniority = 'entry_level') AS entry_n, count(*) AS n FROM facts GROUP BY skill HAVING count(*) >= 10)
"""


def _differences(spark, sf):
    counted = _facts(spark, sf).groupBy("skill").agg(F.count_if(F.col("seniority") == "senior").alias("senior_n"), F.count_if(F.col("seniority") == "entry_level").alias("entry_n"), _n().alias("n"))
    return counted.where("n >= 10").withColumn("difference", F.col("senior_n") - F.col("entry_n"))


@query(_DIFF + "SELECT skill, senior_n, entry_n, n, senior_n - entry_n AS difference FROM counted")
def filtered_counts_diff(spark, sf):
    """Filtered counts with a HAVING."""
    return _differences(spark, sf)


@query(_DIFF + """, d AS (SELECT skill, senior_n - entry_n AS difference FROM counted)
(SELECT 'senior' AS side, skill, difference FROM d ORDER BY difference DESC, skill LIMIT 8) UNION ALL (SELECT 'entry', skill, difference FROM d ORDER BY difference, skill LIMIT 8)""")
def head_tail(spark, sf):
    """Both ends of a ranking."""
    ranked = _differences(spark, sf).select("skill", "difference")
    head = ranked.orderBy(F.desc("difference"), "skill").limit(8).withColumn("side", F.lit("senior"))
    return head.unionByName(ranked.orderBy("difference", "skill").limit(8).withColumn("side", F.lit("entry")))


@query(_FACTS + "SELECT seniority, " + ", ".join(f"count(*) FILTER (category = '{c}') AS {c}" for c in S.CATEGORIES) + " FROM facts WHERE occupation ILIKE '%network%' AND seniority IS NOT NULL GROUP BY 1")
def pivot_fill(spark, sf):
    """Seniority by category, 0 where there is none."""
    rows = _facts(spark, sf).where(F.col("occupation").ilike("%network%") & F.col("seniority").isNotNull())
    return rows.groupBy("seniority").pivot("category", list(S.CATEGORIES)).agg(_n()).na.fill(0)


@query(_FACTS + ", c AS (SELECT skill, category, seniority, count(*) AS n FROM facts WHERE occupation ILIKE '%network%' GROUP BY 1, 2, 3) SELECT skill, category, sum(n)::BIGINT AS n FROM c GROUP BY 1, 2 ORDER BY n DESC, skill, category LIMIT 15")
def two_level_sum(spark, sf):
    """Q7, A10, L2: counts summed again."""
    rows = _facts(spark, sf).where(F.col("occupation").ilike("%network%")).groupBy("skill", "category", "seniority").agg(_n().alias("n"))
    return rows.groupBy("skill", "category").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "skill", "category").limit(15)


def _top_occupations(spark, sf, n: int = 5):
    counted = table(spark, sf, "fact_job_postings").where("noc_id is not null").groupBy("noc_id").agg(_n().alias("n"))
    named = small_side(table(spark, sf, "noc_titles").select(F.col("id").alias("noc_id"), F.col("noc21_name").alias("occupation")))
    return counted.join(named, "noc_id").orderBy(F.desc("n"), "occupation").limit(n)


_TOP_SQL = "(SELECT p.noc_id, n.noc21_name AS occupation, count(*) AS n FROM fact_job_postings p JOIN noc_titles n ON n.id = p.noc_id GROUP BY 1, 2 ORDER BY n DESC, occupation LIMIT 5)"


@query(f"SELECT occupation, n FROM {_TOP_SQL}")
def top_occupations(spark, sf):
    """Q8, L1."""
    return _top_occupations(spark, sf).select("occupation", "n")


@query(_FACTS + f"SELECT occupation, category, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY occupation), 4) AS pct FROM facts WHERE noc_id IN (SELECT noc_id FROM {_TOP_SQL}) GROUP BY 1, 2")
def share_pct(spark, sf):
    """Shares of categories in the top occupations."""
    rows = _facts(spark, sf).join(F.broadcast(_top_occupations(spark, sf).select("noc_id")), "noc_id", "left_semi").groupBy("occupation", "category").agg(_n().alias("n"))
    return rows.select("occupation", "category", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy("occupation")), 4).alias("pct"))


@query(_FACTS + f", c AS (SELECT occupation, skill, count(*) AS n FROM facts WHERE noc_id IN (SELECT noc_id FROM {_TOP_SQL}) GROUP BY 1, 2) SELECT occupation, skill, n FROM c QUALIFY row_number() OVER (PARTITION BY occupation ORDER BY n DESC, skill) <= 8")
def topk_per_group(spark, sf):
    """Q10, W5."""
    rows = _facts(spark, sf).join(F.broadcast(_top_occupations(spark, sf).select("noc_id")), "noc_id", "left_semi").groupBy("occupation", "skill").agg(_n().alias("n"))
    return rows.withColumn("rn", F.row_number().over(W.partitionBy("occupation").orderBy(F.desc("n"), "skill"))).where("rn <= 8").drop("rn")


@query(_FACTS + "SELECT skill, coalesce(occupation, 'Unknown') AS occupation, count(*) AS n FROM facts WHERE category = 'certification' GROUP BY 1, 2 ORDER BY n DESC, skill, occupation LIMIT 10")
def top_certifications(spark, sf):
    """Q11, L1."""
    rows = _facts(spark, sf).where(F.col("category") == "certification").groupBy("skill", F.coalesce("occupation", F.lit("Unknown")).alias("occupation")).agg(_n().alias("n"))
    return rows.orderBy(F.desc("n"), "skill", "occupation").limit(10)


@query("SELECT job_id, (SELECT count(*) FROM fact_job_skill_demand d WHERE d.job_id = p.job_id) AS n_skills FROM fact_job_postings p")
def scalar_subquery_count(spark, sf):
    """A count per posting, 0 where there is none."""
    counted = table(spark, sf, "fact_job_skill_demand").groupBy("job_id").agg(_n().alias("n_skills"))
    return table(spark, sf, "fact_job_postings").select("job_id").join(counted, "job_id", "left").na.fill(0, ["n_skills"])


_TOPK = """WITH r AS (SELECT DISTINCT d.job_id, s.name, s.id FROM fact_job_skill_demand d JOIN dim_skills s ON s.id = d.skill_id),
k AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY name, id) <= 5), a AS (SELECT job_id, string_agg(name, ', ' ORDER BY name, id) AS top_skills FROM k GROUP BY job_id)
"""


@query(_TOPK + "SELECT p.job_id, p.raw_title, a.top_skills FROM fact_job_postings p LEFT JOIN a ON a.job_id = p.job_id")
def topk_string_agg(spark, sf):
    """The first five skills of each posting in a string."""
    named = small_side(table(spark, sf, "dim_skills").select(F.col("id").alias("skill_id"), "name"))
    rows = table(spark, sf, "fact_job_skill_demand").distinct().join(named, "skill_id")
    # a posting has at most as many skills as the dimension
    top = rows.groupBy("job_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("name", "skill_id"))), 1, 5).alias("top"))
    text = F.array_join(F.transform("top", lambda x: x["name"]), ", ")
    return table(spark, sf, "fact_job_postings").select("job_id", "raw_title").join(top.select("job_id", text.alias("top_skills")), "job_id", "left")


@query("""WITH picked AS (SELECT * FROM fact_job_postings WHERE noc_id IS NOT NULL ORDER BY job_id LIMIT 10),
asked AS (SELECT DISTINCT d.job_id, d.skill_id, s.name FROM fact_job_skill_demand d JOIN picked USING (job_id) JOIN dim_skills s ON s.id = d.skill_id),
best AS (SELECT job_id, string_agg(name, ', ' ORDER BY skill_id) AS top_skills FROM (SELECT * FROM asked QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY skill_id) <= 5) GROUP BY job_id)
SELECT p.job_id, c.name AS company, p.raw_title AS title, n.noc21_code AS noc, n.noc21_name AS noc_name, t.level AS seniority, p.noc_match_method AS method,
  (SELECT count(*) FROM fact_job_skill_demand f WHERE f.job_id = p.job_id) AS skills, b.top_skills
FROM picked p LEFT JOIN dim_companies c ON c.id = p.company_id LEFT JOIN dim_seniority t ON t.id = p.seniority_id LEFT JOIN noc_titles n ON n.id = p.noc_id LEFT JOIN best b ON b.job_id = p.job_id""")
def sample_report(spark, sf):
    """Ten postings with an occupation, the first by their ids, with all names, the number of skills and the first five of them."""
    picked = F.broadcast(table(spark, sf, "fact_job_postings").where("noc_id is not null").orderBy("job_id").limit(10))  # ten rows
    demand = table(spark, sf, "fact_job_skill_demand").join(picked.select("job_id"), "job_id")
    counted = demand.groupBy("job_id").agg(_n().alias("skills"))
    named = small_side(table(spark, sf, "dim_skills").select(F.col("id").alias("skill_id"), "name"))
    top = demand.distinct().join(named, "skill_id").groupBy("job_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("skill_id", "name"))), 1, 5).alias("top"))
    side = lambda name, key, **columns: table(spark, sf, name).select(F.col("id").alias(key), *(F.col(c).alias(a) for a, c in columns.items()))
    joined = picked.join(counted, "job_id", "left").join(top, "job_id", "left").join(side("dim_companies", "company_id", company="name"), "company_id", "left").join(side("dim_seniority", "seniority_id", seniority="level"), "seniority_id", "left").join(side("noc_titles", "noc_id", noc="noc21_code", noc_name="noc21_name"), "noc_id", "left")
    text = F.array_join(F.transform("top", lambda x: x["name"]), ", ")
    return joined.select("job_id", "company", F.col("raw_title").alias("title"), "noc", "noc_name", "seniority", F.col("noc_match_method").alias("method"), F.coalesce("skills", F.lit(0)).alias("skills"), text.alias("top_skills"))


@query("""WITH n AS (SELECT job_id, count(*) AS n FROM fact_job_skill_demand GROUP BY 1)
SELECT p.job_id, rpad(substr(coalesce(c.name, ''), 1, 24), 24, ' ') || ' ' || rpad(substr(p.raw_title, 1, 29), 29, ' ') || ' ' || rpad(substr(coalesce(t.level, '?'), 1, 11), 11, ' ') || ' ' || lpad(coalesce(n.n, 0)::VARCHAR, 3, ' ') AS line,
  printf('%.1f%%', round(100.0 * coalesce(n.n, 0) / (SELECT count(*) FROM dim_skills), 1)) AS share
FROM fact_job_postings p LEFT JOIN dim_companies c ON c.id = p.company_id LEFT JOIN dim_seniority t ON t.id = p.seniority_id LEFT JOIN n USING (job_id)""")
def report_lines(spark, sf):
    """a line of fixed width for each posting, and the share of all skills that it asks for as text."""
    side = lambda name, key, column, alias: small_side(table(spark, sf, name).select(F.col("id").alias(key), F.col(column).alias(alias)))
    counted = table(spark, sf, "fact_job_skill_demand").groupBy("job_id").agg(_n().alias("n"))
    every = table(spark, sf, "dim_skills").agg(_n().alias("n_skills"))
    rows = table(spark, sf, "fact_job_postings").join(side("dim_companies", "company_id", "name", "company"), "company_id", "left").join(side("dim_seniority", "seniority_id", "level", "seniority"), "seniority_id", "left").join(counted, "job_id", "left").crossJoin(F.broadcast(every))
    n = F.coalesce("n", F.lit(0))
    line = F.concat_ws(" ", S.fitted(F.col("company"), 24), S.fitted(F.col("raw_title"), 29), S.fitted(F.col("seniority"), 11, "?"), F.lpad(n.cast("string"), 3, " "))
    return rows.select("job_id", line.alias("line"), S.percent(n, F.col("n_skills")).alias("share"))


@query("""SELECT count(*) AS total, count(noc_id) AS with_occupation, count(seniority_id) AS with_seniority, count(DISTINCT noc_id) AS occupations,
  round(100.0 * count(noc_id) / count(*), 2) AS occupation_pct, (SELECT round(avg(n), 2) FROM (SELECT count(*) AS n FROM fact_job_skill_demand GROUP BY job_id)) AS avg_skills FROM fact_job_postings""")
def report_counts(spark, sf):
    """Q13, F27."""
    counts = table(spark, sf, "fact_job_postings").agg(_n().alias("total"), F.count("noc_id").alias("with_occupation"), F.count("seniority_id").alias("with_seniority"), F.countDistinct("noc_id").alias("occupations"), F.round(100.0 * F.count("noc_id") / _n(), 2).alias("occupation_pct"))
    average = table(spark, sf, "fact_job_skill_demand").groupBy("job_id").agg(_n().alias("n")).agg(F.round(F.avg("n"), 2).alias("avg_skills"))
    return counts.crossJoin(F.broadcast(average))


_TABLES = ("fact_job_postings", "fact_job_skill_demand", "dim_companies", "dim_skills", "dim_seniority", "noc_titles")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _TABLES))
def load_counts(spark, sf):
    """Q15, G7."""
    result = None
    for t in _TABLES:
        one = table(spark, sf, t).agg(_n().alias("n")).select(F.lit(t).alias("table_name"), "n")
        result = one if result is None else result.unionByName(one)
    return result


@query("SELECT substr(n.noc21_code, 1, 2) AS major_group, count(*) AS n, sum(vacancy_count)::BIGINT AS vacancies, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM job_postings p JOIN noc_titles n ON n.id = p.noc_id GROUP BY 1")
def major_group_share(spark, sf):
    """share of the major groups."""
    codes = small_side(table(spark, sf, "noc_titles").select(F.col("id").alias("noc_id"), S.major_group(F.col("noc21_code")).alias("major_group")))
    rows = table(spark, sf, "job_postings").join(codes, "noc_id").groupBy("major_group").agg(_n().alias("n"), F.sum("vacancy_count").alias("vacancies"))
    return rows.crossJoin(F.broadcast(rows.agg(F.sum("n").alias("whole")))).select("major_group", "n", "vacancies", F.round(100.0 * F.col("n") / F.col("whole"), 4).alias("pct"))


@query("SELECT province, round(quantile_cont(salary_min_hourly::DOUBLE, 0.25), 4) AS p25, round(quantile_cont(salary_min_hourly::DOUBLE, 0.5), 4) AS p50, round(quantile_cont(salary_min_hourly::DOUBLE, 0.75), 4) AS p75 FROM job_postings GROUP BY 1")
def salary_distribution(spark, sf):
    """Quartiles of hourly pay by province."""
    at = lambda q: F.round(F.percentile(F.col("salary_min_hourly").cast("double"), q), 4)
    return table(spark, sf, "job_postings").groupBy("province").agg(at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"))


@query("SELECT province, city, count(*) AS n, sum(vacancy_count)::BIGINT AS vacancies FROM job_postings GROUP BY 1, 2")
def hiring_locations(spark, sf):
    """Postings and vacancies by place."""
    return table(spark, sf, "job_postings").groupBy("province", "city").agg(_n().alias("n"), F.sum("vacancy_count").alias("vacancies"))


@query("SELECT strftime(first_posting_date, '%Y-%m') AS month, count(*) AS n FROM job_postings GROUP BY 1")
def posting_trend(spark, sf):
    """Postings by month."""
    return table(spark, sf, "job_postings").groupBy(F.date_format("first_posting_date", "yyyy-MM").alias("month")).agg(_n().alias("n"))
