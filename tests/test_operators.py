"""Operators of the engine against plain Python on small inputs."""

import random
from collections import defaultdict
from itertools import groupby

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workloom.operators import enrich, matching, packing, postings, quality, skills, warehouse
from workloom.plans import catalogue
from workloom.sources import files
from workloom.streaming import ingest


def python_pack(rows, stages, size, rest):
    left, out = rows, []
    for kind, group, order in stages:
        left = sorted(left, key=lambda r: (group(r), order(r)))
        tails = []
        for _, members in groupby(left, key=group):
            members = list(members)
            whole = len(members) // size * size
            out += [(kind, r["id"], k // size) for k, r in enumerate(members[:whole])]
            tails += members[whole:]
        left = tails
    return out + [("rem", r["id"], k // size) for k, r in enumerate(sorted(left, key=rest))]


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 60), (3, 230)])
def test_packing(spark, seed, n):
    rng = random.Random(seed)
    rows = [{"company": rng.choice(["", "a", "Café", "b"]), "noc": rng.choice([0, 1, 2]), "ord": k, "id": k} for k in range(n)]
    df = spark.createDataFrame([(r["company"] or None, r["noc"] or None, r["ord"], r["id"]) for r in rows], "company string, noc int, ord bigint, id bigint")
    both = [("co_noc", lambda r: (r["company"], r["noc"]), lambda r: r["ord"]), ("noc", lambda r: r["noc"], lambda r: (r["company"], r["ord"]))]
    want = python_pack(rows, both, 10, lambda r: (r["noc"], r["company"], r["ord"]))
    packed = packing.pack_matched(df)
    assert sorted((r.kind, r.id, r.chunk) for r in packed.collect()) == sorted(want)
    want = python_pack(rows, [("co", lambda r: r["company"], lambda r: r["ord"])], 5, lambda r: (r["company"], r["ord"]))
    packed = packing.pack_unmatched(df)
    assert sorted((r.kind, r.id, r.chunk) for r in packed.collect()) == sorted(want)
    made = packing.batches(packed)
    assert sum(r.n_rows for r in made.collect()) == n and made.select("batch_id").distinct().count() == made.count()
    numbers = sorted(r.session_no for r in packing.sessions(made, 3).collect())
    assert numbers == sorted(k // 3 for k in range(len(numbers)))
    done = spark.createDataFrame([(r["id"],) for r in rows[1:]], "id bigint")
    assert packing.undone(made, done).count() == 1


def test_capacity(spark):
    got = spark.range(1).select(packing.capacity(F.lit(1600)).alias("c")).first().c
    assert got.sessions == 2 and got.hours == pytest.approx(1600 * 11 / 3600 + 1.5)


def test_prepare(spark):
    columns = "noc21_code string, noc21_code_name string, noc_2016_code string, noc_2016_code_name string, job_title string, vacancy_count int, first_posting_date string, salary_minimum string, salary_maximum string, salary_per string, province_territory string, city string"
    full = ("00010", "a", "1", "b", "Cook", 2, "2023/01/15", "52000", "x", "Year", "Quebec", "Y")
    rows = [full] + [(*full[:k], None, *full[k + 1 :]) for k in (0, 1, 2, 3, 4, 10, 11)]
    df = spark.createDataFrame(rows, columns)
    nocs = spark.createDataFrame([(7, "10", "n"), (8, "99", "m")], "id int, noc21_code string, noc21_name string")
    got = postings.prepare_postings(postings.lookup_occupation(postings.normalise_pay(df), nocs)).collect()
    assert len(got) == 1 and got[0].noc_id == 7 and float(got[0].salary_min_hourly) == 25.0 and got[0].salary_max_hourly is None
    assert got[0].__fields__ == ["noc_id", "normalized_title", "vacancy_count", "province", "city", "first_posting_date", "salary_min_hourly", "salary_max_hourly"]
    with pytest.raises(ValueError, match="wages"):
        postings.require_columns(df, ["city", "wages"])


def test_nearest(spark):
    refs = spark.createDataFrame([(3, [0.0, 0.1, 0.9]), (2, [0.8, 0.2, 0.0]), (1, [0.9, 0.1, 0.0]), (4, None)], "rid int, v array<float>")
    asks = spark.createDataFrame([(1, [0.95, 0.05, 0.0]), (2, [0.3, 0.3, 0.3]), (3, None), (4, [0.0, 0.0, 0.0])], "id int, e array<float>")
    got = {r.id: r for r in matching.nearest_reference(asks, refs, "id", "e", "rid", "v", 0.95).collect()}
    assert got[1].match_id == 1 and got[2].match_id is None and got[2].match_score is not None and got[3].match_score is None and got[4].match_id is None
    assert matching.nearest_reference(asks, refs, "id", "e", "rid", "v", 0.95, keep_scores=False).where("id = 2").first().match_score is None
    assert matching.nearest_reference(asks.limit(0), refs, "id", "e", "rid", "v").columns == ["id", "e", "match_id", "match_score"]
    assert matching.nearest_reference(asks, refs.limit(0), "id", "e", "rid", "v").where("match_id is not null").isEmpty()
    parts = {r.id: (r.match_id, r.match_score) for r in matching.nearest_reference(asks, refs, "id", "e", "rid", "v", 0.95, block_rows=1).collect()}
    assert parts == {k: (r.match_id, r.match_score) for k, r in got.items()}


def test_nearest_of_repeated_ids_in_many_blocks(spark):
    rng = random.Random(4)
    vectors = [[rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)] for _ in range(60)]
    refs = spark.createDataFrame([*((k, v) for k, v in enumerate(vectors)), (None, [1.0, 0.0, 0.0])], "rid int, v array<float>")
    asks = spark.createDataFrame([(rng.choice([None, 1, 2]), [rng.random() for _ in range(3)], k, 0.5) for k in range(40)], "id int, e array<float>, n int, match_score double")
    whole, parts = ({r.n: tuple(r) for r in matching.nearest_reference(asks, refs, "id", "e", "rid", "v", 0.5, block_rows=size).collect()} for size in (100, 7))
    assert whole == parts and len(whole) == 40
    norm = lambda v: sum(x * x for x in v) ** 0.5
    for r in asks.collect():
        score = lambda v: round(sum(x * y for x, y in zip(r.e, v)) / ((norm(r.e) + 1e-10) * (norm(v) + 1e-10)), 12)
        best = max(range(60), key=lambda k: (score(vectors[k]), -k))
        assert whole[r.n][3] == (best if score(vectors[best]) >= 0.5 else None)


ANSWERS = [
    ("a", '```json\n{"results":[{"job_id":1,"noc_title":"Cooks","seniority":"senior","skills":[{"name":" Soup ","category":"hard_skill"},{"name":"x","category":"superpower"}]}]}\n```'),
    ("b", '{"results":[{"job_id":2,"noc_title":"null","seniority":"wizard","skills":"oops"},{"job_id":"x"}]}'), ("c", "not json"), ("d", ""), ("e", None), ("f", '{"results": 5}'),
]


def test_enrichment(spark):
    answers = spark.createDataFrame(ANSWERS, "batch_id string, response string")
    got = {r.job_id: r for r in enrich.validated(answers).collect()}
    assert set(got) == {1, 2} and got[1].noc_title == "Cooks" and [tuple(s) for s in got[1].skills] == [("soup", "hard_skill")]
    assert got[2].noc_title is None and got[2].seniority is None and got[2].skills == []
    rows = spark.createDataFrame([("a", 1, 5, "m", "intern"), ("a", 9, None, None, "intern"), ("b", 2, 6, "m", "intern"), ("c", 3, 7, "m", None)], "batch_id string, job_id bigint, noc_id int, noc_match_method string, seniority string")
    nocs = spark.createDataFrame([(11, "Cooks"), (12, "Cooks")], "id int, name string")
    merged = {r.job_id: r for r in enrich.merge(rows, enrich.validated(answers), nocs, matched=False).collect()}
    assert set(merged) == {1, 9, 2}
    assert (merged[1].noc_id, merged[1].noc_match_method, merged[1].seniority) == (12, "llm_noc_match", "senior")
    assert (merged[9].noc_id, merged[9].skills) == (None, []) and (merged[2].noc_id, merged[2].seniority) == (6, "intern")
    kept = {r.job_id: r for r in enrich.merge(rows, enrich.validated(answers), nocs, matched=True, respect_existing=True).collect()}
    assert (kept[1].noc_id, kept[1].seniority) == (5, "intern")


def test_the_last_result_counts(spark):
    results = spark.createDataFrame([("a", 1, 0, "Cooks", "intern", []), ("a", 1, 2, None, "senior", []), ("a", 1, 1, "Bakers", None, []), ("a", 2, 3, "Bakers", None, [])], "batch_id string, job_id bigint, position int, noc_title string, seniority string, skills " + enrich.SKILLS)
    rows = spark.createDataFrame([("a", 1, 9, "x", "mid_level"), ("a", 2, None, None, None), ("a", 3, 5, "x", None), ("b", 4, 5, "x", None)], "batch_id string, job_id bigint, noc_id int, noc_match_method string, seniority string")
    occupations = spark.createDataFrame([(1, "Cooks"), (2, "Bakers"), (3, "Bakers"), (4, None)], "id int, name string")
    got = {r.job_id: (r.noc_id, r.noc_match_method, r.seniority) for r in enrich.merge(rows, results, occupations, False).collect()}
    assert got == {1: (9, "x", "senior"), 2: (3, "llm_noc_match", None), 3: (5, "x", None)}


def test_prompts_and_completion(spark):
    rows = spark.createDataFrame([("a", 1, "Cook", None, "X", None), ("a", 2, "Chef", "d" * 2000, "Y", "senior")], "batch_id string, job_id bigint, title string, description string, company string, seniority string")
    asked = enrich.prompts(rows, spark.createDataFrame([("Cooks",), ("Bakers",)], "name string"))
    text = asked.first().prompt
    assert "- Bakers\n- Cooks" in text and "Seniority is known: senior" in text and "d" * 1500 in text and "d" * 1501 not in text and "postings of X" in text

    def completion(prompt):
        if "Chef" in prompt:
            raise RuntimeError
        return "ok"

    assert enrich.complete(asked, completion).first().response is None
    assert "Occupations" not in enrich.prompts(rows).first().prompt


def test_skills(spark):
    lists = spark.createDataFrame([(1, [("a ", "tool"), ("a", "tool"), ("", "tool"), ("b", "")]), (2, None), (3, [])], "job_id bigint, skills array<struct<name:string,category:string>>")
    assert [tuple(r) for r in skills.explode_skills(lists).collect()] == [(1, "a", "tool")]
    rng = random.Random(5)
    rows = [(k, rng.choice("xyz"), rng.choice(["tool", "hard_skill", "soft_skill"])) for k in range(40)]
    votes = defaultdict(dict)
    for k, s, c in rows:
        votes[s].setdefault(c, [0, -k])[0] += 1
    want = {s: max(v, key=lambda c: v[c]) for s, v in votes.items()}
    got = skills.majority_category(spark.createDataFrame(rows, "ordinal int, skill string, category string"))
    assert {r.skill: r.category for r in got.collect()} == want
    both = spark.createDataFrame([(1, "tests", "tool", 1), (1, "test", "tool", 2), (2, "tests", "hard_skill", 3)], "job_id int, skill string, category string, ordinal int")
    assert sorted(map(tuple, skills.normalise_skills(both).collect())) == [(1, "test", "tool"), (2, "test", "tool")]


def test_multi_category(spark, tmp_path):
    votes = {"even": (6, 5), "one": (90, 0), "p": (10, 1), "q": (9, 1), "r": (8, 1), "s": (7, 1), "t": (7, 1)}
    named = [(2 * k + c, skill if c else skill.upper(), "xy"[c]) for k, skill in enumerate(votes) for c in (0, 1)]
    rows = [(job, i) for i, skill, c in named for job in range(votes[skill.lower()]["xy".index(c)])]
    spark.createDataFrame(named, "id int, name string, category string").write.parquet(f"{tmp_path}/dim_skills.parquet")
    spark.createDataFrame(rows, "job_id bigint, skill_id int").write.parquet(f"{tmp_path}/fact_job_skill_demand.parquet")
    got = catalogue.queries()["multi_category"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("even", "x", 6, 2), ("p", "x", 10, 2), ("q", "x", 9, 2), ("r", "x", 8, 2), ("s", "x", 7, 2)]
    assert catalogue.queries()["majority_vote"](spark, str(tmp_path)).columns == ["skill", "category", "votes", "n_categories"]


def test_warehouse(spark):
    names = warehouse.dim_of(spark.createDataFrame([("b",), ("a",), ("a",), (None,), ("nan",), ("é",)], "n string"), "n")
    assert sorted(map(tuple, names.collect())) == [(1, "a"), (2, "b"), (3, "é")]
    target = spark.createDataFrame([("1", "x")], "code string, name string")
    assert warehouse.insert_absent(target, spark.createDataFrame([("1", "y"), ("2", "z"), ("2", "z")], "code string, name string"), "code").count() == 2
    first = warehouse.first_wins(spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, f string"), "k", "f")
    assert sorted(map(tuple, first.collect())) == [(1, "a"), (2, "c")]
    facts = warehouse.fact_skills(spark.createDataFrame([(1, "a"), (1, "a"), (1, "?")], "job_id int, skill string"), names)
    assert [tuple(r) for r in facts.collect()] == [(1, 1)]


def test_gates(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    for gate in (lambda: quality.assert_unique(df, "k"), lambda: quality.assert_not_null(df, "v"), lambda: quality.assert_domain(df, "v", ("b",)), lambda: quality.at_least(df, 3), lambda: quality.assert_foreign_key(df, "k", df.where("k = 2"), "k")):
        with pytest.raises(quality.GateError):
            gate()
    assert quality.assert_domain(df, "v", ("a",)) is df and quality.assert_foreign_key(df, "k", df, "k") is df
    scored = spark.createDataFrame([(1, 0.9), (2, 0.8), (None, None), (None, None)], "noc_id int, noc_match_score double")
    got = quality.match_stats(scored).first()
    assert (got.total, got.matched, got.unmatched, got.match_rate) == (4, 2, 2, 0.5) and got.mean_score == pytest.approx(0.85)
    assert quality.match_stats(scored.limit(0)).first().match_rate == 0.0


HEADER = list(files.REQUIRED)


@pytest.mark.parametrize("encoding,separator", [("utf-16", "\t"), ("utf-8-sig", ","), ("latin-1", ",")])
def test_csv_formats(spark, tmp_path, encoding, separator):
    path = str(tmp_path / "a.csv")
    row = ["Opératrice", "12345", "NA", "1", "2023/01/02", "", "20", "Hour", "Quebec", '"Y\nZ"', "1", "n"]
    with open(path, "w", encoding=encoding, newline="") as file:
        file.write("\n".join(separator.join(x) for x in (HEADER, row)) + "\n")
    got = files.read_csv(spark, path).collect()
    assert len(got) == 1 and got[0]["Job Title"] == "Opératrice" and got[0]["NOC21 Code Name"] is None and got[0]["City"] == "Y\nZ" and got[0]["Salary Minimum"] is None
    assert files.validate(spark, path)["ok"]
    assert files.read_months(spark, {"2023-01": path, "2023-02": path}).count() == 2


def test_files_split_where_they_can(spark, tmp_path):
    for name, city, whole in (("a", '"Y\nZ"', True), ("b", '"Y ""Z"""', False), ("c", "Opéra", False)):
        with open(tmp_path / name, "w", encoding="latin-1" if name == "c" else "utf-8") as file:
            file.write(f"id,city\n1,{city}\n2,x\n")
        fmt = files.sniff(spark, str(tmp_path / name))
        assert fmt.multi_line == whole and fmt.encoding == ("ISO-8859-1" if name == "c" else "UTF-8")
        got = files.validate(spark, f"file://{tmp_path / name}", ("id", "city"))
        assert got["ok"] and got["rows"] == 2


def test_masters_and_postings(spark, tmp_path):
    (tmp_path / "m.csv").write_text('Level,Code - NOC 2021 V1.0,Class title,Class definition\n5,00010,Legislators,"a\nb"\n4,0001,Law,x\n5,,None,x\n')
    assert [tuple(r) for r in files.read_occupations(spark, str(tmp_path / "m.csv")).collect()] == [("00010", "Legislators")]
    (tmp_path / "p.csv").write_text('job_id,company_name,title,description,formatted_experience_level,x\n7,A,Cook,"long\ntext",NA,1\n')
    got = files.read_postings(spark, str(tmp_path / "p.csv")).first()
    assert got.job_id == 7 and got.description == "long\ntext" and got.formatted_experience_level is None
    with pytest.raises(ValueError, match="missing columns"):
        files.read_postings(spark, str(tmp_path / "m.csv"))


def test_seed_once_and_months(spark, tmp_path):
    rows = spark.createDataFrame([("2023-01", 1), ("2023-02", 2)], "year_month string, n int")
    target = f"file://{tmp_path}/seed"
    assert warehouse.seed_once(spark, rows, target) and not warehouse.seed_once(spark, rows.union(rows), target)
    assert spark.read.parquet(target).count() == 2
    files.write_months(rows, str(tmp_path / "months"))
    assert (tmp_path / "months/year_month=2023-02").is_dir()
    with pytest.raises(ValueError, match="no files"):
        files.read_months(spark, {})


def test_csv_errors(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "w.csv").write_text("a|b\n1|2\n")
    assert not files.validate(spark, str(tmp_path / "no.csv"))["ok"] and "empty" in files.validate(spark, str(tmp_path / "e.csv"))["error"]
    assert "missing" in files.validate(spark, str(tmp_path / "w.csv"))["error"]


def test_catalogue(spark):
    text = '{"result":{"resources":[{"url":"http://x/a-en-january2023.csv","format":"CSV"},{"url":"http://x/a-fr-january2023.csv"},{"url":"http://x/b-en-january2023.csv"},{"url":"http://x/a-en-may2024.xls"}]}}'
    urls = files.catalogue_urls(spark.createDataFrame([(text,)], "value string"))
    months = files.months_of(urls)
    assert [tuple(r) for r in months.collect()] == [("2023-01", "http://x/b-en-january2023.csv")]
    assert files.download_plan(months, spark.createDataFrame([("2023-01",)], "year_month string")).isEmpty()


def test_checkpoints_and_stream(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/1.json").write_text('{"job_id": 1}\n')
    (tmp_path / "c/2.json").write_text('{"job_id": \n')
    rows, corrupt = files.read_checkpoints(spark, str(tmp_path / "c"), T.StructType([T.StructField("job_id", T.LongType())]))
    assert rows.count() == 1 and corrupt.count() == 1
    source, target, state = (str(tmp_path / x) for x in "sto")
    for k in range(2):
        df = spark.range(k, k + 1)
        df.write.mode("append").parquet(source)
        ingest.ingest_new(spark, source, df.schema, target, state, lambda d: d.withColumn("x", F.col("id") * 2)).awaitTermination(60)
        assert spark.read.parquet(target).count() == k + 1
