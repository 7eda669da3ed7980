"""Both pipelines end to end, with a small encoder and a made-up completion."""

import json
import re

import numpy as np
import pytest

from workloom.plans import pipeline
from workloom.sources import files


def made_up():
    """(encoder, completion), defined here so that they are sent to the workers by value."""

    def encoder(texts):
        """Letter counts: enough to match a title with the occupation of the same words."""
        return np.array([[x.lower().rstrip("s").count(c) + 1e-3 for c in "abcdefghijklmnopqrstuvwxyz"] for x in texts], "f4")

    def completion(prompt):
        if "Broken" in prompt:
            raise RuntimeError
        jobs = [int(x) for x in re.findall(r"Job (\d+)", prompt)]
        return json.dumps({"results": [{"job_id": j, "noc_title": "Bakers", "seniority": "senior", "skills": [{"name": "Ovens", "category": "tool"}, {"name": f"skill {j % 2}", "category": "hard_skill"}]} for j in jobs]})

    return encoder, completion


OCCUPATIONS = [(1, "11111", "Cooks"), (2, "22222", "Bakers"), (3, "33", "Short codes")]


def test_config():
    with pytest.raises(ValueError, match="threshold"):
        pipeline.Config(threshold=2)
    with pytest.raises(ValueError, match="partitions"):
        pipeline.Config(partitions=0)


def test_skill_demand(spark, tmp_path):
    encoder, completion = made_up()
    text = "long enough " * 10
    rows = [(k, f"Firm {k % 3}", "Cook" if k % 2 else "Night porter wanted", text, "Associate") for k in range(24)] + [(90, "Firm 0", None, text, None), (91, "Firm 0", "Cook", "short", None), (92, None, "Broken oven xyz", text, None)]
    raw = spark.createDataFrame(rows, "job_id bigint, company_name string, title string, description string, formatted_experience_level string")
    occupations = spark.createDataFrame(OCCUPATIONS, "id int, noc21_code string, noc21_name string")
    config = pipeline.Config(threshold=0.99, matched_batch=4, unmatched_batch=3, batches_per_session=2, partitions=2)
    store, target = str(tmp_path / "store"), str(tmp_path / "out")
    tables = pipeline.skill_demand(spark, raw, occupations, encoder, completion, store, [target, target + "2"], config)
    facts = {r.job_id: r for r in spark.read.parquet(f"{target}/fact_job_postings.parquet").collect()}
    assert set(range(1, 24, 2)) <= set(facts) and not {90, 91, 92} & set(facts)
    assert facts[1].noc_id == 1 and facts[1].noc_match_method == "sentence_transformer" and facts[0].noc_id == 2 and facts[0].noc_match_method == "llm_noc_match"
    names = {r.name: r.category for r in tables["dim_skills"].collect()}
    assert names == {"oven": "tool", "skill 0": "hard_skill", "skill 1": "hard_skill"}
    assert spark.read.parquet(f"{target}2/fact_job_skill_demand.parquet").count() == 2 * len(facts)

    def down(prompt):
        raise RuntimeError

    again = pipeline.enriched(spark, pipeline.normalised(pipeline.extracted(raw, config), occupations, encoder, config), occupations, down, store, config)
    assert again.select("job_id").distinct().count() == again.count() >= len(facts)  # what is stored isn't asked again


def test_market_trend(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    rows = [list(files.REQUIRED), ["Cook", "11111.0", "Cooks", "2", "2023/01/15", "52000", "", "Year", "Quebec", "Y", "1", "n"], ["Cook", "", "Cooks", "2", "2023/01/15", "25", "", "Hour", "Quebec", "Y", "1", "n"]]
    with open(path, "w", encoding="utf-16") as file:
        file.write("\n".join("\t".join(x) for x in rows))
    target = str(tmp_path / "out")
    occupations = spark.createDataFrame(OCCUPATIONS, "id int, noc21_code string, noc21_name string")
    assert pipeline.market_trend(spark, {"2023-01": path}, occupations, target) == 1
    got = spark.read.parquet(target).first()
    assert got.noc_id == 1 and float(got.salary_min_hourly) == 25.0 and got.salary_max_hourly is None
