"""Problems 1 and 6 against brute force."""

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from workloom.llm import pairs, queries, termfreq


def brute(rows, vocabulary=None):
    baskets = defaultdict(set)
    for b, i in rows:
        if b is not None:
            baskets[b]
            if i is not None and (vocabulary is None or i in vocabulary):
                baskets[b].add(i)
    single, both = Counter(), Counter()
    for items in baskets.values():
        single.update(items)
        both.update(combinations(sorted(items), 2))
    return {(a, b): (n, single[a], single[b], len(baskets)) for (a, b), n in both.items()}


def data(seed, n=600):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, 1, 1, 1, *range(30)])) for _ in range(n)]
    return rows + [(7, k) for k in range(60)] + rows[:50]  # one basket holds every item


@pytest.mark.parametrize("limit", [2000, 10])
def test_pairs(spark, limit):
    rows = data(1)
    df = spark.createDataFrame(rows, "job int, skill int").withColumn("basket", F.lit("clash")).withColumn("n", F.lit(1))
    got = pairs.cooccurrence(df, "job", "skill", basket_items=limit).collect()
    want = brute(rows)
    assert {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n_baskets) for r in got} == want
    for r in got[:50]:
        assert r.lift == pytest.approx(r.n_ab * r.n_baskets / (r.n_a * r.n_b)) and r.pmi == pytest.approx(math.log2(r.lift))


def test_pairs_vocabulary_and_empty(spark):
    rows = data(2)
    df, vocabulary = spark.createDataFrame(rows, "job int, skill int"), spark.createDataFrame([(k,) for k in (1, 2, 3, None)], "id int")
    got = pairs.cooccurrence(df, "job", "skill", vocabulary, "id", min_count=2).collect()
    assert {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n_baskets) for r in got} == {k: v for k, v in brute(rows, {1, 2, 3}).items() if v[0] >= 2}
    assert pairs.cooccurrence(df.limit(0), "job", "skill").isEmpty() and pairs.cooccurrence(df, "job", "skill", vocabulary.limit(0), "id").isEmpty()


def test_pair_queries(spark, tmp_path):
    rows = data(4)
    df, known = spark.createDataFrame(rows, "job_id bigint, skill_id int"), set(range(2, 50))
    df.write.parquet(f"{tmp_path}/fact_job_skill_demand.parquet")
    spark.createDataFrame([(k,) for k in known], "id int").write.parquet(f"{tmp_path}/dim_skills.parquet")
    want = brute(rows, known)
    got = queries.p1_pmi(spark, str(tmp_path)).collect()
    assert {(r.skill_a, r.skill_b): (r.n_ab, r.n_a, r.n_b) for r in got} == {k: v[:3] for k, v in want.items()}
    assert len(got) == len(want) and {1, 2, 3, 4} <= {r.n_ab for r in got}
    assert all(r.lift == pytest.approx(v[0] * v[3] / (v[1] * v[2]), abs=1e-6) and r.pmi == pytest.approx(math.log2(v[0] * v[3] / (v[1] * v[2])), abs=1e-6) for r in got for v in [want[r.skill_a, r.skill_b]])
    found = {tuple(r) for r in queries.p1_found(spark, str(tmp_path)).collect()}
    assert found == {k for k, (n, a, b, all_) in want.items() if n >= 5 and n * all_ >= 4 * a * b}


def test_bitmaps():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5000, 70000):
        ids = np.unique(rng.integers(0, 1 << 20, size))
        packed = termfreq.pack(ids)
        assert termfreq.cardinality(packed) == len(ids) and (termfreq.unpack(packed) == ids).all()
    a, b = np.unique(rng.integers(0, 200_000, 90_000)), np.unique(rng.integers(100_000, 1 << 26, 9000))
    assert (termfreq.unpack(termfreq.union([termfreq.pack(a), termfreq.pack(b)])) == np.union1d(a, b)).all()


def test_frequencies(spark, monkeypatch):
    monkeypatch.setattr(termfreq, "GATHERED_ROWS", 50)
    rng = random.Random(3)
    names = [(-1, "unknown"), (0, "nought"), (1, " Kiln  Firing"), (2, "kiln firing"), (3, "Welding\t"), (4, "unused"), (5, None), (6, "common")]
    rows = [(rng.choice([None, *range(-(10**10), 10**12, 10**10)]), rng.choice([None, -1, 0, 1, 2, 3, 6, 6, 6, 77])) for _ in range(2000)]
    term_of = {-1: "unknown", 0: "nought", 1: "kiln firing", 2: "kiln firing", 3: "welding", 4: "unused", 6: "common"}
    occurrences, records, every = Counter(), defaultdict(set), set()
    for record, item in rows:
        if record is not None:
            every.add(record)
            if item in term_of:
                occurrences[term_of[item]] += 1
                records[term_of[item]].add(record)
    df = spark.createDataFrame(rows, "job bigint, skill int").withColumn("term", F.lit("clash"))
    got = termfreq.term_frequencies(df, "job", "skill", spark.createDataFrame(names, "id int, name string"), "id", "name").collect()
    assert {r.term: (r.occurrences, r.records, r.total_records) for r in got} == {t: (occurrences[t], len(records[t]), len(every)) for t in term_of.values()}
    assert {r.term: r.mark for r in got}["unused"] == "rare" and {r.term: r.mark for r in got}["common"] == "common"
    none = termfreq.term_frequencies(df.limit(0), "job", "skill", spark.createDataFrame(names, "id int, name string"), "id", "name").collect()
    assert {(r.records, r.mark) for r in none} == {(0, "rare")}
