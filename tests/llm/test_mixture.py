"""Problem 9: budgets, repeats and the order of the keys against a plain computation."""

import math

import pytest
from pyspark.sql import functions as F

from workloom.llm import mixture

TARGETS = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.15, 2), ("gone", 0.05, 4)]


def tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, weight double").withColumn("key", F.lit("clash")).withColumn("bin", F.lit(1))
    return docs, spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")


def corpus():
    rows = [(k, "a", 50 + k % 7, 1.0) for k in range(3000)] + [(10_000 + k, "b", 40 + k % 11, 0.5) for k in range(200)] + [(20_000 + k, "c", 100, 0.05 + k % 10 / 10) for k in range(150)]
    return rows + [(30_000, "a", 0, 1.0), (30_001, None, 10, 1.0), (30_002, "stray", 10, 1.0)]


def keys(spark, docs):
    drawn = docs.select("doc_id", "source", "n_tokens", (-F.log(mixture.draw("doc_id", 7)) / F.col("weight")).alias("k"))
    return sorted(drawn.collect(), key=lambda r: (r.k, r.doc_id))


def test_mixture(spark):
    docs, targets = tables(spark, corpus())
    for bins in (4096, 3, 1):
        selection, shares = mixture.mix(docs, targets, weight="weight", bins=bins)
        got = {r.doc_id: r.copies for r in selection.collect()}
        told = {r.source: r for r in shares.collect()}
        assert set(told) == {"a", "b", "c", "gone"} and told["gone"].tokens == 0
        order = keys(spark, docs)
        for source, _, most in TARGETS[:3]:
            mine = [r for r in order if r.source == source and r.n_tokens > 0]
            held, budget = sum(r.n_tokens for r in mine), told[source].budget
            passes, rest, want = budget // held, budget % held, {}
            for r in mine:
                rest -= r.n_tokens
                copies = passes + (rest >= 0)
                if copies:
                    want[r.doc_id] = copies
            assert {d: c for d, c in got.items() if d in {r.doc_id for r in mine}} == want
            assert max(want.values()) <= most and abs(told[source].tokens - budget) <= max(r.n_tokens for r in mine)
            assert math.isclose(told[source].actual_share, told[source].reachable_share, abs_tol=0.01)
        assert not {30_000, 30_001, 30_002} & set(got)


def test_given_total_beyond_reach(spark):
    docs, targets = tables(spark, corpus())
    selection, shares = mixture.mix(docs, targets, weight="weight", total=10**9)
    assert {r.source: r.copies for r in selection.groupBy("source").agg(F.min("copies").alias("copies")).collect()} == {"a": 1, "b": 3, "c": 2}
    assert shares.where("budget < tokens").isEmpty()


def test_empty(spark):
    docs, targets = tables(spark, corpus())
    selection, shares = mixture.mix(docs.limit(0), targets, weight="weight")
    assert selection.isEmpty() and shares.count() == 4
    selection, shares = mixture.mix(docs, targets.limit(0), weight="weight")
    assert selection.isEmpty() and shares.isEmpty()


def test_weights(spark):
    plain = "The apparatus of claim 1, in which the valve is held by a spring and the spring is set in the housing."
    rows = [plain, plain.replace("the", "t�e\x00"), "||| ~~~ 0x3F " * 20 + plain, "Die Vorrichtung nach Anspruch, die mit dem Ventil in der Kammer ist.", "123", "", None, "   ", plain * 2000, "Valve housing spring"]
    got = [r.w for r in spark.createDataFrame([(x,) for x in rows], "text string").select(mixture.quality_weight("text").alias("w")).collect()]
    assert got[0] > 0.9 and got[3] > 0.9 and got[8] > 0.9 and got[4:8] == [0.05] * 4
    assert got[1] < 0.5 and got[2] < 0.8 * got[0] and 0.4 < got[9] < got[0]


def test_low_and_useless_weights(spark):
    """Low weights don't crowd the last bin; null, zero and negative ones come last, in the order of the ids."""
    rows = [(k, "a", 10, 0.001) for k in range(2000)] + [(k, "a", 10, w) for k, w in ((5000, None), (5001, 0.0), (5002, -1.0))]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, weight double")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    order = [r.doc_id for r in docs.where("weight > 0").select("doc_id", (-F.log(mixture.draw("doc_id", 7)) / F.col("weight")).alias("k")).orderBy("k").collect()] + [5000, 5001, 5002]
    for n in (0, 777, 2001):
        selection, _ = mixture.mix(docs, targets, weight="weight", total=n * 10)
        assert {r.doc_id for r in selection.collect()} == set(order[:n])


def test_shares_by_sql(spark, tmp_path):
    """The shares told are those that SQL counts in the selection."""
    duckdb = pytest.importorskip("duckdb")
    docs, targets = tables(spark, corpus())
    selection, shares = mixture.mix(docs, targets, weight="weight")
    selection.write.parquet(f"{tmp_path}/selection")
    targets.write.parquet(f"{tmp_path}/targets")
    sql = f"""SELECT source, coalesce(sum(n_tokens * copies), 0)::BIGINT AS tokens, count(doc_id) AS n_documents, coalesce(sum(copies), 0)::BIGINT AS n_copies,
      round(coalesce(sum(n_tokens * copies), 0) / (SELECT sum(n_tokens * copies) FROM read_parquet('{tmp_path}/selection/*.parquet')), 9) AS actual_share
      FROM read_parquet('{tmp_path}/targets/*.parquet') t LEFT JOIN read_parquet('{tmp_path}/selection/*.parquet') s USING (source) GROUP BY source"""
    told = {(r.source, r.tokens, r.n_documents, r.n_copies, round(r.actual_share, 9)) for r in shares.collect()}
    assert told == set(duckdb.sql(sql).fetchall())
