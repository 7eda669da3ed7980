"""Checked broadcasts and lineage cuts."""

from workloom.runtime import cut, small_side


def is_hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_small_side(spark):
    df = spark.createDataFrame([(1, "a" * 100), (2, None)], "k int, v string")
    assert is_hinted(small_side(df)) and is_hinted(small_side(df.limit(0)))
    assert not is_hinted(small_side(df, max_rows=1)) and not is_hinted(small_side(df, max_bytes=50))


def test_cut(spark):
    df = spark.range(5).withColumnRenamed("id", "x")
    got = cut(df)
    assert got.schema["x"].dataType == df.schema["x"].dataType and sorted(r.x for r in got.collect()) == [0, 1, 2, 3, 4]
    parted = cut(df.withColumn("y", df.x % 2), "y")
    assert sorted(r.x for r in parted.where("y = 1").collect()) == [1, 3]
    assert "Range" not in got._jdf.queryExecution().logical().toString()


def test_ranks(spark):
    from workloom.runtime import ranked, ranked_within

    rows = [(k * 7 % 101, "hot" if k % 3 else (str(k % 5) if k % 2 else None)) for k in range(101)]
    df = spark.createDataFrame([*rows], "x int, g string")
    assert {r.x: r.rank for r in ranked(df, "x").collect()} == {k: k + 1 for k in range(101)}
    for hot_rows in (1_000, 20, 0):  # no, one and all groups are hot
        got = {r.x: (r.rank, r.size) for r in ranked_within(df, ("g",), ("x",), hot_rows=hot_rows).collect()}
        for g in {g for _, g in rows}:
            own = sorted(x for x, h in rows if h == g)
            assert [got[x] for x in own] == [(k, len(own)) for k in range(1, len(own) + 1)]
    assert ranked(df.limit(0), "x").isEmpty()


def test_release(spark, tmp_path):
    from workloom import runtime

    path = runtime.cut(spark.range(3)).inputFiles()[0]
    assert runtime.exists(spark, path) and not runtime.exists(spark, f"file://{tmp_path}/no")
    runtime.release()
    assert not runtime.exists(spark, path)
