"""Session helpers: checked broadcasts, lineage cuts on shared storage, table reading."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows up to which a side of a join may be broadcast.
BROADCAST_ROWS = 200_000
#: Bytes of them, as JSON, up to which it may be.
BROADCAST_BYTES = 64 << 20
#: Rows of a group up to which one task numbers them.
HOT_GROUP_ROWS = 1_000_000


def local_session(name: str = "workloom", cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster, use the cluster's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it is proven to have at most max_rows rows of max_bytes in all, else df as it is.

    The proof reads max_rows + 1 rows at most. Without the hint Spark joins by shuffle, so the result is the
    same for a side of any size.
    """
    size = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    rows, held = df.limit(max_rows + 1).select(size.alias("size")).agg(F.count(F.lit(1)), F.sum("size")).first()
    return F.broadcast(df) if rows <= max_rows and (held or 0) <= max_bytes else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where it is unset."""
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir")
    if given:
        return given
    jsc = sc._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="workloom-"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: a lineage cut that survives lost executors.

    partition_by: columns by whose values the files are kept apart, so that a filter on them reads its own only. The
    files are deleted when the driver's Python ends, or by release().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/workloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


#: The folders that cut() wrote.
_WRITTEN: list[tuple[SparkSession, str]] = []


def release() -> None:
    """Deletes the files of all cuts so far, for long sessions; DataFrames made with them can't be read any more."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, on whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


@atexit.register
def _release_at_exit() -> None:
    try:
        release()
    except Exception:  # the JVM is gone already
        pass


def ranked(df: DataFrame, *order: str, rank: str = "rank") -> DataFrame:
    """df with its row numbers from 1 in the order of the columns, which must be a total one.

    Rows are dealt to ranges of the order and numbered within each; no task holds more than its range.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"))  # one row per range
    own = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return ranged.join(F.broadcast(before), "_range").withColumn(rank, own + F.col("_before")).drop("_range", "_before")


def ranked_within(df: DataFrame, group: tuple[str, ...], order: tuple[str, ...], rank: str = "rank", size: str = "size", hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """df with row numbers from 1 within each group, and the size of the group.

    Groups of up to hot_rows rows are numbered by one window; larger ones are dealt to ranges of their order, so
    that no task holds one whole. The numbers are the same both ways, as the order is a total one.
    """
    within = W.partitionBy(*group)
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = sizes.select(*(F.col(g).alias(f"_g_{g}") for g in group), "_n")
    if hot.isEmpty():
        return df.withColumns({rank: F.row_number().over(within.orderBy(*order)).cast("long"), size: F.count(F.lit(1)).over(within)})
    hot = cut(hot)
    side = small_side(hot)

    def is_hot(rows: DataFrame, how: str) -> DataFrame:
        return rows.join(side, reduce(lambda x, y: x & y, (rows[g].eqNullSafe(F.col(f"_g_{g}")) for g in group)), how)

    few = is_hot(df, "left_anti").withColumns({rank: F.row_number().over(within.orderBy(*order)).cast("long"), size: F.count(F.lit(1)).over(within)})
    numbered = ranked(is_hot(df, "left_semi"), *group, *order, rank="_at")
    firsts = small_side(cut(numbered.groupBy(*(F.col(g).alias(f"_f_{g}") for g in group)).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias(size))))
    same = reduce(lambda x, y: x & y, (numbered[g].eqNullSafe(F.col(f"_f_{g}")) for g in group))
    many = numbered.join(firsts, same).withColumn(rank, F.col("_at") - F.col("_first") + 1)
    return few.unionByName(many.select(*df.columns, rank, size))
