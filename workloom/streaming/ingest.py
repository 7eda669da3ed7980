"""Incremental ingestion of files as a stream that handles what is new and ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def ingest_new(spark: SparkSession, source: str, schema: T.StructType, target: str, state: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Appends the transformed rows of the Parquet files in source that weren't handled before to target.

    state, a folder all executors share, remembers the files; a run that broke off is taken up where it stopped.
    """
    read = spark.readStream.schema(schema).parquet(source)
    return transform(read).writeStream.format("parquet").option("path", target).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
