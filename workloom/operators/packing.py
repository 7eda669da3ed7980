"""Packing of postings into batches of similar ones, with ids from their content; sessions and the plan of batches.

Each stage chunks the groups of a key; full chunks are emitted, the tails flow over to the next stage, and what
is left at the end is chunked as it comes. The order within a group is a total one, so packing is repeatable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.functions import scalars as S
from workloom.runtime import cut, ranked, ranked_within


@dataclass(frozen=True)
class Stage:
    kind: str
    group: tuple[str, ...]
    order: tuple[str, ...]


MATCHED = (Stage("co_noc", ("company", "noc"), ("ord",)), Stage("noc", ("noc",), ("company", "ord")))
UNMATCHED = (Stage("co", ("company",), ("ord",)),)
MATCHED_REST, UNMATCHED_REST = ("noc", "company", "ord"), ("company", "ord")


def pack(df: DataFrame, stages: tuple[Stage, ...], rest_order: tuple[str, ...], size: int) -> DataFrame:
    """df (company, noc, ord, id) with kind, group_no and chunk: the batch of each row.

    Groups are numbered by ranges of their order, so that no task holds a hot company or the whole rest.
    """
    left, done = df.withColumns({"company": F.coalesce("company", F.lit("")), "noc": F.coalesce("noc", F.lit(0))}), None
    for stage in stages:
        within = ranked_within(left, stage.group, stage.order)
        chunk = F.floor((F.col("rank") - 1) / size).cast("int")
        numbered = cut(within.withColumn("chunk", chunk).withColumn("full", (F.col("chunk") + 1) * size <= F.col("size")).drop("rank", "size"))
        emitted = numbered.where("full").withColumn("kind", F.lit(stage.kind)).drop("full")
        done = emitted if done is None else done.unionByName(emitted)
        left = numbered.where("not full").drop("full", "chunk")
    rest = ranked(left, *rest_order).withColumn("chunk", F.floor((F.col("rank") - 1) / size).cast("int")).withColumn("kind", F.lit("rem")).drop("rank")
    return done.unionByName(rest)


def pack_matched(df: DataFrame, size: int = 10) -> DataFrame:
    return pack(df, MATCHED, MATCHED_REST, size)


def pack_unmatched(df: DataFrame, size: int = 5) -> DataFrame:
    return pack(df, UNMATCHED, UNMATCHED_REST, size)


def _prefix() -> Column:
    return (
        F.when(F.col("kind") == "co_noc", F.concat(F.lit("co_noc_"), S.safe_name(F.col("company"))))
        .when(F.col("kind") == "noc", F.concat(F.lit("noc_"), F.col("noc").cast("string")))
        .when(F.col("kind") == "co", F.concat(F.lit("co_"), S.safe_name(F.col("company"))))
        .otherwise("rem")
    )


def batches(packed: DataFrame) -> DataFrame:
    """batch_id, kind, n_rows, ids (in order) of each batch."""
    company = F.when(F.col("kind").isin("co_noc", "co"), F.col("company")).otherwise("")
    noc = F.when(F.col("kind").isin("co_noc", "noc"), F.col("noc")).otherwise(0)
    grouped = packed.groupBy("kind", company.alias("company"), noc.alias("noc"), "chunk").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return grouped.select(F.concat_ws("_", _prefix(), S.content_hash(F.col("ids"))).alias("batch_id"), "kind", F.size("ids").alias("n_rows"), "ids")


def batch_plan(made: DataFrame) -> DataFrame:
    """Batches and rows of each kind."""
    return made.groupBy("kind").agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n_rows").alias("n_rows"))


def capacity(n_calls: Column, per_session: int = 800, delay_s: int = 5, call_s: int = 6, cooldown_min: int = 90) -> Column:
    """struct(sessions, hours): sessions of per_session calls with a pause between them."""
    sessions = F.ceil(n_calls / per_session)
    hours = n_calls * (delay_s + call_s) / 3600 + (sessions - 1) * cooldown_min / 60
    return F.struct(sessions.alias("sessions"), hours.alias("hours"))


def sessions(made: DataFrame, per_session: int) -> DataFrame:
    """made with session_no: consecutive groups of per_session batches in the order of their ids."""
    return ranked(made, "batch_id").withColumn("session_no", F.floor((F.col("rank") - 1) / per_session).cast("int")).drop("rank")


def undone(made: DataFrame, done: DataFrame) -> DataFrame:
    """Batches with any id that isn't done yet (done: id); they are run again whole."""
    open_ids = made.select("batch_id", F.explode("ids").alias("id")).join(done.select("id").distinct(), "id", "left_anti")
    return made.join(open_ids.select("batch_id").distinct(), "batch_id", "left_semi")
