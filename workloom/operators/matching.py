"""Nearest reference by cosine similarity of embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workloom.runtime import cut, ranked

#: References in one matrix, and matrices that the workers hold at a time.
BLOCK_ROWS, PASS_BLOCKS = 20_000, 4


def nearest_reference(queries: DataFrame, references: DataFrame, ident: str, vector: str, reference_id: str, reference_vector: str, threshold: float = 0.75, keep_scores: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """queries with match_id and match_score: the reference of greatest cosine, the least id at ties.

    The references are multiplied block by block, as matrices of block_rows rows in the order of their ids; each row
    of queries carries the best one so far from block to block, so rows with equal or null idents (ident names
    them for the reader only) don't meet, and a list of any length is treated alike. PASS_BLOCKS blocks are
    with the workers at a time; a longer list takes more passes over the queries. Cosines are compared to twelve
    digits, a tie goes to the least id; the threshold is held against the unrounded one. Below it match_id is
    null, and so is the score unless keep_scores. Null vectors and an empty list of references give nulls.
    Columns of queries called match_id or match_score are replaced.
    """
    kept = [c for c in queries.columns if c not in ("match_id", "match_score")]
    blank = queries.select(*kept, F.lit(None).cast("long").alias("_rid"), F.lit(None).cast("double").alias("_score"))
    listed = references.select(F.col(reference_id).cast("long").alias("rid"), F.col(reference_vector).alias("rvec")).where("rid is not null and rvec is not null")
    held = listed.limit(block_rows + 1).collect()  # the only block, of a short list
    if len(held) <= block_rows:
        matched = _improved(blank, [_matrix(held)], vector)
    else:
        numbered = cut(ranked(listed, "rid", "rvec").withColumn("block", F.floor((F.col("rank") - 1) / block_rows).cast("int")).drop("rank"), "block")
        n_blocks = numbered.agg(F.max("block")).first()[0] + 1
        matched = blank
        for first in range(0, n_blocks, PASS_BLOCKS):
            blocks = [_matrix(numbered.where(F.col("block") == k).collect()) for k in range(first, min(first + PASS_BLOCKS, n_blocks))]
            matched = cut(_improved(matched, blocks, vector))
    hit, score = F.col("_score") >= threshold, F.round("_score", 4)
    return matched.select(*kept, F.when(hit, F.col("_rid")).alias("match_id"), (score if keep_scores else F.when(hit, score)).alias("match_score"))


def _matrix(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """The ids of references, ascending, and their vectors over their norms."""
    rows = sorted(rows, key=lambda r: r.rid)
    matrix = np.array([r.rvec for r in rows], "f8") if rows else np.zeros((0, 1))
    return np.array([r.rid for r in rows], "i8"), matrix / (np.linalg.norm(matrix, axis=1) + 1e-10)[:, None]


def _improved(queries: DataFrame, blocks: list[tuple[np.ndarray, np.ndarray]], vector: str) -> DataFrame:
    """queries (with _rid and _score, the best so far) with the best of these blocks where it is better."""
    held = queries.sparkSession.sparkContext.broadcast(blocks)
    at = queries.columns.index(vector)
    schema = T.StructType([*queries.schema.fields[:-2], T.StructField("_rid", T.LongType()), T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, n = batch.column(at), batch.num_rows
            there = given.is_valid().to_numpy(zero_copy_only=False)
            best = batch.column(n_columns - 2).fill_null(0).to_numpy(zero_copy_only=False).copy()
            found = batch.column(n_columns - 1).is_valid().to_numpy(zero_copy_only=False).copy()
            score = batch.column(n_columns - 1).fill_null(-np.inf).to_numpy(zero_copy_only=False).copy()
            if there.any():
                x = np.array(given.filter(pa.array(there)).to_pylist(), "f8")
                unit, rows = x / (np.linalg.norm(x, axis=1) + 1e-10)[:, None], np.flatnonzero(there)
                for ids, matrix in held.value:
                    if len(ids):
                        cosine = unit @ matrix.T
                        first = np.round(cosine, 12).argmax(1)
                        new = cosine[np.arange(len(rows)), first]
                        better = ~found[rows] | (np.round(new, 12) > np.round(score[rows], 12))
                        best[rows[better]], score[rows[better]], found[rows[better]] = ids[first[better]], new[better], True
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(best, pa.int64(), mask=~found), pa.array(score, pa.float64(), mask=~found)], names=batch.schema.names)

    n_columns = len(queries.columns)
    return queries.mapInArrow(run, schema)
