"""Frequency of every term in a vertical layout: a compressed bitmap of record ids for each term.

The bitmaps follow the public roaring layout: ids are split into a high part and a low part of 16 bits; a
container holds the low parts of one high part, as sorted 16-bit numbers, or as 8 KB of bits once that is
smaller. The high parts and sizes of all containers come first, then the containers. Workers build bitmaps of what they read (the map-side part), bitmaps of one term and shard are
merged by union, and the number of records is the cardinality. A shard is a range of 2^26 ids, so that no
union has more than 8 MB, however hot its term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.runtime import cut, small_side

SHARD_BITS = 26
#: Rows a worker gathers before it hands on their bitmaps.
GATHERED_ROWS = 2_000_000
_ARRAY_MOST = 4096


def pack(low: np.ndarray) -> bytes:
    """Bitmap of sorted distinct ids within a shard."""
    high = low >> 16
    start = np.flatnonzero(np.diff(high, prepend=-1)) if len(low) else np.empty(0, "i8")
    sizes = np.diff(start, append=len(low))
    head = np.concatenate([[len(start)], high[start], sizes]).astype("<u4").tobytes()
    part, out, done = (low & 0xFFFF).astype("<u2"), [head], 0
    for k in np.flatnonzero(sizes > _ARRAY_MOST).tolist():
        first, last = int(start[k]), int(start[k] + sizes[k])
        bits = np.zeros(65536, "u1")
        bits[part[first:last]] = 1
        out += [part[done:first].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
        done = last
    return b"".join([*out, part[done:].tobytes()])


def _head(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """High parts and sizes of the containers, and where these begin."""
    count = int(np.frombuffer(data, "<u4", 1)[0])
    high, sizes = np.frombuffer(data, "<u4", 2 * count, 4).astype("i8").reshape(2, count)
    return high, sizes, 4 + 8 * count


def unpack(data: bytes) -> np.ndarray:
    """The sorted ids of a bitmap."""
    high, sizes, at = _head(data)
    low, done, filled = np.empty(int(sizes.sum()), "i8"), 0, 0
    for k in [*np.flatnonzero(sizes > _ARRAY_MOST).tolist(), len(sizes)]:
        n = int(sizes[done:k].sum())
        low[filled : filled + n] = np.frombuffer(data, "<u2", n, at)
        at, filled = at + 2 * n, filled + n
        if k < len(sizes):
            low[filled : filled + int(sizes[k])] = np.flatnonzero(np.unpackbits(np.frombuffer(data, "u1", 8192, at), bitorder="little"))
            at, filled, done = at + 8192, filled + int(sizes[k]), k + 1
    return low + np.repeat(high << 16, sizes)


def cardinality(data: bytes) -> int:
    return int(_head(data)[1].sum())


def union(parts: list[bytes]) -> bytes:
    if len(parts) == 1:
        return parts[0]
    ids = np.concatenate([unpack(p) for p in parts])
    ids.sort(kind="stable")  # merges the runs
    return pack(ids[np.diff(ids, prepend=-1) > 0])


_SCHEMA = "whole boolean, term_key long, shard long, occurrences long, bitmap binary"


def _emit(keys: np.ndarray, ids: np.ndarray, whole: bool) -> pa.RecordBatch:
    """A bitmap for each key and shard of the rows; whole: for each shard alone, under the key 0."""
    order = np.argsort(ids, kind="stable") if whole else np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    shards = ids >> SHARD_BITS
    edge = np.ones(len(keys), bool)
    edge[1:] = (keys[1:] != keys[:-1]) | (shards[1:] != shards[:-1])
    start = np.flatnonzero(edge)
    bounds = [*start.tolist(), len(keys)]
    low = ids - (shards << SHARD_BITS)
    bitmaps = [pack(low[a:b][new[a:b]]) for a, b in zip(bounds, bounds[1:])]
    kind = pa.array(np.full(len(start), whole))
    return pa.RecordBatch.from_arrays([kind, pa.array(keys[start]), pa.array(shards[start]), pa.array(np.diff(bounds).astype("i8")), pa.array(bitmaps, pa.binary())], names=["whole", "term_key", "shard", "occurrences", "bitmap"])


def _slices(batch: pa.RecordBatch, bytes_most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose bitmaps stay small enough for one Arrow message."""
    step = max(1, int(batch.num_rows * bytes_most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _build(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Bitmaps of the rows (key or null, record); whole: those of all their records too."""
    keys, ids, all_ids, held = [], [], [], 0

    def emitted() -> Iterator[pa.RecordBatch]:
        if sum(map(len, keys)):
            yield from _slices(_emit(np.concatenate(keys), np.concatenate(ids), False))
        if whole:
            every = np.concatenate(all_ids)
            yield from _slices(_emit(np.zeros(len(every), "i8"), every, True))

    for batch in batches:
        key, record = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        known = ~key.is_null().to_numpy(zero_copy_only=False)
        keys.append(key.fill_null(0).to_numpy(zero_copy_only=False)[known])
        ids.append(record[known])
        if whole:
            all_ids.append(record)
        held += batch.num_rows
        if held >= GATHERED_ROWS:
            yield from emitted()
            keys, ids, all_ids, held = [], [], [], 0
    if held:
        yield from emitted()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unions of rows that come sorted by term and shard; holds one union at a time."""
    key, held, occurrences = None, b"", 0
    waiting: list[bytes] = []
    done: list[tuple] = []
    for batch in batches:
        for *at, n, bitmap in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if at != key:
                if key is not None:
                    held = union([held, *waiting] if held else waiting)
                    done.append((*key, occurrences, cardinality(held)))
                key, held, occurrences, waiting = at, b"", 0, []
            occurrences += n
            waiting.append(bitmap)
            if sum(map(len, waiting[-64:])) > 4 << 20 or len(waiting) >= 64:
                held, waiting = union([held, *waiting] if held else waiting), []
        if len(done) >= 10_000:
            yield _rows(done)
            done = []
    if key is not None:
        done.append((*key, occurrences, cardinality(union([held, *waiting] if held else waiting))))
    if done:
        yield _rows(done)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), kinds)], names=["whole", "term_key", "shard", "occurrences", "records"])


def bitmap_frequencies(rows: DataFrame, key: str, record: str, whole: bool = False) -> DataFrame:
    """term_key, occurrences, records: rows and distinct records of each key (both integers); null keys and records count nowhere.

    whole: one row more, with a null term_key, for all rows whose record isn't null, of whatever key.
    """
    given = rows.select(F.col(key).cast("long").alias("term_key"), F.col(record).cast("long").alias("record")).where("record is not null")
    built = (given if whole else given.where("term_key is not null")).mapInArrow(lambda batches: _build(batches, whole), _SCHEMA)
    by = ("whole", "term_key", "shard")
    merged = built.repartition(*by).sortWithinPartitions(*by).mapInArrow(_merge, "whole boolean, term_key long, shard long, occurrences long, records long")
    summed = merged.groupBy("whole", "term_key").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    return summed.select(F.when(~F.col("whole"), F.col("term_key")).alias("term_key"), "occurrences", "records")


def normal_term(name) -> F.Column:
    """Lower case, trimmed, each run of white space one blank."""
    return F.trim(F.regexp_replace(F.lower(F.col(name) if isinstance(name, str) else name), r"(?U)\s+", " "))


def term_frequencies(rows: DataFrame, record: str, item: str, names: DataFrame, name_id: str, name: str, rare_below: int = 5, common_above: float = 0.05) -> DataFrame:
    """term, occurrences, records, total_records, mark: how often each term of names occurs in rows and in how many records.

    A term is a name in lower case, trimmed, with each run of white space one blank; several ids may share a
    term, and a record counts once for it. mark is rare under rare_below records (also for terms that never
    occur), common above the share common_above of the distinct records of all rows, else null. Null names
    are no terms, rows with null records count nowhere; rows with null or unknown items count for the total.
    """
    named = names.select(F.col(name_id).alias("_id"), normal_term(name).alias("term")).where("term is not null")
    terms = named.groupBy("term").agg(F.min("_id").cast("long").alias("term_key"))
    lookup = small_side(named.join(terms, "term").where("_id is not null").select(F.col("_id").alias("_item"), "term_key").distinct())
    given = rows.select(F.col(record).alias("record"), F.col(item).alias("_item"))
    found = cut(bitmap_frequencies(given.join(lookup, "_item", "left"), "term_key", "record", whole=True))  # one row a term
    total = found.where("term_key is null").agg(F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"))
    counted = terms.join(found.where("term_key is not null"), "term_key", "left").crossJoin(F.broadcast(total))
    records = F.coalesce("records", F.lit(0))
    mark = F.when(records < rare_below, "rare").when(records > common_above * F.col("total_records"), "common")
    return counted.select("term", F.coalesce("occurrences", F.lit(0)).alias("occurrences"), records.alias("records"), "total_records", mark.alias("mark"))
