"""Exact duplicates by two passes over a Bloom filter.

Pass one marks, for every text hash, the filter positions that at least two
rows touch. Pass two lets each row whose positions are not all marked go
straight through: no other row can have its text. Only the rest, true
duplicates and a few false alarms, is shuffled and grouped by SHA-256.

The filter never grows with the data: hashes are dealt into as many parts as
keep one part's filter within ``max_bits``, and the parts run one after the
other. Marks travel as 64-Kibit segments, sparse ones as lists, and are merged
as a stream, so a task holds its own segments and nothing else.

Defined results: a null text equals the empty text. Of equal texts the row with
the largest id stays, a null id counting as smallest; rows equal in id and text
are one document twice, and one of them stays. Extra columns are ignored by
``groups`` and kept by ``deduplicate``, also those with the names used here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.support import staged

SEGMENT_BITS = 1 << 16
BITS_PER_ROW = 16
MAX_BITS = 1 << 28
PROBES = 3


def filter_parts(rows: int, max_bits: int = MAX_BITS) -> tuple[int, int]:
    """(parts, bits of one part's filter) for so many rows."""
    wanted = max(SEGMENT_BITS, rows * BITS_PER_ROW)
    parts = -(-wanted // max_bits)
    bits = SEGMENT_BITS
    while bits < min(max_bits, -(-wanted // parts)):
        bits *= 2
    return parts, min(bits, max_bits)


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES positions for each hash, one row per probe."""
    h = hashes.astype(np.int64).view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(i) * high) % np.uint64(bits) for i in range(PROBES)]).astype(np.int64)


def _pack(offsets: np.ndarray) -> bytes:
    """Offsets in a segment as 16-bit numbers, or as a bit map where that is shorter."""
    if len(offsets) * 2 < SEGMENT_BITS // 8:
        return offsets.astype("<u2").tobytes()
    flags = np.zeros(SEGMENT_BITS, bool)
    flags[offsets] = True
    return np.packbits(flags).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if len(data) < SEGMENT_BITS // 8:
        flags = np.zeros(SEGMENT_BITS, bool)
        flags[np.frombuffer(data, "<u2")] = True
        return flags
    return np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)


def _touch(bits: int):
    """Per partition and segment: positions touched, and touched by two rows or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            # the probes of one row count once, so that a row never marks itself
            at = np.sort(_positions(batch.column(0).to_numpy(zero_copy_only=False), bits), axis=0)
            fresh = np.ones(at.shape, bool)
            fresh[1:] = at[1:] != at[:-1]
            found, counts = np.unique(at[fresh], return_counts=True)
            byte, mask = found >> 3, (128 >> (found & 7)).astype(np.uint8)
            again = (counts > 1) | ((once[byte] & mask) != 0)
            np.bitwise_or.at(twice, byte[again], mask[again])
            np.bitwise_or.at(once, byte, mask)
        step = SEGMENT_BITS // 8
        for k in np.unique(np.flatnonzero(once) // step):
            spans = [np.flatnonzero(np.unpackbits(x[k * step:(k + 1) * step])) for x in (once, twice)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(k)], pa.int32()), *(pa.array([_pack(s)], pa.binary()) for s in spans)],
                names=["segment", "once", "twice"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of one partition, merged row by row."""
    seen: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            once, twice = _unpack(once), _unpack(twice)
            if k in seen:
                twice = twice | seen[k][1] | (once & seen[k][0])
                once = once | seen[k][0]
            seen[k] = [once, twice]
    for k, (_, twice) in seen.items():
        if twice.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())],
                names=["segment", "twice"])


def repeated_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The marked positions of the one hash column of ``hashes``: ``bits / 8`` bytes, whatever the rows."""
    touched = hashes.mapInArrow(_touch(bits), "segment int, once binary, twice binary")
    merged = touched.repartition("segment").mapInArrow(_merge, "segment int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for k, twice in merged.toLocalIterator():
        out[k * SEGMENT_BITS // 8:(k + 1) * SEGMENT_BITS // 8] = np.frombuffer(twice, np.uint8)
    return out


def _may_repeat(df: DataFrame, hash_column: Column, marked: np.ndarray) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(marked.tobytes())

    @F.arrow_udf(T.BooleanType())
    def test(h: pa.Array) -> pa.Array:
        bits = np.frombuffer(shared.value, np.uint8)
        at = _positions(h.to_numpy(zero_copy_only=False), len(bits) * 8)
        return pa.array(((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0))

    return test(hash_column)


def split_repeats(df: DataFrame, hash_name: str, rows: int, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose hash may occur again, rows whose hash surely does not)."""
    parts, bits = filter_parts(rows, max_bits)
    again = once = None
    for part in range(parts):
        own = df.where(F.pmod(F.shiftright(hash_name, 7), F.lit(parts)) == part) if parts > 1 else df
        marked = repeated_filter(own.select(hash_name), bits)
        tested = own.withColumn("_again", _may_repeat(df, F.col(hash_name), marked))
        yes, no = tested.where("_again").drop("_again"), tested.where(~F.col("_again")).drop("_again")
        again, once = (yes, no) if again is None else (again.unionByName(yes), once.unionByName(no))
    return again, once


def groups(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col(text_name), F.lit(""))
    digests = staged(docs.select(
        F.col(id_name).alias("_id"), F.xxhash64(text).alias("_hash"), F.sha2(text, 256).alias("_sha"),
        F.monotonically_increasing_id().alias("_row"),
    ), "digests")
    again, once = split_repeats(digests, "_hash", digests.count(), max_bits)
    again = again.drop("_hash")
    best = staged(
        again.groupBy("_sha").agg(F.max(F.struct("_id", "_row")).alias("_best"), F.count("*").alias("_size")).where("_size > 1"),
        "repeats",
    )
    found = again.join(best, "_sha", "left").select(
        "_id", F.when(F.col("_best").isNull(), F.col("_id")).otherwise(F.col("_best._id")).alias("_keep"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("_size"),
        F.coalesce(F.col("_best._row") == F.col("_row"), F.lit(True)).alias("_kept"), "_sha",
    )
    single = once.select("_id", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_size"), F.lit(True).alias("_kept"), "_sha")
    return found.unionByName(single).toDF(id_name, "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns. Rows that pass the filter are never shuffled."""
    text = F.coalesce(F.col(text_name), F.lit(""))
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), F.col(id_name).alias("_id"),
        F.xxhash64(text).alias("_hash"), F.sha2(text, 256).alias("_sha"),
    )
    again, once = split_repeats(packed, "_hash", docs.count(), max_bits)
    best = staged(
        again.groupBy("_sha", "_id").agg(F.count("*").alias("_n"))
        .groupBy("_sha").agg(F.max(F.struct("_id", "_n")).alias("_best"), F.sum("_n").alias("_size")).where("_size > 1"),
        "repeats",
    )
    found = again.join(best, "_sha", "left").where(F.col("_best").isNull() | F.col("_id").eqNullSafe(F.col("_best._id")))
    twins = found.where("_best._n > 1").groupBy("_sha").agg(F.first("_doc").alias("_doc"))
    stay = found.where(F.col("_best").isNull() | (F.col("_best._n") == 1))
    return stay.select("_doc.*").unionByName(twins.select("_doc.*")).unionByName(once.select("_doc.*"))
