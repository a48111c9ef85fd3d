"""Exact top-k search among binary codes by multi-index hashing.

An embedding becomes a 64-bit code: bit i is set if component i is positive.
Codes are made distinct and dealt into blocks; each block indexes its codes by
m segments. A query looks up all values within radius 0, 1, 2, ... of its own
in segment after segment and verifies what it finds. A code not yet found
differs by more than the radius in every segment looked up, and by at least the
radius in the others, which bounds its distance from below; the query is done
when its k-th verified distance lies below that bound.

Blocks of codes and blocks of queries meet pairwise, so a task holds one of
each, however many there are. Each pair yields the k best of its block; the best
of those are the best of all.

A code shared by many rows is searched once; its rows come back in the order of
their ids, and of them no more than the k + 1 smallest can ever be wanted.

Defined results: neighbours are ranked by distance, then by id. A query's own
row is no neighbour of its own; other rows with the same code are, at distance
0. Rows whose id or embedding is null are left out. Of rows with the same id and
code one is kept; an id with several codes is several rows. Missing components count as
not positive, those beyond the 64th are ignored. Other columns are ignored. A
table with fewer than k other rows gives all of them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.support import staged

BITS = 64
BLOCK_CODES = 1 << 15
BLOCK_QUERIES = 1 << 11


def code_of(embedding: Column) -> Column:
    """Signs of the first 64 components, the first as the highest bit."""
    bits = [F.when(F.get(embedding, F.lit(i)) > 0, F.lit(_signed(1 << (BITS - 1 - i)))).otherwise(F.lit(0).cast("long")) for i in range(BITS)]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return bits[0]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _flips(width: int, radius: int) -> np.ndarray:
    """All masks of so many set bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


class MultiIndex:
    """Codes of one block, sorted by each of their segments."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        # segments about as wide as the number of codes has bits: one code per value on average
        self.parts = max(2, -(-BITS // max(4, int(np.log2(max(len(codes), 2))))))
        edges = [round(i * BITS / self.parts) for i in range(self.parts + 1)]
        self.widths = np.diff(edges).tolist()
        self.shifts = [BITS - e for e in edges[1:]]
        self.values = [self.segment(codes, j) for j in range(self.parts)]
        self.order = [np.argsort(v, kind="stable") for v in self.values]
        self.sorted = [v[o] for v, o in zip(self.values, self.order)]

    def segment(self, codes: np.ndarray, j: int) -> np.ndarray:
        return ((codes >> np.uint64(self.shifts[j])) & np.uint64((1 << self.widths[j]) - 1)).astype(np.int64)

    def search(self, query: np.uint64, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of the nearest codes that hold ``k`` rows, ``wanted`` being the rows of each; ties of the last are all kept."""
        seen = np.zeros(len(self.codes), bool)
        places, distances = np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = [int(self.segment(np.array([query]), j)[0]) for j in range(self.parts)]
        for radius in range(max(self.widths) + 1):
            for j in range(self.parts):
                if radius <= self.widths[j]:
                    probes = own[j] ^ _flips(self.widths[j], radius)
                    low = np.searchsorted(self.sorted[j], probes, "left")
                    high = np.searchsorted(self.sorted[j], probes, "right")
                    many = high - low
                    at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                    found = self.order[j][at]
                    found = found[~seen[found]]
                    seen[found] = True
                    far = np.bitwise_count(self.codes[found] ^ query).astype(np.int64)
                    places, distances = np.concatenate([places, found]), np.concatenate([distances, far])
                # what is not found differs by radius + 1 or more in segments 0..j and by radius or more in the rest
                covered = self.parts * radius + j
                if wanted[places[distances <= covered]].sum() >= k:
                    order = np.argsort(distances, kind="stable")
                    rows = np.cumsum(wanted[places[order]])
                    last = distances[order][min(int(np.searchsorted(rows, k)), len(order) - 1)]
                    near = distances <= last
                    return places[near], distances[near]
        return places, distances


def _cell(k: int):
    """Per pair of blocks: the rows nearest to each query code."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codes = left.column("code").to_numpy().astype(np.int64).view(np.uint64)
        queries = right.column("code").to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        if len(codes) and len(queries):
            ids = left.column("ids").combine_chunks()
            offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            index, wanted = MultiIndex(codes), np.diff(offsets)
            for q in queries:
                # one row more than k, since the query's own row may be among them
                places, distances = index.search(np.int64(q).view(np.uint64), wanted, k + 1)
                many = wanted[places]
                at = np.repeat(offsets[places] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                found, far = flat[at], np.repeat(distances, many)
                best = np.lexsort((found, far))[:k + 1]
                for column, values in zip(out, (np.full(len(best), q), found[best], far[best])):
                    column.append(values)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["code", "neighbor", "distance"])

    return run


def top_k(rows: DataFrame, queries: Column, k: int = 10, id_name: str = "vec_id", embedding_name: str = "embedding") -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k rows nearest to each row for which ``queries`` holds."""
    named = rows.where(F.col(id_name).isNotNull() & F.col(embedding_name).isNotNull())
    coded = staged(named.select(
        F.col(id_name).cast("long").alias("id"), code_of(F.col(embedding_name)).alias("code"), F.coalesce(queries, F.lit(False)).alias("asks")), "codes")
    # of equal codes the k + 1 smallest ids: what a window keeps before it shuffles
    first = Window.partitionBy("code").orderBy("id")
    few = coded.select("id", "code").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    held = staged(few.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "held")
    asked = staged(coded.where("asks").select("code").distinct(), "asked")
    row_blocks = -(-held.count() // BLOCK_CODES) or 1
    query_blocks = -(-asked.count() // BLOCK_QUERIES) or 1
    deal = lambda n: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")
    left = held.withColumn("row_block", deal(row_blocks)).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = asked.withColumn("query_block", deal(query_blocks)).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    near = left.groupBy("row_block", "query_block").cogroup(right.groupBy("row_block", "query_block")).applyInArrow(
        _cell(k), "code long, neighbor long, distance long")
    by_code = Window.partitionBy("code").orderBy("distance", "neighbor")
    best = staged(near.withColumn("n", F.row_number().over(by_code)).where(F.col("n") <= k + 1).drop("n"), "near")
    asking = coded.where("asks").select(F.col("id").alias("query_id"), "code").distinct()
    pairs = asking.join(best, "code").where(~((F.col("query_id") == F.col("neighbor")) & (F.col("distance") == 0)))
    rank = F.row_number().over(Window.partitionBy("query_id", "code").orderBy("distance", "neighbor"))
    return pairs.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("neighbor").alias("neighbor_id"), "distance")
