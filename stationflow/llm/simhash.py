"""Near duplicates: 64-bit SimHash of three-word shingles, linked through pigeonring chains.

A fingerprint is cut into a ring of five segments. If two fingerprints differ in
at most ``tau`` bits, then from some segment on every chain of 1, 2, ... 5
consecutive segments differs in at most ``tau * length / 5`` bits. With tau = 2
a chain therefore starts with two equal segments (26 or 25 bits: the join key)
and stays within 1, 1 and 2 differences afterwards: pairs that leave a budget
are dropped inside the join, before the full Hamming check.

A key shared by more than ``bucket`` different fingerprints is not paired.
Instead each of its fingerprints names itself and every fingerprint one flipped
bit away; two of them are within two bits exactly if they name a common one,
and all that name it are linked to the smallest. That is exact and linear.

Copies never reach the join: fingerprints are made distinct first.

Defined results: null and blank texts have fingerprint zero; texts of one or two
words are one shingle. Rows with equal ids are separate rows with one answer
each. A null id never names a component: it is the smallest non-null id, null
only if all are null. Other columns are ignored by ``near_groups`` and kept by
``keep_one``, also those with the names used here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.components import components
from stationflow.llm.support import staged, utf8

SHINGLE = 3
SEED = 42
TAU = 2
WIDTHS = (13, 13, 13, 13, 12)
BUCKET = 64
_LINE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text in UTF-8 as an unsigned number; A-Z count as a-z."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
        total = 1
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        total = len(words) - shingle + 1
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(line[a:b], SEED) for a, b in zip(starts[:total].tolist(), ends[shingle - 1:].tolist())), np.uint64, total)
    counts = np.zeros(64)
    for at in range(0, total, _LINE):  # sums of so many ones are whole numbers in float32
        bits = np.unpackbits(hashes[at:at + _LINE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += np.ones(len(bits), np.float32) @ bits.astype(np.float32)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


@F.arrow_udf(T.LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t) for t in utf8(texts)], np.uint64).view(np.int64))


def _chains(prints: DataFrame) -> DataFrame:
    """Five rows per fingerprint: key (start and its two equal segments), then the other segments c1 to c3 in ring order."""
    starts = np.concatenate([[0], np.cumsum(WIDTHS)]).tolist()
    segment = [F.shiftrightunsigned("fp", 64 - starts[i + 1]).bitwiseAND(F.lit((1 << w) - 1)) for i, w in enumerate(WIDTHS)]
    ring = len(WIDTHS)
    rows = []
    for i in range(ring):
        s = [segment[(i + j) % ring] for j in range(ring)]
        key = F.lit(i << 26).bitwiseOR(F.shiftleft(s[0], 13)).bitwiseOR(s[1])
        rows.append(F.struct(key.alias("key"), s[2].alias("c1"), s[3].alias("c2"), s[4].alias("c3")))
    return prints.select("fp", F.inline(F.array(*rows)))


def _differ(name: str) -> F.Column:
    return F.bit_count(F.col(f"x.{name}").bitwiseXOR(F.col(f"y.{name}")))


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that join all of ``prints`` (one distinct column fp) within TAU bits of each other."""
    chains = staged(_chains(prints), "chains")
    sizes = staged(chains.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    few = staged(chains.join(sizes.where(F.col("n") <= bucket), "key", "left_semi"), "few")
    ring = len(WIDTHS)
    budget = [TAU * length // ring for length in range(1, ring + 1)]
    viable = (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
        & (_differ("c1") <= budget[2]) & (_differ("c1") + _differ("c2") <= budget[3])
        & (_differ("c1") + _differ("c2") + _differ("c3") <= budget[4])
    )
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= TAU
    pairs = few.alias("x").join(few.alias("y"), viable).where(near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    crowded = chains.join(sizes.where(F.col("n") > bucket), "key", "left_semi").select("fp").distinct()
    flips = F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))")
    named = staged(crowded.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("hub")), "named")
    hubs = named.groupBy("hub").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b")
    hubs = staged(hubs.select("hub", "a"), "hubs")
    stars = named.join(hubs, "hub").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(stars)


def prints_of(docs: DataFrame, id_name: str, text_name: str) -> DataFrame:
    return docs.select(F.col(id_name).alias("_id"), fingerprints(F.col(text_name)).alias("fp"))


def _classes(prints: DataFrame, bucket: int) -> DataFrame:
    """(fp, first): the smallest id reachable from each fingerprint."""
    unique = staged(prints.groupBy("fp").agg(F.min("_id").alias("low")), "prints")
    roots = staged(components(links(unique.select("fp"), bucket)), "roots")
    member = unique.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    first = staged(member.groupBy("root").agg(F.min("low").alias("first")), "first")
    return staged(member.join(first, "root").select("fp", "first"), "classes")


def near_groups(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id."""
    prints = staged(prints_of(docs, id_name, text_name), "fingerprints")
    return prints.join(_classes(prints, bucket), "fp").select(
        F.col("_id").alias(id_name), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with their columns.

    Rows with the same id, or without one, are judged together: they stay if any of them is the smallest.
    """
    prints = staged(prints_of(docs, id_name, text_name), "fingerprints")
    judged = prints.join(_classes(prints, bucket), "fp").select("_id", F.col("_id").eqNullSafe(F.col("first")).alias("kept"))
    lost = staged(judged.groupBy("_id").agg(F.bool_or("kept").alias("kept")).where("not kept").select("_id"), "lost")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), F.col(id_name).alias("_own"))
    return packed.join(lost, F.col("_own").eqNullSafe(F.col("_id")), "left_anti").select("_doc.*")
