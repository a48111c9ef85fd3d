"""Substring de-duplication: passages of many words that repeat across documents, by difference-cover anchors.

A window is ``words`` (50) consecutive words. Two equal windows may stand at any
two places, so anchors cannot stand at multiples of a period. They stand where
the word's place modulo ``PERIOD`` is in a difference cover: for any two places
there is a shift below the period that takes both into the cover. So two equal
windows have an anchor of ``words - PERIOD + 1`` words at the same offset in
both, though only 5 places of 21 are hashed.

1. Anchors that occur in more than one document are found by an aggregate with
   map-side combine, and joined back to the places that hold them.
2. Around each shared anchor the match is extended: all windows that contain it
   are hashed whole (96 bits), and for each the smallest document is found.
   Where nothing is shared, no window is ever formed.
3. A window that also starts in a smaller document has its words removed.

Every step is an aggregate with map-side combine or a join on hashes. What a
passage shared by many documents would gather in one task of a join never gets
there: of all keys, the ``HOT`` ones with the most rows are broadcast to the
rows, and only the other keys' rows are shuffled. Rows meet their own results by
id and a hash of the text, so nothing depends on the order in which a table is
read.

Defined results: a null text has no words. A null id counts as smaller than any
other; rows that share an id are one document, so they never remove words of
each other. Texts of fewer words than a window keep all of them. Rows that are
equal in id and text get equal results. Other columns are kept in ``_doc``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import wordhash
from stationflow.llm.support import joined, settled, slices

WORDS = 50
HOT = 1 << 16
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # every difference modulo 21 is one of two members
NO_ID = -(2 ** 63)
_ANCHOR, _LOW, _HIGH = (wordhash.Powers(b) for b in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xB564EF22EC7AECE5))

KEY = "id long, own long"
Batches = Iterator[pa.RecordBatch]


def cover_for(words: int) -> tuple[int, tuple[int, ...]]:
    """(period, cover) for windows of so many words: the period is below the window's length."""
    return (PERIOD, COVER) if words > PERIOD else (1, (0,))


def _keyed(docs: DataFrame, id_name: str, text_name: str) -> DataFrame:
    return docs.select(*_key(F.col(f"`{id_name}`"), F.col(f"`{text_name}`")), F.col(f"`{text_name}`").alias("text"))


def _key(id_: Column, text: Column) -> list[Column]:
    return [F.coalesce(id_.cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("own")]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _rows(batch: pa.RecordBatch, row: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """The keys of these rows, with more columns."""
    keys = [pa.array(batch.column(c).to_numpy(zero_copy_only=False)[row]) for c in ("id", "own")]
    return pa.RecordBatch.from_arrays([*keys, *(pa.array(c) for c in columns.values())], names=["id", "own", *columns])


def _anchors(words: int) -> Callable[[Batches], Batches]:
    """(id, own, at, anchor) of all anchors of all texts."""
    period, cover = cover_for(words)
    length = words - period + 1

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, 2):
                hashes, first = wordhash.word_hashes(_texts(batch))
                count = np.diff(first)
                row = np.repeat(np.arange(len(count)), count)
                at = np.arange(len(hashes)) - first[row]
                here = np.flatnonzero(np.isin(at % period, cover) & (at + length <= count[row]) & (count[row] >= words))
                yield _rows(batch, row[here], at=at[here].astype(np.int32), anchor=wordhash.Runs(hashes, _ANCHOR).at(here, length).view(np.int64))

    return run


def _windows(words: int) -> Callable[[Batches], Batches]:
    """(id, own, at, low, high) of all windows around the anchors in column ``at``."""
    period, _ = cover_for(words)

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, 2):
                hashes, first = wordhash.word_hashes(_texts(batch))
                marks = batch.column("at")
                row = np.repeat(np.arange(batch.num_rows), np.diff(marks.offsets.to_numpy()))
                at = marks.flatten().to_numpy().astype(np.int64)
                start = np.maximum(at - period + 1, 0)
                stop = np.minimum(at, first[row + 1] - first[row] - words)
                # how many anchors' ranges of window starts cover each place
                depth = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(depth, first[row] + start, 1)
                np.add.at(depth, first[row] + stop + 1, -1)
                here = np.flatnonzero(np.cumsum(depth) > 0)
                row = np.searchsorted(first, here, "right") - 1
                yield _rows(
                    batch, row, at=(here - first[row]).astype(np.int32),
                    low=wordhash.Runs(hashes, _LOW).at(here, words).view(np.int64),
                    high=(wordhash.Runs(wordhash.mixed(hashes), _HIGH).at(here, words) >> np.uint64(32)).astype(np.uint32).view(np.int32))

    return run


def _meet(rows: DataFrame, groups: DataFrame, keys: list[str], hot: int) -> DataFrame:
    """``rows`` joined with ``groups`` (keys, ..., n) on ``keys``; the ``hot`` groups with the largest n without a shuffle of their rows."""
    top = F.broadcast(groups.orderBy(F.desc("n"), *keys).limit(hot))
    return rows.join(top, keys).union(rows.join(top.select(keys), keys, "left_anti").join(groups, keys))


def repeats(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", words: int = WORDS, hot: int = HOT) -> DataFrame:
    """(id, own, starts): by key of a row, where windows start in it that also start in a document with a smaller id."""
    keyed = _keyed(docs, id_name, text_name)
    ends = F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n")
    anchors = keyed.mapInArrow(_anchors(words), f"{KEY}, at int, anchor long")
    shared = settled(anchors.groupBy("anchor").agg(*ends).where("least < most").select("anchor", "n"), "shared")
    marks = settled(_meet(anchors, shared, ["anchor"], hot).groupBy("id", "own").agg(F.collect_set("at").alias("at")), "anchors")
    windows = settled(keyed.join(marks, ["id", "own"]).mapInArrow(_windows(words), f"{KEY}, at int, low long, high int"), "windows")
    first = settled(windows.groupBy("low", "high").agg(*ends).where("least < most").select("low", "high", "least", "n"), "first")
    later = _meet(windows, first, ["low", "high"], hot).where("id > least")
    return settled(later.groupBy("id", "own").agg(F.collect_set("at").alias("starts")), "repeats")


def _cut(words: int):
    kind = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    @F.arrow_udf(kind)
    def cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
        parts = []
        for batch in slices(pa.RecordBatch.from_arrays([texts, starts], names=["text", "starts"]), 0):
            own = _texts(batch)
            data, offsets = joined([t + b" " for t in own])
            a, b = wordhash.spans(data)
            first = np.searchsorted(a, offsets)
            marks = batch.column("starts")
            counts = np.where(marks.is_null().to_numpy(zero_copy_only=False), 0, np.diff(marks.offsets.to_numpy()))
            at = first[np.repeat(np.arange(len(own)), counts)] + marks.flatten().to_numpy()
            depth = np.zeros(len(a) + 1, np.int64)
            np.add.at(depth, at, 1)
            np.add.at(depth, at + words, -1)
            gone = np.cumsum(depth[:-1]) > 0
            removed = np.concatenate([[0], np.cumsum(gone)])[first]
            stay, kept = ~gone, []
            for i in range(len(own)):
                lo, hi = first[i], first[i + 1]
                mine = stay[lo:hi]
                kept.append(b" ".join([own[i][s:e] for s, e in zip((a[lo:hi][mine] - offsets[i]).tolist(), (b[lo:hi][mine] - offsets[i]).tolist())]))
            parts.append(pa.StructArray.from_arrays(
                [pa.array(np.diff(first)), pa.array(np.diff(removed)), pa.array(kept, pa.binary()).cast(pa.string())], names=kind.names))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    return cut


def remove_repeats(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` as struct column _doc, and _found: n_words, n_removed, and the kept words joined by one space."""
    found = repeats(docs, id_name, text_name, words)
    id_, text = F.col(f"_doc.`{id_name}`"), F.col(f"_doc.`{text_name}`")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")).select("_doc", *_key(id_, text))
    return packed.join(found, ["id", "own"], "left").select("_doc", _cut(words)(text, F.col("starts")).alias("_found"))
