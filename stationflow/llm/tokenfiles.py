"""Token counts of flat token files by a separator scan.

A token file is nothing but token ids, 2 or 4 bytes each and little-endian; a
document ends with the end-of-document id. There is no index. Files are taken
in blocks; in each block numpy finds all separators at once. What a block adds
to the document that its first separator ends is known after a prefix scan over
the blocks of the file: the furthest separator so far, and how many there were.

``write`` makes such files with Spark's own text writer: a document's ids are
the line, and the separator is the line's end, so any store Spark writes to will
do. Beside them, in the same order, go the documents' ids as 11-byte records.

Defined results: a null or empty text is a document of 0 tokens. Tokens after
the last separator of a file are a last document, if there are any; odd bytes at
a file's end are ignored. A folder without files has no documents. Documents
with equal or null ids are counted one by one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.llm import pieces
from stationflow.llm.support import blocks as texts_in_blocks
from stationflow.session import scratch_path

END = 2  # the vocabulary's end-of-text id; encoded texts never hold it
WIDTH = 2
BLOCK = 1 << 20
_RECORD = np.dtype([("known", "u1"), ("id", "<i8"), ("end", f"S{WIDTH}")])


def _separator(end: int, width: int) -> str:
    """The separator as a line end; its bytes must be text."""
    raw = end.to_bytes(width, "little")
    if max(raw) > 127:
        raise ValueError(f"id {end} can't be written as a line end")
    return raw.decode("ascii")


def write(docs: DataFrame, path: str, id_name: str = "doc_id", text_name: str = "text", model_path: str = pieces.MODEL_PATH) -> None:
    """Token files of ``docs`` in ``path``/kind=tokens, and the ids in their order in ``path``/kind=ids."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces.Vocabulary.load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved, row = pieces.Solved(), 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part in texts_in_blocks(batch.column(1)):
                tokens, counts = shared.value.encode(part, solved)
                ends = np.cumsum(counts)
                flat = tokens.astype("<u2")
                lines = [flat[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())]
                own, ids = ids[:len(part)], ids[len(part):]
                names = [bytes([x is not None]) + int(x or 0).to_bytes(8, "little", signed=True) for x in own]
                order = pa.array(np.arange(row, row + len(part)))
                row += len(part)
                for kind, data in (("ids", names), ("tokens", lines)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(part)), order, pa.array(data, pa.binary())], names=["kind", "row", "data"])

    lines = docs.select(F.col(id_name).cast("long"), F.col(text_name)).mapInArrow(run, "kind string, row long, data binary")
    ordered = lines.sortWithinPartitions("kind", "row").select("kind", F.col("data").cast("string").alias("value"))
    ordered.write.partitionBy("kind").option("lineSep", _separator(END, WIDTH)).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def blocks(spark: SparkSession, path: str, size: int = BLOCK) -> DataFrame:
    """(path, block, data): the files of a folder in blocks of ``size`` bytes (a multiple of the ids' width)."""
    cut = F.expr(f"transform(sequence(0L, greatest(length(content) - 1, 0) div {size}), i -> substring(content, cast(i * {size} + 1 as int), {size}))")
    return _files(spark, path).select("path", cut.alias("parts")).select("path", F.posexplode("parts").alias("block", "data"))


def _scan(end: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for data in batch.column(2):
                ids = np.frombuffer(data.as_buffer(), f"<u{width}", len(data.as_buffer()) // width)
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == end).astype(np.int32))
            offsets = np.concatenate([[0], np.cumsum([len(e) for e in ends])]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ends or [np.zeros(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), found], names=["path", "block", "size", "ends"])

    return run


def counts(spark: SparkSession, path: str, end: int = END, width: int = WIDTH, size: int = BLOCK) -> DataFrame:
    """(path, document, first, n_tokens) of all documents of the token files in a folder; documents count from 0 in each file."""
    found = blocks(spark, path, size).mapInArrow(_scan(end, width), "path string, block int, size long, ends array<int>")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn(
        "after", F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1) + 1))
    stitched = stitched.withColumn("open", F.coalesce(F.max("after").over(before), F.lit(0))).withColumn(
        "done", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))).withColumn(
        "last", F.lead("block").over(Window.partitionBy("path").orderBy("block")).isNull())
    documents = stitched.select("path", F.inline(F.expr("""concat(
        transform(ends, (e, i) -> named_struct(
            'document', done + i, 'first', if(i = 0, open, base + get(ends, i - 1) + 1),
            'n_tokens', base + e - if(i = 0, open, base + get(ends, i - 1) + 1))),
        if(last and base + size > coalesce(after, open), array(named_struct(
            'document', done + size(ends), 'first', coalesce(after, open), 'n_tokens', base + size - coalesce(after, open))), array()))""")))
    return documents


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = np.frombuffer(data.as_buffer(), _RECORD)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(rows), pa.string()), pa.array(np.arange(len(rows))), pa.array(rows["id"].copy(), pa.int64(), mask=rows["known"] == 0)],
                names=["path", "document", "id"])


def _part(path: str) -> F.Column:
    return F.regexp_extract(path, r"part-[0-9]+", 0)


def count_documents(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", model_path: str = pieces.MODEL_PATH, size: int = BLOCK) -> DataFrame:
    """(id, n_tokens) of every row of ``docs``, written as token files below the shared folder and counted from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write(docs, path, id_name, text_name, model_path)
    if not docs.take(1):
        return docs.select(F.col(id_name), F.lit(0).cast("long").alias("n_tokens"))
    names = _files(spark, f"{path}/kind=ids").mapInArrow(_names, "path string, document long, id long").select(_part("path").alias("part"), "document", "id")
    found = counts(spark, f"{path}/kind=tokens", size=size).select(_part("path").alias("part"), "document", "n_tokens")
    return names.join(found, ["part", "document"]).select(F.col("id").alias(id_name), "n_tokens")
