"""Staged tables, and texts as bytes inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from stationflow.session import scratch_path

_ROWS = 128


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back: lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, label: str) -> DataFrame:
    """``staged``, with the shuffle files of the write removed at its end instead of whenever the driver collects garbage."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return staged(df, label)
    finally:
        conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; null counts as empty. Few of them are held at a time."""
    data = texts.cast(pa.binary())
    for at in range(0, len(data), _ROWS):
        for t in data.slice(at, _ROWS).to_pylist():
            yield b"" if t is None else t


def blocks(texts: pa.Array, most: int = 1 << 20) -> Iterator[list[str]]:
    """The texts in runs of some bytes, null as empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield ["" if t is None else t for t in texts.slice(at, to - at).to_pylist()]
        at = to


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts come to about ``most`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All parts as one byte array, and the offset at which each begins (one more at the end)."""
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), np.uint8), offsets
