"""Repeatable pseudo-random values: equal for equal keys on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(seed: int, *keys: str) -> Column:
    """A number in [0, 2**32) from the text of the keys and the seed."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
