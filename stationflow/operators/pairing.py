"""Pairing of a forecast with the next observation of its station."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import clock

LEAD_MS = 15 * 60 * 1000
DAY_MS = 24 * 60 * 60 * 1000


def pair_forward(
    predictions: DataFrame, actuals: DataFrame, lead_ms: int = LEAD_MS, tolerance_ms: int | None = None
) -> DataFrame:
    """Forward as-of join: the first actual at or after prediction time + lead, however late or within a tolerance.

    Both sides are stacked and read backwards in time, one 10-minute chunk of a
    station at a time; what lies beyond a chunk is the first actual of a later
    chunk, found among one row per chunk. No candidate pairs are formed, and a
    station's rows are never all in one task. Unpaired forecasts keep NULLs.
    """
    fields = ["actual_event", "actual_ms", "actual_stands"]
    asked = predictions.select(
        "number", (F.col("pred_ms") + lead_ms).alias("at"), "event_id", "pred_ms", "pred_stands",
        F.lit(None).cast("struct<actual_ms:bigint,actual_event:bigint,actual_stands:bigint>").alias("seen"),
    )
    seen = actuals.select(
        "number", F.col("actual_ms").alias("at"), F.lit(None).cast("long").alias("event_id"),
        F.lit(None).cast("long").alias("pred_ms"), F.lit(None).cast("long").alias("pred_stands"),
        F.struct("actual_ms", F.col("event_id").alias("actual_event"), "actual_stands").alias("seen"),
    )
    both = asked.unionByName(seen).withColumn("chunk", clock.slot_start(F.col("at")))

    # Latest first, and at one instant actuals before forecasts: the last actual
    # met so far is then the nearest one to come.
    backwards = Window.partitionBy("number", "chunk").orderBy(
        F.desc("at"), F.col("seen").isNull(), F.desc("seen.actual_event")
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = both.withColumn("next_here", F.last("seen", True).over(backwards))

    chunks = both.groupBy("number", "chunk").agg(F.min("seen").alias("first_seen"))
    later = Window.partitionBy("number").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("number", "chunk", F.last("first_seen", True).over(later).alias("next_later"))

    paired = rows.where(F.col("seen").isNull()).join(chunks, ["number", "chunk"], "left").withColumn(
        "next", F.coalesce("next_here", "next_later")
    )
    near = F.lit(True) if tolerance_ms is None else F.col("next.actual_ms") - F.col("at") <= tolerance_ms
    return paired.select(
        "event_id", "number", "pred_ms", "pred_stands",
        *[F.when(near, F.col(f"next.{f}")).alias(f) for f in fields],
    )
