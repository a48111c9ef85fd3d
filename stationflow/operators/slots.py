"""Stand deltas and the 10-minute slot table.

A chain is the history of one (number, name, address). Ordering a whole chain
in one window would put every raw row of a busy station into one task, so both
operators work in two steps: inside a slot first, then from slot to slot. A
chain has at most 144 slots a day however many raw rows it has, so the second
window is small for any station, and everything keyed by station after it is
free of hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import clock, stands
from stationflow.operators.clean import clean_observations, dedup_observations, rename_stations

CHAIN = ["number", "name", "address"]


def _steps(df: DataFrame) -> DataFrame:
    """Adds the slot and the change since the previous row of the same slot.

    ``step`` is NULL on the first row of a slot.
    """
    inside = Window.partitionBy(*CHAIN, "slot").orderBy("last_update", "available_bike_stands")
    previous = F.lag("available_bike_stands").over(inside)
    return df.withColumn("slot", clock.slot_start(F.col("last_update"))).withColumns({
        "last_available_stands": previous,
        "step": F.col("available_bike_stands") - previous,
    })


def _with_parts(df: DataFrame) -> DataFrame:
    date = clock.utc_date(F.col("slot"))
    return df.withColumns({
        "date": date.cast("string"),
        "time": clock.slot_time_text(F.col("slot")),
        "weekday": clock.weekday_name(date),
    })


def stand_deltas(observations: DataFrame) -> DataFrame:
    """Every observation with its predecessor's stands, delta, check-in and check-out.

    The first row of a chain is its own predecessor. Only the first row of each
    slot needs the state of an earlier slot, so only those rows go through the
    chain window; both branches read the same shuffle.
    """
    rows = _steps(observations)
    closing = Window.partitionBy(*CHAIN, "slot").orderBy("last_update", "available_bike_stands").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = rows.withColumn("closed", F.last("available_bike_stands").over(closing))
    chain = Window.partitionBy(*CHAIN).orderBy("slot")
    openers = rows.where(F.col("step").isNull()).withColumn(
        "last_available_stands",
        F.coalesce(F.lag("closed").over(chain), F.col("available_bike_stands")),
    )
    joined = rows.where(F.col("step").isNotNull()).unionByName(openers)
    delta = F.col("available_bike_stands") - F.col("last_available_stands")
    return joined.select(
        *CHAIN, "bike_stands", "available_bike_stands", "last_update", "last_available_stands",
        delta.alias("diff"), stands.rise(delta).alias("check_in"), stands.fall(delta).alias("check_out"),
    )


def slot_states(observations: DataFrame) -> DataFrame:
    """One row per chain and slot: smallest capacity, first and last stands, moves inside."""
    ins = F.coalesce(F.sum(stands.rise(F.col("step"))), F.lit(0).cast("long"))
    outs = F.coalesce(F.sum(stands.fall(F.col("step"))), F.lit(0).cast("long"))
    opened = F.max(F.when(F.col("step").isNull(), F.col("available_bike_stands")))
    return (
        _steps(observations)
        .groupBy(*CHAIN, "slot")
        .agg(F.min("bike_stands").alias("bike_stands"), opened.alias("opened"),
             ins.alias("ins"), outs.alias("outs"))
        .withColumn("closed", F.col("opened") + F.col("ins") - F.col("outs"))
    )


def rollup_slots(observations: DataFrame) -> DataFrame:
    """The slot table from clean, de-duplicated observations.

    The slot's net change is its last state less the previous slot's last
    state; moves are those inside the slot plus the one that enters it. The
    result is hash-partitioned by ``number``, which later per-station
    operators reuse.
    """
    chain = Window.partitionBy(*CHAIN).orderBy("slot")
    states = slot_states(observations).repartition("number").withColumn(
        "before", F.coalesce(F.lag("closed").over(chain), F.col("opened"))
    )
    entering = F.col("opened") - F.col("before")
    return _with_parts(states).select(
        *CHAIN, "date", "time", "weekday", "bike_stands",
        (F.col("closed") - F.col("before")).alias("diff"),
        F.col("closed").alias("available_stands"),
        (F.col("ins") + stands.rise(entering)).alias("check_in"),
        (F.col("outs") + stands.fall(entering)).alias("check_out"),
    )


def build_slots(raw: DataFrame, renamed: dict[int, tuple[str, str]] | None = None) -> DataFrame:
    """Raw observations to the slot table: rename, clean, de-duplicate, roll up."""
    fixed = rename_stations(raw) if renamed is None else rename_stations(raw, renamed)
    return rollup_slots(dedup_observations(clean_observations(fixed)))


def slot_key_counts(slots: DataFrame) -> DataFrame:
    """Rows and distinct keys of a slot table by date; equal when the keys are unique."""
    per_key = slots.groupBy("date", "number", "name", "address", "time", "weekday").agg(
        F.count(F.lit(1)).alias("rows")
    )
    return per_key.groupBy("date").agg(
        F.sum("rows").alias("slot_rows"), F.count(F.lit(1)).alias("distinct_keys")
    )
