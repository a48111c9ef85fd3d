"""Activity questions on the slot table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions.clock import WEEKDAYS

# Below this many rows in a group, quartiles are taken from the whole group;
# above it, only from a bracket around each quartile.
SKETCH_ACCURACY = 10_000
QUARTILES = (0.25, 0.5, 0.75)
WHISKER_REACH = 1.5


def measure_column(measure: str) -> Column:
    """``measure`` is check_in, check_out or activity (their sum)."""
    return F.col("check_in") + F.col("check_out") if measure == "activity" else F.col(measure)


def date_coverage(slots: DataFrame) -> DataFrame:
    return slots.groupBy("date").agg(F.count(F.lit(1)).alias("row_count"))


def activity_by_address(slots: DataFrame, measure: str = "activity") -> DataFrame:
    return slots.groupBy("address").agg(F.sum(measure_column(measure)).alias(f"total_{measure}"))


def top_addresses(slots: DataFrame, measure: str = "activity", n: int = 10, ascending: bool = False) -> DataFrame:
    """The n addresses with most (or least) activity; the address breaks ties."""
    total = F.col(f"total_{measure}")
    totals = activity_by_address(slots, measure)
    return totals.orderBy(total.asc() if ascending else total.desc(), "address").limit(n)


def top_address_detail(slots: DataFrame, measure: str, n: int = 10) -> DataFrame:
    """Slot rows of the top n addresses, each with its address total."""
    top = F.broadcast(top_addresses(slots, measure, n))  # n rows
    return slots.join(top, "address")


def weekday_values(slots: DataFrame, measure: str, how: str) -> DataFrame:
    """Mean or sum of a measure per station and weekday."""
    agg = {"avg": F.avg, "sum": F.sum}[how](measure_column(measure))
    return slots.groupBy("number", "name", "weekday").agg(agg.alias("value"))


def plot_values(slots: DataFrame) -> DataFrame:
    """The values behind all three box plots: per station and weekday mean check-ins and check-outs, and the sum of both.

    ``plot`` is measure and weekday, the group of a box.
    """
    wide = slots.groupBy("number", "name", "weekday").agg(
        F.avg("check_in").alias("check_in"), F.avg("check_out").alias("check_out"),
        F.sum(measure_column("activity")).cast("double").alias("activity"),
    )
    return wide.select("number", "name", "weekday", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in ("check_in", "check_out", "activity")
    ]))).withColumn("plot", F.concat_ws(" ", "measure", "weekday"))


def weekday_pivot(slots: DataFrame, measure: str, how: str) -> DataFrame:
    """The same with one column per weekday."""
    value = measure_column(measure)
    agg = {"avg": F.avg, "sum": F.sum}[how]
    return slots.groupBy("number", "name").agg(
        *[agg(F.when(F.col("weekday") == day, value)).alias(day) for day in WEEKDAYS]
    )


def _brackets(values: DataFrame, group: str) -> DataFrame:
    """Per group and quartile, a value range that surely holds the quartile."""
    margin = 2.0 / SKETCH_ACCURACY
    ends = [p + sign * margin for p in QUARTILES for sign in (-1, 1)]
    sketch = values.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"),
        F.percentile_approx("value", [float(e) for e in ends], SKETCH_ACCURACY).alias("ends"),
    )
    small = F.col("n") <= SKETCH_ACCURACY
    ranges = F.array(*[
        F.struct(
            F.lit(p).alias("p"),
            F.when(small, F.col("least")).otherwise(F.col("ends")[2 * i]).alias("low"),
            F.when(small, F.col("most")).otherwise(F.col("ends")[2 * i + 1]).alias("high"),
        )
        for i, p in enumerate(QUARTILES)
    ])
    return sketch.select(group, "n", F.inline(ranges))


def quartiles(values: DataFrame, group: str) -> DataFrame:
    """Exact interpolated quartiles of ``value`` per group, with the count ``n``.

    A sketch brackets each quartile within its guaranteed rank error; values
    below the bracket are only counted and equal values are merged, so the
    sorted part is a small fraction of a large group. ``group`` must be a
    column of few distinct values (a weekday).
    """
    ranges = F.broadcast(_brackets(values, group))  # three rows per weekday
    near = values.join(ranges, group).where(F.col("value") <= F.col("high"))
    inside = F.col("value") >= F.col("low")
    merged = near.groupBy(group, "p", "n", F.when(inside, F.col("value")).alias("v")).agg(
        F.count(F.lit(1)).alias("c")
    )
    # Values below the bracket share the NULL value, which sorts first.
    upto = Window.partitionBy(group, "p").orderBy(F.col("v").asc_nulls_first())
    ranked = merged.withColumn("upto", F.sum("c").over(upto))
    position = (F.col("n") - 1) * F.col("p")

    def at(rank):
        hit = (F.col("upto") > rank) & (F.col("upto") - F.col("c") <= rank)
        return F.max(F.when(hit, F.col("v")))

    picked = ranked.groupBy(group, "p", "n").agg(
        at(F.floor(position)).alias("lower"), at(F.ceil(position)).alias("upper")
    )
    fraction = position - F.floor(position)
    missed = F.raise_error(F.lit("a quartile lies outside its bracket")).cast("double")
    value = F.coalesce(F.col("lower") + (F.col("upper") - F.col("lower")) * fraction, missed)
    return picked.groupBy(group, "n").agg(*[
        F.max(F.when(F.col("p") == p, value)).alias(name) for p, name in zip(QUARTILES, ("q1", "median", "q3"))
    ])


def _fences(values: DataFrame, group: str) -> DataFrame:
    reach = (F.col("q3") - F.col("q1")) * WHISKER_REACH
    return quartiles(values, group).withColumns({
        "fence_low": F.col("q1") - reach, "fence_high": F.col("q3") + reach,
    })


def box_stats(values: DataFrame, group: str = "weekday") -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outlier count."""
    fenced = values.join(F.broadcast(_fences(values, group)), group)  # one row per weekday
    inside = F.col("value").between(F.col("fence_low"), F.col("fence_high"))
    return fenced.groupBy(group, "n", "q1", "median", "q3").agg(
        F.least(F.min(F.when(inside, F.col("value"))), F.first("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col("value"))), F.first("q3")).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("outliers"),
    )


def box_outliers(values: DataFrame, group: str = "weekday") -> DataFrame:
    fences = F.broadcast(_fences(values, group).select(group, "fence_low", "fence_high"))
    return values.join(fences, group).where(
        ~F.col("value").between(F.col("fence_low"), F.col("fence_high"))
    ).drop("fence_low", "fence_high")
