"""Stand arithmetic: deltas, rounding, capacities, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Capacities of the stations whose forecasts are logged.
LOGGED_CAPACITY = {79: 27, 5: 40, 100: 25, 66: 40}
DEFAULT_CAPACITY = 23


def rise(delta: Column) -> Column:
    """Positive part. A rise of free stands is counted as "check in" (a bike left the station)."""
    return F.greatest(delta, F.lit(0).cast("long"))


def fall(delta: Column) -> Column:
    """Size of the negative part, counted as "check out"."""
    return F.greatest(-delta, F.lit(0).cast("long"))


def to_whole(value: Column, mode: str) -> Column:
    """Whole stands: ``half_even`` rounds, ``truncate`` cuts toward zero."""
    if mode == "half_even":
        return F.bround(value, 0).cast("long")
    if mode == "truncate":
        return value.cast("long")
    raise ValueError(f"unknown rounding mode: {mode}")


def logged_capacity(number: Column) -> Column:
    out = F.lit(DEFAULT_CAPACITY)
    for station, stands in LOGGED_CAPACITY.items():
        out = F.when(number == station, F.lit(stands)).otherwise(out)
    return out.cast("long")


def bikes_from_stands(capacity: Column, stands: Column, bikes: Column) -> Column:
    """Bikes implied by the free stands; a missing bike count stays missing."""
    return F.when(bikes.isNotNull(), capacity - stands)


def sufficient(predicted: Column, actual: Column) -> Column:
    """1 when no more stands were promised than were there."""
    return F.when(predicted <= actual, F.lit(1)).otherwise(F.lit(0))


def supply_class(value: Column, low: Column, high: Column) -> Column:
    return (
        F.when((value >= low) & (value <= high), "Sufficient")
        .when(value > high, "Oversupply")
        .otherwise("Insufficient")
    )


def station_range(number: Column) -> Column:
    return (
        F.when(number < 26, "1-25").when(number < 51, "26-50")
        .when(number < 76, "51-75").otherwise("76-102")
    )
