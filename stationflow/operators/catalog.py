"""Station catalogue look-ups and the overlay of forecast answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Forecast horizons in minutes, first, last and step.
HORIZON_RANGE = (0, 60, 15)


def list_all(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy("number")


def by_number(catalog: DataFrame, number: int) -> DataFrame:
    return catalog.where(F.col("number") == number)


def by_address(catalog: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring; empty text finds everything."""
    return catalog.where(F.contains(F.lower("address"), F.lit(text.lower())))


def by_position(catalog: DataFrame, latitude: float, longitude: float) -> DataFrame:
    return catalog.where(F.col("position") == f"{latitude},{longitude}")


def open_only(catalog: DataFrame) -> DataFrame:
    return catalog.where("open")


def with_coordinates(catalog: DataFrame) -> DataFrame:
    """Latitude and longitude from the position text; an empty text gives zeros."""
    empty = F.col("position") == ""
    return catalog.withColumns({
        "lat": F.when(empty, 0.0).otherwise(F.substring_index("position", ",", 1).cast("double")),
        "lng": F.when(empty, 0.0).otherwise(F.substring_index("position", ",", -1).cast("double")),
    })


def overlay(catalog: DataFrame, answers: DataFrame) -> DataFrame:
    """Each station with the counts of its successful answer, if there is one."""
    good = answers.where(F.col("status") == 200).select(
        "number", F.col("curr_bike_stands").alias("bike_stands"),
        F.col("available_bike_stands").alias("available_stands"), "available_bikes",
    )
    return catalog.join(good, "number", "left")


def card_view(overlaid: DataFrame) -> DataFrame:
    """Open stations with a title-case name; counts show only when all three are known and not negative."""
    counts = ["bike_stands", "available_stands", "available_bikes"]
    shown = (F.col(counts[0]) >= 0) & (F.col(counts[1]) >= 0) & (F.col(counts[2]) >= 0)
    return open_only(overlaid).select(
        "number", F.initcap("name").alias("title"), *[F.when(shown, F.col(c)).alias(c) for c in counts]
    )


def horizons(stations: DataFrame) -> DataFrame:
    """One row per station and selectable horizon, with its label."""
    first, last, step = HORIZON_RANGE
    minutes = F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(step)))
    label = F.when(F.col("minutes") == 0, "Now").otherwise(
        F.concat(F.lit("Next "), F.col("minutes").cast("string"), F.lit(" minutes"))
    )
    return stations.select("number", minutes.alias("minutes")).withColumn("label", label)
