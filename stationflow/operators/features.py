"""Half-hour features: rollup, previous stands, geography, weather, codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import clock, stands
from stationflow.operators.clean import dedup_weather, group_without_nulls

HALF_HOUR_KEY = ["number", "name", "address", "date", "time", "bike_stands", "weekday", "season"]
WEATHER_COLUMNS = ["atmospheric_pressure", "wind_speed", "air_temperature"]

# Candidate factors of the model, and those kept without weather.
CONSIDERED_FACTORS = [
    "weekday_code", "time_code", "prev_stands", "cluster", "latitude", "longitude",
    "season_code", "wind_speed", "air_temperature",
]
IMPORTANT_FACTORS = [
    "weekday_code", "time_code", "prev_stands", "cluster", "latitude", "longitude", "season_code",
]
TARGET = "avg_stands"


def attach_cluster(slots: DataFrame, clusters: DataFrame) -> DataFrame:
    """Left join of ``clusters`` (number, time, cluster) on number and time of day.

    The right side becomes one row per station holding its (at most 144)
    time-to-cluster entries, so the join key is the station alone: the slot
    table keeps its partitioning by ``number`` and is not shuffled again.
    """
    per_station = (
        clusters.select("number", "time", "cluster").dropna()
        .repartition("number")
        .groupBy("number", "time").agg(F.min("cluster").alias("cluster"))
        .groupBy("number")
        .agg(F.map_from_entries(F.collect_list(F.struct("time", "cluster"))).alias("by_time"))
    )
    joined = slots.join(per_station, "number", "left")
    return joined.withColumn("cluster", F.element_at("by_time", F.col("time"))).drop("by_time")


def half_hour_rollup(clustered: DataFrame, rounding: str) -> DataFrame:
    """Mean stands and first known cluster per station, day and half hour."""
    keyed = clustered.withColumns({
        "minute": clock.minute_of_day(F.col("time")),
        "time": clock.slot30(F.col("time")),
        "season": clock.season(F.col("date").cast("date")),
    })
    known = F.when(F.col("cluster").isNotNull(), F.col("minute"))
    return group_without_nulls(keyed, *HALF_HOUR_KEY).agg(
        stands.to_whole(F.avg("available_stands"), rounding).alias(TARGET),
        F.min_by("cluster", known).alias("cluster"),
    )


def with_previous(features: DataFrame) -> DataFrame:
    """Stands of the station's previous half hour of the same day; its own on the first."""
    day = Window.partitionBy("number", "name", "address", "date").orderBy("time", "bike_stands")
    return features.withColumn("prev_stands", F.coalesce(F.lag(TARGET).over(day), F.col(TARGET)))


def attach_geo(features: DataFrame, geo: DataFrame) -> DataFrame:
    return features.join(geo.select("number", "latitude", "longitude"), "number", "left")


def weather_by_slot(raw: DataFrame) -> DataFrame:
    """De-duplicated readings with the date and time text of their hour."""
    text = F.to_timestamp_ntz("datetime", F.lit("M/d/yyyy H:mm")).cast("string")
    return dedup_weather(raw).select(
        F.substring(text, 1, 10).alias("date"),
        F.concat(F.substring(text, 12, 5), F.lit(":00")).alias("time"),
        *WEATHER_COLUMNS,
    )


def attach_weather(features: DataFrame, weather: DataFrame) -> DataFrame:
    return features.join(weather, ["date", "time"], "left")


def impute_weather(features: DataFrame) -> DataFrame:
    """Missing readings become the column mean over all joined rows."""
    means = features.agg(F.struct(*[F.avg(c).alias(c) for c in WEATHER_COLUMNS]).alias("means")).scalar()
    return features.withColumns({c: F.coalesce(F.col(c), means.getField(c)) for c in WEATHER_COLUMNS})


def level_code(df: DataFrame, column: str) -> Column:
    """Rank of a value among the sorted distinct values of ``df``, from 0.

    For columns whose set of values is small by definition (seasons, half
    hours, weekdays): the sorted set is one scalar array.
    """
    levels = df.agg(F.sort_array(F.collect_set(column))).scalar()
    return (F.array_position(levels, F.col(column)) - 1).cast("int")


def level_table(df: DataFrame, column: str) -> DataFrame:
    """The encoding itself: code and value, for decoding."""
    levels = df.agg(F.sort_array(F.collect_set(column)).alias("levels"))
    return levels.select(F.posexplode("levels").alias(f"{column}_code", column))


def moments(slots: DataFrame) -> DataFrame:
    """Half hour and season of slot rows: enough to fit the codes on."""
    return slots.select(
        clock.slot30(F.col("time")).alias("time"), clock.season(F.col("date").cast("date")).alias("season")
    )


def with_codes(features: DataFrame, fitted_on: DataFrame | None = None) -> DataFrame:
    """Weekday, season and time codes, the latter two fitted on ``fitted_on`` or on these rows."""
    levels = features if fitted_on is None else fitted_on
    return features.withColumns({
        "weekday_code": clock.weekday_code(F.col("date").cast("date")),
        "season_code": level_code(levels, "season"),
        "time_code": level_code(levels, "time"),
    })


def decode_time(coded: DataFrame, levels: DataFrame) -> DataFrame:
    return coded.join(F.broadcast(levels), "time_code")  # at most 48 half hours


def station_features(slots: DataFrame, clusters: DataFrame, geo: DataFrame, rounding: str) -> DataFrame:
    """Features without weather and codes. One shuffle by station serves every step."""
    rolled = half_hour_rollup(attach_cluster(slots, clusters), rounding)
    return attach_geo(with_previous(rolled), geo)
