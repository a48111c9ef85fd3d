"""Station data seen in the ``events`` table: user = station, value = free stands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import clock
from stationflow.operators import clean, slots
from stationflow.session import once, scratch_path, version
from stationflow.sources import files

TRAINING = ("2024-01-01", "2024-01-21")
UNSEEN = ("2024-01-22", "2024-01-28")
REQUESTED_AT_MS = 1_706_515_200_000  # 2024-01-29 08:00:00 UTC
CENTERS = [(1, 150.0), (2, 400.0), (3, 700.0), (4, 1100.0)]


EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def source(spark: SparkSession, sf_dir: str) -> str:
    """The name under which a session keeps what it made of these events: another one once the files change."""
    return version(spark, f"{sf_dir}/events.parquet")


def epoch_ms(column: str):
    return F.unix_millis(F.col(column).cast("timestamp"))


def observation_columns() -> list:
    station = F.col("user_id")
    return [
        F.col("event_id"),
        station.alias("number"),
        F.concat(F.lit("STATION "), station.cast("string")).alias("name"),
        F.concat(F.lit("Address "), (station % 40).cast("string")).alias("address"),
        (20 + station % 21).alias("bike_stands"),
        (F.floor("value") % (21 + station % 21)).alias("available_bike_stands"),
        epoch_ms("ts").alias("last_update"),
    ]


def obs_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(*observation_columns())


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_id(spark, sf_dir).drop("event_id")


def dirty_observations(rows: DataFrame) -> DataFrame:
    """Observations with copies of every tenth and nameless rows for every fiftieth."""
    copy = F.explode(F.array_compact(F.array(
        F.lit(0), F.when(F.col("event_id") % 10 == 0, 1), F.when(F.col("event_id") % 50 == 0, 2)
    )))
    return rows.select(*observation_columns()).withColumn("copy", copy).select(
        "number", F.when(F.col("copy") < 2, F.col("name")).alias("name"), "address", "bike_stands",
        "available_bike_stands",
        (F.col("last_update") + F.when(F.col("copy") == 2, 1).otherwise(0)).alias("last_update"),
    )


def obs_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_observations(events(spark, sf_dir))


def obs_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_id(spark, sf_dir).where(F.col("event_id") % 2 == 0).drop("event_id")


def obs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_id(spark, sf_dir).where(F.col("event_id") % 2 == 1).drop("event_id")


def obs_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations whose names and addresses hold quotes, commas, spaces and accents; some addresses are empty."""
    number = F.col("number")
    return obs(spark, sf_dir).withColumns({
        "name": F.concat(F.lit(' "Café", n° '), number.cast("string"), F.lit(" ")),
        "address": F.when(number % 3 == 0, F.lit("")).otherwise(F.concat(F.lit('The "Long", Rue '), number.cast("string"))),
    })


def slot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No station is renamed here: test stations keep their own names."""
    return slots.build_slots(obs_dirty(spark, sf_dir), renamed={})


def stored_slots(spark: SparkSession, sf_dir: str, bounds: tuple[str, str] | None = None) -> DataFrame:
    """The slot table, written once per session and folder below the shared folder.

    The raw rows are read and rolled up a single time for all queries that pass
    over it. Partitioned by station for the steps that follow.
    """
    def write() -> str:
        path = scratch_path(spark, "slots")
        files.write_slots(slot_table(spark, sf_dir), path)
        return path

    return by_station(files.read_slots(spark, once(spark, f"slots of {source(spark, sf_dir)}", write)), bounds)


def by_station(rows: DataFrame, bounds: tuple[str, str] | None = None) -> DataFrame:
    return (in_range(rows, bounds) if bounds else rows).repartition("number")


def in_range(df: DataFrame, bounds: tuple[str, str]) -> DataFrame:
    return df.where(F.col("date").between(*bounds))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station, time and cluster for slots seen in training; some stations have none."""
    seen = events(spark, sf_dir).select(F.col("user_id").alias("number"), epoch_ms("ts").alias("ms"))
    rows = seen.where(F.col("number") % 30 != 29).select(
        "number", clock.date_text(F.col("ms")).alias("date"), clock.slot_time_text(F.col("ms")).alias("time")
    )
    return in_range(rows, TRAINING).select("number", "time").distinct().select(
        "number", "time", (1 + F.col("number") % 4).cast("int").alias("cluster")
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).select("number", "name", "address").distinct()


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("number")
    return stations(spark, sf_dir).where(number % 50 != 0).select(
        "number", "name", "address",
        (F.lit(53.33) + (number % 17) * F.lit(0.002)).alias("latitude"),
        (F.lit(-6.30) + (number % 23) * F.lit(0.003)).alias("longitude"),
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings with text times, each reported twice; some hours are missing."""
    hours = events(spark, sf_dir).where(F.col("event_type") == "error").groupBy(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h")
    ).agg(F.min("event_id").alias("m"))
    return hours.select(
        F.lit("M2").alias("station_id"),
        F.date_format("h", "MM/dd/yyyy HH:mm").alias("datetime"),
        (990 + F.col("m") % 40).cast("double").alias("atmospheric_pressure"),
        (F.col("m") % 25).cast("double").alias("wind_speed"),
        (F.col("m") % 20).cast("double").alias("air_temperature"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("k"),
    ).drop("k")


def centers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CENTERS, "cluster INT, sum_of_stands DOUBLE")


def view_events(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("event_type") == "view").select(
        "event_id", F.col("user_id").alias("number"), epoch_ms("ts").alias("pred_ms"),
        (F.col("event_id") % 25).alias("pred_stands"),
    )


def click_events(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("event_type") == "click").select(
        "event_id", F.col("user_id").alias("number"), epoch_ms("ts").alias("actual_ms"),
        (F.col("event_id") % 25).alias("actual_stands"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_events(events(spark, sf_dir))


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_events(events(spark, sf_dir))


def forecast_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast log with times in epoch seconds; every seventh forecast has no actual."""
    row = F.col("event_id")
    missing = row % 7 == 0
    capacity = 20 + F.col("user_id") % 21
    pred, actual = row % 25, (row * 7) % 25
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    return events(spark, sf_dir).where(F.col("event_type") == "view").select(
        F.col("user_id").alias("number"), second.alias("time"), pred.alias("pred_stands"),
        (capacity - pred).alias("pred_bikes"),
        F.when(~missing, second + 900).alias("actual_time"),
        F.when(~missing, actual).alias("actual_stands"),
        F.when(~missing, capacity - actual).alias("actual_bikes"),
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state; zeros stand for a failed call."""
    failed = F.col("number") % 10 == 0
    last = clean.latest_state(obs(spark, sf_dir))
    return last.select("number", *[
        F.when(failed, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c)
        for c in ("bike_stands", "available_bike_stands", "last_update")
    ], F.when(failed, 0.0).otherwise(F.lit(53.34) + (F.col("number") % 17) * F.lit(0.002)).alias("latitude"),
        F.when(failed, 0.0).otherwise(F.lit(-6.25) - (F.col("number") % 23) * F.lit(0.003)).alias("longitude"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = obs(spark, sf_dir).select("number").distinct()
    return numbers.select(
        "number", F.explode(F.array(*[F.lit(m) for m in (0, 15, 30, 45, 60)])).alias("minutes"),
        F.lit(REQUESTED_AT_MS).cast("long").alias("requested_ms"),
    )


def odd_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as they come in: minutes as text, some empty, missing or no number; some of stations that do not exist."""
    minutes = F.array(*[F.lit(m) for m in ("15", " 30", "soon", "")], F.lit(None).cast("string"))
    return requests(spark, sf_dir).select(
        F.when(F.col("number") % 20 == 19, F.col("number") + 1_000_000).otherwise(F.col("number")).alias("number"),
        F.get(minutes, (F.col("minutes") / 15).cast("int")).alias("minutes"), "requested_ms")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = geo(spark, sf_dir).select("number", "latitude", "longitude")
    text = F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    return stations(spark, sf_dir).join(places, "number", "left").select(
        "number", "name", "address", (F.col("number") % 7 != 0).alias("open"), text.alias("position")
    )
