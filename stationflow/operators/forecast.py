"""Batch forecasts: many (station, minutes) requests answered in one job."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import clock, stands
from stationflow.operators.clean import group_without_nulls
from stationflow.operators.features import TARGET

CONTEXT_KEY = [
    "number", "name", "address", "weekday_code", "time_code", "season_code", "cluster", "latitude", "longitude",
]
MOMENT = ["number", "time", "weekday", "season"]


def request_parts(requests: DataFrame) -> DataFrame:
    """Target instant of each request and its half hour, weekday and season. Minutes that are missing or no number are 0."""
    target = F.col("target_ms")
    date = clock.utc_date(target)
    return requests.withColumn("minutes", F.coalesce(F.col("minutes").try_cast("int"), F.lit(0))).withColumn(
        "target_ms", F.col("requested_ms") + clock.horizon_ms(F.col("minutes"))
    ).withColumns({
        "time": clock.slot30(clock.slot_time_text(target)),
        "weekday": clock.weekday_name(date),
        "season": clock.season(date),
    })


def relevant_days(slots: DataFrame, parts: DataFrame) -> DataFrame:
    """Slot rows of the station, weekday and season combinations that are asked for.

    A whole-day filter, so it may precede the rollup and the previous-stands step.
    """
    asked = parts.select("number", "weekday", "season").distinct()
    seasoned = slots.withColumn("season", clock.season(F.col("date").cast("date")))
    return seasoned.join(asked, ["number", "weekday", "season"], "left_semi").drop("season")


def context(features: DataFrame) -> DataFrame:
    """Historic state per station and moment: largest capacity, mean stands, mean previous stands.

    Features are coded and rolled up with half-even rounding. Should a station
    have several names or clusters at one moment, the first in key order stands.
    """
    grouped = group_without_nulls(features, *CONTEXT_KEY, "time", "weekday", "season").agg(
        F.max("bike_stands").alias("bike_stands"),
        stands.to_whole(F.avg(TARGET), "half_even").alias(TARGET),
        stands.to_whole(F.avg("prev_stands"), "half_even").alias("prev_stands"),
    )
    rest = [c for c in grouped.columns if c not in MOMENT]
    first = grouped.groupBy(*MOMENT).agg(F.min(F.struct(*rest)).alias("first"))
    return first.select(*MOMENT, "first.*")


def station_history(slots: DataFrame) -> DataFrame:
    """Per station: the capacity of its first slot and the time of its last one."""
    ordered = F.struct("name", "address", "date", "time", "bike_stands")
    saved = F.concat_ws(" ", "date", "time")
    spans = slots.groupBy("number").agg(F.min(ordered).alias("first"), F.max(ordered).alias("last"))
    return spans.select(
        "number", F.col("first.bike_stands").alias("first_capacity"),
        F.concat_ws(" ", "last.date", "last.time").alias("saved_update"),
    )


def live_override(rows: DataFrame, live: DataFrame) -> DataFrame:
    """Live state replaces history unless both live counts are zero or the station is absent.

    ``live`` has number, bike_stands, available_bike_stands, last_update, latitude, longitude.
    """
    state = live.select(
        "number", F.col("bike_stands").alias("live_capacity"),
        F.col("available_bike_stands").alias("live_stands"), F.col("last_update").alias("live_update"),
        F.col("latitude").alias("live_latitude"), F.col("longitude").alias("live_longitude"),
    )
    joined = rows.join(state, "number", "left").fillna(0, ["live_capacity", "live_stands", "live_update"])
    failed = (F.col("live_capacity") == 0) & (F.col("live_stands") == 0)

    def pick(historic, current):
        return F.when(failed, historic).otherwise(current)

    return joined.withColumns({
        "latitude": pick(F.col("latitude"), F.col("live_latitude")),
        "longitude": pick(F.col("longitude"), F.col("live_longitude")),
        "prev_stands": pick(F.col("prev_stands"), F.col("live_stands")),
        "current_capacity": pick(F.col("bike_stands"), F.col("live_capacity")),
        "last_update": pick(F.col("saved_update"), clock.timestamp_text(F.col("live_update"))),
    }).drop("live_latitude", "live_longitude")


def forecast_inputs(requests: DataFrame, slots: DataFrame, coded_features: DataFrame, live: DataFrame) -> DataFrame:
    """One row per request with its context, history and live state; NULLs where there is none."""
    parts = request_parts(requests)
    rows = parts.join(context(coded_features), MOMENT, "left").join(station_history(slots), "number", "left")
    return live_override(rows, live)


FACTORS = ["weekday_code", "prev_stands", "cluster", "latitude", "longitude"]


def model_inputs(inputs: DataFrame) -> DataFrame:
    """Inputs as a fitted model takes them, with ``known``: whether no factor is missing."""
    known = reduce(and_, [F.col(f).isNotNull() for f in FACTORS])
    return inputs.drop("time_code", "season_code").withColumn("known", known).fillna(0, FACTORS)


def predicted(fitted: PipelineModel, inputs: DataFrame) -> DataFrame:
    """Inputs with the model's whole-stand prediction, NULL where a factor is missing."""
    return fitted.transform(model_inputs(inputs)).withColumn(
        "pred", F.when(F.col("known"), stands.to_whole(F.col("raw_pred"), "half_even"))
    ).drop("known", "features", "raw_pred")


def answer(inputs: DataFrame, pred: str = "pred") -> DataFrame:
    """Responses. Minutes 0 answers with the live state, later horizons with ``pred``.

    Status 500 marks a request without a station, and beyond now one without a context or without a prediction.
    """
    now = F.col("minutes") <= 0
    ok = F.when(now, F.col("first_capacity").isNotNull()).otherwise(F.col(TARGET).isNotNull() & F.col(pred).isNotNull())
    free = F.when(now, F.col("live_stands")).otherwise(F.col(pred)).cast("long")
    capacity = F.when(now, F.col("live_capacity")).otherwise(F.col("current_capacity"))
    old = F.when(now, F.col("first_capacity")).otherwise(F.col("bike_stands"))
    updated = F.when(now, F.when(F.col("live_update") > 0, clock.timestamp_text(F.col("live_update")))).otherwise(
        F.col("last_update")
    )
    fault = F.when(F.col("first_capacity").isNull(), "unknown station").when(
        F.col(TARGET).isNull(), "no history for this moment").otherwise("a factor of the forecast is missing")
    return inputs.select(
        "number", "minutes", F.when(ok, 200).otherwise(500).alias("status"),
        F.when(ok, capacity - free).alias("available_bikes"),
        F.when(ok, free).alias("available_bike_stands"),
        F.when(ok, old).alias("old_bike_stands"),
        F.when(ok, capacity).alias("curr_bike_stands"),
        F.when(ok, updated).alias("last_update"),
        F.when(~ok, fault).alias("error"),
    )
