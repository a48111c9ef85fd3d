"""Errors, profiles and sufficiency of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import clock, stands
from stationflow.operators.features import TARGET


def service_hours(df: DataFrame) -> DataFrame:
    """Rows from the start of service on; a text comparison, so it pushes down."""
    return df.where(F.col("time") >= clock.SERVICE_START)


def absolute_errors(scored: DataFrame) -> DataFrame:
    return scored.withColumn("error", F.abs(F.col(TARGET) - F.col("pred")))


def regression_error(scored: DataFrame) -> DataFrame:
    squared = F.pow(F.col(TARGET) - F.col("pred"), F.lit(2.0))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.avg(squared).alias("mse"), F.sqrt(F.avg(squared)).alias("rmse")
    )


def prediction_band(scored: DataFrame) -> DataFrame:
    """Prediction less and plus the root mean squared error of the whole set."""
    rmse = regression_error(scored).select("rmse").scalar()
    return scored.withColumns({"band_low": F.col("pred") - rmse, "band_high": F.col("pred") + rmse})


def supply_classes(scored: DataFrame) -> DataFrame:
    """Rounded bounds clipped at zero, gaps to them, a three-way class and a station range."""
    banded = prediction_band(scored).withColumns({
        "upper": F.greatest(F.bround("band_high", 0), F.lit(0.0)).cast("long"),
        "lower": F.greatest(F.bround("band_low", 0), F.lit(0.0)).cast("long"),
    })
    actual = F.col(TARGET)
    return banded.drop("band_low", "band_high").withColumns({
        "upper_gap": F.col("upper") - actual,
        "lower_gap": F.abs(actual - F.col("lower")),
        "supply": stands.supply_class(actual, F.col("lower"), F.col("upper")),
        "station_range": stands.station_range(F.col("number")),
    })


def scored_profile(scored: DataFrame, *extra_keys: str) -> DataFrame:
    """Whole-number mean actual, mean prediction and largest capacity per station and time."""
    return scored.groupBy("number", "address", "time", *extra_keys).agg(
        stands.to_whole(F.avg(TARGET), "half_even").alias(TARGET),
        stands.to_whole(F.avg("pred"), "half_even").alias("pred"),
        F.max("bike_stands").alias("bike_stands"),
    )


def match_test_to_stations(test: DataFrame, features: DataFrame) -> DataFrame:
    """Join of test rows (latitude, longitude, time) to the stations at that place and time.

    A row-level join pairs every test row with every date of its station. Only
    sums over those pairs are wanted, so both sides are summed first and the
    pair count is the product of the two counts.
    """
    place = ["latitude", "longitude", "time"]
    tested = test.dropna(subset=place).groupBy(*place).agg(
        F.count(F.lit(1)).alias("test_rows"), F.sum(TARGET).alias("actual_sum"), F.sum("pred").alias("pred_sum")
    )
    stations = features.dropna(subset=place).groupBy("number", "address", *place).agg(
        F.count(F.lit(1)).alias("dates"), F.max("bike_stands").alias("bike_stands")
    )
    return stations.join(tested, place).select(
        "number", "address", "time", "bike_stands",
        (F.col("test_rows") * F.col("dates")).alias("pairs"),
        (F.col("actual_sum") * F.col("dates")).alias("actual_sum"),
        (F.col("pred_sum") * F.col("dates")).alias("pred_sum"),
    )


def fit_profile(matched: DataFrame) -> DataFrame:
    """Mean actual, mean prediction and largest capacity per station and time."""
    return matched.groupBy("number", "address", "time").agg(
        (F.sum("actual_sum") / F.sum("pairs")).alias(TARGET),
        (F.sum("pred_sum") / F.sum("pairs")).alias("pred"),
        F.max("bike_stands").alias("bike_stands"),
    )


def capacity_max(slots: DataFrame) -> DataFrame:
    return slots.agg(F.max("bike_stands").alias("capacity_max"))


def station_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("number").alias("station_count"))


def logged_bikes(log: DataFrame) -> DataFrame:
    """Bikes recomputed from the capacities of the logged stations."""
    capacity = F.col("bike_stands")
    return log.withColumn("bike_stands", stands.logged_capacity(F.col("number"))).withColumns({
        "pred_bikes": stands.bikes_from_stands(capacity, F.col("pred_stands"), F.col("pred_bikes")),
        "actual_bikes": stands.bikes_from_stands(capacity, F.col("actual_stands"), F.col("actual_bikes")),
    })


def evaluated_log(log: DataFrame) -> DataFrame:
    """Complete log rows in service hours, with date, 10-minute time and sufficiency flag."""
    complete = logged_bikes(log.drop("time")).dropna("any")
    ms = F.col("actual_time") * clock.MS_PER_SECOND
    timed = complete.withColumns({"date": clock.date_text(ms), "time": clock.slot_time_text(ms)})
    return service_hours(timed).withColumn(
        "sufficient", stands.sufficient(F.col("pred_stands"), F.col("actual_stands"))
    )


def sufficiency_ratio(evaluated: DataFrame) -> DataFrame:
    correct, total = F.sum("sufficient"), F.count(F.lit(1))
    return evaluated.agg(
        correct.alias("correct_cases"), total.alias("total_cases"), (correct / total * 100).alias("correct_ratio")
    )


def log_profile(evaluated: DataFrame) -> DataFrame:
    return evaluated.groupBy("number", "time").agg(
        stands.to_whole(F.avg("actual_stands"), "half_even").alias("actual_stands"),
        stands.to_whole(F.avg("pred_stands"), "half_even").alias("pred_stands"),
        F.max("bike_stands").alias("bike_stands"),
    )
