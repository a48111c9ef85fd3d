"""Registered queries: one function of (spark, sf_dir) per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow import schemas
from stationflow.functions import clock, stands
from stationflow.operators import (
    catalog, clean, evaluate, explore, features, forecast, model, pairing, profile, selection, slots,
)
from stationflow.plans import views
from stationflow.session import configure, once, scratch_path
from stationflow.sources import files
from stationflow.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__doc__ = query.__doc__
    QUERIES[query.__name__] = run
    return query


# Cleaning and preparation


@register
def clean_observations(spark, sf_dir):
    return clean.clean_observations(views.obs_dirty(spark, sf_dir))


@register
def dedup_observations(spark, sf_dir):
    return clean.dedup_observations(clean.clean_observations(views.obs_dirty(spark, sf_dir)))


@register
def union_sources(spark, sf_dir):
    return clean.union_sources(views.obs_json(spark, sf_dir), views.obs_csv(spark, sf_dir))


@register
def source_counts(spark, sf_dir):
    return clean.source_counts(union_sources(spark, sf_dir))


@register
def rename_stations(spark, sf_dir):
    return clean.rename_stations(views.obs(spark, sf_dir))


@register
def stand_deltas(spark, sf_dir):
    return slots.stand_deltas(dedup_observations(spark, sf_dir))


@register
def slot_fact(spark, sf_dir):
    return views.slot_table(spark, sf_dir)


@register
def slot_uniqueness(spark, sf_dir):
    return slots.slot_key_counts(views.slot_table(spark, sf_dir))


@register
def latest_state(spark, sf_dir):
    return clean.latest_state(views.obs(spark, sf_dir))


# Exploration


@register
def date_coverage(spark, sf_dir):
    return explore.date_coverage(views.slot_table(spark, sf_dir))


@register
def top_checkins(spark, sf_dir):
    return explore.top_addresses(views.slot_table(spark, sf_dir), "check_in")


@register
def top_checkouts(spark, sf_dir):
    return explore.top_addresses(views.slot_table(spark, sf_dir), "check_out")


@register
def busiest(spark, sf_dir):
    return explore.top_addresses(views.slot_table(spark, sf_dir))


@register
def quietest(spark, sf_dir):
    return explore.top_addresses(views.slot_table(spark, sf_dir), ascending=True)


@register
def top_checkin_detail(spark, sf_dir):
    return explore.top_address_detail(views.slot_table(spark, sf_dir), "check_in")


@register
def top_checkout_detail(spark, sf_dir):
    return explore.top_address_detail(views.slot_table(spark, sf_dir), "check_out")


@register
def avg_ci_by_weekday(spark, sf_dir):
    return explore.weekday_pivot(views.slot_table(spark, sf_dir), "check_in", "avg")


@register
def avg_co_by_weekday(spark, sf_dir):
    return explore.weekday_pivot(views.slot_table(spark, sf_dir), "check_out", "avg")


@register
def usage_by_weekday(spark, sf_dir):
    return explore.weekday_pivot(views.slot_table(spark, sf_dir), "activity", "sum")


@register
def weekday_box_stats(spark, sf_dir):
    values = explore.weekday_values(views.slot_table(spark, sf_dir), "check_in", "avg")
    stats = explore.box_stats(_written(spark, values))
    return stats.select("weekday", "n", "outliers", *[
        F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")
    ])


@register
def weekday_outliers(spark, sf_dir):
    values = explore.weekday_values(views.slot_table(spark, sf_dir), "activity", "sum")
    return explore.box_outliers(_written(spark, values))


def _written(spark, values: DataFrame) -> DataFrame:
    """Values written once: sketch, bracket and fences each pass over them."""
    path = scratch_path(spark, "plot-values")
    values.write.parquet(path)
    return spark.read.schema(values.schema).parquet(path)


def _plot_values(spark, sf_dir) -> DataFrame:
    return _written(spark, explore.plot_values(views.slot_table(spark, sf_dir)))


@register
def weekday_boxes(spark, sf_dir):
    """Box statistics of all three plots."""
    stats = explore.box_stats(_plot_values(spark, sf_dir), "plot")
    return stats.select(
        F.substring_index("plot", " ", 1).alias("measure"), F.substring_index("plot", " ", -1).alias("weekday"), "n", "outliers",
        *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


@register
def weekday_box_outliers(spark, sf_dir):
    """Stations beyond the whiskers of all three plots."""
    return explore.box_outliers(_plot_values(spark, sf_dir), "plot").drop("plot").withColumn("value", F.round("value", 6))


# Clusters and profiles


def _clustered(spark, sf_dir, bounds=views.TRAINING) -> DataFrame:
    rows = views.in_range(views.slot_table(spark, sf_dir), bounds)
    return features.attach_cluster(rows, views.clusters(spark, sf_dir))


@register
def date_range_filter(spark, sf_dir):
    return views.in_range(views.slot_table(spark, sf_dir), views.UNSEEN)


@register
def weekday_weekend_split(spark, sf_dir):
    rows = views.slot_table(spark, sf_dir)
    parts = [profile.split_week(rows, p).withColumn("part", F.lit(p)) for p in ("weekday", "weekend")]
    return parts[0].unionByName(parts[1])


@register
def time_levels(spark, sf_dir):
    return profile.time_levels(views.slot_table(spark, sf_dir))


@register
def slot_grid(spark, sf_dir):
    return profile.slot_grid(views.stored_slots(spark, sf_dir))


@register
def gap_fill(spark, sf_dir):
    return profile.gap_fill(views.stored_slots(spark, sf_dir))


@register
def gap_fill_station(spark, sf_dir):
    return profile.gap_fill(views.stored_slots(spark, sf_dir), scope="station")


@register
def slot_matrix(spark, sf_dir):
    return profile.slot_matrix(views.slot_table(spark, sf_dir))


@register
def slot_matrix_melt(spark, sf_dir):
    return profile.melt_matrix(slot_matrix(spark, sf_dir))


@register
def wss_k1(spark, sf_dir):
    total = profile.wss_one_cluster(gap_fill(spark, sf_dir))
    return total.select("n", F.round("wss", 3).alias("wss"))


@register
def station_profile(spark, sf_dir):
    return profile.station_profile(views.in_range(views.slot_table(spark, sf_dir), views.TRAINING))


@register
def profile_sums(spark, sf_dir):
    sums = profile.profile_sums(station_profile(spark, sf_dir))
    return sums.select("number", F.round("station_sum", 6).alias("station_sum"))


@register
def assign_cluster(spark, sf_dir):
    nearest = profile.assign_cluster(
        profile.profile_sums(station_profile(spark, sf_dir)), views.centers(spark)
    )
    return nearest.select("number", "cluster", F.round("gap", 6).alias("gap"))


@register
def label_profile(spark, sf_dir):
    return profile.label_profile(station_profile(spark, sf_dir), views.centers(spark))


@register
def cluster_join(spark, sf_dir):
    return _clustered(spark, sf_dir, (views.TRAINING[0], views.UNSEEN[1]))


# Selection


@register
def cluster_activity(spark, sf_dir):
    return selection.cluster_activity(_clustered(spark, sf_dir))


@register
def cluster_top_station(spark, sf_dir):
    return selection.cluster_extreme(cluster_activity(spark, sf_dir), "max")


@register
def cluster_bottom_station(spark, sf_dir):
    return selection.cluster_extreme(cluster_activity(spark, sf_dir), "min")


def _stored_clustered(spark, sf_dir) -> DataFrame:
    rows = views.stored_slots(spark, sf_dir, views.TRAINING)
    return features.attach_cluster(rows, views.clusters(spark, sf_dir))


def _beside_top(clustered: DataFrame) -> DataFrame:
    top = selection.cluster_extreme(selection.cluster_activity(clustered), "max")
    return selection.unselected(clustered, top.select("number"))


@register
def unselected_anti(spark, sf_dir):
    return _beside_top(_stored_clustered(spark, sf_dir))


@register
def cluster_sample(spark, sf_dir):
    return selection.sample_per_cluster(_beside_top(_stored_clustered(spark, sf_dir)))


@register
def selected_stations(spark, sf_dir):
    return selection.selected_stations(_stored_clustered(spark, sf_dir))


@register
def selected_semi(spark, sf_dir):
    clustered = _stored_clustered(spark, sf_dir)
    return selection.keep_selected(clustered.drop("cluster"), selection.selected_stations(clustered))


# Features


@register
def feature_rollup(spark, sf_dir):
    return features.half_hour_rollup(_clustered(spark, sf_dir), "truncate")


@register
def feature_rollup_half_even(spark, sf_dir):
    return features.half_hour_rollup(_clustered(spark, sf_dir), "half_even")


def _features(spark, sf_dir, bounds=views.TRAINING, rounding="truncate") -> DataFrame:
    rows = views.in_range(views.slot_table(spark, sf_dir), bounds)
    return _features_of(spark, sf_dir, rows, rounding)


def _features_of(spark, sf_dir, rows: DataFrame, rounding: str) -> DataFrame:
    return features.station_features(
        rows, views.clusters(spark, sf_dir), views.geo(spark, sf_dir), rounding
    )


def _stored_features(spark, sf_dir, bounds=views.TRAINING, rounding="truncate") -> DataFrame:
    """The same for queries that use the features more than once."""
    return _features_of(spark, sf_dir, views.stored_slots(spark, sf_dir, bounds), rounding)


@register
def prev_stands(spark, sf_dir):
    return features.with_previous(feature_rollup(spark, sf_dir))


@register
def geo_join(spark, sf_dir):
    return _features(spark, sf_dir)


@register
def weather_clean(spark, sf_dir):
    return features.weather_by_slot(views.weather_raw(spark, sf_dir))


@register
def weather_join(spark, sf_dir):
    return features.attach_weather(_features(spark, sf_dir), weather_clean(spark, sf_dir))


def _weather_features(spark, sf_dir) -> DataFrame:
    rows = _stored_features(spark, sf_dir)
    return features.impute_weather(features.attach_weather(rows, weather_clean(spark, sf_dir)))


@register
def weather_impute(spark, sf_dir):
    filled = _weather_features(spark, sf_dir)
    return filled.select("number", "date", "time", "bike_stands", *[
        F.round(c, 6).alias(c) for c in features.WEATHER_COLUMNS
    ])


@register
def label_encode(spark, sf_dir):
    rows = views.stored_slots(spark, sf_dir, views.TRAINING)
    coded = features.with_codes(_features_of(spark, sf_dir, rows, "truncate"), features.moments(rows))
    return coded.select("number", "date", "time", "bike_stands", "weekday_code", "season_code", "time_code")


@register
def label_decode(spark, sf_dir):
    rows = _stored_features(spark, sf_dir)
    coded = features.with_codes(rows).select("number", "date", "bike_stands", "time_code")
    return features.decode_time(coded, features.level_table(rows, "time"))


# Scalar functions over whole tables


@register
def slot10(spark, sf_dir):
    rows = views.events(spark, sf_dir).select("event_id", F.minute(F.col("ts").cast("timestamp")).alias("minute"))
    return rows.withColumn("ten", clock.slot10(F.col("minute")))


@register
def slot30(spark, sf_dir):
    text = F.date_format(F.col("ts").cast("timestamp"), "HH:mm:ss")
    return views.events(spark, sf_dir).select("event_id", clock.slot30(text).alias("half_hour"))


@register
def season(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", clock.season(F.col("o_orderdate").cast("date")).alias("season")
    )


@register
def epoch_to_ts(spark, sf_dir):
    rows = views.obs_id(spark, sf_dir)
    return rows.select(
        "event_id", clock.timestamp_text(F.col("last_update")).alias("from_ms"),
        clock.timestamp_text(F.floor(F.col("last_update") / 1000) * 1000).alias("from_seconds"),
    )


@register
def time_parts(spark, sf_dir):
    ms = F.col("last_update")
    date = clock.utc_date(ms)
    return views.obs_id(spark, sf_dir).select(
        "event_id", date.cast("string").alias("date"), clock.slot_time_text(ms).alias("time"),
        clock.weekday_name(date).alias("weekday"), clock.weekday_code(date).alias("weekday_code"),
    )


@register
def half_even(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("half")
    )
    return rows.select(
        "l_orderkey", "l_linenumber", stands.to_whole(F.col("half"), "half_even").alias("rounded"),
        stands.to_whole(-F.col("half") - 0.2, "truncate").alias("cut"),
    )


@register
def capacity_lookup(spark, sf_dir):
    return views.obs(spark, sf_dir).select("number").distinct().withColumn(
        "capacity", stands.logged_capacity(F.col("number"))
    )


# Evaluation. The prediction of these queries is the station's previous half hour.


def _persistence(spark, sf_dir) -> DataFrame:
    return _stored_features(spark, sf_dir, views.UNSEEN, "half_even").withColumn("pred", F.col("prev_stands"))


@register
def service_hours(spark, sf_dir):
    return evaluate.service_hours(views.slot_table(spark, sf_dir))


@register
def unseen_errors(spark, sf_dir):
    scored = evaluate.absolute_errors(evaluate.service_hours(_persistence(spark, sf_dir)))
    return scored.select("number", "date", "time", "bike_stands", "avg_stands", "pred", "error")


@register
def regression_error(spark, sf_dir):
    total = evaluate.regression_error(evaluate.service_hours(_persistence(spark, sf_dir)))
    return total.select("n", F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"))


@register
def prediction_band(spark, sf_dir):
    banded = evaluate.prediction_band(_persistence(spark, sf_dir))
    return banded.select("number", "date", "time", "bike_stands", "pred", *[
        F.round(c, 6).alias(c) for c in ("band_low", "band_high")
    ])


@register
def supply_class(spark, sf_dir):
    classes = evaluate.supply_classes(_persistence(spark, sf_dir))
    return classes.select(
        "number", "date", "time", "bike_stands", "pred", "upper", "lower", "upper_gap", "lower_gap",
        "supply", "station_range",
    )


@register
def unseen_profile(spark, sf_dir):
    return evaluate.scored_profile(evaluate.service_hours(_persistence(spark, sf_dir)), "weekday")


@register
def unseen_guard(spark, sf_dir):
    """The same profile of a week without rows and of one with rows; the empty one adds nothing."""
    parts = []
    for label, week in (("none", ("2017-11-06", "2017-11-13")), ("some", views.UNSEEN)):
        rows = _features(spark, sf_dir, week, "half_even").withColumn("pred", F.col("prev_stands"))
        parts.append(evaluate.scored_profile(evaluate.service_hours(rows), "weekday").withColumn("week", F.lit(label)))
    return parts[0].unionByName(parts[1])


@register
def split_counts(spark, sf_dir):
    train, test = model.split(_stored_features(spark, sf_dir))
    parts = train.select(F.lit("train").alias("part"), "date").unionByName(
        test.select(F.lit("test").alias("part"), "date")
    )
    return parts.groupBy("part", "date").agg(F.count(F.lit(1)).alias("row_count"))


def _test_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _stored_features(spark, sf_dir)
    test = model.split(rows)[1].withColumn("pred", F.col("prev_stands"))
    return test, rows


@register
def test_fanout_join(spark, sf_dir):
    return evaluate.match_test_to_stations(*_test_rows(spark, sf_dir))


@register
def test_profile(spark, sf_dir):
    fitted = evaluate.service_hours(evaluate.fit_profile(test_fanout_join(spark, sf_dir)))
    return fitted.select("number", "address", "time", "bike_stands", *[
        F.round(c, 6).alias(c) for c in ("avg_stands", "pred")
    ])


@register
def capacity_max(spark, sf_dir):
    return evaluate.capacity_max(views.slot_table(spark, sf_dir))


@register
def station_count(spark, sf_dir):
    return evaluate.station_count(_persistence(spark, sf_dir))


@register
def bikes_from_stands(spark, sf_dir):
    return evaluate.logged_bikes(views.forecast_log(spark, sf_dir))


@register
def sufficiency_flag(spark, sf_dir):
    return evaluate.evaluated_log(views.forecast_log(spark, sf_dir))


@register
def sufficiency_ratio(spark, sf_dir):
    ratio = evaluate.sufficiency_ratio(sufficiency_flag(spark, sf_dir))
    return ratio.withColumn("correct_ratio", F.round("correct_ratio", 6))


@register
def log_profile(spark, sf_dir):
    return evaluate.log_profile(sufficiency_flag(spark, sf_dir))


@register
def forecast_actual_pairing(spark, sf_dir):
    return pairing.pair_forward(views.predictions(spark, sf_dir), views.actuals(spark, sf_dir))


@register
def forecast_actual_pairing_day(spark, sf_dir):
    """The same with actuals of the next 24 hours only."""
    return pairing.pair_forward(views.predictions(spark, sf_dir), views.actuals(spark, sf_dir), tolerance_ms=pairing.DAY_MS)


# Forecast requests


def _coded_history(spark, sf_dir, rows: DataFrame, requests=views.requests) -> DataFrame:
    asked = forecast.request_parts(requests(spark, sf_dir))
    history = _features_of(spark, sf_dir, forecast.relevant_days(rows, asked), "half_even")
    return features.with_codes(history, features.moments(views.in_range(rows, views.TRAINING)))


def _inputs(spark, sf_dir, rows: DataFrame | None = None, requests=views.requests) -> DataFrame:
    rows = views.stored_slots(spark, sf_dir) if rows is None else rows
    return forecast.forecast_inputs(
        requests(spark, sf_dir), rows, _coded_history(spark, sf_dir, rows, requests), views.live(spark, sf_dir)
    )


@register
def forecast_request_parts(spark, sf_dir):
    return forecast.request_parts(views.requests(spark, sf_dir))


@register
def forecast_context(spark, sf_dir):
    parts = forecast.request_parts(views.requests(spark, sf_dir))
    history = _coded_history(spark, sf_dir, views.stored_slots(spark, sf_dir))
    rows = parts.join(forecast.context(history), forecast.MOMENT)
    return rows.select(
        "number", "minutes", "name", "address", "weekday_code", "time_code", "season_code", "cluster",
        "bike_stands", "avg_stands", "prev_stands",
    )


@register
def live_override(spark, sf_dir):
    return _inputs(spark, sf_dir).select(
        "number", "minutes", "prev_stands", "bike_stands", "current_capacity", "last_update",
        F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
    )


@register
def forecast_now(spark, sf_dir):
    answers = forecast.answer(_inputs(spark, sf_dir), "prev_stands")
    return answers.where(F.col("minutes") == 0)


@register
def forecast_status(spark, sf_dir):
    """Answers of every horizon with the previous stands as prediction."""
    return forecast.answer(_inputs(spark, sf_dir), "prev_stands")


@register
def odd_requests(spark, sf_dir):
    """The same for minutes that are text, missing or no number, and for unknown stations."""
    return forecast.answer(_inputs(spark, sf_dir, requests=views.odd_requests), "prev_stands")


# Catalogue


@register
def catalog_list(spark, sf_dir):
    return catalog.list_all(views.catalog(spark, sf_dir))


@register
def catalog_by_number(spark, sf_dir):
    return catalog.by_number(views.catalog(spark, sf_dir), 5)


@register
def catalog_by_address(spark, sf_dir):
    return catalog.by_address(views.catalog(spark, sf_dir), "aDDress 1")


@register
def catalog_by_position(spark, sf_dir):
    return catalog.by_position(views.catalog(spark, sf_dir), 53.332, -6.297)


@register
def catalog_open(spark, sf_dir):
    return catalog.open_only(views.catalog(spark, sf_dir))


@register
def position_split(spark, sf_dir):
    return catalog.with_coordinates(views.catalog(spark, sf_dir)).select("number", "lat", "lng")


@register
def horizons(spark, sf_dir):
    return catalog.horizons(views.catalog(spark, sf_dir))


@register
def catalog_overlay(spark, sf_dir):
    answers = forecast_status(spark, sf_dir).where(F.col("minutes") == 15)
    return catalog.overlay(views.catalog(spark, sf_dir), answers)


@register
def catalog_view(spark, sf_dir):
    return catalog.card_view(catalog_overlay(spark, sf_dir))


# Observations that land in one array.
ROWS_PER_ARRAY = 500

# Files. The tables are written below the shared folder and read back.


def _landed_json(spark, sf_dir) -> str:
    """Snapshots with the fields a poll has, one array per line."""
    path = scratch_path(spark, "snapshots")
    rows = views.obs_json(spark, sf_dir).withColumns({
        "available_bikes": F.col("bike_stands") - F.col("available_bike_stands"),
        "position": F.struct(F.lit(53.3).alias("lat"), F.lit(-6.2).alias("lng")),
        "status": F.lit("OPEN"),
    })
    rows.select(F.to_json(F.array(F.struct("*"))).alias("value")).write.text(path)
    return path


@register
def scan_csv_roundtrip(spark, sf_dir):
    """All observations through CSV with names that need quoting, a leading column without a name and another order."""
    path = scratch_path(spark, "history")
    rows = views.obs_odd_names(spark, sf_dir)
    files.save_csv(rows.select(F.lit(1).alias(""), "last_update", *schemas.OBSERVATION_COLUMNS[:5]), path, encoding=files.ENCODING)
    return files.read_observations_csv(spark, path).drop("path")


@register
def scan_json_snapshots(spark, sf_dir):
    return files.read_snapshots_json(spark, _landed_json(spark, sf_dir), multi_line=False).drop("path")


@register
def file_day_key(spark, sf_dir):
    """Every observation named as its snapshot file would be; some names have no day."""
    ms = F.col("last_update")
    date = clock.utc_date(ms)
    name = F.when(F.col("event_id") % 10 == 0, F.lit("snapshot.json")).otherwise(F.concat(
        clock.weekday_name(date), F.date_format(date, "-dd-MM-yyyy"), F.lit("-"), F.col("event_id").cast("string"),
        F.lit(".json"),
    ))
    rows = views.obs_id(spark, sf_dir).select("event_id", F.concat(F.lit("file:/landing/"), name).alias("path"))
    return rows.withColumn("day", files.day_key(F.col("path")))


def _by_day(spark, sf_dir) -> DataFrame:
    rows = views.obs(spark, sf_dir)
    return rows.withColumn("day", clock.date_text(F.col("last_update"))).withColumn("path", F.col("day"))


@register
def scan_json_arrays(spark, sf_dir):
    """All observations as files of one array each, over many lines, with many stations; some arrays are empty."""
    landing = scratch_path(spark, "arrays")
    rows = views.obs(spark, sf_dir)
    groups = -(-rows.count() // ROWS_PER_ARRAY) or 1
    keyed = rows.withColumn("file", F.pmod(F.xxhash64("number", "last_update"), F.lit(groups)))
    arrays = keyed.groupBy("file").agg(F.to_json(F.collect_list(F.struct(*schemas.OBSERVATION_COLUMNS)), {"pretty": "true"}).alias("value"))
    nothing = spark.range(5).select((-F.col("id") - 1).alias("file"), F.lit("[ ]").alias("value"))
    arrays.unionByName(nothing).write.partitionBy("file").text(landing)
    return files.read_snapshots_json(spark, landing).drop("path")


@register
def incremental_days(spark, sf_dir):
    """Odd days are done already; the others are compacted."""
    rows = _by_day(spark, sf_dir)
    done = rows.where(F.substring("day", 10, 1).cast("int") % 2 == 1).select("day")
    return files.dedup_by_day(files.pending(rows, done)).drop("path")


@register
def compacted_days(spark, sf_dir):
    """Files land in two parts, late files of days that were taken before among the second, and are compacted in two runs."""
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "days")
    rows = views.obs_dirty(spark, sf_dir).dropna("any")
    date = clock.utc_date(F.col("last_update"))
    named = rows.withColumn("day", F.concat(clock.weekday_name(date), F.date_format(date, "-dd-MM-yyyy")))
    # an array holds what one poll of some stations gives: the rows of a minute, in groups of stations
    poll = (F.col("last_update") / 60_000).cast("long"), F.pmod(F.xxhash64("number"), F.lit(64))
    arrays = named.groupBy("day", (F.col("number") % 2).alias("part"), *poll).agg(F.to_json(F.collect_list(F.struct(*schemas.OBSERVATION_COLUMNS))).alias("value"))
    for part in (0, 1):
        # in folders with the day's name, an array to a line
        arrays.where(F.col("part") == part).select("value", F.concat("day", F.lit(f"-{part}")).alias("file")).write.partitionBy("file").text(f"{landing}/{part}")
    for part in (0, 1):
        files.compact_days(spark, f"{landing}/{part}", table, multi_line=False)
    return files.read_compacted(spark, table).select(*schemas.OBSERVATION_COLUMNS, "day")


@register
def prepared_slots(spark, sf_dir):
    """Snapshots and history with rows in both, station 1 renamed, as one slot table."""
    json, history = scratch_path(spark, "json"), scratch_path(spark, "history")
    rows = views.obs_id(spark, sf_dir)
    rows.where("event_id % 2 = 0").select(F.to_json(F.array(F.struct(*schemas.OBSERVATION_COLUMNS))).alias("value")).write.text(json)
    # every third row is in both; the history gives it another address, which must lose
    files.save_csv(rows.where("event_id % 2 = 1 or event_id % 3 = 0").withColumn("address", F.when(
        (F.col("event_id") % 2 == 0), F.lit("Elsewhere")).otherwise(F.col("address"))).select(*schemas.OBSERVATION_COLUMNS), history)
    sources = files.read_snapshots_json(spark, json, multi_line=False), files.read_observations_csv(spark, history)
    return slots.build_slots(clean.union_sources(*sources))


@register
def geography_file(spark, sf_dir):
    """Written in two parts with the columns in another order and an unnamed one in front, and read by headings."""
    path = scratch_path(spark, "geography")
    rows = views.geo(spark, sf_dir)
    files.save_csv(rows.where("number % 2 = 0").select(F.lit(7).alias(""), *reversed(rows.columns)), f"{path}/a")
    files.save_csv(rows.where("number % 2 = 1").withColumnsRenamed({c: c.title() for c in rows.columns}), f"{path}/b")
    return files.read_geography(spark, path)


@register
def weather_file(spark, sf_dir):
    """Weather written as text and read back, cleaned like the table itself."""
    path = scratch_path(spark, "weather")
    files.save_csv(views.weather_raw(spark, sf_dir), path)
    return features.weather_by_slot(files.read_weather(spark, path))




@register
def sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "slots-csv")
    files.save_csv(views.slot_table(spark, sf_dir), path, schemas.SLOT_FACT_HEADINGS)
    return files.read_slots_csv(spark, path)


@register
def bucketed_features(spark, sf_dir):
    """Features from the slot table in buckets by station, which none of their steps shuffles."""
    path = scratch_path(spark, "buckets")
    table = "slots_" + path.rpartition("-")[2]
    files.save_station_buckets(views.slot_table(spark, sf_dir), table, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _features_of(spark, sf_dir, views.in_range(spark.table(table), views.TRAINING), "truncate")


@register
def slot_store(spark, sf_dir):
    """The date-partitioned slot table, read back for one week."""
    path = scratch_path(spark, "slots")
    files.write_slots(views.slot_table(spark, sf_dir), path)
    return views.in_range(files.read_slots(spark, path), views.UNSEEN)


@register
def forecast_log(spark, sf_dir):
    path = scratch_path(spark, "forecast-log")
    files.append_forecast_log(views.forecast_log(spark, sf_dir), path)
    return files.read_forecast_log(spark, path)


@register
def scan_forecast_log(spark, sf_dir):
    """Log files whose unpaired rows end after the fourth field."""
    path = scratch_path(spark, "short-log")
    log = views.forecast_log(spark, sf_dir)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in log.columns])
    log.select(line.alias("value")).write.text(path)
    return files.read_forecast_log(spark, path, header=False)


@register
def log_rejects(spark, sf_dir):
    """Per day of the log: rows, short rows and malformed ones, of files in which some fields are no numbers."""
    path = scratch_path(spark, "reject-log")
    log = views.forecast_log(spark, sf_dir)
    fields = [F.col(c).cast("string") for c in log.columns]
    fields[2] = F.when(F.col("time") % 13 == 0, "n/a").otherwise(fields[2])
    fields.append(F.when(F.col("time") % 17 == 0, "more"))
    day = F.date_format(F.timestamp_seconds("time"), "yyyy-MM-dd")
    log.select(F.concat_ws(",", *fields).alias("value"), day.alias("day")).write.partitionBy("day").text(path)
    account = files.log_account(spark, path, header=False)
    return account.groupBy(F.regexp_extract("path", "day=([0-9-]+)", 1).alias("day")).agg(
        *[F.sum(c).alias(c) for c in ("row_count", "short_rows", "malformed_rows")], F.count_if("unreadable").alias("unreadable_files"))


# Streams. Each runs over what has landed and ends.


BATCHES = 6
ROWS_PER_FILE = 500_000
# Two hours beyond the pairing's hour: every watermark has passed such forecasts.
CLOSED_MS = 3 * 60 * 60 * 1000


def _event_stream(spark, sf_dir) -> DataFrame:
    """The events as files of consecutive times, unordered inside, as many files to a micro-batch as their rows need."""
    def land() -> tuple[str, int]:
        path = scratch_path(spark, "events")
        rows = views.events(spark, sf_dir)
        low, high, count = rows.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
        parts = -(-count // (BATCHES * ROWS_PER_FILE)) or 1
        for i in range(BATCHES if count else 0):  # one after the other: a file source takes files by age
            begin, end = low + (high - low) * i / BATCHES, low + (high - low) * (i + 1) / BATCHES
            part = rows.where((F.col("ts") >= F.lit(begin)) & ((F.col("ts") < F.lit(end)) | F.lit(i == BATCHES - 1)))
            part.repartition(parts, F.xxhash64("event_id")).write.mode("append").parquet(path)
        return path, parts

    path, parts = once(spark, f"landed events of {views.source(spark, sf_dir)}", land)
    return spark.readStream.schema(views.EVENTS).option("maxFilesPerTrigger", parts).parquet(path)


def _run(spark, stream, label) -> DataFrame:
    path = scratch_path(spark, label)
    return jobs.run_available(stream, f"{path}/out", f"{path}/checkpoint")


def _observation_stream(spark, sf_dir) -> DataFrame:
    return jobs.timed(views.dirty_observations(_event_stream(spark, sf_dir)))


@register
def stream_dedup(spark, sf_dir):
    unique = jobs.dedup_stream(_observation_stream(spark, sf_dir)).drop("event_time")
    return _run(spark, unique, "stream-dedup")


@register
def stream_slots(spark, sf_dir):
    rows = jobs.timed(_event_stream(spark, sf_dir).select(*views.observation_columns()).drop("event_id"))
    return _run(spark, jobs.slot_stream(rows), "stream-slots")


@register
def stream_deltas(spark, sf_dir):
    rows = _event_stream(spark, sf_dir).select(*views.observation_columns()).drop("event_id")
    return _run(spark, jobs.delta_stream(rows), "stream-deltas")


@register
def stream_deltas_by_slot(spark, sf_dir):
    """The same in groups of a station's slot, with a small second stream that carries values from slot to slot."""
    rows = _event_stream(spark, sf_dir).select(*views.observation_columns()).drop("event_id")
    return jobs.deltas_by_slot(rows, scratch_path(spark, "stream-slot-deltas"))


@register
def stream_pairing(spark, sf_dir):
    source = _event_stream(spark, sf_dir)
    return _run(spark, jobs.pair_stream(views.view_events(source), views.click_events(source)), "stream-pairing")


@register
def stream_pairing_by_slot(spark, sf_dir):
    """The same in groups of a station's slot, with a second stream for forecasts that their slot does not answer."""
    source = _event_stream(spark, sf_dir)
    return jobs.pairs_by_slot(views.view_events(source), views.click_events(source), scratch_path(spark, "stream-slot-pairs"))


@register
def stream_pairing_hour(spark, sf_dir):
    """Forecasts and their first observation within an hour, by a join of two streams; those whose hour is long over."""
    source = _event_stream(spark, sf_dir)
    forecasts, seen = views.view_events(source), views.click_events(source)
    pairs = _run(spark, jobs.pair_within(forecasts, seen), "stream-pairing-hour")
    last = views.events(spark, sf_dir).where("event_type in ('view', 'click')").agg(F.max(views.epoch_ms("ts"))).scalar()
    return pairs.where(F.col("pred_ms") < last - CLOSED_MS)


@register
def live_table(spark, sf_dir):
    """The latest state of every station, kept up to date batch by batch; the last batch is run twice."""
    path = scratch_path(spark, "live")
    rows = _event_stream(spark, sf_dir).select(*views.observation_columns()).drop("event_id")
    jobs.keep_latest(rows, f"{path}/out", f"{path}/checkpoint")
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/checkpoint/commits")
    system = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [int(f.getPath().getName()) for f in system.listStatus(commits) if f.getPath().getName().isdigit()]
    if numbers:  # as if the program had ended before the last batch was noted as done
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(commits, str(max(numbers))), False)
    return jobs.keep_latest(rows, f"{path}/out", f"{path}/checkpoint")


@register
def stream_intake(spark, sf_dir):
    """Snapshots land, are taken in once, and a second run finds nothing new."""
    landing, table = _landed_json(spark, sf_dir), scratch_path(spark, "intake")
    for _ in range(2):
        source = jobs.dedup_stream(jobs.timed(jobs.snapshot_stream(spark, landing, multi_line=False))).drop("event_time")
        taken = jobs.run_available(source, f"{table}/out", f"{table}/checkpoint")
    return taken


# Models. Trees are fitted on the training part of the selected stations, once per session and folder.


def _features_of_selected(spark, sf_dir, clusters: DataFrame, label: str) -> DataFrame:
    """Training features of the stations that are selected by these clusters; the selection is made once per session and events.

    All steps of the features stay within a station, so only the slots of the selected ones take them.
    """
    rows = views.stored_slots(spark, sf_dir, views.TRAINING)

    def choose() -> str:
        path = scratch_path(spark, "selected")
        selection.selected_stations(features.attach_cluster(rows, clusters)).write.parquet(path)
        return path

    chosen = spark.read.schema("number BIGINT").parquet(once(spark, f"stations selected by {label} of {views.source(spark, sf_dir)}", choose))
    kept = [selection.keep_selected(part, chosen) for part in (rows, clusters, views.geo(spark, sf_dir))]
    return features.station_features(*kept, "truncate")


def _selected_features(spark, sf_dir) -> DataFrame:
    return _features_of_selected(spark, sf_dir, views.clusters(spark, sf_dir), "given clusters")


def _model_features(spark, sf_dir) -> DataFrame:
    rows = features.attach_weather(_selected_features(spark, sf_dir), weather_clean(spark, sf_dir))
    return features.impute_weather(rows)


def _fitted(spark, sf_dir, factors=features.IMPORTANT_FACTORS):
    def fit():
        rows = _selected_features(spark, sf_dir) if factors == features.IMPORTANT_FACTORS else _model_features(spark, sf_dir)
        return model.train(model.split(rows)[0], factors)

    return once(spark, f"{model.TREES} trees on {','.join(factors)} of {views.source(spark, sf_dir)}", fit)


def _filled_days(spark, sf_dir, bounds=views.TRAINING, part: str | None = None) -> DataFrame:
    rows = views.stored_slots(spark, sf_dir, bounds)
    return profile.filled_days(profile.split_week(rows, part) if part else rows)


@register
def filled_days(spark, sf_dir):
    """The filled grid with a day to a row, before k-means takes it."""
    rows = profile.filled_days(views.stored_slots(spark, sf_dir))
    return rows.select("number", "date", F.explode(F.arrays_zip("times", "stands"))).select(
        "number", "date", F.col("col.times").alias("time"), F.col("col.stands").cast("long").alias("available_stands"))


@register
def elbow_curve(spark, sf_dir):
    return once(spark, f"elbow of {views.source(spark, sf_dir)}", lambda: model.elbow(spark, _filled_days(spark, sf_dir)))


@register
def elbow_check(spark, sf_dir):
    """Of the curve: the cost of one cluster, and that no number of clusters costs more."""
    curve = elbow_curve(spark, sf_dir)
    one = curve.where("num_clusters = 1").agg(F.max("wss")).scalar()
    return curve.select("num_clusters", F.round(one, 3).alias("wss_k1"), (F.col("wss") <= one).alias("no_dearer"))


@register
def cluster_account(spark, sf_dir):
    """For all days, weekdays and weekends: figures that hold for any k-means result, added up over its clusters."""
    parts = {part: model.kmeans_account(spark, _filled_days(spark, sf_dir, part=part)) for part in (None, "weekday", "weekend")}
    rows = [account.select(
        F.lit(part or "all").alias("part"), "days", F.round("stands").cast("long").alias("stands"), F.round("squares", 3).alias("squares"),
        "nearest", "adds_up", "settled") for part, account in parts.items()]
    return rows[0].union(rows[1]).union(rows[2])


@register
def centroids_long(spark, sf_dir):
    return model.centroids(spark, _filled_days(spark, sf_dir))


@register
def weekday_centroids(spark, sf_dir):
    return model.centroids(spark, _filled_days(spark, sf_dir, part="weekday"))


@register
def weekend_centroids(spark, sf_dir):
    return model.centroids(spark, _filled_days(spark, sf_dir, part="weekend"))


@register
def station_clusters(spark, sf_dir):
    """Every station labelled with the nearest of the fitted centers."""
    centers = model.center_sums(model.centroids(spark, _filled_days(spark, sf_dir)))
    return profile.label_profile(profile.station_profile(views.stored_slots(spark, sf_dir, views.TRAINING)), centers)


def _fitted_clusters(spark, sf_dir) -> DataFrame:
    """Station, time and the fitted cluster; the centers are fitted once per session and events."""
    def centers() -> list:
        return model.center_sums(model.centroids(spark, _filled_days(spark, sf_dir))).collect()  # one row a cluster

    sums = spark.createDataFrame(once(spark, f"centers of {views.source(spark, sf_dir)}", centers), "cluster INT, sum_of_stands DOUBLE")
    rows = profile.station_profile(views.stored_slots(spark, sf_dir, views.TRAINING))
    return profile.label_profile(rows, sums).select("number", "time", "cluster").distinct()


def _clustered_features(spark, sf_dir, bounds=views.TRAINING, rounding="truncate") -> DataFrame:
    rows = views.stored_slots(spark, sf_dir, bounds)
    return features.station_features(rows, _fitted_clusters(spark, sf_dir), views.geo(spark, sf_dir), rounding)


@register
def clustered_features(spark, sf_dir):
    """Features with the fitted clusters: everything but the label, and that a station has one label from 1 to 4."""
    rows = _clustered_features(spark, sf_dir)
    by_station = Window.partitionBy("number")
    one = (F.min("cluster").over(by_station) == F.max("cluster").over(by_station)) & F.col("cluster").between(1, model.CLUSTERS)
    return rows.withColumn("labelled", F.coalesce(one, F.lit(False))).drop("cluster")


@register
def clustered_forecast(spark, sf_dir):
    """Clusters, then the stations selected by their activity, then trees on the features with those clusters: predictions of the unseen week."""
    def fit():
        rows = _features_of_selected(spark, sf_dir, _fitted_clusters(spark, sf_dir), "fitted clusters")
        return model.train(model.split(rows)[0], features.IMPORTANT_FACTORS)

    fitted = once(spark, f"{model.TREES} trees on fitted clusters of {views.source(spark, sf_dir)}", fit)
    week = evaluate.service_hours(_clustered_features(spark, sf_dir, views.UNSEEN, "half_even"))
    return model.certified_score(spark, fitted, week).select(
        "number", "date", "time", "bike_stands", "avg_stands", "cluster", "pred", "follows", "within")


@register
def station_cluster_check(spark, sf_dir):
    """Of ``station_clusters``: its profile rows, and that no center's sum is nearer to the station's than its own cluster's."""
    centers = model.center_sums(model.centroids(spark, _filled_days(spark, sf_dir))).collect()  # one row a cluster
    rows = profile.label_profile(
        profile.station_profile(views.stored_slots(spark, sf_dir, views.TRAINING)), spark.createDataFrame(centers, "cluster INT, sum_of_stands DOUBLE"))
    own = F.sum("stands").over(Window.partitionBy("number"))
    gaps = [F.abs(own - F.lit(c.sum_of_stands)) for c in centers]
    mine = F.coalesce(*[F.when(F.col("cluster") == c.cluster, gap) for c, gap in zip(centers, gaps)])
    return rows.select(
        "number", "name", "time", F.round("stands", 6).alias("stands"), (mine <= F.least(*gaps) + 1e-6).alias("nearest"))


@register
def training_rows(spark, sf_dir):
    """Rows the model is trained on and tested with, and those left out for a missing factor."""
    return model.missing_factors(_selected_features(spark, sf_dir), features.IMPORTANT_FACTORS)


@register
def train_gbt(spark, sf_dir):
    """Predictions on the hold-out rows."""
    _, test_rows = model.split(_selected_features(spark, sf_dir))
    scored = model.score(_fitted(spark, sf_dir), test_rows)
    return scored.select("number", "date", "time", "bike_stands", "avg_stands", "pred")


def _both_fitted(spark, sf_dir) -> dict:
    """The two models, fitted at the same time where they are not yet."""
    sets = {"considered": features.CONSIDERED_FACTORS, "important": features.IMPORTANT_FACTORS}
    return model.at_once({name: partial(_fitted, spark, sf_dir, factors) for name, factors in sets.items()})


@register
def factor_comparison(spark, sf_dir):
    _, test_rows = model.split(_model_features(spark, sf_dir))
    return model.compare_factors(spark, test_rows, _both_fitted(spark, sf_dir))


@register
def factor_comparison_check(spark, sf_dir):
    """Of the comparison: its hold-out rows, and that walking the trees' tables gives the same errors."""
    _, test_rows = model.split(_model_features(spark, sf_dir))
    errors = factor_comparison(spark, sf_dir).withColumnRenamed("factors", "set")
    parts = []
    for name, fitted in _both_fitted(spark, sf_dir).items():
        rows = model.certified_score(spark, fitted, test_rows).where(F.col("follows"))
        error = rows.agg(F.count("*").alias("test_rows"), F.sqrt(F.avg(F.pow(F.col("raw_pred") - F.col("avg_stands"), 2))).alias("again"))
        parts.append(error.withColumn("factors", F.lit(name)))
    return parts[0].union(parts[1]).join(errors, F.col("factors") == F.col("set")).select(
        "factors", "factor_count", "test_rows", (F.abs(F.col("rmse") - F.col("again")) <= 1e-6).alias("same"))


@register
def holdout_rows(spark, sf_dir):
    """Of ``train_gbt``: the hold-out rows, which have a prediction, and that it is what the trees' table says."""
    _, test_rows = model.split(_selected_features(spark, sf_dir))
    scored = model.certified_score(spark, _fitted(spark, sf_dir), test_rows)
    return scored.select(
        "number", "date", "time", "bike_stands", "avg_stands", F.col("pred").isNotNull().alias("known"),
        F.coalesce("follows", F.lit(True)).alias("follows"), F.coalesce("within", F.lit(True)).alias("within"))


@register
def feature_importance(spark, sf_dir):
    fitted = _fitted(spark, sf_dir, features.CONSIDERED_FACTORS)
    return model.importances(spark, fitted, features.CONSIDERED_FACTORS)


@register
def importance_check(spark, sf_dir):
    """Of ``feature_importance``: its factors, and that the gains in the trees' table give the same shares."""
    fitted = _fitted(spark, sf_dir, features.CONSIDERED_FACTORS)
    again = model.table_importances(model.tree_table(spark, fitted), features.CONSIDERED_FACTORS).toDF("name", "again")
    rows = model.importances(spark, fitted, features.CONSIDERED_FACTORS)
    return rows.join(again, F.col("factor") == F.col("name"), "left").select(
        "factor", (F.abs(F.col("importance") - F.coalesce("again", F.lit(0.0))) <= 1e-6).alias("same"))


def _unseen_week(spark, sf_dir) -> DataFrame:
    rows = views.in_range(views.stored_slots(spark, sf_dir), views.UNSEEN)
    return evaluate.service_hours(_features_of(spark, sf_dir, rows, "half_even"))


@register
def score_unseen(spark, sf_dir):
    """Every row of the unseen week in service hours; without a prediction where a factor is missing."""
    scored = model.score(_fitted(spark, sf_dir), _unseen_week(spark, sf_dir))
    return evaluate.absolute_errors(scored).select(
        "number", "date", "time", "bike_stands", "avg_stands", "pred", "error"
    )


@register
def scored_rows(spark, sf_dir):
    """Of ``score_unseen``: its rows, which have a prediction, that it is what the trees' table says, and that it is
    plausible: between the weighted sums of the trees' smallest and largest leaves, half-even rounded."""
    scored = model.certified_score(spark, _fitted(spark, sf_dir), _unseen_week(spark, sf_dir))
    return scored.select(
        "number", "date", "time", "bike_stands", "avg_stands", F.col("pred").isNotNull().alias("known"),
        F.coalesce("within", F.lit(True)).alias("plausible"), F.coalesce("follows", F.lit(True)).alias("follows"))


@register
def model_roundtrip(spark, sf_dir):
    """Predictions of the saved and reloaded model, with the time decoded by it."""
    path = scratch_path(spark, "model")
    model.save(_fitted(spark, sf_dir), path)
    fitted = model.load(path)
    scored = model.decode_time(fitted, model.score(fitted, _stored_features(spark, sf_dir)))
    return scored.select("number", "date", "time", "bike_stands", "decoded_time", "pred")


@register
def reloaded_model(spark, sf_dir):
    """Rows on which the reloaded model differs from the one that was saved, and whose time it does not decode."""
    again = model_roundtrip(spark, sf_dir)
    first = model.score(_fitted(spark, sf_dir), _stored_features(spark, sf_dir)).select(
        "number", "date", "time", "bike_stands", F.col("pred").alias("before"))
    both = again.join(first, ["number", "date", "time", "bike_stands"])
    return both.agg(
        F.count("*").alias("row_count"), F.count_if(~F.col("pred").eqNullSafe(F.col("before"))).alias("changed"),
        F.count_if(~F.col("decoded_time").eqNullSafe(F.col("time"))).alias("wrong_times"))


@register
def forecast_requests(spark, sf_dir):
    """All requests answered by the model."""
    rows = views.stored_slots(spark, sf_dir)
    return forecast.answer(forecast.predicted(_fitted(spark, sf_dir), _inputs(spark, sf_dir, rows)))


@register
def request_check(spark, sf_dir):
    """Of ``forecast_requests``: each request, whether it has a factor missing, and that its prediction is what the trees' table says."""
    inputs = forecast.model_inputs(_inputs(spark, sf_dir, views.stored_slots(spark, sf_dir)))
    scored = model.certified(spark, _fitted(spark, sf_dir), inputs, F.col("known"))
    return scored.select(
        "number", "minutes", F.col("pred").isNotNull().alias("known"), F.coalesce("follows", F.lit(True)).alias("follows"),
        F.coalesce("within", F.lit(True)).alias("within"))
