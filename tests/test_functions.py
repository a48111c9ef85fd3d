"""Scalar functions on edge values."""

import datetime as dt

from pyspark.sql import functions as F

from stationflow.functions import clock, stands
from stationflow.operators import forecast


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in rows.select(expression(F.col("v")), "i").orderBy("i").collect()]


def test_slot_edges(spark):
    assert column(spark, [0, 9, 10, 29, 30, 59, 60], "INT", clock.slot10) == ["00", "00", "10", "20", "30", "50", None]
    times = ["05:00:00", "05:29:59", "05:30:00", "23:59:00"]
    assert column(spark, times, "STRING", clock.slot30) == ["05:00:00", "05:00:00", "05:30:00", "23:30:00"]


def test_season_edges(spark):
    days = ["2017-01-31", "2017-02-01", "2017-04-30", "2017-05-01", "2017-07-31", "2017-08-01", "2017-10-31", "2017-11-01"]
    got = column(spark, days, "STRING", lambda c: clock.season(c.cast("date")))
    assert got == ["Winter", "Spring", "Spring", "Summer", "Summer", "Autumn", "Autumn", "Winter"]


def test_half_even_and_truncation(spark):
    values = [0.5, 1.5, 2.5, -1.7]
    assert column(spark, values, "DOUBLE", lambda c: stands.to_whole(c, "half_even")) == [0, 2, 2, -2]
    assert column(spark, values, "DOUBLE", lambda c: stands.to_whole(c, "truncate")) == [0, 1, 2, -1]


def test_clock_parts_do_not_depend_on_the_session_zone(spark):
    instants = [1_510_039_457_000, -1, 1_509_235_199_999]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = column(spark, instants, "BIGINT", clock.timestamp_text)
        slot = column(spark, instants, "BIGINT", clock.slot_time_text)
        weekday = column(spark, instants, "BIGINT", lambda c: clock.weekday_name(clock.utc_date(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    moments = [dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc) for ms in instants]
    assert text == [m.strftime("%Y-%m-%d %H:%M:%S") for m in moments]
    assert slot == [f"{m.hour:02d}:{m.minute // 10 * 10:02d}:00" for m in moments]
    assert weekday == [m.strftime("%a") for m in moments]


def test_horizons_cross_midnight(spark):
    asked = 1_510_012_800_000 - 30 * 60_000  # 2017-11-06 23:30
    rows = spark.createDataFrame([(1, m, asked) for m in (0, 10, 15, 45, None)], "number BIGINT, minutes INT, requested_ms BIGINT")
    got = {r.minutes: r for r in forecast.request_parts(rows).where("minutes > 0").collect()}
    assert got[10].target_ms - asked == 612_000  # 0.17 h
    assert got[15].target_ms - asked == 900_000
    assert (got[45].weekday, got[45].time, got[15].weekday, got[15].time) == ("Tue", "00:00:00", "Mon", "23:30:00")
    assert forecast.request_parts(rows).where("minutes = 0").count() == 2


def test_capacities_and_bikes(spark):
    assert column(spark, [79, 5, 100, 66, 33], "BIGINT", stands.logged_capacity) == [27, 40, 25, 40, 23]
    rows = spark.createDataFrame([(20, 5, 1), (20, 5, None)], "c BIGINT, s BIGINT, b BIGINT")
    assert [r[0] for r in rows.select(stands.bikes_from_stands(F.col("c"), F.col("s"), F.col("b"))).collect()] == [15, None]


def test_supply_classes(spark):
    got = column(spark, [1, 5, 9], "BIGINT", lambda c: stands.supply_class(c, F.lit(3), F.lit(7)))
    assert got == ["Insufficient", "Sufficient", "Oversupply"]
    assert column(spark, [25, 26, 51, 76], "BIGINT", stands.station_range) == ["1-25", "26-50", "51-75", "76-102"]
