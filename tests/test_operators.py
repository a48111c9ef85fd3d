"""Exploration, profiles, features, selection, evaluation and forecasts on hand-made rows."""

import random
import statistics

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationflow.operators import evaluate, explore, features, forecast, model, pairing, profile, selection
from stationflow.operators.clean import group_without_nulls
from stationflow.schemas import SLOT_FACT


def slot_rows(spark, cells):
    """(number, date, time, stands) to slot rows."""
    return spark.createDataFrame(
        [(n, f"S{n}", f"a{n}", d, t, "Mon", 20, 0, v, 0, 0) for n, d, t, v in cells], SLOT_FACT
    )


def test_null_keys_form_no_group(spark):
    rows = spark.createDataFrame([(1, None), (1, 2), (1, 2)], "number BIGINT, cluster INT")
    assert [tuple(r) for r in group_without_nulls(rows, "number", "cluster").count().collect()] == [(1, 2, 2)]


def test_box_has_outliers_on_both_sides(spark):
    values = [1.0, 50.0] + [20.0 + i for i in range(10)]
    rows = spark.createDataFrame([(i, f"S{i}", "Mon", v) for i, v in enumerate(values)],
                                 "number BIGINT, name STRING, weekday STRING, value DOUBLE")
    box = explore.box_stats(rows).first()
    q = statistics.quantiles(values, n=4, method="inclusive")
    assert (box.q1, box["median"], box.q3) == tuple(q)
    assert (box.whisker_low, box.whisker_high, box.outliers) == (20.0, 29.0, 2)
    assert sorted(r.value for r in explore.box_outliers(rows).collect()) == [1.0, 50.0]


def test_quartiles_of_a_large_group_come_from_brackets(spark, monkeypatch):
    monkeypatch.setattr(explore, "SKETCH_ACCURACY", 100)
    rng = random.Random(3)
    values = {"Mon": [rng.gauss(0, 5) for _ in range(5001)], "Tue": [float(rng.randrange(7)) for _ in range(4002)], "Sun": [1.0, 4.0]}
    rows = spark.createDataFrame([(d, v) for d, vs in values.items() for v in vs], "weekday STRING, value DOUBLE")
    got = {r.weekday: r for r in explore.quartiles(rows, "weekday").collect()}
    for day, vs in values.items():
        q = statistics.quantiles(vs, n=4, method="inclusive")
        assert (got[day].q1, got[day]["median"], got[day].q3) == pytest.approx(tuple(q))


def filled_by_walking(cells):
    """The fill rule cell by cell: previous row of the same time, first rows from below."""
    times = sorted({t for _, _, t, _ in cells})
    rows = sorted({(n, d) for n, d, _, _ in cells})
    known = {(n, d, t): v for n, d, t, v in cells}
    out = {}
    for t in times:
        column = [known.get((*row, t)) for row in rows]
        first = next(v for v in column if v is not None)
        last = first
        for row, v in zip(rows, column):
            last = v if v is not None else last
            out[(*row, t)] = last
    return out


@pytest.mark.parametrize("block", [2, 4096])
def test_gap_fill_crosses_stations_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(profile, "STATIONS_PER_BLOCK", block)
    rng = random.Random(11)
    cells = [(n, f"2017-11-{d:02d}", t, rng.randrange(20)) for n in range(1, 14) for d in range(6, 12)
             for t in ("05:00:00", "05:10:00", "23:50:00") if rng.random() < 0.25]
    got = profile.gap_fill(slot_rows(spark, cells)).collect()
    assert {(r.number, r.date, r.time): r.available_stands for r in got} == filled_by_walking(cells)


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("at_once", [1, 2, 4096])
def test_a_walk_keeps_values_from_part_to_part(monkeypatch, before, at_once):
    monkeypatch.setattr(profile, "ROWS_AT_ONCE", at_once)
    rng = random.Random(5)
    rows = [(g, p, g in (1, 7) and p == 0, [{"slot_no": rng.choice([0, 5, 143, 144, None]), "v": rng.choice([None, 2**60 + 1, 3])} for _ in range(rng.randrange(3))])
            for g in (None, 1, 2, 7) for p in range(6)]
    want, group, held = [], "none", {}
    for g, p, start, cells in rows:
        held, group = ({} if g != group else held), g
        then = {**held, **{c["slot_no"]: c["v"] for c in cells if c["v"] is not None and c["slot_no"] in (0, 5, 143)}}
        if not start:
            shown = held if before else then
            want.append((g, p, [shown.get(i) for i in range(144)], len(shown)))
        held = then
    kind = pa.list_(pa.struct([("slot_no", pa.int32()), ("v", pa.int64())]))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.bool_(), kind))]
    batch = pa.RecordBatch.from_arrays(columns, ["number", "day", "start", "cells"])
    got = [tuple(r.values()) for part in profile._walk(before)(iter([batch.slice(0, 7), batch.slice(7)])) for r in part.to_pylist()]
    assert got == want


@pytest.mark.parametrize("scope", ["all", "station"])
def test_a_fill_has_no_column_for_every_slot(spark, scope):
    """A window with 144 columns, and stands computed both for the filter and for the result, were most of the time of a clustering."""
    days = profile.filled_days(slot_rows(spark, [(1, "2017-11-06", "05:00:00", 3), (2, "2017-11-07", "05:00:00", 5)]), scope)
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition") <= 2 and "exists(" not in plan


def test_gap_fill_within_station(spark):
    cells = [(1, "2017-11-06", "05:00:00", 3), (2, "2017-11-06", "05:10:00", 9), (2, "2017-11-07", "05:00:00", 5)]
    got = profile.gap_fill(slot_rows(spark, cells), scope="station").collect()
    assert {(r.number, r.date, r.time): r.available_stands for r in got} == {
        (1, "2017-11-06", "05:00:00"): 3, (1, "2017-11-06", "05:10:00"): None,
        (2, "2017-11-06", "05:00:00"): 5, (2, "2017-11-06", "05:10:00"): 9,
        (2, "2017-11-07", "05:00:00"): 5, (2, "2017-11-07", "05:10:00"): 9,
    }


def test_extremes_keep_ties(spark):
    activity = spark.createDataFrame([(1, 1, 9), (2, 1, 9), (3, 1, 2), (4, 2, 5)], "number BIGINT, cluster INT, total_activity BIGINT")
    assert {r.number for r in selection.cluster_extreme(activity, "max").collect()} == {1, 2, 4}
    assert {r.number for r in selection.cluster_extreme(activity, "min").collect()} == {3, 4}


def test_samples_are_distinct_and_repeatable(spark):
    stations = spark.range(1, 200).select(F.col("id").alias("number"), (F.col("id") % 4).cast("int").alias("cluster"))
    first = {tuple(r) for r in selection.sample_per_cluster(stations).collect()}
    again = {tuple(r) for r in selection.sample_per_cluster(stations.repartition(5)).collect()}
    assert first == again and len(first) == 12


def test_previous_stands_restart_each_day(spark):
    cells = [(1, "2017-11-06", "05:00:00", 4), (1, "2017-11-06", "05:30:00", 8), (1, "2017-11-07", "00:00:00", 1)]
    clusters = spark.createDataFrame([(1, "05:00:00", 2)], "number BIGINT, time STRING, cluster INT")
    rolled = features.half_hour_rollup(features.attach_cluster(slot_rows(spark, cells), clusters), "truncate")
    got = {(r.date, r.time): (r.prev_stands, r.cluster) for r in features.with_previous(rolled).collect()}
    assert got == {("2017-11-06", "05:00:00"): (4, 2), ("2017-11-06", "05:30:00"): (4, None), ("2017-11-07", "00:00:00"): (1, None)}


def test_rollup_rounding_modes(spark):
    cells = [(1, "2017-11-06", "05:00:00", 1), (1, "2017-11-06", "05:10:00", 2), (1, "2017-11-06", "05:30:00", 2), (1, "2017-11-06", "05:40:00", 3)]
    rows = slot_rows(spark, cells).withColumn("cluster", F.lit(1))
    means = {mode: [r.avg_stands for r in features.half_hour_rollup(rows, mode).orderBy("time").collect()] for mode in ("truncate", "half_even")}
    assert means == {"truncate": [1, 2], "half_even": [2, 2]}


def test_nearest_center_ties_go_to_the_lower_cluster(spark):
    sums = spark.createDataFrame([(1, 10.0), (2, 21.0)], "number BIGINT, station_sum DOUBLE")
    centers = spark.createDataFrame([(2, 20.0), (1, 0.0)], "cluster INT, sum_of_stands DOUBLE")
    assert {r.number: (r.cluster, r.gap) for r in profile.assign_cluster(sums, centers).collect()} == {1: (1, 10.0), 2: (2, 1.0)}


def test_fanout_sums_equal_the_row_join(spark):
    rng = random.Random(2)
    rows = [(n, f"a{n}", f"0{h}:00:00", 53.0 + n % 2, -6.0, 20 + d, rng.randrange(20)) for n in range(4) for h in range(3) for d in range(4)]
    frame = spark.createDataFrame(rows, "number BIGINT, address STRING, time STRING, latitude DOUBLE, longitude DOUBLE, bike_stands BIGINT, avg_stands BIGINT")
    test = frame.where("avg_stands % 3 = 0").withColumn("pred", F.col("avg_stands") + 1)
    pairs = test.select("latitude", "longitude", "time", "avg_stands", "pred").join(frame.drop("avg_stands"), ["latitude", "longitude", "time"])
    plain = pairs.groupBy("number", "address", "time").agg(F.avg("avg_stands"), F.avg("pred"), F.max("bike_stands"))
    quick = evaluate.fit_profile(evaluate.match_test_to_stations(test, frame)).select("number", "address", "time", "avg_stands", "pred", "bike_stands")

    def rounded(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect())

    assert rounded(quick) == rounded(plain)


def test_pairing_equals_search(spark):
    rng = random.Random(4)
    # One station has most rows, many at the same instant.
    preds = [(i, 1 if rng.random() < 0.7 else 2, rng.randrange(0, 4 * 86_400_000, 450_000), i % 9) for i in range(300)]
    acts = [(1000 + i, 1 if rng.random() < 0.7 else 2, rng.randrange(0, 4 * 86_400_000, 450_000), i % 7) for i in range(60)]
    got = pairing.pair_forward(
        spark.createDataFrame(preds, "event_id BIGINT, number BIGINT, pred_ms BIGINT, pred_stands BIGINT"),
        spark.createDataFrame(acts, "event_id BIGINT, number BIGINT, actual_ms BIGINT, actual_stands BIGINT"),
        tolerance_ms=6 * 3_600_000,
    ).collect()
    assert len(got) == len(preds)
    for r in got:
        later = sorted((a[2], a[0], a[3]) for a in acts if a[1] == r.number and 0 <= a[2] - r.pred_ms - 900_000 <= 6 * 3_600_000)
        expected = later[0] if later else (None, None, None)
        assert (r.actual_ms, r.actual_event, r.actual_stands) == expected


def test_live_zero_falls_back_to_history(spark):
    rows = spark.createDataFrame(
        [(n, 53.0, -6.0, 7, 20, "2017-11-05 10:00:00") for n in (1, 2, 3)],
        "number BIGINT, latitude DOUBLE, longitude DOUBLE, prev_stands BIGINT, bike_stands BIGINT, saved_update STRING")
    live = spark.createDataFrame([(1, 0, 0, 0, 0.0, 0.0), (2, 10, 0, 1_510_012_800_000, 54.0, -7.0)],
        "number BIGINT, bike_stands BIGINT, available_bike_stands BIGINT, last_update BIGINT, latitude DOUBLE, longitude DOUBLE")
    got = {r.number: (r.latitude, r.prev_stands, r.current_capacity, r.last_update) for r in forecast.live_override(rows, live).collect()}
    history = (53.0, 7, 20, "2017-11-05 10:00:00")
    assert got == {1: history, 2: (54.0, 0, 10, "2017-11-07 00:00:00"), 3: history}


def test_split_is_the_same_on_any_partitioning(spark):
    rows = spark.range(1000).select(F.col("id").alias("number"), *[F.lit("x").alias(c) for c in ("name", "address", "date", "time")], F.lit(20).alias("bike_stands"))
    train, test = model.split(rows)
    again, _ = model.split(rows.repartition(7))
    assert train.count() + test.count() == 1000 and 600 < train.count() < 740
    assert train.exceptAll(again).count() == 0 and again.exceptAll(train).count() == 0
