"""Cleaning, deltas and the slot table on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from stationflow.functions import clock
from stationflow.operators import clean, slots
from stationflow.schemas import OBSERVATION

DAY = 1_510_012_800_000  # 2017-11-07 00:00:00 UTC, a Tuesday


def at(hour, minute, second=0):
    return DAY + ((hour * 60 + minute) * 60 + second) * 1000


def observations(spark, rows):
    return spark.createDataFrame(rows, OBSERVATION)


def test_two_updates_in_one_slot(spark):
    rows = [(7, "A", "a", 20, 10, at(5, 24, 17)), (7, "A", "a", 20, 2, at(5, 29, 5))]
    got = slots.build_slots(observations(spark, rows)).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.date, row.time, row.weekday) == ("2017-11-07", "05:20:00", "Tue")
    assert (row.diff, row.available_stands, row.check_in, row.check_out) == (-8, 2, 0, 8)


def test_first_row_has_no_delta(spark):
    row = slots.build_slots(observations(spark, [(7, "A", "a", 20, 10, at(1, 0))])).first()
    assert (row.diff, row.check_in, row.check_out, row.available_stands) == (0, 0, 0, 10)


def test_rename_joins_the_chain(spark):
    rows = [(1, "OLD", "Old St", 20, 10, at(1, 0)), (1, "NEW", "New St", 20, 4, at(1, 10))]
    fixed = slots.build_slots(observations(spark, rows)).orderBy("time").collect()
    assert [(r.name, r.diff) for r in fixed] == [("CLARENDON ROW", 0), ("CLARENDON ROW", -6)]
    split = slots.build_slots(observations(spark, rows), renamed={}).collect()
    assert sorted((r.name, r.diff) for r in split) == [("NEW", 0), ("OLD", 0)]


def test_null_rows_and_unnamed_columns_go(spark):
    rows = [(7, "A", "a", 20, 10, at(1, 0)), (7, None, "a", 20, 10, at(1, 5))]
    df = observations(spark, rows).withColumn("Unnamed: 6", F.lit(None).cast("string"))
    assert clean.clean_observations(df).count() == 1


def test_first_source_wins(spark):
    json = observations(spark, [(7, "FROM JSON", "a", 20, 10, at(1, 0))])
    csv = observations(spark, [(7, "A FROM CSV", "a", 20, 10, at(1, 0))])
    kept = clean.dedup_observations(clean.clean_observations(clean.union_sources(json, csv)))
    assert [r.name for r in kept.collect()] == ["FROM JSON"]


def brute_force(rows):
    """Deltas by walking each chain in order, then sums per slot."""
    out, last = {}, {}
    for number, name, address, stands, free, ms in sorted(set(rows), key=lambda r: (r[:3], r[5], r[4])):
        chain = (number, name, address)
        delta = free - last.get(chain, free)
        last[chain] = free
        slot = out.setdefault((*chain, ms - ms % 600_000), [stands, 0, 0, 0, 0])
        slot[0] = min(slot[0], stands)
        slot[1] += delta
        slot[2] = free
        slot[3] += max(delta, 0)
        slot[4] += max(-delta, 0)
    return {key: tuple(value) for key, value in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_slots_equal_brute_force_with_a_hot_station(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(3000):
        number = 3 if rng.random() < 0.4 else rng.randrange(2, 12)
        rows.append((number, f"S{number}", f"a{number}", 15 + rng.randrange(5), rng.randrange(15),
                     DAY + rng.randrange(3 * clock.MS_PER_DAY)))
    # Keys are unique here, so any row per key is the row.
    rows = list({(r[0], r[5], r[4]): r for r in rows}.values())
    expected = brute_force(rows)
    got = slots.rollup_slots(observations(spark, rows)).collect()
    assert len(got) == len(expected)
    for r in got:
        hour, minute, _ = map(int, r.time.split(":"))
        day = (int(r.date[8:]) - 7) * clock.MS_PER_DAY + DAY
        key = (r.number, r.name, r.address, day + (hour * 60 + minute) * 60_000)
        assert expected[key] == (r.bike_stands, r.diff, r.available_stands, r.check_in, r.check_out)


def test_deltas_telescope(spark):
    rng = random.Random(5)
    rows = [(n, f"S{n}", "a", 30, rng.randrange(30), DAY + rng.randrange(clock.MS_PER_DAY)) for n in (1, 2) for _ in range(200)]
    df = slots.stand_deltas(clean.dedup_observations(observations(spark, rows)))
    got = df.groupBy("number").agg(
        F.sum("diff").alias("total"), F.sum(F.col("check_in") - F.col("check_out")).alias("net"),
        F.min_by("available_bike_stands", F.struct("last_update", "available_bike_stands")).alias("first"),
        F.max_by("available_bike_stands", F.struct("last_update", "available_bike_stands")).alias("last"),
    ).collect()
    assert all(r.total == r.net == r.last - r["first"] for r in got)


def test_no_window_or_shuffle_is_keyed_by_the_station_before_the_rollup(spark, small_dir):
    """Raw rows are only ever shuffled by keys that end in a time."""
    import __spark_entry__ as entry

    plan = entry.queries()["slot_fact"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 3
    assert "last_update" in shuffles[2] and "slot" in shuffles[1]
    assert plan.index("REPARTITION_BY_COL") < plan.index("HashAggregate")
    assert "SinglePartition" not in plan
