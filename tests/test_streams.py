"""Streams over several micro-batches."""

import json

from stationflow.operators import clean, pairing, slots
from stationflow.schemas import OBSERVATION
from stationflow.streaming import jobs
from tests_support import station_row


def feed(folder, name, rows):
    (folder / name).write_text(json.dumps([station_row(*r) for r in rows]))


def run(stream, tmp_path, label):
    return jobs.run_available(stream, str(tmp_path / label / "out"), str(tmp_path / label / "check"))


def test_deltas_continue_over_batches_and_restarts(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    first = [(1, 1000, 5), (1, 2000, 9), (2, 1000, 3)]
    # the second batch brings rows from between those of the first, and one far later that closes both
    second = [(1, 3000, 4), (1, 1500, 2), (2, 9000, 3), (3, 1, 1), (9, 9_000_000, 1)]
    feed(landing, "a.json", first)
    source = jobs.snapshot_stream(spark, str(landing), max_files=1)
    run(jobs.delta_stream(source), tmp_path, "deltas")
    feed(landing, "b.json", second)
    got = run(jobs.delta_stream(source), tmp_path, "deltas").collect()
    batch = slots.stand_deltas(spark.createDataFrame(
        [(n, f"S{n}", "a", 20, free, ms) for n, ms, free in (first + second)[:-1]], OBSERVATION))
    columns = jobs.DELTA_COLUMNS
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(tuple(r) for r in batch.select(*columns).collect())


def test_deltas_by_slot_equal_the_batch(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    minute = 60_000
    rows = [(1 if i % 3 else 2, 86_400_000 + (i * 7919 % 200) * minute // 4 + i, i * 5 % 17) for i in range(240)]
    ordered = sorted(rows, key=lambda r: r[1] + (r[2] - 8) * 20_000)  # somewhat out of order
    for n in range(4):
        feed(landing, f"{n}.json", ordered[n * 60:(n + 1) * 60])
        got = jobs.deltas_by_slot(jobs.snapshot_stream(spark, str(landing), max_files=1), str(tmp_path / "t"))
    feed(landing, "z.json", [(9, 86_400_000 + 9_000 * minute, 1)])
    got = jobs.deltas_by_slot(jobs.snapshot_stream(spark, str(landing), max_files=1), str(tmp_path / "t"))
    batch = slots.stand_deltas(spark.createDataFrame([(n, f"S{n}", "a", 20, free, ms) for n, ms, free in rows], OBSERVATION))
    columns = jobs.DELTA_COLUMNS
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(tuple(r) for r in batch.select(*columns).collect())


def test_copies_are_dropped_and_open_slots_withheld(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    minute = 60_000
    feed(landing, "a.json", [(1, 1 * minute, 5), (1, 1 * minute, 5), (1, 9 * minute, 7), (1, 45 * minute, 2)])
    rows = jobs.dedup_stream(jobs.timed(jobs.snapshot_stream(spark, str(landing))))
    assert run(rows.drop("event_time"), tmp_path, "dedup").count() == 3
    closed = run(jobs.slot_stream(jobs.timed(jobs.snapshot_stream(spark, str(landing)))), tmp_path, "slots").collect()
    assert [(r.slot_ms, r.available_stands, r.row_count) for r in closed] == [(0, 7, 3)]


def test_pairing_waits_for_a_later_batch(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    minute, day = 60_000, 86_400_000
    schema = "kind STRING, event_id BIGINT, number BIGINT, ms BIGINT, stands BIGINT"

    def source():
        rows = spark.readStream.schema(schema).json(str(landing))
        asked = rows.where("kind = 'p'").selectExpr("event_id", "number", "ms AS pred_ms", "stands AS pred_stands")
        seen = rows.where("kind = 'a'").selectExpr("event_id", "number", "ms AS actual_ms", "stands AS actual_stands")
        return jobs.pair_stream(asked, seen)

    def lines(*rows):
        # away from the beginning of time, where the first watermark is
        return "\n".join(json.dumps(dict(zip(("kind", "event_id", "number", "ms", "stands"), (*r[:3], r[3] + day, r[4])))) for r in rows)

    (landing / "a.json").write_text(lines(("p", 1, 7, 0, 4), ("a", 2, 7, 5 * minute, 9), ("p", 3, 7, 10 * minute, 5)))
    assert run(source(), tmp_path, "pairs").count() == 0
    (landing / "b.json").write_text(lines(("a", 4, 7, 20 * minute, 6), ("a", 5, 7, 3000 * minute, 6)))
    got = run(source(), tmp_path, "pairs").collect()
    assert [(r.event_id, r.actual_event) for r in got] == [(1, 4)]  # 5 is not final yet
    (landing / "c.json").write_text(lines(("p", 6, 8, 3000 * minute, 1), ("a", 7, 8, 9000 * minute, 1)))
    assert sorted((r.event_id, r.actual_event) for r in run(source(), tmp_path, "pairs").collect()) == [(1, 4), (3, 5)]


def test_pairs_by_slot_equal_the_batch(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    minute, day = 60_000, 86_400_000
    schema = "kind STRING, event_id BIGINT, number BIGINT, ms BIGINT, stands BIGINT"
    rows = [("ap"[i // 2 % 2], i, 7 if i % 3 else 8, day + (i * 7919 % 300) * minute + i % 7, i % 19) for i in range(200)]
    ordered = sorted(rows, key=lambda r: r[3] + (r[4] - 9) * 20_000)
    for n in range(5):
        part = ordered[n * 40:(n + 1) * 40] + [("a", 900 + n, 9, day + 20_000 * minute, 1)] * (n == 4)
        (landing / f"{n}.json").write_text("\n".join(json.dumps(dict(zip(("kind", "event_id", "number", "ms", "stands"), r))) for r in part))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(landing))
    sides = [["event_id", "number", f"ms AS {k}_ms", f"stands AS {k}_stands"] for k in ("pred", "actual")]
    asked, seen = (source.where(f"kind = '{k}'").selectExpr(*c) for k, c in zip("pa", sides))
    got = jobs.pairs_by_slot(asked, seen, str(tmp_path / "t"))
    table = spark.createDataFrame(rows, schema)
    batch = pairing.pair_forward(*(table.where(f"kind = '{k}'").selectExpr(*c) for k, c in zip("pa", sides))).where("actual_ms is not null")
    expected = sorted(tuple(r) for r in batch.select(*jobs.PAIR_COLUMNS).collect())
    assert sorted(tuple(r) for r in got.select(*jobs.PAIR_COLUMNS).collect()) == expected and len(expected) > 50


def test_an_actual_before_its_forecast_is_not_forgotten(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    minute = 60_000
    rows = [[("a", 1, 7, 120 * minute, 9)], [("p", 2, 7, 100 * minute, 5), ("a", 3, 7, 150 * minute, 8)], [("a", 4, 7, 199 * minute, 8)]]
    schema = "kind STRING, event_id BIGINT, number BIGINT, ms BIGINT, stands BIGINT"
    for i, part in enumerate(rows):
        (landing / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("kind", "event_id", "number", "ms", "stands"), r))) for r in part))
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(landing))
        asked = source.where("kind = 'p'").selectExpr("event_id", "number", "ms AS pred_ms", "stands AS pred_stands")
        seen = source.where("kind = 'a'").selectExpr("event_id", "number", "ms AS actual_ms", "stands AS actual_stands")
        got = run(jobs.pair_stream(asked, seen, "30 minutes"), tmp_path, "pairs").collect()
    assert [(r.event_id, r.actual_event) for r in got] == [(2, 1)]


def test_intake_takes_each_file_once(spark, small_dir):
    import __spark_entry__ as entry
    from stationflow.plans import views

    got = entry.queries()["stream_intake"](spark, small_dir)
    assert got.count() == clean.dedup_observations(views.obs_json(spark, small_dir)).count()


def test_latest_table_survives_a_repeated_batch(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def state():
        table = jobs.keep_latest(jobs.snapshot_stream(spark, str(landing), max_files=1), out, check)
        return sorted((r.number, r.last_update, r.available_bike_stands) for r in table.collect())

    assert state() == []
    feed(landing, "a.json", [(1, 1000, 5), (2, 3000, 9)])
    assert state() == [(1, 1000, 5), (2, 3000, 9)]
    feed(landing, "b.json", [(1, 900, 7), (2, 4000, 1), (3, 1, 1)])
    assert state() == [(1, 1000, 5), (2, 4000, 1), (3, 1, 1)]
    last = max((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.with_name(f".{last.name}.crc").unlink()
    last.unlink()  # the batch is run again, beside a file that is new
    feed(landing, "c.json", [(3, 2, 2)])
    assert state() == [(1, 1000, 5), (2, 4000, 1), (3, 2, 2)]


def test_unanswered_forecasts_are_let_go(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    minute, day = 60_000, 86_400_000
    schema = "kind STRING, event_id BIGINT, number BIGINT, ms BIGINT, stands BIGINT"
    rows = [[("p", 1, 7, 0, 4), ("p", 2, 8, 0, 4), ("a", 3, 7, 30 * minute, 9)], [("a", 4, 7, 20 * minute, 6), ("a", 5, 8, 200 * minute, 6)],
            [("p", 6, 9, 900 * minute, 1), ("a", 7, 9, 900 * minute, 1)], [("p", 8, 9, 1900 * minute, 1), ("a", 9, 9, 1900 * minute, 1)]]
    for i, part in enumerate(rows):
        (landing / f"{i}.json").write_text("\n".join(
            json.dumps(dict(zip(("kind", "event_id", "number", "ms", "stands"), (*r[:3], r[3] + day, r[4])))) for r in part))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(landing))
    asked = source.where("kind = 'p'").selectExpr("event_id", "number", "ms AS pred_ms", "stands AS pred_stands")
    seen = source.where("kind = 'a'").selectExpr("event_id", "number", "ms AS actual_ms", "stands AS actual_stands")
    got = run(jobs.pair_within(asked, seen, "1 HOUR", "30 minutes"), tmp_path, "pairs").collect()
    assert {(r.event_id, r.actual_event) for r in got} >= {(1, 4), (2, None)} and len({r.event_id for r in got}) == len(got)


def test_many_stations_share_the_groups_of_a_stream(spark, tmp_path):
    """Stations and slots by the thousand are a bounded number of groups, and give what the batch gives."""
    minute, day, n = 60_000, 86_400_000, 3 * jobs.GROUPS
    landing = tmp_path / "in"
    seen = spark.range(2 * n).selectExpr(
        f"id % {n} AS number", f"concat('S', id % {n}) AS name", "'a' AS address", "20L AS bike_stands", "(id * 7) % 20 AS available_bike_stands",
        f"{day} + (id div {n}) * {25 * minute} + id % 1000 AS last_update", "id AS event_id")
    end = spark.createDataFrame([(n, "S", "a", 20, 1, 2 * day, -1)], seen.schema)
    seen.repartition(1).union(end).coalesce(1).write.parquet(str(landing))
    rows = spark.readStream.schema(seen.schema).parquet(str(landing))
    asked = rows.selectExpr("event_id", "number", "last_update AS pred_ms", "available_bike_stands AS pred_stands")
    actual = rows.selectExpr("event_id", "number", "last_update AS actual_ms", "available_bike_stands AS actual_stands")
    streams = {"deltas": jobs.delta_stream(rows), "slots": jobs.slot_delta_stream(rows),
               "pairs": jobs.pair_stream(asked, actual), "slot-pairs": jobs.slot_pair_stream(asked, actual)}
    for label, stream in streams.items():
        path = tmp_path / label
        query = stream.writeStream.format("parquet").option("path", str(path / "out")).option(
            "checkpointLocation", str(path / "check")).trigger(availableNow=True).start()
        query.awaitTermination()
        groups = [state.numRowsTotal for progress in query.recentProgress for state in progress.stateOperators]
        assert 0 < max(groups) <= jobs.GROUPS, label
    batch = slots.stand_deltas(seen.select(*rows.columns[:6]))
    columns = jobs.DELTA_COLUMNS
    expected = sorted(map(tuple, batch.select(*columns).collect()))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "deltas/out")).select(*columns).collect())) == expected
    by_slot = jobs.deltas_by_slot(rows, str(tmp_path / "by-slot"))
    assert sorted(map(tuple, by_slot.select(*columns).collect())) == expected
    table = spark.read.parquet(str(landing))
    paired = pairing.pair_forward(
        table.selectExpr("event_id", "number", "last_update AS pred_ms", "available_bike_stands AS pred_stands"),
        table.selectExpr("event_id", "number", "last_update AS actual_ms", "available_bike_stands AS actual_stands"))
    answers = sorted(map(tuple, paired.where(f"number < {n} AND actual_ms IS NOT NULL").select(*jobs.PAIR_COLUMNS).collect()))
    assert len(answers) == n
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "pairs/out")).select(*jobs.PAIR_COLUMNS).collect())) == answers
    got = jobs.pairs_by_slot(asked, actual, str(tmp_path / "pairs-by-slot"))
    assert sorted(map(tuple, got.select(*jobs.PAIR_COLUMNS).collect())) == answers
