"""Readers and writers on real small files."""

import json

import pytest

from stationflow.operators import features, slots
from stationflow.plans import views
from stationflow.schemas import SLOT_FACT_HEADINGS
from stationflow.sources import files


def station(number, ms, free):
    return {
        "number": number, "name": f"S{number}", "address": "St. Stephen's", "bike_stands": 20,
        "available_bike_stands": free, "last_update": ms, "available_bikes": 20 - free, "banking": True,
        "bonus": False, "contract_name": "x", "position": {"lat": 53.3, "lng": -6.2}, "status": "OPEN",
    }


def land(folder, name, rows):
    (folder / name).write_text(json.dumps(rows))


def test_snapshots_are_arrays_and_empty_files_give_nothing(spark, tmp_path):
    land(tmp_path, "Mon-06-11-2017-08-00.json", [station(1, 1000, 5), station(2, 1000, 6)])
    land(tmp_path, "Mon-06-11-2017-08-05.json", [])
    land(tmp_path, "notes.json", [station(3, 1000, 6)])
    rows = files.read_snapshots_json(spark, str(tmp_path))
    assert rows.count() == 3 and rows.columns[:6] == views.clean.OBSERVATION_COLUMNS
    assert [r.path.split("/")[-1] for r in files.unmatched_files(rows).collect()] == ["notes.json"]


def test_compaction_reads_only_new_files_and_merges_late_ones(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    land(landing, "Mon-06-11-2017-08-00.json", [station(1, 1000, 5)])
    land(landing, "Mon-06-11-2017-08-05.json", [station(1, 1000, 5), station(1, 2000, 6)])
    land(landing, "notes.json", [station(9, 1000, 5)])
    for _ in range(2):  # the second run finds nothing new
        left = files.compact_days(spark, str(landing), out)
        assert [r.path.split("/")[-1] for r in left.collect()] == ["notes.json"]
        assert files.read_compacted(spark, out).count() == 2
    # a file that has been taken is not read again, whatever becomes of it
    (landing / "Mon-06-11-2017-08-00.json").write_text("broken")
    land(landing, "Mon-06-11-2017-09-00.json", [station(1, 9000, 5), station(1, 2000, 6)])
    land(landing, "Tue-07-11-2017-08-00.json", [station(1, 3000, 7)])
    files.compact_days(spark, str(landing), out)
    kept = files.read_compacted(spark, out).collect()
    assert sorted((r.day, r.last_update) for r in kept) == [
        ("Mon-06-11-2017", 1000), ("Mon-06-11-2017", 2000), ("Mon-06-11-2017", 9000), ("Tue-07-11-2017", 3000)]


def test_compaction_in_small_rounds_is_the_same(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for i in range(5):
        land(landing, f"Mon-06-11-2017-08-0{i}.json", [station(1, 1000 + i // 2, 5), station(2, 1000 * i, 6)])
    rows = []
    for n in (1, 2, 100):
        files.compact_days(spark, str(landing), str(tmp_path / f"out{n}"), at_once=n)
        rows.append(sorted((r.number, r.last_update, r.path) for r in files.read_compacted(spark, str(tmp_path / f"out{n}")).collect()))
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 8


def test_all_readers_find_columns_by_heading(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(text)
        return str(tmp_path / name)

    geo = files.read_geography(spark, put("geo", ",Longitude,LATITUDE,Address,Name,Number\n0,-6.2,53.3,Rue,S1,1\n")).first()
    assert tuple(geo) == (1, "S1", "Rue", 53.3, -6.2)
    weather = files.read_weather(spark, put("w", "Air Temperature,datetime,station id,x,wind-speed,atmospheric_pressure\n7.5,01/02/2017 10:00,M2,9,3,1000\n")).first()
    assert tuple(weather) == ("M2", "01/02/2017 10:00", 1000.0, 3.0, 7.5)
    slot = files.read_slots_csv(spark, put("s", ",".join(["", *reversed(list(SLOT_FACT_HEADINGS.values()))]) + "\n7,1,2,3,4,20,Mon,10:00:00,2017-11-06,Rue,S1,1\n")).first()
    assert (slot.number, slot.date, slot.check_out, slot.bike_stands, slot.diff) == (1, "2017-11-06", 1, 20, 4)
    log = files.read_forecast_log(spark, put("l", "Pred Bikes,Time,Number,Pred Available Bike Stands\n22,100,79,5\n")).first()
    assert tuple(log) == (79, 100, 5, 22, None, None, None)


def test_fields_of_another_type_are_reported(spark, tmp_path):
    (tmp_path / "a.csv").write_text("number,name,address,latitude,longitude\n1,S1,a,53.3,west\nx,S2,b,,-6\n")
    (tmp_path / "b.csv").write_text("longitude,latitude,address,name,number\n-6,53,c,S3,3\n")
    rows = files.read_headed(spark, str(tmp_path), "number BIGINT, name STRING, address STRING, latitude DOUBLE, longitude DOUBLE")
    assert sorted((r.name, r.number, r.longitude) for r in rows.collect()) == [("S1", 1, None), ("S2", None, -6.0), ("S3", 3, -6.0)]
    found = {(r.path.split("/")[-1], r.column): r.row_count for r in files.type_conflicts(rows).collect()}
    assert found == {("a.csv", "longitude"): 1, ("a.csv", "number"): 1}


def test_account_of_log_files(spark, tmp_path):
    head = "Number,Time,Pred Available Bike Stands,Pred Bikes,Actual Time,Actual Available Bike Stands,Actual Bikes\n"
    (tmp_path / "a.csv").write_text(head + "79,100,5,22,1000,6,21\n5,100,7,33\n66,100,\n\n9,x,1,2,3,4,5\n1,2,3,4,5,6,7,8\n")
    (tmp_path / "b.csv.gz").write_bytes(b"this is not gzip")
    (tmp_path / "c.csv").write_text(head)
    (tmp_path / "d.csv").write_text("")
    found = {r.path.split("/")[-1]: tuple(r)[1:] for r in files.log_account(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": (5, 1, 3, False), "b.csv.gz": (0, 0, 0, True), "c.csv": (0, 0, 0, False)}


def test_headings_place_the_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text(',number,name,address,bike_stands,available_bike_stands,last_update\n0,4,"A ""B"", C"," lead ",20,3,1000\n')
    (tmp_path / "b.csv").write_text('last_update,name,number,address,bike_stands,available_bike_stands,Unnamed: 6\n2000,,5,"",20.0,4.0,x\n')
    (tmp_path / "c.csv").write_text("")
    rows = {r.number: r for r in files.read_observations_csv(spark, str(tmp_path), "UTF-8").collect()}
    assert (rows[4].name, rows[4].address, rows[4].last_update) == ('A "B", C', " lead ", 1000)
    assert (rows[5].name, rows[5].address, rows[5].bike_stands, rows[5].available_bike_stands) == (None, "", 20, 4)
    (tmp_path / "d.csv").write_text("number,name\n1,x\n")
    with pytest.raises(ValueError, match="d.csv"):
        files.read_observations_csv(spark, str(tmp_path))


def test_latin1_history_and_preparation(spark, tmp_path):
    text = "number,name,address,bike_stands,available_bike_stands,last_update\n7,CAF\xc9,Rue,20,4,1000\n7,CAF\xc9,Rue,,4,2000\n"
    (tmp_path / "export.csv").write_bytes(text.encode("latin-1"))
    rows = files.prepare(files.read_observations_csv(spark, str(tmp_path))).collect()
    assert [(r.name, r.available_bike_stands) for r in rows] == [("CAF\xc9", 4)]


def test_short_and_broken_log_files(spark, tmp_path):
    head = "Number,Time,Pred Available Bike Stands,Pred Bikes,Actual Time,Actual Available Bike Stands,Actual Bikes\n"
    (tmp_path / "a.csv").write_text(head + "79,100,5,22,1000,6,21\n5,100,7,33\n66,100,\n")
    (tmp_path / "b.csv.gz").write_bytes(b"this is not gzip")
    rows = {r.number: r for r in files.read_forecast_log(spark, str(tmp_path)).collect()}
    assert set(rows) == {79, 5, 66}
    assert rows[5].actual_time is None and rows[66].pred_stands is None and rows[79].actual_bikes == 21


def test_csv_headings_at_the_edge(spark, small_dir, tmp_path):
    table, path = views.slot_table(spark, small_dir), str(tmp_path / "csv")
    files.save_csv(table, path, SLOT_FACT_HEADINGS)
    assert spark.read.option("header", True).csv(path).columns == list(SLOT_FACT_HEADINGS.values())
    assert dict(files.read_slots_csv(spark, path, parse_dates=True).dtypes)["date"] == "date"


def test_slot_store_prunes_by_date(spark, small_dir, tmp_path):
    path = str(tmp_path / "slots")
    files.write_slots(views.slot_table(spark, small_dir), path)
    week = views.in_range(files.read_slots(spark, path), views.UNSEEN)
    plan = week.select("number", "date")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "ReadSchema: struct<number:bigint>" in plan
    assert slots.slot_key_counts(files.read_slots(spark, path)).where("slot_rows <> distinct_keys").count() == 0


def test_bucketed_slots_are_not_shuffled_for_features(spark, small_dir, tmp_path):
    files.save_station_buckets(views.slot_table(spark, small_dir), "slots_by_station", str(tmp_path / "b"), 4)
    try:
        rows = features.with_previous(features.half_hour_rollup(
            features.attach_cluster(spark.table("slots_by_station"), views.clusters(spark, small_dir)), "truncate"))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        before_slots = plan[:plan.index("slots_by_station")]
        # Only the cluster side, which comes after the slot scan, is shuffled or broadcast.
        assert "Exchange" not in before_slots and "Bucketed: true" in plan
        assert rows.count() == features.half_hour_rollup(
            features.attach_cluster(views.slot_table(spark, small_dir), views.clusters(spark, small_dir)), "truncate").count()
    finally:
        spark.sql("DROP TABLE slots_by_station")
