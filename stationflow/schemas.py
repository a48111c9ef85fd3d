"""Explicit schemas, as DDL text, of every table that is read from files. The files' column names."""

from __future__ import annotations

# Raw observations, one row per station and poll. last_update is epoch milliseconds.
OBSERVATION = (
    "number BIGINT, name STRING, address STRING, bike_stands BIGINT,"
    " available_bike_stands BIGINT, last_update BIGINT"
)
OBSERVATION_COLUMNS = [
    "number", "name", "address", "bike_stands", "available_bike_stands", "last_update",
]

# Raw snapshot files hold an array of these.
SNAPSHOT = (
    "number BIGINT, name STRING, address STRING, bike_stands BIGINT,"
    " available_bike_stands BIGINT, last_update BIGINT, available_bikes BIGINT,"
    " banking BOOLEAN, bonus BOOLEAN, contract_name STRING,"
    " position STRUCT<lat: DOUBLE, lng: DOUBLE>, status STRING"
)

SLOT_FACT = (
    "number BIGINT, name STRING, address STRING, date STRING, time STRING, weekday STRING,"
    " bike_stands BIGINT, diff BIGINT, available_stands BIGINT, check_in BIGINT, check_out BIGINT"
)

GEOGRAPHY = "number BIGINT, name STRING, address STRING, latitude DOUBLE, longitude DOUBLE"

WEATHER = (
    "station_id STRING, datetime STRING, atmospheric_pressure DOUBLE,"
    " wind_speed DOUBLE, air_temperature DOUBLE"
)

# Times are epoch seconds. The last three fields are absent until an actual is paired.
FORECAST_LOG = (
    "number BIGINT, time BIGINT, pred_stands BIGINT, pred_bikes BIGINT,"
    " actual_time BIGINT, actual_stands BIGINT, actual_bikes BIGINT"
)

# Column headings of the exchanged CSV files.
SLOT_FACT_HEADINGS = {
    "number": "Number", "name": "Name", "address": "Address", "date": "Date", "time": "Time",
    "weekday": "Weekday", "bike_stands": "Bike Stands", "diff": "Diff",
    "available_stands": "Available Stands", "check_in": "Check In", "check_out": "Check Out",
}
FORECAST_LOG_HEADINGS = {
    "number": "Number", "time": "Time", "pred_stands": "Pred Available Bike Stands",
    "pred_bikes": "Pred Bikes", "actual_time": "Actual Time",
    "actual_stands": "Actual Available Bike Stands", "actual_bikes": "Actual Bikes",
}
