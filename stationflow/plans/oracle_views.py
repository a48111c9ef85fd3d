"""The views of ``views.py`` in plain SQL, as a chain of common table expressions."""

from __future__ import annotations

import re

from stationflow.plans.views import CENTERS, TRAINING, UNSEEN

_SLOT = "(last_update - last_update % 600000)"
SLOT_STAMP = f"make_timestamp({_SLOT} * 1000)"

VIEWS: dict[str, str] = {
    "obs_id": """
        SELECT event_id, user_id AS number, concat('STATION ', CAST(user_id AS VARCHAR)) AS name,
               concat('Address ', CAST(user_id % 40 AS VARCHAR)) AS address,
               20 + user_id % 21 AS bike_stands,
               CAST(floor(value) AS BIGINT) % (21 + user_id % 21) AS available_bike_stands,
               epoch_us(ts) // 1000 AS last_update
        FROM events""",
    "obs": """
        SELECT number, name, address, bike_stands, available_bike_stands, last_update FROM obs_id""",
    "obs_dirty": """
        SELECT number, name, address, bike_stands, available_bike_stands, last_update FROM obs_id
        UNION ALL
        SELECT number, name, address, bike_stands, available_bike_stands, last_update
        FROM obs_id WHERE event_id % 10 = 0
        UNION ALL
        SELECT number, NULL AS name, address, bike_stands, available_bike_stands, last_update + 1
        FROM obs_id WHERE event_id % 50 = 0""",
    "obs_clean": """
        SELECT * FROM obs_dirty
        WHERE number IS NOT NULL AND name IS NOT NULL AND address IS NOT NULL AND bike_stands IS NOT NULL
          AND available_bike_stands IS NOT NULL AND last_update IS NOT NULL""",
    "obs_unique": """
        SELECT number, name, address, bike_stands, available_bike_stands, last_update
        FROM (SELECT *, row_number() OVER (PARTITION BY number, last_update, available_bike_stands
                                           ORDER BY name, address, bike_stands) AS rn FROM obs_clean) q
        WHERE rn = 1""",
    "deltas": f"""
        SELECT *, available_bike_stands - last_available_stands AS diff,
               greatest(available_bike_stands - last_available_stands, 0) AS check_in,
               greatest(last_available_stands - available_bike_stands, 0) AS check_out,
               strftime({SLOT_STAMP}, '%Y-%m-%d') AS date, strftime({SLOT_STAMP}, '%H:%M:00') AS time,
               strftime({SLOT_STAMP}, '%a') AS weekday
        FROM (SELECT *, coalesce(lag(available_bike_stands) OVER (
                  PARTITION BY number, name, address ORDER BY last_update, available_bike_stands),
                  available_bike_stands) AS last_available_stands FROM obs_unique) q""",
    "slots": """
        SELECT number, name, address, date, time, weekday,
               min(bike_stands) AS bike_stands, CAST(sum(diff) AS BIGINT) AS diff,
               arg_max(available_bike_stands, last_update * 1000 + available_bike_stands) AS available_stands,
               CAST(sum(check_in) AS BIGINT) AS check_in, CAST(sum(check_out) AS BIGINT) AS check_out
        FROM deltas GROUP BY number, name, address, date, time, weekday""",
    "training": f"SELECT * FROM slots WHERE date BETWEEN '{TRAINING[0]}' AND '{TRAINING[1]}'",
    "unseen": f"SELECT * FROM slots WHERE date BETWEEN '{UNSEEN[0]}' AND '{UNSEEN[1]}'",
    "clusters": """
        SELECT DISTINCT number, time, CAST(1 + number % 4 AS INTEGER) AS cluster
        FROM training WHERE number % 30 <> 29""",
    "stations": "SELECT DISTINCT number, name, address FROM obs",
    "geo": """
        SELECT number, name, address,
               CAST(53.33 AS DOUBLE) + (number % 17) * CAST(0.002 AS DOUBLE) AS latitude,
               CAST(-6.30 AS DOUBLE) + (number % 23) * CAST(0.003 AS DOUBLE) AS longitude
        FROM stations WHERE number % 50 <> 0""",
    "weather_hour": """
        SELECT date_trunc('hour', ts) AS h, min(event_id) AS m
        FROM events WHERE event_type = 'error' GROUP BY date_trunc('hour', ts)""",
    "weather_raw": """
        SELECT 'M2' AS station_id, strftime(h, '%m/%d/%Y %H:%M') AS datetime,
               CAST(990 + m % 40 AS DOUBLE) AS atmospheric_pressure,
               CAST(m % 25 AS DOUBLE) AS wind_speed, CAST(m % 20 AS DOUBLE) AS air_temperature
        FROM weather_hour CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k) copies""",
    "weather": """
        SELECT strftime(strptime(datetime, '%m/%d/%Y %H:%M'), '%Y-%m-%d') AS date,
               strftime(strptime(datetime, '%m/%d/%Y %H:%M'), '%H:%M:00') AS time,
               atmospheric_pressure, wind_speed, air_temperature
        FROM (SELECT DISTINCT station_id, datetime, atmospheric_pressure, wind_speed, air_temperature
              FROM weather_raw) q""",
    "centers": "SELECT * FROM (VALUES "
    + ", ".join(f"({c}, CAST({s} AS DOUBLE))" for c, s in CENTERS)
    + ") AS t(cluster, sum_of_stands)",
    "predictions": """
        SELECT event_id, user_id AS number, epoch_us(ts) // 1000 AS pred_ms, event_id % 25 AS pred_stands
        FROM events WHERE event_type = 'view'""",
    "actuals": """
        SELECT event_id, user_id AS number, epoch_us(ts) // 1000 AS actual_ms, event_id % 25 AS actual_stands
        FROM events WHERE event_type = 'click'""",
    "forecast_log": """
        SELECT user_id AS number, epoch_us(ts) // 1000000 AS time, event_id % 25 AS pred_stands,
               20 + user_id % 21 - event_id % 25 AS pred_bikes,
               CASE WHEN event_id % 7 <> 0 THEN epoch_us(ts) // 1000000 + 900 END AS actual_time,
               CASE WHEN event_id % 7 <> 0 THEN (event_id * 7) % 25 END AS actual_stands,
               CASE WHEN event_id % 7 <> 0 THEN 20 + user_id % 21 - (event_id * 7) % 25 END AS actual_bikes
        FROM events WHERE event_type = 'view'""",
    "latest": """
        SELECT number, name, address, bike_stands, available_bike_stands, last_update
        FROM (SELECT *, row_number() OVER (PARTITION BY number
                  ORDER BY last_update DESC, available_bike_stands DESC, name DESC) AS rn FROM obs) q
        WHERE rn = 1""",
    "live": """
        SELECT number, CASE WHEN number % 10 = 0 THEN 0 ELSE bike_stands END AS bike_stands,
               CASE WHEN number % 10 = 0 THEN 0 ELSE available_bike_stands END AS available_bike_stands,
               CASE WHEN number % 10 = 0 THEN 0 ELSE last_update END AS last_update,
               CASE WHEN number % 10 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(53.34 AS DOUBLE) + (number % 17) * CAST(0.002 AS DOUBLE) END AS latitude,
               CASE WHEN number % 10 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(-6.25 AS DOUBLE) - (number % 23) * CAST(0.003 AS DOUBLE) END AS longitude
        FROM latest""",
    "requests": """
        SELECT number, minutes, CAST(1706515200000 AS BIGINT) AS requested_ms
        FROM (SELECT DISTINCT number FROM obs) s CROSS JOIN (VALUES (0), (15), (30), (45), (60)) AS h(minutes)""",
    "catalog": """
        SELECT s.number, s.name, s.address, s.number % 7 <> 0 AS open,
               CASE WHEN g.number IS NULL THEN '' ELSE concat(CAST(g.latitude AS VARCHAR), ',',
                    CAST(g.longitude AS VARCHAR)) END AS position
        FROM stations s LEFT JOIN geo g ON s.number = g.number""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it needs, in dependency order."""
    known = {**VIEWS, **(extra or {})}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+([a-z_]\w*)", sql):
            if name in known and name not in ordered:
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n].strip()})" for n in ordered) + "\n" + body
