"""SQL equivalents of the registered queries."""

from __future__ import annotations

from stationflow.functions.clock import SLOT_LEVELS, WEEKDAYS
from stationflow.plans.oracle_views import SLOT_STAMP, VIEWS, with_views
from stationflow.plans.views import TRAINING, UNSEEN

ORACLE: dict[str, str] = {}

_RAW = "number, name, address, bike_stands, available_bike_stands, last_update"


def add(name: str, body: str, **extra: str) -> None:
    ORACLE[name] = with_views(body, extra)


def _top(measure: str, order: str) -> str:
    expr = {"activity": "check_in + check_out"}.get(measure, measure)
    return f"""SELECT address, CAST(sum({expr}) AS BIGINT) AS total_{measure}
        FROM slots GROUP BY address ORDER BY total_{measure} {order}, address LIMIT 10"""


def _pivot(agg: str, expr: str) -> str:
    columns = ", ".join(f"{agg.format(f'CASE WHEN weekday = {chr(39)}{d}{chr(39)} THEN {expr} END')} AS {d}" for d in WEEKDAYS)
    return f"SELECT number, name, {columns} FROM slots GROUP BY number, name"


add("clean_observations", f"SELECT {_RAW} FROM obs_clean")
add("dedup_observations", f"SELECT {_RAW} FROM obs_unique")
add("union_sources", f"""
    SELECT {_RAW}, CAST(0 AS INTEGER) AS source_priority FROM obs_id WHERE event_id % 2 = 0
    UNION ALL SELECT {_RAW}, CAST(1 AS INTEGER) AS source_priority FROM obs_id WHERE event_id % 2 = 1""")
add("source_counts", """
    SELECT CAST(event_id % 2 AS INTEGER) AS source_priority, count(*) AS row_count FROM obs_id GROUP BY 1""")
add("rename_stations", """
    SELECT number, CASE WHEN number = 1 THEN 'CLARENDON ROW' ELSE name END AS name,
           CASE WHEN number = 1 THEN 'Claredon Row' ELSE address END AS address,
           bike_stands, available_bike_stands, last_update FROM obs""")
add("stand_deltas", f"SELECT {_RAW}, last_available_stands, diff, check_in, check_out FROM deltas")
add("slot_fact", "SELECT * FROM slots")
add("slot_uniqueness", """
    SELECT date, count(*) AS slot_rows,
           count(DISTINCT concat(number, '|', name, '|', address, '|', time, '|', weekday)) AS distinct_keys
    FROM slots GROUP BY date""")
add("latest_state", f"SELECT {_RAW} FROM latest")
add("date_coverage", "SELECT date, count(*) AS row_count FROM slots GROUP BY date")
add("top_checkins", _top("check_in", "DESC"))
add("top_checkouts", _top("check_out", "DESC"))
add("busiest", _top("activity", "DESC"))
add("quietest", _top("activity", "ASC"))
for _query, _measure in (("top_checkin_detail", "check_in"), ("top_checkout_detail", "check_out")):
    add(_query, f"SELECT slots.*, best.total_{_measure} FROM slots JOIN best ON slots.address = best.address",
        best=_top(_measure, "DESC"))
add("avg_ci_by_weekday", _pivot("avg({})", "check_in"))
add("avg_co_by_weekday", _pivot("avg({})", "check_out"))
add("usage_by_weekday", _pivot("CAST(sum({}) AS BIGINT)", "check_in + check_out"))

_FENCES = """
    SELECT weekday, count(*) AS n, quantile_cont(CAST(value AS DOUBLE), 0.25) AS q1,
           quantile_cont(CAST(value AS DOUBLE), 0.5) AS median,
           quantile_cont(CAST(value AS DOUBLE), 0.75) AS q3
    FROM station_values GROUP BY weekday"""
add("weekday_box_stats", """
    SELECT f.weekday, f.n, CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS outliers,
           round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(least(q1, min(CASE WHEN inside THEN value END)), 6) AS whisker_low,
           round(greatest(q3, max(CASE WHEN inside THEN value END)), 6) AS whisker_high
    FROM (SELECT f.*, v.value, v.value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM station_values v JOIN fences f ON v.weekday = f.weekday) f
    GROUP BY f.weekday, f.n, q1, median, q3""",
    station_values="SELECT number, name, weekday, avg(check_in) AS value FROM slots GROUP BY number, name, weekday",
    fences=_FENCES)
add("weekday_outliers", """
    SELECT v.number, v.name, v.weekday, v.value FROM station_values v JOIN fences f ON v.weekday = f.weekday
    WHERE v.value < q1 - 1.5 * (q3 - q1) OR v.value > q3 + 1.5 * (q3 - q1)""",
    station_values="""SELECT number, name, weekday, CAST(sum(check_in + check_out) AS BIGINT) AS value
        FROM slots GROUP BY number, name, weekday""",
    fences=_FENCES)

_PLOTS = " UNION ALL ".join(
    f"SELECT number, name, weekday, '{m}' AS measure, CAST({e} AS DOUBLE) AS value FROM slots GROUP BY number, name, weekday"
    for m, e in (("check_in", "avg(check_in)"), ("check_out", "avg(check_out)"), ("activity", "sum(check_in + check_out)")))
_PLOT_FENCES = """
    SELECT measure, weekday, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
           quantile_cont(value, 0.75) AS q3 FROM plot_values GROUP BY measure, weekday"""
add("weekday_boxes", """
    SELECT measure, weekday, n, CAST(count(*) FILTER (WHERE NOT inside) AS BIGINT) AS outliers,
           round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(least(q1, min(CASE WHEN inside THEN value END)), 6) AS whisker_low,
           round(greatest(q3, max(CASE WHEN inside THEN value END)), 6) AS whisker_high
    FROM (SELECT f.*, v.value, v.value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM plot_values v JOIN plot_fences f ON v.weekday = f.weekday AND v.measure = f.measure) f
    GROUP BY measure, weekday, n, q1, median, q3""", plot_values=_PLOTS, plot_fences=_PLOT_FENCES)
add("weekday_box_outliers", """
    SELECT v.number, v.name, v.weekday, v.measure, round(v.value, 6) AS value
    FROM plot_values v JOIN plot_fences f ON v.weekday = f.weekday AND v.measure = f.measure
    WHERE v.value < q1 - 1.5 * (q3 - q1) OR v.value > q3 + 1.5 * (q3 - q1)""", plot_values=_PLOTS, plot_fences=_PLOT_FENCES)

# Clusters and profiles. Unused helper views are left out of the text by with_views.

_HALF = "CASE WHEN substr({t}, 4, 2) < '30' THEN substr({t}, 1, 2) || ':00:00' ELSE substr({t}, 1, 2) || ':30:00' END"
_SEASON = """CASE WHEN month({d}) IN (11, 12, 1) THEN 'Winter' WHEN month({d}) IN (2, 3, 4) THEN 'Spring'
    WHEN month({d}) IN (5, 6, 7) THEN 'Summer' ELSE 'Autumn' END"""
_FEATURE_KEY = "number, name, address, date, time, bike_stands, weekday, season"


def _clustered(source: str) -> str:
    return f"""
        SELECT s.*, c.cluster FROM {source} s
        LEFT JOIN clusters c ON s.number = c.number AND s.time = c.time"""


def _rolled(source: str, whole: str) -> str:
    return f"""
        SELECT {_FEATURE_KEY}, {whole} AS avg_stands, arg_min(cluster, time10) FILTER (cluster IS NOT NULL) AS cluster
        FROM (SELECT number, name, address, date, {_HALF.format(t="time")} AS time, time AS time10, bike_stands,
                     weekday, {_SEASON.format(d="CAST(date AS DATE)")} AS season, available_stands, cluster
              FROM {source}) q
        GROUP BY {_FEATURE_KEY}"""


_TRUNCATE = "CAST(trunc(avg(available_stands)) AS BIGINT)"
_HALF_EVEN = "CAST(round_even(avg(available_stands), 0) AS BIGINT)"


def _previous(source: str) -> str:
    return f"""
        SELECT *, coalesce(lag(avg_stands) OVER (PARTITION BY number, name, address, date
            ORDER BY time, bike_stands), avg_stands) AS prev_stands FROM {source}"""


def _located(source: str) -> str:
    return f"SELECT f.*, g.latitude, g.longitude FROM {source} f LEFT JOIN geo g ON f.number = g.number"


_STEPS = {
    "grid": """
        SELECT d.number, d.date, t.time, s.available_stands
        FROM (SELECT DISTINCT number, date FROM slots) d CROSS JOIN (SELECT DISTINCT time FROM slots) t
        LEFT JOIN slots s ON s.number = d.number AND s.date = d.date AND s.time = t.time""",
    "filled": """
        SELECT number, date, time, coalesce(
            last_value(available_stands IGNORE NULLS) OVER (PARTITION BY time ORDER BY number, date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(available_stands IGNORE NULLS) OVER (PARTITION BY time ORDER BY number, date
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS available_stands
        FROM grid""",
    "filled_station": """
        SELECT number, date, time, coalesce(
            last_value(available_stands IGNORE NULLS) OVER (PARTITION BY number, time ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(available_stands IGNORE NULLS) OVER (PARTITION BY number, time ORDER BY date
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS available_stands
        FROM grid""",
    "profile": "SELECT number, name, time, avg(available_stands) AS stands FROM training GROUP BY number, name, time",
    "sums": "SELECT number, sum(stands) AS station_sum FROM profile GROUP BY number",
    "nearest": """
        SELECT number, cluster, gap FROM (
            SELECT s.number, c.cluster, abs(c.sum_of_stands - s.station_sum) AS gap, row_number() OVER (
                PARTITION BY s.number ORDER BY abs(c.sum_of_stands - s.station_sum), c.cluster) AS rn
            FROM sums s CROSS JOIN centers c) q WHERE rn = 1""",
    "clustered": _clustered("training"),
    "activity": """
        SELECT number, cluster, CAST(sum(check_in + check_out) AS BIGINT) AS total_activity
        FROM clustered WHERE cluster IS NOT NULL GROUP BY number, cluster""",
    "most": """
        SELECT number, cluster, total_activity FROM activity a
        WHERE total_activity = (SELECT max(total_activity) FROM activity b WHERE b.cluster = a.cluster)""",
    "least": """
        SELECT number, cluster, total_activity FROM activity a
        WHERE total_activity = (SELECT min(total_activity) FROM activity b WHERE b.cluster = a.cluster)""",
    "not_most": """
        SELECT DISTINCT number, cluster FROM clustered
        WHERE cluster IS NOT NULL AND number NOT IN (SELECT number FROM most)""",
    "extremes": "SELECT number FROM most UNION SELECT number FROM least",
    "not_extreme": """
        SELECT DISTINCT number, cluster FROM clustered
        WHERE cluster IS NOT NULL AND number NOT IN (SELECT number FROM extremes)""",
    "rolled": _rolled("clustered", _TRUNCATE),
    "rolled_even": _rolled("clustered", _HALF_EVEN),
    "with_prev": _previous("rolled"),
    "features": _located("with_prev"),
    "features_weather": """
        SELECT f.*, w.atmospheric_pressure, w.wind_speed, w.air_temperature
        FROM features f LEFT JOIN weather w ON f.date = w.date AND f.time = w.time""",
    "coded": """
        SELECT *, CAST(isodow(CAST(date AS DATE)) - 1 AS INTEGER) AS weekday_code,
               CAST(dense_rank() OVER (ORDER BY season) - 1 AS INTEGER) AS season_code,
               CAST(dense_rank() OVER (ORDER BY time) - 1 AS INTEGER) AS time_code
        FROM features""",
    "clustered_week": _clustered("unseen"),
    "rolled_week": _rolled("clustered_week", _HALF_EVEN),
    "prev_week": _previous("rolled_week"),
    "scored": "SELECT p.*, prev_stands AS pred FROM prev_week p",
    "in_service": "SELECT * FROM scored WHERE time >= '05:30:00'",
    "fit": """
        SELECT count(*) AS n, avg(power(CAST(avg_stands - pred AS DOUBLE), 2)) AS mse,
               sqrt(avg(power(CAST(avg_stands - pred AS DOUBLE), 2))) AS rmse FROM scored""",
    "parted": """
        SELECT f.*, prev_stands AS pred, CAST(concat('0x', substr(md5(concat(number, '|', name, '|', address, '|',
               date, '|', time, '|', bike_stands, '|7')), 1, 8)) AS BIGINT) % 100 < 67 AS training_part
        FROM features f""",
    "fanned": """
        SELECT f.number, f.address, f.time, f.bike_stands, t.avg_stands, t.pred, t.latitude, t.longitude
        FROM (SELECT * FROM parted WHERE NOT training_part) t JOIN features f
        ON t.latitude = f.latitude AND t.longitude = f.longitude AND t.time = f.time""",
    "log_complete": """
        SELECT number, pred_stands, bike_stands - pred_stands AS pred_bikes, actual_time, actual_stands,
               bike_stands - actual_stands AS actual_bikes, bike_stands,
               strftime(make_timestamp(actual_time * 1000000), '%Y-%m-%d') AS date,
               strftime(make_timestamp((actual_time - actual_time % 600) * 1000000), '%H:%M:00') AS time,
               CASE WHEN pred_stands <= actual_stands THEN 1 ELSE 0 END AS sufficient
        FROM (SELECT *, CASE number WHEN 79 THEN 27 WHEN 5 THEN 40 WHEN 100 THEN 25 WHEN 66 THEN 40 ELSE 23 END
                  AS bike_stands FROM forecast_log) q
        WHERE actual_time IS NOT NULL AND actual_stands IS NOT NULL AND actual_bikes IS NOT NULL""",
    "log_rows": "SELECT * FROM log_complete WHERE time >= '05:30:00'",
    "parts": f"""
        SELECT *, {_HALF.format(t="slot_time")} AS time, strftime(make_timestamp(target_ms * 1000), '%a') AS weekday,
               {_SEASON.format(d="make_timestamp(target_ms * 1000)")} AS season
        FROM (SELECT *, strftime(make_timestamp(target_ms * 1000), '%H:%M:00') AS slot_time
              FROM (SELECT *, requested_ms + CAST(round(round(minutes / 60.0, 2) * 3600000) AS BIGINT) AS target_ms
                    FROM requests) q) p""",
    "clustered_all": _clustered("slots"),
    "rolled_all": _rolled("clustered_all", _HALF_EVEN),
    "prev_all": _previous("rolled_all"),
    "history": _located("prev_all"),
    "time_codes": f"""
        SELECT time, CAST(row_number() OVER (ORDER BY time) - 1 AS INTEGER) AS time_code
        FROM (SELECT DISTINCT {_HALF.format(t="time")} AS time FROM training) q""",
    "season_codes": f"""
        SELECT season, CAST(row_number() OVER (ORDER BY season) - 1 AS INTEGER) AS season_code
        FROM (SELECT DISTINCT {_SEASON.format(d="CAST(date AS DATE)")} AS season FROM training) q""",
    "context_groups": """
        SELECT h.number, h.name, h.address, h.time, h.weekday, h.season, h.cluster, h.latitude, h.longitude,
               CAST(isodow(CAST(min(h.date) AS DATE)) - 1 AS INTEGER) AS weekday_code, t.time_code, s.season_code,
               max(h.bike_stands) AS bike_stands,
               CAST(round_even(avg(h.avg_stands), 0) AS BIGINT) AS avg_stands,
               CAST(round_even(avg(h.prev_stands), 0) AS BIGINT) AS prev_stands
        FROM history h JOIN time_codes t ON h.time = t.time JOIN season_codes s ON h.season = s.season
        WHERE h.cluster IS NOT NULL AND h.latitude IS NOT NULL AND h.longitude IS NOT NULL
        GROUP BY h.number, h.name, h.address, h.time, h.weekday, h.season, h.cluster, h.latitude, h.longitude,
                 t.time_code, s.season_code""",
    "context": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY number, time, weekday, season
            ORDER BY name, address, weekday_code, time_code, season_code, cluster, latitude, longitude) AS rn
            FROM context_groups) q WHERE rn = 1""",
    "spans": """
        SELECT number, arg_min(bike_stands, name || address || date || time) AS first_capacity,
               arg_max(date || ' ' || time, name || address || date || time) AS saved_update
        FROM slots GROUP BY number""",
    "inputs": """
        SELECT p.number, p.minutes, c.avg_stands, sp.first_capacity, c.bike_stands,
               l.bike_stands AS live_capacity, l.available_bike_stands AS live_stands, l.last_update AS live_update,
               CASE WHEN failed THEN c.latitude ELSE l.latitude END AS latitude,
               CASE WHEN failed THEN c.longitude ELSE l.longitude END AS longitude,
               CASE WHEN failed THEN c.prev_stands ELSE l.available_bike_stands END AS prev_stands,
               CASE WHEN failed THEN c.bike_stands ELSE l.bike_stands END AS current_capacity,
               CASE WHEN failed THEN sp.saved_update ELSE live_text END AS last_update, live_text
        FROM parts p
        LEFT JOIN context c ON p.number = c.number AND p.time = c.time AND p.weekday = c.weekday
             AND p.season = c.season
        LEFT JOIN spans sp ON p.number = sp.number
        LEFT JOIN (SELECT *, bike_stands = 0 AND available_bike_stands = 0 AS failed,
                          strftime(make_timestamp(last_update // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS live_text
                   FROM live) l ON p.number = l.number""",
    "answers": """
        SELECT number, minutes, CASE WHEN good THEN 200 ELSE 500 END AS status,
               CASE WHEN good THEN capacity - free END AS available_bikes,
               CASE WHEN good THEN free END AS available_bike_stands,
               CASE WHEN good THEN old END AS old_bike_stands,
               CASE WHEN good THEN capacity END AS curr_bike_stands,
               CASE WHEN good THEN updated END AS last_update,
               CASE WHEN NOT good THEN CASE WHEN first_capacity IS NULL THEN 'unknown station'
                    WHEN avg_stands IS NULL THEN 'no history for this moment'
                    ELSE 'a factor of the forecast is missing' END END AS error
        FROM (SELECT *, CASE WHEN minutes <= 0 THEN first_capacity IS NOT NULL
                             ELSE avg_stands IS NOT NULL AND prev_stands IS NOT NULL END AS good,
                     CASE WHEN minutes <= 0 THEN live_stands ELSE prev_stands END AS free,
                     CASE WHEN minutes <= 0 THEN live_capacity ELSE current_capacity END AS capacity,
                     CASE WHEN minutes <= 0 THEN first_capacity ELSE bike_stands END AS old,
                     CASE WHEN minutes <= 0 THEN CASE WHEN live_update > 0 THEN live_text END
                          ELSE last_update END AS updated
              FROM inputs) q""",
    "overlaid": """
        SELECT c.*, a.curr_bike_stands AS bike_stands, a.available_bike_stands AS available_stands, a.available_bikes
        FROM catalog c LEFT JOIN (SELECT * FROM answers WHERE minutes = 15 AND status = 200) a
        ON c.number = a.number""",
}


def step(name: str, body: str) -> None:
    ORACLE[name] = with_views(body, _STEPS)


_MATRIX = "SELECT number, date, " + ", ".join(
    f"max(CASE WHEN time = '{t}' THEN available_stands END) AS \"{t}\"" for t in SLOT_LEVELS
) + " FROM grid GROUP BY number, date"
_SCORED_KEY = "number, date, time, bike_stands"

step("date_range_filter", "SELECT * FROM unseen")
step("weekday_weekend_split", """
    SELECT *, CASE WHEN weekday IN ('Mon', 'Tue', 'Wed', 'Thu', 'Fri') THEN 'weekday' ELSE 'weekend' END AS part
    FROM slots""")
step("time_levels", "SELECT DISTINCT time FROM slots ORDER BY time")
step("slot_grid", "SELECT * FROM grid")
step("filled_days", "SELECT number, date, time, available_stands FROM filled")
step("gap_fill", "SELECT * FROM filled")
step("gap_fill_station", "SELECT * FROM filled_station")
step("slot_matrix", _MATRIX)
step("slot_matrix_melt", f"""
    SELECT d.number, d.date, t.time, s.available_stands
    FROM (SELECT DISTINCT number, date FROM slots) d
    CROSS JOIN (VALUES {", ".join(f"('{t}')" for t in SLOT_LEVELS)}) AS t(time)
    LEFT JOIN slots s ON s.number = d.number AND s.date = d.date AND s.time = t.time""")
step("wss_k1", """
    SELECT max(n) AS n, round((max(n) - 1) * sum(v), 3) AS wss
    FROM (SELECT time, count(available_stands) AS n, var_samp(available_stands) AS v FROM filled GROUP BY time) q""")
step("station_profile", "SELECT * FROM profile")
step("profile_sums", "SELECT number, round(station_sum, 6) AS station_sum FROM sums")
step("assign_cluster", "SELECT number, cluster, round(gap, 6) AS gap FROM nearest")
step("label_profile", "SELECT p.*, n.cluster FROM profile p LEFT JOIN nearest n ON p.number = n.number")
step("cluster_join", f"""
    SELECT s.*, c.cluster FROM slots s LEFT JOIN clusters c ON s.number = c.number AND s.time = c.time
    WHERE s.date BETWEEN '{TRAINING[0]}' AND '{UNSEEN[1]}'""")
step("cluster_activity", "SELECT * FROM activity")
step("cluster_top_station", "SELECT * FROM most")
step("cluster_bottom_station", "SELECT * FROM least")
step("unselected_anti", "SELECT * FROM not_most")


def _draw(source: str) -> str:
    return f"""
        SELECT number, cluster FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY
            CAST(concat('0x', substr(md5(concat(number, '|7')), 1, 8)) AS BIGINT), number) AS pick FROM {source}) q
        WHERE pick <= 3"""


_CHOSEN = f"SELECT number FROM extremes UNION SELECT number FROM ({_draw('not_extreme')}) d"
step("cluster_sample", _draw("not_most"))
step("selected_stations", _CHOSEN)
step("selected_semi", f"SELECT * FROM training WHERE number IN ({_CHOSEN})")
step("feature_rollup", "SELECT * FROM rolled")
step("feature_rollup_half_even", "SELECT * FROM rolled_even")
step("prev_stands", "SELECT * FROM with_prev")
step("geo_join", "SELECT * FROM features")
step("weather_clean", "SELECT * FROM weather")
step("weather_join", "SELECT * FROM features_weather")
step("weather_impute", """
    SELECT number, date, time, bike_stands, """ + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM features_weather)), 6) AS {c}"
    for c in ("atmospheric_pressure", "wind_speed", "air_temperature")) + " FROM features_weather")
step("label_encode", f"SELECT {_SCORED_KEY}, weekday_code, season_code, time_code FROM coded")
step("label_decode", "SELECT number, date, bike_stands, time_code, time FROM coded")
step("slot10", """
    SELECT event_id, CAST(minute(ts) AS INTEGER) AS minute,
           lpad(CAST(minute(ts) // 10 * 10 AS VARCHAR), 2, '0') AS ten FROM events""")
step("slot30", f"SELECT event_id, {_HALF.format(t='''strftime(ts, '%H:%M:%S')''')} AS half_hour FROM events")
step("season", f"SELECT o_orderkey, {_SEASON.format(d='o_orderdate')} AS season FROM orders")
step("epoch_to_ts", """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_ms,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_seconds FROM events""")
step("time_parts", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
           concat(strftime(ts, '%H:'), lpad(CAST(minute(ts) // 10 * 10 AS VARCHAR), 2, '0'), ':00') AS time,
           strftime(ts, '%a') AS weekday, CAST(isodow(ts) - 1 AS INTEGER) AS weekday_code FROM events""")
step("half_even", """
    SELECT l_orderkey, l_linenumber, CAST(round_even(CAST(l_quantity AS DOUBLE) / 2, 0) AS BIGINT) AS rounded,
           CAST(trunc(-CAST(l_quantity AS DOUBLE) / 2 - 0.2) AS BIGINT) AS cut FROM lineitem""")
step("capacity_lookup", """
    SELECT number, CAST(CASE number WHEN 79 THEN 27 WHEN 5 THEN 40 WHEN 100 THEN 25 WHEN 66 THEN 40 ELSE 23 END
        AS BIGINT) AS capacity FROM (SELECT DISTINCT number FROM obs) q""")
step("service_hours", "SELECT * FROM slots WHERE time >= '05:30:00'")
step("unseen_errors", f"""
    SELECT {_SCORED_KEY}, avg_stands, pred, abs(avg_stands - pred) AS error FROM in_service""")
step("regression_error", """
    SELECT count(*) AS n, round(avg(power(CAST(avg_stands - pred AS DOUBLE), 2)), 6) AS mse,
           round(sqrt(avg(power(CAST(avg_stands - pred AS DOUBLE), 2))), 6) AS rmse FROM in_service""")
step("prediction_band", f"""
    SELECT {_SCORED_KEY}, pred, round(pred - rmse, 6) AS band_low, round(pred + rmse, 6) AS band_high
    FROM scored CROSS JOIN fit""")
step("supply_class", f"""
    SELECT {_SCORED_KEY}, pred, upper, lower, upper - avg_stands AS upper_gap, abs(avg_stands - lower) AS lower_gap,
           CASE WHEN avg_stands BETWEEN lower AND upper THEN 'Sufficient' WHEN avg_stands > upper THEN 'Oversupply'
                ELSE 'Insufficient' END AS supply,
           CASE WHEN number < 26 THEN '1-25' WHEN number < 51 THEN '26-50' WHEN number < 76 THEN '51-75'
                ELSE '76-102' END AS station_range
    FROM (SELECT s.*, greatest(CAST(round_even(pred + rmse, 0) AS BIGINT), 0) AS upper,
                 greatest(CAST(round_even(pred - rmse, 0) AS BIGINT), 0) AS lower FROM scored s CROSS JOIN fit) q""")
step("unseen_profile", """
    SELECT number, address, time, weekday, CAST(round_even(avg(avg_stands), 0) AS BIGINT) AS avg_stands,
           CAST(round_even(avg(pred), 0) AS BIGINT) AS pred, max(bike_stands) AS bike_stands
    FROM in_service GROUP BY number, address, time, weekday""")
step("unseen_guard", """
    SELECT number, address, time, weekday, CAST(round_even(avg(avg_stands), 0) AS BIGINT) AS avg_stands,
           CAST(round_even(avg(pred), 0) AS BIGINT) AS pred, max(bike_stands) AS bike_stands, 'some' AS week
    FROM in_service GROUP BY number, address, time, weekday""")
step("split_counts", """
    SELECT CASE WHEN training_part THEN 'train' ELSE 'test' END AS part, date, count(*) AS row_count
    FROM parted GROUP BY 1, 2""")
step("test_fanout_join", """
    SELECT number, address, time, max(bike_stands) AS bike_stands, count(*) AS pairs,
           CAST(sum(avg_stands) AS BIGINT) AS actual_sum, CAST(sum(pred) AS BIGINT) AS pred_sum
    FROM fanned GROUP BY number, address, time, latitude, longitude""")
step("test_profile", """
    SELECT number, address, time, max(bike_stands) AS bike_stands, round(avg(avg_stands), 6) AS avg_stands,
           round(avg(pred), 6) AS pred
    FROM fanned WHERE time >= '05:30:00' GROUP BY number, address, time""")
step("capacity_max", "SELECT max(bike_stands) AS capacity_max FROM slots")
step("station_count", "SELECT count(DISTINCT number) AS station_count FROM scored")
step("bikes_from_stands", """
    SELECT number, time, pred_stands, actual_time, actual_stands, CAST(bike_stands AS BIGINT) AS bike_stands,
           CASE WHEN pred_bikes IS NOT NULL THEN bike_stands - pred_stands END AS pred_bikes,
           CASE WHEN actual_bikes IS NOT NULL THEN bike_stands - actual_stands END AS actual_bikes
    FROM (SELECT *, CASE number WHEN 79 THEN 27 WHEN 5 THEN 40 WHEN 100 THEN 25 WHEN 66 THEN 40 ELSE 23 END
              AS bike_stands FROM forecast_log) q""")
step("sufficiency_flag", "SELECT * FROM log_rows")
step("sufficiency_ratio", """
    SELECT CAST(sum(sufficient) AS BIGINT) AS correct_cases, count(*) AS total_cases,
           round(CAST(sum(sufficient) AS DOUBLE) / count(*) * 100, 6) AS correct_ratio FROM log_rows""")
step("log_profile", """
    SELECT number, time, CAST(round_even(avg(actual_stands), 0) AS BIGINT) AS actual_stands,
           CAST(round_even(avg(pred_stands), 0) AS BIGINT) AS pred_stands, max(bike_stands) AS bike_stands
    FROM log_rows GROUP BY number, time""")
step("forecast_actual_pairing", """
    SELECT p.*, a.event_id AS actual_event, a.actual_ms, a.actual_stands
    FROM predictions p ASOF LEFT JOIN actuals a ON p.number = a.number AND p.pred_ms + 900000 <= a.actual_ms""")
step("forecast_actual_pairing_day", """
    SELECT event_id, number, pred_ms, pred_stands,
           CASE WHEN near THEN actual_event END AS actual_event, CASE WHEN near THEN actual_ms END AS actual_ms,
           CASE WHEN near THEN actual_stands END AS actual_stands
    FROM (SELECT p.*, a.event_id AS actual_event, a.actual_ms, a.actual_stands,
                 a.actual_ms - (p.pred_ms + 900000) <= 86400000 AS near
          FROM predictions p ASOF LEFT JOIN actuals a ON p.number = a.number AND p.pred_ms + 900000 <= a.actual_ms) q""")
step("forecast_request_parts", """
    SELECT number, minutes, requested_ms, target_ms, time, weekday, season FROM parts""")
step("forecast_context", """
    SELECT p.number, p.minutes, c.name, c.address, c.weekday_code, c.time_code, c.season_code, c.cluster,
           c.bike_stands, c.avg_stands, c.prev_stands
    FROM parts p JOIN context c ON p.number = c.number AND p.time = c.time AND p.weekday = c.weekday
         AND p.season = c.season""")
step("live_override", """
    SELECT number, minutes, prev_stands, bike_stands, current_capacity, last_update,
           round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM inputs""")
step("forecast_now", "SELECT * FROM answers WHERE minutes = 0")
step("forecast_status", "SELECT * FROM answers")
_ODD = {"requests": f"""
    SELECT CASE WHEN number % 20 = 19 THEN number + 1000000 ELSE number END AS number,
           coalesce(TRY_CAST((['15', ' 30', 'soon', '', NULL])[minutes // 15 + 1] AS INTEGER), 0) AS minutes, requested_ms
    FROM ({VIEWS["requests"]}) r"""}
add("odd_requests", "SELECT * FROM answers", **(_STEPS | _ODD))
step("catalog_list", "SELECT * FROM catalog ORDER BY number")
step("catalog_by_number", "SELECT * FROM catalog WHERE number = 5")
step("catalog_by_address", "SELECT * FROM catalog WHERE contains(lower(address), 'address 1')")
step("catalog_by_position", "SELECT * FROM catalog WHERE position = '53.332,-6.297'")
step("catalog_open", "SELECT * FROM catalog WHERE open")
step("position_split", """
    SELECT number, CASE WHEN position = '' THEN 0 ELSE CAST(split_part(position, ',', 1) AS DOUBLE) END AS lat,
           CASE WHEN position = '' THEN 0 ELSE CAST(split_part(position, ',', 2) AS DOUBLE) END AS lng FROM catalog""")
step("horizons", """
    SELECT number, minutes, CASE WHEN minutes = 0 THEN 'Now' ELSE concat('Next ', minutes, ' minutes') END AS label
    FROM stations CROSS JOIN (VALUES (0), (15), (30), (45), (60)) AS h(minutes)""")
step("catalog_overlay", "SELECT * FROM overlaid")
step("catalog_view", """
    SELECT number, concat('Station ', number) AS title,
           CASE WHEN shown THEN bike_stands END AS bike_stands,
           CASE WHEN shown THEN available_stands END AS available_stands,
           CASE WHEN shown THEN available_bikes END AS available_bikes
    FROM (SELECT *, bike_stands >= 0 AND available_stands >= 0 AND available_bikes >= 0 AS shown FROM overlaid) q
    WHERE open""")

# Files and streams

_EVEN = "event_id % 2 = 0"
_LOG = "pred_stands, pred_bikes, actual_time, actual_stands, actual_bikes"

step("scan_csv_roundtrip", """
    SELECT number, concat(' "Café", n° ', number, ' ') AS name,
           CASE WHEN number % 3 = 0 THEN '' ELSE concat('The "Long", Rue ', number) END AS address,
           bike_stands, available_bike_stands, last_update, CAST(1 AS INTEGER) AS source_priority FROM obs""")
step("scan_json_snapshots", f"SELECT {_RAW}, CAST(0 AS INTEGER) AS source_priority FROM obs_id WHERE {_EVEN}")
step("scan_json_arrays", f"SELECT {_RAW}, CAST(0 AS INTEGER) AS source_priority FROM obs")
step("bucketed_features", "SELECT * FROM features")
step("file_day_key", """
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'file:/landing/snapshot.json'
               ELSE concat('file:/landing/', strftime(ts, '%a-%d-%m-%Y'), '-', event_id, '.json') END AS path,
           CASE WHEN event_id % 10 = 0 THEN '' ELSE strftime(ts, '%a-%d-%m-%Y') END AS day
    FROM events""")
step("incremental_days", f"""
    SELECT DISTINCT {_RAW}, strftime(make_timestamp(last_update * 1000), '%Y-%m-%d') AS day FROM obs
    WHERE day(make_timestamp(last_update * 1000)) % 2 = 0""")
step("sink_roundtrip", "SELECT * FROM slots")
step("slot_store", "SELECT * FROM unseen")
step("forecast_log", f"SELECT number, time, {_LOG} FROM forecast_log")
step("compacted_days", f"""
    SELECT {_RAW}, strftime(make_timestamp(last_update * 1000), '%a-%d-%m-%Y') AS day FROM obs_unique""")
step("geography_file", "SELECT * FROM geo")
step("weather_file", "SELECT * FROM weather")
step("prepared_slots", f"""
    SELECT number, name, address, date, time, weekday, min(bike_stands) AS bike_stands, CAST(sum(diff) AS BIGINT) AS diff,
           arg_max(available_bike_stands, last_update * 1000 + available_bike_stands) AS available_stands,
           CAST(sum(greatest(diff, 0)) AS BIGINT) AS check_in, CAST(sum(greatest(-diff, 0)) AS BIGINT) AS check_out
    FROM (SELECT *, strftime({SLOT_STAMP}, '%Y-%m-%d') AS date, strftime({SLOT_STAMP}, '%H:%M:00') AS time,
                 strftime({SLOT_STAMP}, '%a') AS weekday, available_bike_stands - coalesce(lag(available_bike_stands) OVER (
                     PARTITION BY number, name, address ORDER BY last_update, available_bike_stands),
                     available_bike_stands) AS diff
          FROM (SELECT DISTINCT number, CASE WHEN number = 1 THEN 'CLARENDON ROW' ELSE name END AS name,
                       CASE WHEN number = 1 THEN 'Claredon Row' ELSE address END AS address,
                       bike_stands, available_bike_stands, last_update FROM obs) u) d
    GROUP BY number, name, address, date, time, weekday""")
step("scan_forecast_log", f"SELECT number, time, {_LOG} FROM forecast_log")
step("log_rejects", """
    SELECT strftime(make_timestamp(time * 1000000), '%Y-%m-%d') AS day, count(*) AS row_count,
           count(*) FILTER (time % 13 <> 0 AND time % 17 <> 0 AND actual_time IS NULL) AS short_rows,
           count(*) FILTER (time % 13 = 0 OR time % 17 = 0) AS malformed_rows, CAST(0 AS BIGINT) AS unreadable_files
    FROM forecast_log GROUP BY 1""")
step("stream_dedup", f"SELECT {_RAW} FROM obs_unique")
step("stream_slots", """
    SELECT number, name, address, last_update - last_update % 600000 AS slot_ms, min(bike_stands) AS bike_stands,
           arg_max(available_bike_stands, last_update * 1000 + available_bike_stands) AS available_stands,
           count(*) AS row_count
    FROM obs GROUP BY number, name, address, slot_ms
    HAVING slot_ms + 600000 <= (SELECT max(last_update) FROM obs) - 600000""")
for _name in ("stream_deltas", "stream_deltas_by_slot"):
    step(_name, f"""
    SELECT {_RAW}, last_available_stands, diff, check_in, check_out FROM deltas
    WHERE last_update < (SELECT max(last_update) FROM obs) - 600000""")
for _name in ("stream_pairing", "stream_pairing_by_slot"):
    step(_name, """
    SELECT p.event_id, p.number, p.pred_ms, p.pred_stands, a.event_id AS actual_event, a.actual_ms, a.actual_stands
    FROM predictions p ASOF JOIN actuals a ON p.number = a.number AND p.pred_ms + 900000 <= a.actual_ms
    WHERE a.actual_ms < greatest((SELECT max(pred_ms) FROM predictions), (SELECT max(actual_ms) FROM actuals)) - 600000""")
step("stream_pairing_hour", """
    SELECT event_id, number, pred_ms, pred_stands, CASE WHEN near THEN actual_event END AS actual_event,
           CASE WHEN near THEN actual_ms END AS actual_ms, CASE WHEN near THEN actual_stands END AS actual_stands
    FROM (SELECT p.*, a.event_id AS actual_event, a.actual_ms, a.actual_stands,
                 a.actual_ms - (p.pred_ms + 900000) <= 3600000 AS near
          FROM predictions p ASOF LEFT JOIN actuals a ON p.number = a.number AND p.pred_ms + 900000 <= a.actual_ms) q
    WHERE pred_ms < greatest((SELECT max(pred_ms) FROM predictions), (SELECT max(actual_ms) FROM actuals)) - 10800000""")
step("live_table", f"SELECT {_RAW} FROM latest")
step("stream_intake", f"SELECT DISTINCT {_RAW} FROM obs_id WHERE {_EVEN}")

_FACTORS = {
    "weekday_code": "date", "time_code": "time", "prev_stands": "prev_stands", "cluster": "cluster",
    "latitude": "latitude", "longitude": "longitude", "season_code": "season",
}
_KNOWN = " AND ".join(f"{column} IS NOT NULL" for column in _FACTORS.values())
_MODELLED = f"(SELECT * FROM features WHERE number IN ({_CHOSEN}))"
step("training_rows", " UNION ALL ".join(
    f"SELECT '{name}' AS factor, count(*) FILTER (WHERE {condition}) AS row_count FROM {_MODELLED} m" for name, condition in (
        ("usable", f"{_KNOWN} AND avg_stands IS NOT NULL"), ("dropped", f"NOT ({_KNOWN} AND avg_stands IS NOT NULL)"),
        *((name, f"{column} IS NULL") for name, column in _FACTORS.items()), ("avg_stands", "avg_stands IS NULL"))))
step("scored_rows", f"""
    SELECT number, date, time, bike_stands, avg_stands, {_KNOWN} AS known, true AS plausible, true AS follows
    FROM ({_located("prev_week")}) w WHERE time >= '05:30:00'""")
step("holdout_rows", f"""
    SELECT number, date, time, bike_stands, avg_stands, {_KNOWN} AS known, true AS follows, true AS within
    FROM parted WHERE NOT training_part AND number IN ({_CHOSEN})""")
step("factor_comparison_check", f"""
    SELECT s.factors, CAST(s.factor_count AS INTEGER) AS factor_count, t.test_rows, true AS same
    FROM (VALUES ('considered', 9), ('important', 7)) AS s(factors, factor_count)
    JOIN (SELECT count(*) AS test_rows FROM parted WHERE NOT training_part AND number IN ({_CHOSEN}) AND {_KNOWN}) t ON true""")
step("importance_check", """
    SELECT unnest(['prev_stands', 'weekday_code', 'season_code', 'time_code', 'wind_speed', 'air_temperature', 'cluster',
                   'latitude', 'longitude']) AS factor, true AS same FROM (SELECT count(*) FROM events) q""")
step("request_check", """
    SELECT p.number, p.minutes, i.prev_stands IS NOT NULL AND i.latitude IS NOT NULL AND i.longitude IS NOT NULL
           AND c.cluster IS NOT NULL AND c.weekday_code IS NOT NULL AS known, true AS follows, true AS within
    FROM parts p JOIN inputs i ON p.number = i.number AND p.minutes = i.minutes
    LEFT JOIN context c ON p.number = c.number AND p.time = c.time AND p.weekday = c.weekday AND p.season = c.season""")
step("clustered_features", "SELECT * EXCLUDE (cluster), true AS labelled FROM features")
step("station_cluster_check", "SELECT number, name, time, round(stands, 6) AS stands, true AS nearest FROM profile")


def _trained(weekdays: str) -> dict[str, str]:
    """All steps, over the slots of the training range on some days of the week."""
    return _STEPS | {"slots": f"SELECT * FROM ({VIEWS['slots']}) s WHERE date BETWEEN '{TRAINING[0]}' AND '{TRAINING[1]}' AND weekday IN ({weekdays})"}


_BY_LEVEL = "SELECT time, count(available_stands) AS n, var_samp(available_stands) AS v, sum(available_stands) AS t FROM filled GROUP BY time"
_DAYS = {"weekday": WEEKDAYS[:5], "weekend": WEEKDAYS[5:], "all": WEEKDAYS}
_DAYS = {part: ", ".join(f"'{d}'" for d in days) for part, days in _DAYS.items()}
add("elbow_check", f"""
    SELECT CAST(k AS INTEGER) AS num_clusters, round((max(n) - 1) * sum(v), 3) AS wss_k1, true AS no_dearer
    FROM ({_BY_LEVEL}) q, (SELECT unnest(range(1, 15)) AS k) ks GROUP BY k""", **_trained(_DAYS["all"]))
ORACLE["cluster_account"] = " UNION ALL ".join("SELECT * FROM (" + with_views(f"""
    SELECT '{part}' AS part, max(n) AS days, CAST(sum(t) AS BIGINT) AS stands, round((max(n) - 1) * sum(v), 3) AS squares,
           true AS nearest, true AS adds_up, true AS settled FROM ({_BY_LEVEL}) q""", _trained(days)) + ") a" for part, days in _DAYS.items())
step("reloaded_model", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS wrong_times FROM features")
