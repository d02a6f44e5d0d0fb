"""SQL of the derived tables, for checking queries with another engine.

Number literals carry an exponent, which makes them doubles everywhere.
"""

from ridecells.schemas import (
    GRID_COLUMNS, LAT_NORTH, LAT_SOUTH, LAT_STEP, LON_EAST, LON_STEP, LON_WEST,
)


def double(value):
    return f"{value:.17e}" if value >= 0 else f"({value:.17e})"


def _rides(k):
    return f"""(SELECT event_id, user_id, ts, event_type, value,
      CASE WHEN event_id % 97 = 0 THEN 0e0
           ELSE (404500 + (({k}) * 7919) % 6000) / 10000e0 END AS lat,
      CASE WHEN event_id % 89 = 0 THEN 0e0
           ELSE (736500 + (({k}) * 104729) % 4500) / (-10000e0) END AS lon
    FROM events)"""


SPREAD = _rides("event_id")
BUSY = _rides("user_id % 12")

INSIDE = (f"(lat > {double(LAT_SOUTH)} AND lat < {double(LAT_NORTH)}"
          f" AND lon > {double(LON_WEST)} AND lon < {double(LON_EAST)})")
CELL = (f"CAST({GRID_COLUMNS} * floor(({double(LAT_NORTH)} - lat) / {double(LAT_STEP)})"
        f" + floor((lon - {double(LON_WEST)}) / {double(LON_STEP)}) AS INTEGER)")
BAD = "(lat = 0e0 OR lon = 0e0)"
RIDE_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def cells(rides):
    return f"(SELECT *, {CELL} AS cell_id FROM {rides} r WHERE {INSIDE})"


def center(cell):
    y = f"CAST(floor({cell} / {GRID_COLUMNS}.0) AS INTEGER)"
    lat = f"({double(LAT_NORTH)} - {y} * {double(LAT_STEP)} - {double(LAT_STEP / 2)})"
    lon = (f"(-({double(-LON_WEST)} - ({cell} % {GRID_COLUMNS}) * {double(LON_STEP)}"
           f" - {double(LON_STEP / 2)}))")
    return lat, lon


WEATHER = """(SELECT h + to_minutes(m) AS valid,
      CASE WHEN i % 53 <> 0 THEN (250 + (i * 37 + m) % 750) / 10e0 END AS tmpf,
      CASE WHEN i % 59 <> 0 THEN ((i * 13 + m) % 50) / 100e0 END AS p01i
    FROM (SELECT h, CAST(floor(epoch(h) / 3600) AS BIGINT) AS i
          FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events) a) b,
         (VALUES (21), (51)) minutes(m))"""
WEATHER_RECORDS = f"""(SELECT strftime(valid, '%Y-%m-%d %H:%M') AS datetime, valid,
      tmpf AS fahrenheit, p01i AS precip_in FROM {WEATHER} w
    WHERE tmpf IS NOT NULL AND p01i IS NOT NULL)"""


def warm(value):
    return (f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} < 40e0 THEN 0"
            f" WHEN {value} < 55e0 THEN 1 WHEN {value} < 70e0 THEN 2"
            f" WHEN {value} < 85e0 THEN 3 ELSE 4 END")


def wet(value):
    return (f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} < 1e-1 THEN 0"
            f" WHEN {value} < 3e-1 THEN 1 ELSE 2 END")


CLEAN_WEATHER = f"""(SELECT date_trunc('hour', valid) AS hour_ts, {warm('tmpf')} AS temperature,
      {wet('p01i')} AS precipitation FROM {WEATHER} w WHERE minute(valid) = 51)"""
HOURLY_WEATHER = f"""(SELECT a.hour_ts, fahrenheit, precip_in FROM
      (SELECT date_trunc('hour', valid) AS hour_ts, p01i AS precip_in FROM {WEATHER} w
       WHERE minute(valid) = 51) a JOIN
      (SELECT date_trunc('hour', valid) AS hour_ts, avg(tmpf) AS fahrenheit FROM {WEATHER} w
       GROUP BY 1) b ON a.hour_ts = b.hour_ts)"""
BUCKETED_HOURLY = f"""(SELECT hour_ts, {warm('fahrenheit')} AS temperature,
      {wet('precip_in')} AS precipitation FROM {HOURLY_WEATHER} h)"""


def weekday1(ts):
    return f"CAST(isodow({ts}) AS INTEGER)"


def hour(ts):
    return f"CAST(hour({ts}) AS INTEGER)"


def hour_key(ts):
    return f"strftime({ts}, '%Y-%m-%d-%H')"


JOINED = f"""(SELECT cell_id, {weekday1('ts')} AS weekday, {hour('ts')} AS hour, temperature,
      precipitation, hour_ts FROM {cells(BUSY)} r
    JOIN {CLEAN_WEATHER} w ON date_trunc('hour', r.ts) = w.hour_ts)"""
COUNTS = f"""(SELECT cell_id, weekday, hour, temperature, precipitation, count(*) AS "count"
    FROM {JOINED} j GROUP BY ALL)"""
TRAINING = f"""(SELECT weekday, hour, temperature, precipitation, "count",
      CAST(cell_id % {GRID_COLUMNS} AS INTEGER) AS cell_index_x,
      CAST(floor(cell_id / {GRID_COLUMNS}.0) AS INTEGER) AS cell_index_y FROM {COUNTS} c)"""


def windows(rides, size=15, every=5):
    """Counts per cell and window, with the first and last instant."""
    shifts = ", ".join(f"({i * every})" for i in range(size // every))
    return f"""(SELECT cell_id, w AS window_start, w + INTERVAL {size} MINUTE AS window_end,
      count(*) AS "count" FROM (
        SELECT cell_id, time_bucket(INTERVAL {every} MINUTE, ts) - to_minutes(i) AS w
        FROM {rides} r, (VALUES {shifts}) shifts(i)) x GROUP BY cell_id, w)"""


STAMP = "strftime(window_end - INTERVAL 1 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%gZ')"
LAST_RIDE_TIME = "(SELECT max(date_trunc('second', ts)) FROM events)"
LAST_CELLED_TIME = f"(SELECT max(date_trunc('second', ts)) FROM {cells(BUSY)} r)"

ZIPS = """(SELECT CAST(s_suppkey + 10001 AS VARCHAR) AS zip,
      (405000 + (s_suppkey * 2111) % 5000) / 10000e0 AS zlat,
      (737000 + (s_suppkey * 1733) % 3500) / (-10000e0) AS zlon FROM supplier)"""


def zipped(rides, radius):
    """Rides with the nearest zip, by trying every zip."""
    return f"""(SELECT r.*, coalesce(b.zip, 'missing') AS zip FROM {rides} r LEFT JOIN (
      SELECT event_id, arg_min(zip, (d, zip)) AS zip FROM (
        SELECT event_id, zip, 2 * 6371e0 * 621371e-6 * asin(sqrt(
            pow(sin(radians(zlat - lat) / 2), 2)
            + cos(radians(lat)) * cos(radians(zlat)) * pow(sin(radians(zlon - lon) / 2), 2))) AS d
        FROM {rides} r, {ZIPS} z) x
      WHERE d <= {double(float(radius))} GROUP BY event_id) b ON r.event_id = b.event_id)"""


def zip_counts(radius):
    return f"""(SELECT {hour('ts')} AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, zip,
      temperature, precipitation, count(*) AS "count"
    FROM {zipped(BUSY, radius)} r JOIN {BUCKETED_HOURLY} w
      ON date_trunc('hour', r.ts) = w.hour_ts WHERE zip <> 'missing' GROUP BY ALL)"""
