"""Queries over predicates and scalar functions."""

from pyspark.sql import functions as F

from ridecells.catalog import sql
from ridecells.functions import grid, numbers, text, times, weather
from ridecells.operators import cleaning
from ridecells.plans import derived_tables as derived
from ridecells.schemas import GRID_CELLS


def projected_rides(spark, folder):
    return derived.dated_rides(derived.spread_rides(spark, folder)).select(
        times.hour_key("date").alias("date"), "lat", F.col("lon").alias("longitude"))


def dropped_columns(spark, folder):
    return derived.spread_rides(spark, folder).drop("lat", "lon", "ts")


def in_box_rides(spark, folder):
    number = F.col("event_id")
    rides = derived.spread_rides(spark, folder).withColumn(
        "lat", F.when(number % 103 == 0, F.lit(float("nan"))).when(number % 101 != 0, F.col("lat")))
    return rides.filter(grid.in_box("lat", "lon")).select("event_id", "lat", "lon")


def good_coordinates(spark, folder):
    return cleaning.without_bad_coordinates(derived.spread_rides(spark, folder)).select(
        "event_id", "lat", "lon")


def enriched_or_dropped(spark, folder):
    kept, _ = cleaning.enrich_or_drop(
        derived.spread_rides(spark, folder), lat="lat", lon="lon", cell="cell_id")
    return kept.select("event_id", "cell_id")


def minute_51_reports(spark, folder):
    reports = derived.weather_reports(spark, folder)
    return reports.filter(times.minute_of_hour("valid") == 51).select(
        times.hour_key("valid").alias("date"), "tmpf", "p01i")


def keys_only(spark, folder):
    rides = cleaning.enrich_rides(derived.busy_rides(spark, folder))
    return rides.select(F.col("cell_id").alias("key"))


def constant_column(spark, folder):
    rides = derived.spread_rides(spark, folder)
    return rides.select("event_id", F.lit("yellow").alias("type"), F.lit(1).alias("count"))


def _celled(spark, folder):
    return cleaning.enrich_rides(derived.spread_rides(spark, folder))


def struct_fields(spark, folder):
    indexed = _celled(spark, folder).withColumn("cell_index", grid.cell_index("cell_id"))
    return indexed.select(
        "event_id", F.col("cell_index.x").alias("cell_index_x"),
        F.col("cell_index.y").alias("cell_index_y"))


def grid_cell(spark, folder):
    rides = derived.spread_rides(spark, folder)
    return rides.select("event_id", grid.grid_cell("lat", "lon").alias("cell_id"))


def cell_center(spark, folder):
    cells = derived.table(spark, folder, "events").select(
        "event_id", (F.col("event_id") * 7919 % GRID_CELLS).cast("int").alias("cell_id"))
    return cells.select("event_id", "cell_id", grid.cell_center_lat("cell_id").alias("lat"),
                        grid.cell_center_lon("cell_id").alias("lon"))


def cell_index(spark, folder):
    return _celled(spark, folder).select(
        "event_id", grid.cell_x("cell_id").alias("x"), grid.cell_y("cell_id").alias("y"))


def cell_from_index(spark, folder):
    return cell_index(spark, folder).select(
        "event_id", grid.cell_from_index("x", "y").alias("cell_id"))


def temperature_bucket(spark, folder):
    return derived.weather_reports(spark, folder).select(
        times.window_stamp("valid").alias("before"), "tmpf",
        weather.temperature_bucket("tmpf").alias("temperature"))


def rain_bucket(spark, folder):
    return derived.weather_reports(spark, folder).select(
        times.hour_key("valid").alias("date"), "p01i",
        weather.rain_bucket("p01i", refuse_negative=True).alias("precipitation"))


def calendar_fields(spark, folder):
    return derived.busy_rides(spark, folder).select(
        "event_id", times.weekday_from_one("ts").alias("weekday_from_one"),
        times.weekday_from_zero("ts").alias("weekday_from_zero"),
        times.hour_of_day("ts").alias("hour"), times.minute_of_hour("ts").alias("minute"),
        times.hour_key("ts").alias("hour_key"))


def parsed_times(spark, folder):
    rides = derived.busy_rides(spark, folder).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("a"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("b"))
    return rides.select(
        "event_id", F.unix_seconds(times.parse_ride_time("a")).alias("ride_seconds"),
        F.unix_seconds(times.parse_weather_time("b")).alias("weather_seconds"))


def cell_document(spark, folder):
    counted = _celled(spark, folder).groupBy("cell_id").count().withColumn(
        "time", F.lit("2014-05-07T09:34:59.999Z"))
    return counted.select("cell_id", text.cell_document("time", "cell_id", "count").alias("document"))


def lat_lon_text(spark, folder):
    rides = derived.spread_rides(spark, folder).filter(F.col("lat") != 0).filter(F.col("lon") != 0)
    return rides.select("event_id", grid.lat_lon_text(F.col("lat"), F.col("lon")).alias("location"))


def window_stamp(spark, folder):
    rides = derived.busy_rides(spark, folder).withColumn("end", F.date_trunc("minute", "ts"))
    return rides.select("event_id", times.window_stamp("end").alias("datetime"))


def round_half_up(spark, folder):
    return derived.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.round_half_up("l_extendedprice").alias("rounded"))


def hour_prefix(spark, folder):
    rides = derived.busy_rides(spark, folder).withColumn(
        "valid", F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return rides.select("event_id", text.hour_prefix("valid").alias("date"))


def postcode(spark, folder):
    answers = derived.table(spark, folder, "supplier").select("s_suppkey", F.to_json(F.struct(
        F.col("s_suppkey").alias("place_id"), F.col("s_name").alias("display_name"),
        F.create_map(F.lit("postcode"), (F.col("s_suppkey") + 10001).cast("string"),
                     F.lit("country_code"), F.lit("us")).alias("address"),
    )).alias("answer"))
    return answers.select("s_suppkey", text.postcode("answer").alias("postcode"))


def json_path(spark, folder):
    return derived.table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


def reverse_geocode_url(spark, folder):
    rides = derived.spread_rides(spark, folder).filter(F.col("lat") != 0).filter(F.col("lon") != 0)
    return rides.select(
        "event_id", text.reverse_geocode_url("localhost", 8080, "lat", "lon").alias("url"))


def clean_numbers(spark, folder):
    readings = derived.weather_file(spark, folder)
    return readings.select(
        F.col(" valid").alias("valid"), F.col(" tmpf").alias("text"),
    ).select("valid", numbers.clean_number("text").alias("tmpf"))


def within_tolerance(spark, folder):
    lines = derived.table(spark, folder, "lineitem").withColumn(
        "rounded", F.floor(F.col("l_extendedprice") + 0.5).cast("double"))
    return lines.select(
        "l_orderkey", "l_linenumber",
        numbers.within("l_extendedprice", "rounded", 0.25).alias("close"))


_LAT, _LON = sql.center("cell_id")
_DOCUMENT = (f"""'{{"time":"' || time || '","location":"' || CAST({_LAT} AS VARCHAR) || ','"""
             f""" || CAST({_LON} AS VARCHAR) || '","cnt":' || CAST("count" AS VARCHAR) || '}}'""")
_NONZERO = "lat <> 0e0 AND lon <> 0e0"

QUERIES = [
    ("projected_rides", projected_rides,
     f"SELECT {sql.hour_key('ts')} AS date, lat, lon AS longitude FROM {sql.SPREAD} r"),
    ("dropped_columns", dropped_columns, "SELECT event_id, user_id FROM events"),
    ("in_box_rides", in_box_rides,
     f"""SELECT event_id, lat, lon FROM {sql.SPREAD} r
         WHERE event_id % 101 <> 0 AND event_id % 103 <> 0 AND {sql.INSIDE}"""),
    ("good_coordinates", good_coordinates,
     f"SELECT event_id, lat, lon FROM {sql.SPREAD} r WHERE NOT {sql.BAD}"),
    ("enriched_or_dropped", enriched_or_dropped,
     f"SELECT event_id, cell_id FROM {sql.cells(sql.SPREAD)} r"),
    ("minute_51_reports", minute_51_reports,
     f"""SELECT {sql.hour_key('valid')} AS date, tmpf, p01i FROM {sql.WEATHER} w
         WHERE minute(valid) = 51"""),
    ("keys_only", keys_only, f"SELECT cell_id AS key FROM {sql.cells(sql.BUSY)} r"),
    ("constant_column", constant_column,
     """SELECT event_id, 'yellow' AS type, 1 AS "count" FROM events"""),
    ("struct_fields", struct_fields,
     f"""SELECT event_id, cell_id % 250 AS cell_index_x,
         CAST(floor(cell_id / 250.0) AS INTEGER) AS cell_index_y FROM {sql.cells(sql.SPREAD)} r"""),
    ("grid_cell", grid_cell,
     f"""SELECT event_id, CASE WHEN {sql.INSIDE} THEN {sql.CELL} END AS cell_id
         FROM {sql.SPREAD} r"""),
    ("cell_center", cell_center,
     f"""SELECT event_id, cell_id, {_LAT} AS lat, {_LON} AS lon FROM (SELECT event_id,
         CAST(event_id * 7919 % 100000 AS INTEGER) AS cell_id FROM events) c"""),
    ("cell_index", cell_index,
     f"""SELECT event_id, cell_id % 250 AS x, CAST(floor(cell_id / 250.0) AS INTEGER) AS y
         FROM {sql.cells(sql.SPREAD)} r"""),
    ("cell_from_index", cell_from_index,
     f"SELECT event_id, cell_id FROM {sql.cells(sql.SPREAD)} r"),
    ("temperature_bucket", temperature_bucket,
     f"""SELECT strftime(valid - INTERVAL 1 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%gZ') AS before,
         tmpf, {sql.warm('tmpf')} AS temperature FROM {sql.WEATHER} w"""),
    ("rain_bucket", rain_bucket,
     f"""SELECT {sql.hour_key('valid')} AS date, p01i, {sql.wet('p01i')} AS precipitation
         FROM {sql.WEATHER} w"""),
    ("calendar_fields", calendar_fields,
     f"""SELECT event_id, {sql.weekday1('ts')} AS weekday_from_one,
         CAST(isodow(ts) - 1 AS INTEGER) AS weekday_from_zero, {sql.hour('ts')} AS hour,
         CAST(minute(ts) AS INTEGER) AS minute, {sql.hour_key('ts')} AS hour_key FROM events"""),
    ("parsed_times", parsed_times,
     """SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ride_seconds,
        CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS weather_seconds FROM events"""),
    ("cell_document", cell_document,
     f"""SELECT cell_id, {_DOCUMENT} AS document FROM (SELECT cell_id, count(*) AS "count",
         '2014-05-07T09:34:59.999Z' AS time FROM {sql.cells(sql.SPREAD)} r GROUP BY cell_id) c"""),
    ("lat_lon_text", lat_lon_text,
     f"""SELECT event_id, CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) AS location
         FROM {sql.SPREAD} r WHERE {_NONZERO}"""),
    ("window_stamp", window_stamp,
     """SELECT event_id, strftime(date_trunc('minute', ts) - INTERVAL 1 MILLISECOND,
        '%Y-%m-%dT%H:%M:%S.%gZ') AS datetime FROM events"""),
    ("round_half_up", round_half_up,
     """SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice + 5e-1) AS BIGINT) AS rounded
        FROM lineitem"""),
    ("hour_prefix", hour_prefix, f"SELECT event_id, {sql.hour_key('ts')} AS date FROM events"),
    ("postcode", postcode,
     "SELECT s_suppkey, CAST(s_suppkey + 10001 AS VARCHAR) AS postcode FROM supplier"),
    ("json_path", json_path,
     "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events"),
    ("reverse_geocode_url", reverse_geocode_url,
     f"""SELECT event_id, 'http://localhost:8080/reverse.php?format=json&lat='
         || CAST(lat AS VARCHAR) || '&lon=' || CAST(lon AS VARCHAR) AS url
         FROM {sql.SPREAD} r WHERE {_NONZERO}"""),
    ("clean_numbers", clean_numbers,
     f"SELECT strftime(valid, '%Y-%m-%d %H:%M') AS valid, tmpf FROM {sql.WEATHER} w"),
    ("within_tolerance", within_tolerance,
     """SELECT l_orderkey, l_linenumber,
        abs(l_extendedprice - floor(l_extendedprice + 5e-1)) <= 25e-2 AS close FROM lineitem"""),
]
