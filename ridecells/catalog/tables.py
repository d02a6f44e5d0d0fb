"""Queries over cleaning, joins, aggregates, sorts and samples."""

from pyspark.sql import functions as F

from ridecells.catalog import sql
from ridecells.functions.times import hour_key, hour_start
from ridecells.operators import cleaning, counts, joins, ordering, profile
from ridecells.plans import batch
from ridecells.plans import derived_tables as derived

RADIUS = 3.0


def _celled(spark, folder):
    return cleaning.enrich_rides(derived.busy_rides(spark, folder))


def _dated(spark, folder):
    return derived.dated_rides(derived.busy_rides(spark, folder))


def _clean_rides(spark, folder):
    return cleaning.clean_rides(cleaning.enrich_rides(_dated(spark, folder)))


def _clean_weather(spark, folder):
    return cleaning.clean_weather(derived.weather_reports(spark, folder))


def popular_cells(spark, folder):
    windows = counts.count_by_window(_celled(spark, folder))
    return counts.stamp_windows(counts.popular(windows, 2))


def window_counts(spark, folder):
    windows = counts.count_by_window(_celled(spark, folder))
    return counts.stamp_windows(windows)


def wide_window_counts(spark, folder):
    """Two hours every 45 minutes: the slide does not divide the size."""
    windows = counts.count_by_window(_celled(spark, folder), 120, 45)
    return counts.stamp_windows(counts.popular(windows, 1))


def enriched_rides(spark, folder):
    return cleaning.enrich_rides(derived.spread_rides(spark, folder)).select(
        "event_id", "lat", "lon", "cell_id")


def cleaned_rides(spark, folder):
    return _clean_rides(spark, folder).select(
        "cell_id", "weekday", "hour", hour_key("hour_ts").alias("date"))


def cleaned_weather(spark, folder):
    return _clean_weather(spark, folder).select(
        hour_key("hour_ts").alias("date"), "temperature", "precipitation")


def hourly_weather(spark, folder):
    hourly = cleaning.hourly_weather(derived.weather_reports(spark, folder))
    return hourly.select(hour_key("hour_ts").alias("date"), "fahrenheit", "precip_in")


def bucketed_hourly_weather(spark, folder):
    hourly = cleaning.hourly_weather(derived.weather_reports(spark, folder))
    return cleaning.bucket_hourly_weather(hourly).select(
        hour_key("hour_ts").alias("date"), "temperature", "precipitation")


def rides_with_weather(spark, folder):
    return joins.join_weather(_clean_rides(spark, folder), _clean_weather(spark, folder))


def rides_with_weather_shuffled(spark, folder):
    return joins.join_weather(_clean_rides(spark, folder), _clean_weather(spark, folder), most=0)


def zip_rides_with_weather(spark, folder):
    rides = joins.nearest_zip(_dated(spark, folder), derived.zip_centroids(spark, folder), RADIUS)
    buckets = cleaning.bucket_hourly_weather(
        cleaning.hourly_weather(derived.weather_reports(spark, folder)))
    return joins.join_weather(cleaning.clean_zip_rides(rides), buckets)


def zips_joined_back(spark, folder):
    """Zips found for the keys alone, then put back beside their rides."""
    rides = derived.busy_rides(spark, folder)
    found = joins.nearest_zip(rides.select("event_id", "lat", "lon"),
                              derived.zip_centroids(spark, folder), RADIUS)
    return joins.join_by_row_key(
        rides.select("event_id", "user_id"), found.select("event_id", "zip"), "event_id")


def weather_for_all_cells(spark, folder):
    """Every report beside all 100,000 cells, summed up per report."""
    crossed = joins.with_all_cells(derived.weather_records(spark, folder).select("datetime"))
    return crossed.groupBy("datetime").agg(
        F.count("*").alias("cells"), F.sum("cell_index_x").alias("sum_x"),
        F.sum("cell_index_y").alias("sum_y"), F.max("cell_id").alias("last_cell"))


def nearest_zip(spark, folder):
    found = joins.nearest_zip(derived.spread_rides(spark, folder),
                              derived.zip_centroids(spark, folder), RADIUS)
    return found.select("event_id", "zip")


def nearest_zip_many_centroids(spark, folder):
    found = joins.nearest_zip(derived.spread_rides(spark, folder),
                              derived.zip_centroids(spark, folder), RADIUS, most=0)
    return found.select("event_id", "zip")


def rides_with_zip(spark, folder):
    return batch.add_zip(derived.spread_rides(spark, folder),
                         derived.zip_centroids(spark, folder), RADIUS).select("event_id", "zip")


def odd_missing_zips(spark, folder):
    found = joins.nearest_zip(derived.spread_rides(spark, folder),
                              derived.zip_centroids(spark, folder), RADIUS)
    return cleaning.odd_missing_zip(found).select("event_id", "lat", "lon")


def missing_zips(spark, folder):
    found = joins.nearest_zip(derived.spread_rides(spark, folder),
                              derived.zip_centroids(spark, folder), RADIUS)
    return counts.rows_meeting(found, F.col("zip") == "missing")


def condition_counts(spark, folder):
    return joins.weather_counts(_clean_rides(spark, folder), _clean_weather(spark, folder))


def condition_counts_many_reports(spark, folder):
    return joins.weather_counts(
        _clean_rides(spark, folder), _clean_weather(spark, folder), most=0)


def counted_join(spark, folder):
    return counts.count_conditions(rides_with_weather(spark, folder))


def training_table(spark, folder):
    return batch.training_table(_dated(spark, folder), derived.weather_reports(spark, folder))


def zip_training_table(spark, folder):
    return batch.zip_training_table(
        _dated(spark, folder), derived.weather_reports(spark, folder),
        derived.zip_centroids(spark, folder), RADIUS)


def mean_temperature_by_hour(spark, folder):
    readings = derived.weather_reports(spark, folder).select(
        hour_start("valid").alias("hour_ts"), F.col("tmpf").alias("fahrenheit"))
    return counts.mean_temperature_by_hour(readings).select(
        hour_key("hour_ts").alias("date"), "fahrenheit")


def nulls_per_column(spark, folder):
    return profile.nulls_per_column(derived.weather_reports(spark, folder))


def _rounded(frame):
    return frame.select(*[
        F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in frame.dtypes])


def described_lines(spark, folder):
    lines = derived.table(spark, folder, "lineitem")
    return _rounded(profile.describe(lines, ["l_quantity", "l_extendedprice", "l_discount"]))


def described_rain(spark, folder):
    return _rounded(profile.describe(derived.weather_reports(spark, folder), ["p01i", "tmpf"]))


def rain_histogram(spark, folder):
    rain = derived.weather_reports(spark, folder).filter(F.col("p01i") < 1)
    return _rounded(profile.histogram(rain, "p01i"))


def price_histogram(spark, folder):
    return _rounded(profile.histogram(derived.table(spark, folder, "orders"), "o_totalprice", 20))


def distinct_hours(spark, folder):
    return counts.distinct_hours(_clean_rides(spark, folder))


def conserved_rides(spark, folder):
    return counts.total_count(condition_counts(spark, folder))


def table_shape(spark, folder):
    return counts.shape(derived.table(spark, folder, "lineitem"))


def sorted_rides(spark, folder):
    rides = derived.ride_records(derived.busy_rides(spark, folder))
    return ordering.stable_order(rides, "pickup_datetime")


def most_frequent_conditions(spark, folder):
    return ordering.most_frequent(training_table(spark, folder), 20)


def most_frequent_zip_conditions(spark, folder):
    return ordering.most_frequent(zip_training_table(spark, folder), 5)


def first_orders(spark, folder):
    orders = derived.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy("o_orderkey").limit(20)


def random_orders(spark, folder):
    orders = derived.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordering.random_rows(orders, 10_000, "o_orderkey")


def _stamped(windows, threshold=1):
    return f"""SELECT {sql.STAMP} AS datetime, cell_id, "count" FROM {windows} w
        WHERE "count" >= {threshold}"""


def _described(source, columns):
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
        round(quantile_cont({c}, 25e-2), 6) AS q25, round(quantile_cont({c}, 5e-1), 6) AS q50,
        round(quantile_cont({c}, 75e-2), 6) AS q75, round(max({c}), 6) AS max
        FROM {source} s""" for c in columns]
    return " UNION ALL ".join(parts)


def _histogram(source, column, bins, condition="TRUE"):
    return f"""SELECT bin, round(low + bin * width, 6) AS bin_start,
          round(low + (bin + 1) * width, 6) AS bin_end, count(*) AS rows
        FROM (SELECT low, (high - low) / {bins}e0 AS width,
                CAST(least(floor((v - low) / ((high - low) / {bins}e0)), {bins - 1}) AS INTEGER)
                  AS bin
              FROM (SELECT {column} AS v, min({column}) OVER () AS low,
                      max({column}) OVER () AS high FROM {source} s
                    WHERE {column} IS NOT NULL AND {condition}) a) b
        GROUP BY bin, low, width"""


_KEYS = "cell_id, weekday, hour, temperature, precipitation"
_ZIPPED = sql.zipped(sql.SPREAD, RADIUS)
_WIDE = f"""(SELECT cell_id, w AS window_start, w + INTERVAL 120 MINUTE AS window_end,
      count(*) AS "count" FROM (
        SELECT cell_id, ts, make_timestamp(
            (CAST(floor(epoch(ts) / 2700) AS BIGINT) - i) * 2700 * 1000000) AS w
        FROM {sql.cells(sql.BUSY)} r, (VALUES (0), (1), (2)) shifts(i)) x
      WHERE ts < w + INTERVAL 120 MINUTE GROUP BY cell_id, w)"""

QUERIES = [
    ("popular_cells", popular_cells, _stamped(sql.windows(sql.cells(sql.BUSY)), 2)),
    ("window_counts", window_counts, _stamped(sql.windows(sql.cells(sql.BUSY)))),
    ("wide_window_counts", wide_window_counts, _stamped(_WIDE)),
    ("enriched_rides", enriched_rides,
     f"SELECT event_id, lat, lon, cell_id FROM {sql.cells(sql.SPREAD)} r"),
    ("cleaned_rides", cleaned_rides,
     f"""SELECT cell_id, {sql.weekday1('ts')} AS weekday, {sql.hour('ts')} AS hour,
         {sql.hour_key('ts')} AS date FROM {sql.cells(sql.BUSY)} r"""),
    ("cleaned_weather", cleaned_weather,
     f"""SELECT {sql.hour_key('hour_ts')} AS date, temperature, precipitation
         FROM {sql.CLEAN_WEATHER} w"""),
    ("hourly_weather", hourly_weather,
     f"""SELECT {sql.hour_key('hour_ts')} AS date, fahrenheit, precip_in
         FROM {sql.HOURLY_WEATHER} w"""),
    ("bucketed_hourly_weather", bucketed_hourly_weather,
     f"""SELECT {sql.hour_key('hour_ts')} AS date, temperature, precipitation
         FROM {sql.BUCKETED_HOURLY} w"""),
    ("rides_with_weather", rides_with_weather, f"SELECT {_KEYS} FROM {sql.JOINED} j"),
    ("rides_with_weather_shuffled", rides_with_weather_shuffled,
     f"SELECT {_KEYS} FROM {sql.JOINED} j"),
    ("zip_rides_with_weather", zip_rides_with_weather,
     f"""SELECT zip, {sql.hour('ts')} AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
         temperature, precipitation FROM {sql.zipped(sql.BUSY, RADIUS)} r
         JOIN {sql.BUCKETED_HOURLY} w ON date_trunc('hour', r.ts) = w.hour_ts
         WHERE zip <> 'missing'"""),
    ("zips_joined_back", zips_joined_back,
     f"SELECT event_id, user_id, zip FROM {sql.zipped(sql.BUSY, RADIUS)} r"),
    ("weather_for_all_cells", weather_for_all_cells,
     f"""SELECT datetime, count(*) AS cells, CAST(sum(id % 250) AS BIGINT) AS sum_x,
         CAST(sum(id // 250) AS BIGINT) AS sum_y, CAST(max(id) AS INTEGER) AS last_cell
         FROM {sql.WEATHER_RECORDS} w, range(100000) r(id) GROUP BY datetime"""),
    ("nearest_zip", nearest_zip, f"SELECT event_id, zip FROM {_ZIPPED} r"),
    ("nearest_zip_many_centroids", nearest_zip_many_centroids,
     f"SELECT event_id, zip FROM {_ZIPPED} r"),
    ("rides_with_zip", rides_with_zip,
     f"SELECT event_id, zip FROM {_ZIPPED} r WHERE zip <> 'missing'"),
    ("odd_missing_zips", odd_missing_zips,
     f"""SELECT event_id, lat, lon FROM {_ZIPPED} r WHERE zip = 'missing' AND lat <> 0e0"""),
    ("missing_zips", missing_zips,
     f"SELECT count(*) AS rows FROM {_ZIPPED} r WHERE zip = 'missing'"),
    ("condition_counts", condition_counts, f"""SELECT {_KEYS}, "count" FROM {sql.COUNTS} c"""),
    ("condition_counts_many_reports", condition_counts_many_reports,
     f"""SELECT {_KEYS}, "count" FROM {sql.COUNTS} c"""),
    ("counted_join", counted_join, f"""SELECT {_KEYS}, "count" FROM {sql.COUNTS} c"""),
    ("training_table", training_table, f"SELECT * FROM {sql.TRAINING} t"),
    ("zip_training_table", zip_training_table, f"SELECT * FROM {sql.zip_counts(RADIUS)} t"),
    ("mean_temperature_by_hour", mean_temperature_by_hour,
     f"""SELECT {sql.hour_key('hour_ts')} AS date, fahrenheit FROM (
         SELECT date_trunc('hour', valid) AS hour_ts, avg(tmpf) AS fahrenheit
         FROM {sql.WEATHER} w GROUP BY 1) m"""),
    ("nulls_per_column", nulls_per_column,
     f"""SELECT count(*) FILTER (valid IS NULL) AS valid, count(*) FILTER (tmpf IS NULL) AS tmpf,
         count(*) FILTER (p01i IS NULL) AS p01i FROM {sql.WEATHER} w"""),
    ("described_lines", described_lines,
     _described("lineitem", ["l_quantity", "l_extendedprice", "l_discount"])),
    ("described_rain", described_rain, _described(sql.WEATHER, ["p01i", "tmpf"])),
    ("rain_histogram", rain_histogram, _histogram(sql.WEATHER, "p01i", 10, "p01i < 1e0")),
    ("price_histogram", price_histogram, _histogram("orders", "o_totalprice", 20)),
    ("distinct_hours", distinct_hours,
     f"""SELECT count(DISTINCT date_trunc('hour', ts)) AS hours FROM {sql.cells(sql.BUSY)} r"""),
    ("conserved_rides", conserved_rides, f"SELECT count(*) AS total FROM {sql.JOINED} j"),
    ("table_shape", table_shape,
     """SELECT count(*) AS rows, CAST((SELECT count(*) FROM (DESCRIBE lineitem)) AS INTEGER)
        AS columns FROM lineitem"""),
    ("sorted_rides", sorted_rides,
     f"""SELECT {sql.RIDE_TIME} AS pickup_datetime, lat AS pickup_latitude,
         lon AS pickup_longitude FROM {sql.BUSY} r"""),
    ("most_frequent_conditions", most_frequent_conditions,
     f"""SELECT * FROM {sql.TRAINING} t ORDER BY "count" DESC, weekday NULLS FIRST,
         hour NULLS FIRST, temperature NULLS FIRST, precipitation NULLS FIRST, cell_index_x,
         cell_index_y LIMIT 20"""),
    ("most_frequent_zip_conditions", most_frequent_zip_conditions,
     f"""SELECT * FROM {sql.zip_counts(RADIUS)} t ORDER BY "count" DESC, hour, weekday, zip,
         temperature NULLS FIRST, precipitation NULLS FIRST LIMIT 5"""),
    ("first_orders", first_orders,
     "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20"),
    ("random_orders", random_orders,
     """SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 10000"""),
]
