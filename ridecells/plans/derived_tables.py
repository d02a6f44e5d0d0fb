"""Ride, weather and zip tables derived from the given tables.

The given tables have neither coordinates nor weather. Both are computed from
their columns with integer arithmetic, which any SQL engine repeats exactly.
"""

from pyspark.sql import functions as F

from ridecells.schemas import RIDE_FILE, RIDE_TIME_FORMAT, WEATHER_TIME_FORMAT

SPOTS = 12


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _place(k):
    lat = (F.lit(404500) + F.pmod(k * 7919, F.lit(6000))) / 10000.0
    lon = (F.lit(736500) + F.pmod(k * 104729, F.lit(4500))) / -10000.0
    return lat, lon


def _rides(spark, folder, k, *more):
    lat, lon = _place(k)
    number = F.col("event_id")
    return table(spark, folder, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), *more,
        F.when(number % 97 == 0, F.lit(0.0)).otherwise(lat).alias("lat"),
        F.when(number % 89 == 0, F.lit(0.0)).otherwise(lon).alias("lon"),
    )


def spread_rides(spark, folder):
    """One ride per event, spread over the box and its surroundings."""
    return _rides(spark, folder, F.col("event_id"))


def busy_rides(spark, folder, *more):
    """One ride per event at one of twelve spots, six of them in the box."""
    return _rides(spark, folder, F.col("user_id") % SPOTS, *more)


def ride_records(rides):
    """Rides as topic records."""
    return rides.select(
        F.date_format("ts", RIDE_TIME_FORMAT).alias("pickup_datetime"),
        F.col("lat").alias("pickup_latitude"), F.col("lon").alias("pickup_longitude"),
    )


def dated_rides(rides):
    return rides.select(F.col("ts").alias("date"), "lat", "lon")


def ride_file(spark, folder):
    """Busy rides in the 18 columns of a ride file, names with a leading blank."""
    rides = busy_rides(spark, folder, "event_type", "value")
    time = F.date_format("ts", RIDE_TIME_FORMAT)
    later = F.date_format(F.col("ts") + F.expr("INTERVAL 15 MINUTES"), RIDE_TIME_FORMAT)
    values = {
        "vendor_id": F.col("event_type"), "pickup_datetime": time, "dropoff_datetime": later,
        "passenger_count": F.lit(1) + F.col("user_id") % 6, "trip_distance": F.col("value"),
        "pickup_longitude": F.col("lon"), "pickup_latitude": F.col("lat"),
        "rate_code": F.lit(1), "store_and_fwd_flag": F.lit("N"),
        "dropoff_longitude": F.col("lon"), "dropoff_latitude": F.col("lat"),
        "payment_type": F.lit("CRD"), "fare_amount": F.col("value"),
        "surcharge": F.lit(0.0), "mta_tax": F.lit(0.5), "tip_amount": F.lit(0.0),
        "tolls_amount": F.lit(0.0), "total_amount": F.col("value") + 0.5,
    }
    names = [f.name for f in RIDE_FILE.fields]
    return rides.select(*[
        values[f.name].cast(f.dataType).alias(f.name) for f in RIDE_FILE.fields
    ]).toDF(names[0], *[f" {n}" for n in names[1:]])


def weather_reports(spark, folder):
    """Two reports, at minutes 21 and 51, for every hour with an event.

    A few readings are null.
    """
    hours = (
        table(spark, folder, "events")
        .select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")).distinct()
    )
    i = F.floor(F.unix_seconds("hour") / 3600)
    minute = F.col("minute")
    tmpf = (F.lit(250) + F.pmod(i * 37 + minute, F.lit(750))) / 10.0
    p01i = F.pmod(i * 13 + minute, F.lit(50)) / 100.0
    return hours.withColumn("minute", F.explode(F.array(F.lit(21), F.lit(51)))).select(
        F.timestamp_seconds(F.unix_seconds("hour") + minute * 60).alias("valid"),
        F.when(i % 53 != 0, tmpf).alias("tmpf"), F.when(i % 59 != 0, p01i).alias("p01i"),
    )


def weather_records(spark, folder):
    """Weather reports with readings as topic records."""
    return weather_reports(spark, folder).dropna().select(
        F.date_format("valid", WEATHER_TIME_FORMAT).alias("datetime"),
        F.col("tmpf").alias("fahrenheit"), F.col("p01i").alias("precip_in"),
    )


def weather_file(spark, folder, strict=False):
    """Weather reports as file rows; a null reading is the token "M".

    A strict file leaves the reports with such readings out.
    """
    reports = weather_reports(spark, folder)
    if strict:
        reports = reports.dropna()
    return reports.select(
        F.lit("LGA").alias("station"),
        F.date_format("valid", WEATHER_TIME_FORMAT).alias(" valid"),
        F.coalesce(F.col("tmpf").cast("string"), F.lit("M")).alias(" tmpf"),
        F.lit("-").alias(" unused_3"),
        F.coalesce(F.col("p01i").cast("string"), F.lit("M")).alias(" p01i"),
    )


def zip_centroids(spark, folder):
    """One zip per supplier, inside the box."""
    k = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        (k + 10001).cast("string").alias("zip"),
        ((F.lit(405000) + F.pmod(k * 2111, F.lit(5000))) / 10000.0).alias("lat"),
        ((F.lit(737000) + F.pmod(k * 1733, F.lit(3500))) / -10000.0).alias("lon"),
    )
