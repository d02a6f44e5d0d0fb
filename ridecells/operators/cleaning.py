"""Cleaning of ride and weather tables."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ridecells.functions.grid import bad_coordinate, grid_cell, in_box, inside_box
from ridecells.functions.numbers import clean_number
from ridecells.functions.times import (
    hour_of_day, hour_start, minute_of_hour, weekday_from_one, weekday_from_zero,
)
from ridecells.functions.weather import rain_bucket, temperature_bucket
from ridecells.operators.counts import mean_temperature_by_hour
from ridecells.schemas import MISSING_ZIP, RAIN_MINUTE


def without_bad_coordinates(rides, lat="lat", lon="lon"):
    return rides.filter(~bad_coordinate(lat, lon))


def enrich_rides(rides, lat="lat", lon="lon", cell="cell_id"):
    """Rides inside the box with their cell."""
    return rides.filter(inside_box(lat, lon)).withColumn(cell, grid_cell(lat, lon))


def enrich_or_drop(rides, name="rides without a cell", lat="pickup_latitude",
                   lon="pickup_longitude", cell="pickup_cellid", event_time=None):
    """Rides with their cell; those without one are counted and dropped.

    Gives the frame and, for a batch, the observation that holds the number
    ``dropped`` after an action. A stream reports it in its progress under
    ``name``. With ``event_time`` the condition mentions that column, which
    keeps Catalyst from moving it below the watermark: the watermark must
    follow dropped rides too.
    """
    lost = ~in_box(lat, lon)
    metric = F.count_if(lost).alias("dropped")
    observed = name if rides.isStreaming else Observation(name)
    seen = rides.observe(observed, metric)
    keep = ~lost if event_time is None else F.when(F.col(event_time).isNotNull(), ~lost)
    kept = seen.filter(keep).withColumn(cell, grid_cell(lat, lon))
    return kept, (None if rides.isStreaming else observed)


def clean_rides(enriched, ts="date"):
    """Weekday, hour and hour key in place of time and coordinates."""
    return enriched.select(
        "cell_id", weekday_from_one(ts).alias("weekday"), hour_of_day(ts).alias("hour"),
        hour_start(ts).alias("hour_ts"),
    )


def clean_weather(weather):
    """Hour key and buckets of the reports of minute 51.

    Readings may be numbers or text; text that is no number becomes null.
    """
    return (
        weather.filter(minute_of_hour("valid") == RAIN_MINUTE)
        .withColumn("tmpf", clean_number("tmpf")).withColumn("p01i", clean_number("p01i"))
        .select(
            hour_start("valid").alias("hour_ts"), temperature_bucket("tmpf").alias("temperature"),
            rain_bucket("p01i").alias("precipitation"),
        )
    )


def hourly_weather(weather):
    """Rain of minute 51 beside the mean temperature of the hour.

    Unlike :func:`clean_weather`, which takes both from minute 51.
    """
    readings = weather.select(
        hour_start("valid").alias("hour_ts"), minute_of_hour("valid").alias("minute"),
        clean_number("tmpf").alias("fahrenheit"), clean_number("p01i").alias("precip_in"),
    )
    # One scan: the few readings of minute 51 are kept beside the hour's mean.
    rain = F.collect_list(F.when(F.col("minute") == RAIN_MINUTE, F.struct("precip_in")))
    hours = mean_temperature_by_hour(readings, rain.alias("rain"))
    return hours.select("hour_ts", F.explode("rain").alias("r"), "fahrenheit").select(
        "hour_ts", "r.precip_in", "fahrenheit")


def bucket_hourly_weather(hourly):
    return hourly.select(
        "hour_ts", temperature_bucket("fahrenheit").alias("temperature"),
        rain_bucket("precip_in", refuse_negative=True).alias("precipitation"),
    )


def with_zip(rides, zip_column="zip"):
    """Rides whose zip was found."""
    return rides.filter(F.col(zip_column) != MISSING_ZIP)


def odd_missing_zip(rides, zip_column="zip", lat="lat"):
    """Rides without a zip although their latitude is not zero."""
    return rides.filter((F.col(zip_column) == MISSING_ZIP) & (F.col(lat) != 0.0))


def clean_zip_rides(rides, ts="date"):
    """Hour, weekday from zero, and hour key of rides with a zip."""
    return with_zip(rides).select(
        "zip", hour_of_day(ts).alias("hour"), weekday_from_zero(ts).alias("weekday"),
        hour_start(ts).alias("hour_ts"),
    )
