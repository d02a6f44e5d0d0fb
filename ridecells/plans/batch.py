"""Batch jobs from files to tables and models."""

from ridecells.functions.text import without_leading_blank
from ridecells.models.forest import DEPTH, SEED, TREES, save_model, train_forest
from ridecells.operators.cleaning import (
    bucket_hourly_weather, clean_rides, clean_weather, clean_zip_rides, enrich_rides,
    hourly_weather, with_zip,
)
from ridecells.operators.counts import count_zip_conditions, unpack_cell
from ridecells.operators.joins import join_weather, nearest_zip, weather_counts
from ridecells.session import stored
from ridecells.sinks.tables import write_csv, write_sorted_csv
from ridecells.sinks.topics import publish_rides, write_topic
from ridecells.sources.files import (
    load_rides, load_weather, read_csv, ride_rows, weather_rows,
)
from ridecells.sources.topics import end_offsets, first_records, read_whole_topic


def training_table(rides, weather):
    """Demand per cell position, weekday, hour and weather buckets.

    ``rides`` has ``date, lat, lon``; ``weather`` has ``valid, tmpf, p01i``.
    """
    cells = clean_rides(enrich_rides(rides))
    counts = weather_counts(cells, clean_weather(weather))
    return unpack_cell(counts).select(
        "weekday", "hour", "temperature", "precipitation", "count", "cell_index_x",
        "cell_index_y")


def training_table_from_files(spark, rides_path, weather_path, rides_schema=None,
                              weather_schema=None):
    return training_table(load_rides(spark, rides_path, rides_schema),
                          load_weather(spark, weather_path, weather_schema))


def train_and_save(spark, rides_path, weather_path, model_path, *, trees=TREES, depth=DEPTH,
                   seed=SEED, rides_schema=None, weather_schema=None):
    """Fit the forest on ride and weather files and save it."""
    counts = stored(training_table_from_files(spark, rides_path, weather_path, rides_schema,
                                              weather_schema), "counts")
    _, model = train_forest(counts, trees, depth, seed)
    save_model(model, model_path)
    return model


def sort_rides(spark, source, target, column="pickup_datetime", schema=None):
    """Ride files in order of pick-up time; names lose their leading blank."""
    raw = read_csv(spark, source, schema)
    named = raw.toDF(*[without_leading_blank(c) for c in raw.columns])
    write_sorted_csv(named, target, column)


def add_zip(rides, zips, radius_miles=1.0, lat="lat", lon="lon"):
    """Rides with the zip of their place, those without one dropped."""
    return with_zip(nearest_zip(rides, zips, radius_miles, lat, lon))


def zip_training_table(rides, weather, zips, radius_miles=1.0):
    """Demand per zip, weekday, hour and weather buckets.

    Weather is taken by the rule of :func:`hourly_weather`.
    """
    placed = clean_zip_rides(nearest_zip(rides, zips, radius_miles))
    merged = join_weather(placed, bucket_hourly_weather(hourly_weather(weather)))
    return count_zip_conditions(merged)


def save_zip_training_table(rides, weather, zips, path, radius_miles=1.0):
    write_csv(zip_training_table(rides, weather, zips, radius_miles), path)


def publish_ride_file(spark, path, topic, *, fmt="kafka", options=None, encoding="json"):
    """Ride file to a topic; gives the number of rides with bad coordinates."""
    return publish_rides(ride_rows(spark, path), topic, fmt=fmt, options=options,
                         encoding=encoding)


def publish_weather_file(spark, path, topic, *, fmt="kafka", options=None, encoding="json"):
    write_topic(weather_rows(spark, path), topic, fmt=fmt, options=options, encoding=encoding)


def inspect_topic(spark, topic, value_schema=None, n=20, **how):
    """End offsets and the first n records of a topic.

    ``how`` is passed to :func:`ridecells.sources.topics.read_whole_topic`.
    """
    log = read_whole_topic(spark, topic, value_schema, **how)
    return end_offsets(log), first_records(log, n)
