"""Counts over cells, windows, hours and conditions."""

from math import gcd

from pyspark.sql import functions as F

from ridecells.functions.grid import cell_x, cell_y
from ridecells.functions.times import window_stamp
from ridecells.schemas import POPULAR_COUNT, SLIDE_MINUTES, WINDOW_MINUTES

MICROS_PER_MINUTE = 60_000_000


def _pane_start(ts, minutes):
    micros = F.unix_micros(F.col(ts))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(minutes * MICROS_PER_MINUTE)))


def count_by_window(rides, size=WINDOW_MINUTES, every=SLIDE_MINUTES, ts="ts", cell="cell_id", by_panes=False):
    """Rides per cell and sliding window: ``cell_id, window_start, window_end, count``.

    Windows are half-open and aligned to the epoch. A batch is counted first
    by panes, the longest pieces that no window cuts, so each ride is
    aggregated once and only pane counts are spread over the windows. A
    stream is windowed directly, since lateness is judged per window.

    ``by_panes`` counts a stream by panes too, in two aggregations in a row: a
    ride then changes one row of state instead of one per window, and a pane's
    count moves on when the watermark has passed the pane. So lateness is judged
    per pane: give the watermark a delay that covers the disorder of the rides.
    """
    if rides.isStreaming and by_panes:
        panes = rides.groupBy(
            F.window(F.col(ts), f"{gcd(size, every)} minutes").alias("pane"), F.col(cell).alias("cell_id"),
        ).agg(F.count("*").alias("pane_count"))
        window = F.window(F.window_time("pane"), f"{size} minutes", f"{every} minutes")
        counted = panes.groupBy(window, "cell_id").agg(F.sum("pane_count").alias("count"))
    elif rides.isStreaming:
        window = F.window(F.col(ts), f"{size} minutes", f"{every} minutes")
        counted = rides.groupBy(window, F.col(cell).alias("cell_id")).count()
    else:
        panes = (
            rides.filter(F.col(ts).isNotNull())
            .groupBy(F.col(cell).alias("cell_id"), _pane_start(ts, gcd(size, every)).alias("pane"))
            .agg(F.count("*").alias("pane_count"))
        )
        window = F.window("pane", f"{size} minutes", f"{every} minutes")
        counted = panes.groupBy(window, "cell_id").agg(F.sum("pane_count").alias("count"))
    return counted.select(
        "cell_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "count",
    )


def stamp_windows(counts):
    """Cell counts as records ``datetime, cell_id, count``."""
    return counts.select(window_stamp("window_end").alias("datetime"), "cell_id", "count")


def popular(counts, threshold=POPULAR_COUNT):
    """Counts that reach the threshold."""
    return counts.filter(F.col("count") >= threshold)


def count_conditions(joined):
    """Rides per cell, weekday, hour and weather buckets."""
    return joined.groupBy("cell_id", "weekday", "hour", "temperature", "precipitation").count()


def unpack_cell(counts):
    """Cell id replaced by its grid position."""
    return (
        counts.withColumn("cell_index_x", cell_x("cell_id"))
        .withColumn("cell_index_y", cell_y("cell_id")).drop("cell_id")
    )


def count_zip_conditions(merged):
    """Rides per hour, weekday, zip and weather buckets, as a sum of ones."""
    keys = ["hour", "weekday", "zip", "temperature", "precipitation"]
    return merged.withColumn("count", F.lit(1)).groupBy(*keys).agg(F.sum("count").alias("count"))


def mean_temperature_by_hour(weather, *more, hour="hour_ts", fahrenheit="fahrenheit"):
    """Mean per hour, beside any further aggregates."""
    return weather.groupBy(hour).agg(F.avg(fahrenheit).alias(fahrenheit), *more)


def rows_meeting(df, condition):
    return df.agg(F.count_if(condition).alias("rows"))


def distinct_hours(df, hour="hour_ts"):
    """Number of different hours, to see that none is absent.

    Two steps, so that the hours are made distinct in all tasks.
    """
    return df.select(hour).distinct().agg(F.count(hour).alias("hours"))


def total_count(counts):
    """Sum of all counts; equals the number of counted rows."""
    return counts.agg(F.sum("count").alias("total"))


def shape(df):
    """Number of rows and columns."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))
