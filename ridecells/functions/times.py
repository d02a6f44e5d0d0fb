"""Columns over event times. The session time zone is UTC."""

from pyspark.sql import functions as F

from ridecells.schemas import RIDE_TIME_FORMAT, WEATHER_TIME_FORMAT


def parse_ride_time(text):
    """Null where the text is no such time."""
    return F.try_to_timestamp(F.col(text), F.lit(RIDE_TIME_FORMAT))


def parse_weather_time(text):
    """Null where the text is no such time."""
    return F.try_to_timestamp(F.col(text), F.lit(WEATHER_TIME_FORMAT))


def weekday_from_one(ts):
    """1 is Monday, 7 is Sunday."""
    return (F.weekday(F.col(ts)) + 1).cast("int")


def weekday_from_zero(ts):
    """0 is Monday, 6 is Sunday."""
    return F.weekday(F.col(ts)).cast("int")


def hour_of_day(ts):
    return F.hour(F.col(ts))


def minute_of_hour(ts):
    return F.minute(F.col(ts))


def hour_start(ts):
    """The hour as a timestamp: an eight-byte join and grouping key."""
    return F.date_trunc("hour", F.col(ts))


def hour_key(ts):
    """The hour as text, for output files."""
    return F.date_format(F.col(ts), "yyyy-MM-dd-HH")


def window_stamp(window_end):
    """Last instant of a window, one millisecond before its end, in ISO form."""
    last = F.col(window_end) - F.expr("INTERVAL '0.001' SECOND")
    return F.date_format(last, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
