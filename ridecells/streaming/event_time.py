"""Event time of ride streams."""

from ridecells.functions.times import parse_ride_time


def pickup_time():
    """Event time of a ride record: its parsed pick-up time."""
    return parse_ride_time("pickup_datetime")


def with_watermark(rides, ts="ts", delay="0 seconds"):
    """Watermark at the latest event time seen.

    No delay fits a source in time order. The mark is the maximum over all
    partitions, so a source whose partitions run apart needs a delay, or a
    source per partition (``read_topic`` with ``partitions``). A query restarted from its checkpoint resumes from the mark it had.
    """
    return rides.withWatermark(ts, delay)
