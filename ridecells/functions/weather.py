"""Columns over weather readings."""

from pyspark.sql import functions as F

from ridecells.schemas import RAIN_EDGES, TEMPERATURE_EDGES


def _bucket(value, edges):
    chain = F.when(value.isNull(), F.lit(None).cast("int"))
    for number, edge in enumerate(edges):
        chain = chain.when(value < edge, F.lit(number))
    return chain.otherwise(F.lit(len(edges)))


def temperature_bucket(fahrenheit):
    return _bucket(F.col(fahrenheit), TEMPERATURE_EDGES)


def rain_bucket(inches, refuse_negative=False):
    """Rain bucket; with ``refuse_negative`` a negative amount fails the job."""
    value = F.col(inches)
    bucket = _bucket(value, RAIN_EDGES)
    if not refuse_negative:
        return bucket
    message = F.concat(F.lit("negative precipitation: "), value.cast("string"))
    return F.when(value < 0, F.raise_error(message).cast("int")).otherwise(bucket)
