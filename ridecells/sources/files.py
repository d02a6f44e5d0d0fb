"""CSV sources."""

from pyspark.sql import functions as F

from ridecells.functions.text import without_blanks, without_leading_blank
from ridecells.schemas import RIDE_FILE, WEATHER_FILE


def read_csv(spark, path, schema=None):
    """CSV with a header.

    Without a schema the types are inferred, which reads the files twice;
    give one for large inputs.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # Names in the header carry blanks; with a schema, position decides.
    return reader.option("enforceSchema", True).schema(schema).csv(path)


def load_rides(spark, path, schema=None):
    """Pick-up time and place as ``date, lat, lon``; null where malformed."""
    raw = read_csv(spark, path, schema)
    named = raw.toDF(*[without_leading_blank(c) for c in raw.columns])
    return named.select(
        F.col("pickup_datetime").try_cast("timestamp").alias("date"),
        F.col("pickup_latitude").try_cast("double").alias("lat"),
        F.col("pickup_longitude").try_cast("double").alias("lon"),
    )


def load_weather(spark, path, schema=None):
    """All columns of a weather file with the blanks taken out of the names."""
    raw = read_csv(spark, path, schema)
    return raw.toDF(*[without_blanks(c) for c in raw.columns])


def _required(name):
    message = F.lit(f"no value in column {name}")
    value = F.col(name)
    return F.when(value.isNull(), F.raise_error(message).cast("double")).otherwise(value).alias(name)


def ride_rows(spark, path):
    """Ride records by position; a malformed or absent number fails the job."""
    rows = (
        spark.read.option("header", True).option("mode", "FAILFAST")
        .schema(RIDE_FILE).csv(path)
    )
    return rows.select(
        "pickup_datetime", _required("pickup_latitude"), _required("pickup_longitude"),
    )


def weather_rows(spark, path):
    """Weather records by position; a malformed or absent number fails the job."""
    rows = (
        spark.read.option("header", True).option("mode", "FAILFAST")
        .schema(WEATHER_FILE).csv(path)
    )
    return rows.select(
        F.col("valid").alias("datetime"),
        _required("tmpf").alias("fahrenheit"),
        _required("p01i").alias("precip_in"),
    )
