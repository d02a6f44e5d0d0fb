import datetime
import json

import pytest
from pyspark.sql import functions as F

from ridecells.functions import numbers, text, times, weather
from ridecells.schemas import CELL_COUNT, avro_schema


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column).first()[0]


@pytest.mark.parametrize("value, bucket", [
    (39.9, 0), (40.0, 1), (54.9, 1), (55.0, 2), (70.0, 3), (84.9, 3), (85.0, 4), (None, None)])
def test_temperature_buckets(spark, value, bucket):
    assert one(spark, "v double", (value,), weather.temperature_bucket("v")) == bucket


@pytest.mark.parametrize("value, bucket", [
    (0.0, 0), (0.09, 0), (0.1, 1), (0.29, 1), (0.3, 2), (-1.0, 0), (None, None)])
def test_rain_buckets(spark, value, bucket):
    assert one(spark, "v double", (value,), weather.rain_bucket("v")) == bucket


def test_negative_rain_can_be_refused(spark):
    with pytest.raises(Exception, match="negative precipitation"):
        one(spark, "v double", (-0.1,), weather.rain_bucket("v", refuse_negative=True))
    assert one(spark, "v double", (0.2,), weather.rain_bucket("v", refuse_negative=True)) == 1


def test_calendar(spark):
    frame = spark.createDataFrame([("2014-05-07 09:33:52",), ("2014-05-11 23:51:00",)], "s string")
    timed = frame.withColumn("t", times.parse_ride_time("s"))
    got = timed.select(times.weekday_from_one("t"), times.weekday_from_zero("t"),
                       times.hour_of_day("t"), times.minute_of_hour("t"), times.hour_key("t"))
    assert [tuple(r) for r in got.collect()] == [
        (3, 2, 9, 33, "2014-05-07-09"), (7, 6, 23, 51, "2014-05-11-23")]


def test_weather_time(spark):
    got = one(spark, "s string", ("2014-05-01 05:29",), times.parse_weather_time("s"))
    assert got == datetime.datetime(2014, 5, 1, 5, 29)


def test_window_stamp_is_one_millisecond_before_the_end(spark):
    end = F.timestamp_seconds(F.lit(15 * 60)).alias("end")
    got = spark.range(1).select(end).select(times.window_stamp("end")).first()[0]
    assert got == "1970-01-01T00:14:59.999Z"


def test_text(spark):
    assert one(spark, "s string", ("2014-05-01 05:51",), text.hour_prefix("s")) == "2014-05-01-05"
    answer = '{"lat":"40.7","address":{"city":"NYC","postcode":"10016"}}'
    assert one(spark, "s string", (answer,), text.postcode("s")) == "10016"
    url = one(spark, "lat double, lon double", (40.747167, -73.977133),
              text.reverse_geocode_url("localhost", "8080", "lat", "lon"))
    assert url == "http://localhost:8080/reverse.php?format=json&lat=40.747167&lon=-73.977133"
    assert text.without_leading_blank(" a b") == "a b"
    assert text.without_blanks(" a b ") == "ab"


def test_cell_document(spark):
    got = one(spark, "t string, c int, n bigint", ("x", 20019, 4), text.cell_document("t", "c", "n"))
    assert got.startswith('{"time":"x","location":"40.899375,-74.0227') and got.endswith('"cnt":4}')


@pytest.mark.parametrize("value, rounded", [(0.5, 1), (1.49, 1), (2.5, 3), (-0.5, 0), (-1.5, -1)])
def test_round_half_up(spark, value, rounded):
    assert one(spark, "v double", (value,), numbers.round_half_up("v")) == rounded


def test_numbers(spark):
    assert one(spark, "s string", ("M",), numbers.clean_number("s")) is None
    assert one(spark, "s string", ("0.25",), numbers.clean_number("s")) == 0.25
    assert one(spark, "a double, b double", (1.0, 1.0009), numbers.within("a", "b", 0.001))
    assert not one(spark, "a double, b double", (1.0, 1.002), numbers.within("a", "b", 0.001))


@pytest.mark.parametrize("value", [0, 1, 99_999, 2 ** 31 - 1, -1, -2 ** 31])
def test_integers_as_four_bytes(spark, value):
    stored = one(spark, "v int", (value,), numbers.bytes_from_int(F.col("v")))
    assert bytes(stored) == value.to_bytes(4, "big", signed=True)
    assert one(spark, "v binary", (stored,), numbers.int_from_bytes(F.col("v"))) == value


def test_avro_schema_of_a_record():
    assert json.loads(avro_schema(CELL_COUNT, "CellCount")) == {
        "type": "record", "name": "CellCount", "fields": [
            {"name": "datetime", "type": "string"}, {"name": "cell_id", "type": "int"},
            {"name": "count", "type": "long"}]}
