"""Profiles, order, samples, files and topics."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridecells.operators import cleaning, counts, ordering, profile
from ridecells.plans import batch
from ridecells.schemas import RAW_RIDE, RIDE_FILE, WEATHER_REPORT
from ridecells.session import shared_folder
from ridecells.sinks.topics import write_topic
from ridecells.sources import files, topics


def numbers(spark, n):
    """Skewed numbers, a third of them equal, some null."""
    i = F.col("id")
    value = (F.when(i % 3 == 0, F.lit(7.5)).when(i % 1000 != 1, F.pmod(i * i * 7919, F.lit(100003)) / 8.0))
    return spark.range(n).select(value.alias("v"), (i % 10).alias("w"))


@pytest.mark.parametrize("n, size, most", [(5000, 8192, 10 ** 6), (60_000, 64, 500), (60_000, 200, 10), (60_000, 8192, 10 ** 6), (1, 8, 1)])
def test_describe_equals_pandas(spark, n, size, most):
    frame = numbers(spark, n)
    expected = frame.toPandas().describe()
    for row in profile.describe(frame, ["v", "w"], size, most).collect():
        wanted = expected[row["column"]]
        names = {"count": "count", "mean": "mean", "min": "min", "q25": "25%", "q50": "50%",
                 "q75": "75%", "max": "max"}
        for mine, theirs in names.items():
            assert row[mine] == pytest.approx(wanted[theirs], rel=1e-12), (row["column"], mine)
        if n > 1:
            assert row["std"] == pytest.approx(wanted["std"], rel=1e-9)


def test_other_quantiles(spark):
    frame = numbers(spark, 30_000)
    got = {r["share"]: r["value"] for r in profile.exact_quantiles(
        frame, ["v"], (0.0, 0.001, 0.333, 0.999, 1.0), 2000).collect()}
    series = frame.toPandas()["v"]
    assert got == {q: pytest.approx(series.quantile(q), rel=1e-12) for q in got} and len(got) == 5


def test_misplaced_brackets_are_opened(spark, monkeypatch):
    frame = numbers(spark, 20_000)
    expected = frame.toPandas()["v"].quantile([0.25, 0.5, 0.75]).tolist()
    monkeypatch.setattr(profile, "_slack", lambda size: -0.1)  # both ends on the wrong side
    assert [r["value"] for r in profile.exact_quantiles(frame, ["v"], most=100).collect()] == pytest.approx(expected, rel=1e-12)
    monkeypatch.setattr(profile, "_slack", lambda size: 0.0)
    assert [r["value"] for r in profile.exact_quantiles(frame, ["v"], size=16, most=100).collect()] == pytest.approx(expected, rel=1e-12)


def test_quantiles_of_repeated_values_and_not_a_numbers(spark):
    frame = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") / 100).alias("hot"),
        F.when(F.col("id") < 3000, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("gaps"))
    hot = frame.toPandas()["hot"]
    got = {(r["column"], r["share"]): r["value"] for r in profile.exact_quantiles(frame, ["hot", "gaps"], (0.1, 0.5, 0.9), 32, 5).collect()}
    assert [got["hot", q] for q in (0.1, 0.5, 0.9)] == pytest.approx(hot.quantile([0.1, 0.5, 0.9]).tolist())
    assert got["gaps", 0.1] == pytest.approx(3000 + 0.1 * 8999) and got["gaps", 0.5] == pytest.approx(3000 + 0.5 * 8999)
    assert got["gaps", 0.9] != got["gaps", 0.9]


def test_describe_of_an_empty_column(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    got = {r["column"]: (r["count"], r["q50"]) for r in profile.describe(frame, ["a", "b"]).collect()}
    assert got == {"a": (0, None), "b": (2, 1.5)}


def test_histogram_closes_the_last_bin(spark, rows):
    frame = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10)], "v double")
    assert rows(profile.histogram(frame, "v", 5), "bin", "bin_start", "rows") == [
        (0, 0.0, 2), (1, 2.0, 1), (4, 8.0, 2)]
    same = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert rows(profile.histogram(same, "v", 5), "bin", "rows") == [(0, 2)]


def test_small_counts(spark, rows):
    frame = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a int, b string")
    assert rows(profile.nulls_per_column(frame)) == [(1, 1)]
    assert rows(counts.shape(frame)) == [(3, 2)]
    assert rows(counts.rows_meeting(frame, F.col("b") == "x")) == [(1,)]


def test_order_is_total_and_keeps_ties_in_place(spark):
    frame = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 100).alias("k"), "id")
    got = [tuple(r) for r in ordering.stable_order(frame, "k").collect()]
    assert got == sorted(got)


def test_hot_time_is_spread_by_the_sort(spark):
    frame = spark.range(0, 80_000, 1, 8).select(F.lit(1).alias("k"), "id")
    sizes = ordering.stable_order(frame, "k").groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert max(r["count"] for r in sizes.collect()) < 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sample_has_exactly_n_rows_and_repeats(spark):
    frame = spark.range(20_000)
    first = {r.id for r in ordering.random_rows(frame, 500, "id", seed="a").collect()}
    again = {r.id for r in ordering.random_rows(frame.repartition(3), 500, "id", seed="a").collect()}
    other = {r.id for r in ordering.random_rows(frame, 500, "id", seed="b").collect()}
    assert len(first) == 500 and first == again and first != other
    assert ordering.random_rows(frame, 30_000, "id").count() == 20_000


def test_most_frequent(spark):
    frame = spark.createDataFrame([("a", 2), ("b", 5), ("c", 2)], "k string, count int")
    assert [r.k for r in ordering.most_frequent(frame, 2).collect()] == ["b", "a"]


# The header and one row of a ride file.
HEADER = ("vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,"
          " pickup_longitude, pickup_latitude, rate_code, store_and_fwd_flag, dropoff_longitude,"
          " dropoff_latitude, payment_type, fare_amount, surcharge, mta_tax, tip_amount,"
          " tolls_amount, total_amount")
RIDE = ("CMT,2014-05-07 09:33:52,2014-05-07 09:52:36,1,1.8,-73.977132999999995,"
        "40.747166999999997,1,N,-73.981178,40.765351000000003,CRD,12.5,0,0.5,"
        "2.6000000000000001,0,15.6")


@pytest.fixture
def ride_csv(tmp_path):
    def write(*lines):
        (tmp_path / "rides.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        return str(tmp_path / "rides.csv")
    return write


@pytest.mark.parametrize("schema", [None, RIDE_FILE])
def test_ride_loader(spark, ride_csv, schema):
    frame = files.load_rides(spark, ride_csv(RIDE), schema)
    assert frame.columns == ["date", "lat", "lon"]
    row = frame.withColumn("date", F.col("date").cast("string")).first()
    assert tuple(row) == ("2014-05-07 09:33:52", 40.747167, -73.977133)


def test_ride_rows_abort_on_malformed_numbers(spark, ride_csv):
    good = files.ride_rows(spark, ride_csv(RIDE)).first()
    assert tuple(good) == ("2014-05-07 09:33:52", 40.747167, -73.977133)
    for bad in (RIDE.replace("40.747166999999997", "north"), RIDE.replace("40.747166999999997", "")):
        with pytest.raises(Exception):
            files.ride_rows(spark, ride_csv(RIDE, bad)).collect()


def test_malformed_rides_drop_out_of_the_training_table(spark, ride_csv, tmp_path):
    weather = tmp_path / "weather.csv"
    weather.write_text("station, valid, tmpf, x, p01i\nLGA,2014-05-07 09:51,61.0,-,0.25\n")
    rides = ride_csv(RIDE, RIDE.replace("2014-05-07 09:33:52", "yesterday"),
                     RIDE.replace("-73.977132999999995", "west"), RIDE)
    got = batch.training_table_from_files(spark, rides, str(weather), RIDE_FILE)
    assert [tuple(r) for r in got.collect()] == [(3, 9, 2, 1, 2, 52, 202)]


def test_box_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "rides")
    spark.createDataFrame([(40.7, -73.9, 1, 2)], "lat double, lon double, a int, b int").write.parquet(path)
    rides = cleaning.enrich_rides(cleaning.without_bad_coordinates(spark.read.parquet(path)))
    plan = rides.select("cell_id")._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    for part in ("GreaterThan(lat,40.5)", "LessThan(lat,41.0)", "GreaterThan(lon,-74.05)",
                 "LessThan(lon,-73.7)", "Not(EqualNullSafe(lat,0.0))"):
        assert part in scan
    assert "ReadSchema: struct<lat:double,lon:double>" in scan


def test_weather_rows(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text("station, valid, tmpf, x, p01i\nLGA,2014-05-01 05:51,61.0,-,0.25\n")
    assert [tuple(r) for r in files.weather_rows(spark, str(path)).collect()] == [
        ("2014-05-01 05:51", 61.0, 0.25)]
    assert files.load_weather(spark, str(path)).columns == ["station", "valid", "tmpf", "x", "p01i"]
    path.write_text("station, valid, tmpf, x, p01i\nLGA,2014-05-01 05:51,M,-,0.25\n")
    with pytest.raises(Exception):
        files.weather_rows(spark, str(path)).collect()


def test_sorted_files_follow_each_other(spark, tmp_path, ride_csv):
    lines = [RIDE.replace("09:33:52", f"{h:02d}:{m:02d}:00") for m in range(60) for h in (9, 3, 17)]
    target = tmp_path / "sorted"
    batch.sort_rides(spark, ride_csv(*lines), str(target))
    merged = pd.concat([pd.read_csv(p) for p in sorted(target.glob("part-*.csv")) if p.stat().st_size])
    times = merged.iloc[:, 1].tolist()
    assert len(times) == 180 and times == sorted(times) and times[0] == "2014-05-07 03:00:00"


def test_topic_round_trip(spark, ride_csv):
    how = {"fmt": "parquet", "options": {"path": shared_folder(spark, "round-trip")}}
    zero = RIDE.replace("40.747166999999997", "0")
    path = ride_csv(RIDE, zero, RIDE.replace("CMT", "VTS"))
    for sends in (1, 2):
        assert batch.publish_ride_file(spark, path, "rides", **how) == 1
        offsets, head = batch.inspect_topic(spark, "rides", **how)
        assert offsets.agg(F.sum("end_offset")).first()[0] == 2 * sends
        assert head.count() == 2 * sends
        back = topics.read_topic(spark, "rides", RAW_RIDE, streaming=False, **how)
        assert {(r.key, r.pickup_latitude) for r in back.collect()} == {(None, 40.747167)}


def test_topic_event_time_and_watermark(spark):
    how = {"fmt": "parquet", "options": {"path": shared_folder(spark, "event-time")}}
    frame = spark.createDataFrame([("2014-05-01 05:51", 61.0, 0.0)], WEATHER_REPORT)
    write_topic(frame, "weather", **how)
    stream = topics.read_topic(spark, "weather", WEATHER_REPORT, event_time=F.current_timestamp(),
                               delay="5 minutes", **how)
    assert "EventTimeWatermark" in stream._jdf.queryExecution().analyzed().toString()


def test_shared_folder_needs_a_setting_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")
