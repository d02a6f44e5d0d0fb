import math
import random

import pytest
from pyspark.sql import functions as F

from ridecells.operators import cleaning, counts, joins


def hours(spark, *pairs):
    return spark.createDataFrame(pairs, "hour string, temperature int, precipitation int").select(
        F.to_timestamp("hour", "yyyy-MM-dd-HH").alias("hour_ts"), "temperature", "precipitation")


def rides(spark, n=3000):
    """A third of the rides in one hour and one cell."""
    hot = F.col("id") % 3 == 0
    hour = F.when(hot, F.lit(5)).otherwise(F.col("id") % 48)
    timed = spark.range(n).select(
        F.when(hot, F.lit(777)).otherwise(F.col("id") % 50).cast("int").alias("cell_id"),
        F.timestamp_seconds(F.lit(1399420800) + hour * 3600).alias("date"))
    return cleaning.clean_rides(timed)


def weather(spark):
    """Hours 0 to 39 of two days; hour 5 has three reports, two of one kind."""
    table = [(f"2014-05-{7 + h // 24:02d}-{h % 24:02d}", h % 5, h % 3) for h in range(40)]
    return hours(spark, *table, ("2014-05-07-05", 0, 2), ("2014-05-07-05", 4, 1))


KEYS = ["cell_id", "weekday", "hour", "temperature", "precipitation", "count"]


def test_both_ways_of_counting_agree(spark, rows):
    r, w = rides(spark), weather(spark)
    plain = rows(counts.count_conditions(r.join(w, "hour_ts")), *KEYS)
    assert rows(joins.weather_counts(r, w), *KEYS) == plain
    assert rows(joins.weather_counts(r, w, most=0), *KEYS) == plain
    assert rows(counts.count_conditions(joins.join_weather(r, w)), *KEYS) == plain
    assert rows(counts.count_conditions(joins.join_weather(r, w, most=0)), *KEYS) == plain
    assert sum(row[-1] for row in plain) == r.join(w, "hour_ts").count()


def test_counts_need_one_shuffle_of_rides(spark):
    plan = joins.weather_counts(rides(spark), weather(spark))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
    assert physical.count("Exchange hashpartitioning(cell_id") == 1


def test_cells_beside_every_report(spark, rows):
    reports = spark.createDataFrame([("a",), ("b",)], "datetime string")
    every = joins.with_all_cells(reports)
    assert every.count() == 200_000
    assert rows(every.agg(F.max("cell_index_x"), F.max("cell_index_y"), F.max("cell_id"))) == [
        (249, 399, 99999)]
    known = spark.createDataFrame([(250,), (3,), (250,)], "cell_id int")
    assert rows(joins.with_all_cells(reports, known)) == [
        ("a", 3, 3, 0), ("a", 250, 0, 1), ("b", 3, 3, 0), ("b", 250, 0, 1)]
    beyond = known.union(spark.createDataFrame([(100_000,), (-1,), (None,)], "cell_id int"))
    assert joins.with_all_cells(reports, beyond).count() == 4
    assert rows(joins.known_cells(beyond)) == [(3,), (250,)]


def miles(a, b):
    (la, oa), (lb, ob) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * joins.EARTH_MILES * math.asin(math.sqrt(h))


def brute_force(points, zips, radius):
    found = []
    for name, lat, lon in points:
        best = "missing"
        if lat is not None:
            near = sorted((miles((lat, lon), (zl, zo)), z) for z, zl, zo in zips)
            if near and near[0][0] <= radius:
                best = near[0][1]
        found.append((name, best))
    return sorted(found)


@pytest.mark.parametrize("center, spread, radius", [
    ((40.75, -73.9), 0.3, 1.0), ((40.75, -73.9), 0.3, 3.0), ((0.0, 179.95), 0.4, 5.0),
    ((84.0, -179.9), 0.6, 5.0), ((-33.0, 0.0), 0.05, 0.5), ((40.75, -73.9), 0.004, 3.0)])
@pytest.mark.parametrize("most", [joins.BROADCAST_ROWS, 0])
def test_nearest_zip_is_that_of_brute_force(spark, rows, center, spread, radius, most):
    rng = random.Random(7)

    def around():
        lat = center[0] + rng.uniform(-spread, spread)
        lon = center[1] + rng.uniform(-spread, spread)
        return lat, (lon + 180.0) % 360.0 - 180.0

    zips = [(f"{10000 + i}", *around()) for i in range(120)]
    zips += [("09999", *zips[0][1:])]
    points = [(i, *around()) for i in range(400)]
    # A third of the points at one place, and places without a zip.
    points += [(1000 + i, zips[0][1], zips[0][2]) for i in range(200)]
    points += [(2000, None, None), (2001, 0.0, 0.0)]
    p = spark.createDataFrame(points, "id int, lat double, lon double")
    z = spark.createDataFrame(zips, "zip string, lat double, lon double")
    got = rows(joins.nearest_zip(p, z, radius, most=most), "id", "zip")
    assert got == brute_force(points, zips, radius)
    assert dict(got)[1000] == "09999"


def test_dense_centroids_meet_few_points(spark, rows, monkeypatch):
    rng = random.Random(11)
    zips = [(f"{10000 + i}", 40.75 + rng.uniform(0, 0.02), -73.9 + rng.uniform(0, 0.02)) for i in range(1500)]
    zips += [(f"0{z[0]}", *z[1:]) for z in zips[:300]]
    points = [(i, 40.75 + rng.uniform(0, 0.02), -73.9 + rng.uniform(0, 0.02)) for i in range(1500)]
    p = spark.createDataFrame(points, "id int, lat double, lon double")
    z = spark.createDataFrame(zips, "zip string, lat double, lon double")
    kept, store = {}, joins.stored

    def watched(frame, name):
        kept.setdefault(name, []).append(store(frame, name))
        return kept[name][-1]

    monkeypatch.setattr(joins, "stored", watched)
    got = joins.nearest_zip(p, z, 3.0, most=0)
    # All lie within reach of each other: matched by reach alone, they'd meet in 2.7 million pairs.
    open_squares = (F.col("_rivals") > joins.FEW_RIVALS) & (F.col("_points") > joins.FEW_POINTS)
    met = [f.where(~open_squares).agg(F.sum(F.col("_points") * F.col("_rivals"))).first()[0] or 0 for f in kept["sizes"]]
    assert sum(met) <= 64 * len(points)
    assert max(f.count() for f in kept["near"]) <= 40 * len(zips)
    found = dict(rows(got, "id", "zip"))
    assert len(found) == len(points)
    assert sorted(found.items())[:60] == brute_force(points[:60], zips, 3.0)


def test_no_zips_at_all(spark, rows):
    p = spark.createDataFrame([(1, 40.7, -73.9)], "id int, lat double, lon double")
    z = spark.createDataFrame([], "zip string, lat double, lon double")
    assert rows(joins.nearest_zip(p, z), "id", "zip") == [(1, "missing")]


def test_small_zip_table_moves_no_rides(spark):
    p = spark.createDataFrame([(1, 40.7, -73.9)], "id int, lat double, lon double")
    z = spark.createDataFrame([("1", 40.7, -73.9)], "zip string, lat double, lon double")
    plan = joins.nearest_zip(p, z)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_two_rules_for_the_temperature(spark, rows):
    reports = spark.createDataFrame(
        [("2014-05-07 09:21", "90.0", "0.2"), ("2014-05-07 09:51", "60.0", "0.1"),
         ("2014-05-07 10:51", "M", "0.0"), ("2014-05-07 11:21", "50.0", "0.0")],
        "v string, tmpf string, p01i string").select(
        F.to_timestamp("v").alias("valid"), "tmpf", "p01i")
    hour = F.hour("hour_ts").alias("hour")
    minute51 = cleaning.clean_weather(reports).select(hour, "temperature", "precipitation")
    assert rows(minute51.na.fill(-1)) == [(9, 2, 1), (10, -1, 0)]
    hourly = cleaning.bucket_hourly_weather(cleaning.hourly_weather(reports))
    assert rows(hourly.select(hour, "temperature", "precipitation").na.fill(-1)) == [
        (9, 3, 1), (10, -1, 0)]


def test_dropped_rides_are_counted(spark):
    raw = spark.createDataFrame(
        [("a", 40.7, -73.9), ("b", 0.0, 0.0), ("c", None, -73.9), ("d", 42.0, -73.9)],
        "pickup_datetime string, pickup_latitude double, pickup_longitude double")
    kept, seen = cleaning.enrich_or_drop(raw)
    assert [r.pickup_datetime for r in kept.collect()] == ["a"]
    assert seen.get["dropped"] == 3
