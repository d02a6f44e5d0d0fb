"""Sliding windows, as a batch and as a stream under the same cases."""

import pytest
from pyspark.sql import functions as F

from ridecells.operators.counts import count_by_window, popular, stamp_windows
from ridecells.schemas import CELL_COUNT, CELLED_RIDE, DOCUMENT, RAW_RIDE, REJECTED, WEATHER_REPORT
from ridecells.session import shared_folder
from ridecells.sinks.topics import write_topic
from ridecells.sources.topics import read_topic
from ridecells.streaming import jobs


def minutes(spark, *values, cell=10):
    frame = spark.createDataFrame([(float(v),) for v in values], "m double")
    return frame.select(
        F.timestamp_micros((F.col("m") * 60_000_000).cast("bigint")).alias("ts"),
        F.lit(cell).alias("cell_id"))


def by_start(frame):
    start = (F.unix_seconds("window_start") / 60).cast("int")
    return {r[0]: r[1] for r in frame.select(start, "count").collect()}


def test_no_rides(spark):
    assert by_start(count_by_window(minutes(spark, 1.0).filter("false"))) == {}


def test_one_ride(spark):
    got = by_start(count_by_window(minutes(spark, 2)))
    assert got == {-10: 1, -5: 1, 0: 1}


def test_one_ride_in_two_windows_after_the_epoch(spark):
    got = by_start(count_by_window(minutes(spark, 6)))
    assert got == {-5: 1, 0: 1, 5: 1}


def test_windows_share_rides(spark):
    got = by_start(count_by_window(minutes(spark, 6, 6, 6, 17, 18)))
    assert (got[0], got[5], got[10]) == (3, 5, 2)


def test_windows_are_half_open(spark):
    got = by_start(count_by_window(minutes(spark, 0, 15)))
    assert got[0] == 1 and got[5] == 1 and 15 in got and -15 not in got


@pytest.mark.parametrize("size, every", [(15, 5), (15, 15), (20, 6), (10, 7), (120, 45)])
def test_panes_give_what_windows_give(spark, rows, size, every):
    rides = spark.range(4000).select(
        F.timestamp_seconds(F.col("id") * 37 % 90_000).alias("ts"),
        (F.col("id") % 3).cast("int").alias("cell_id"))
    plain = rides.groupBy(
        F.window("ts", f"{size} minutes", f"{every} minutes"), "cell_id").count().select(
        "cell_id", "window.start", "window.end", "count")
    assert rows(count_by_window(rides, size, every)) == rows(plain)


# Nine celled rides of one morning.
RIDES = [
    ("2014-05-07 09:33:52", 10), ("2014-05-07 09:33:53", 20019), ("2014-05-07 09:33:54", 20019),
    ("2014-05-07 09:33:55", 10), ("2014-05-07 09:33:56", 20019), ("2014-05-07 09:33:57", 10),
    ("2014-05-07 09:33:59", 10), ("2014-05-07 09:49:01", 10), ("2014-05-07 11:49:01", 10),
]
POPULAR = sorted(
    (f"2014-05-07T09:{m}:59.999Z", cell, n)
    for m in (34, 39, 44) for cell, n in ((10, 4), (20019, 3)))


def celled(spark, rides):
    return spark.createDataFrame(
        [(t, 0.0, 0.0, c) for t, c in rides], CELLED_RIDE)


class Topics:
    def __init__(self, spark):
        self.spark = spark
        self.base = shared_folder(spark, "windows")
        self.how = {"fmt": "parquet", "options": {"path": self.base}}

    def send(self, rides):
        write_topic(celled(self.spark, rides).coalesce(1), "celled", key="pickup_cellid",
                    **self.how)

    def run(self, **more):
        query = jobs.run_popular_cells(
            self.spark, "celled", "popular", checkpoint=f"{self.base}/c", **self.how, **more)
        query.awaitTermination()
        return query

    def result(self):
        frame = jobs.topic_values(self.spark, "popular", CELL_COUNT, **self.how)
        return sorted(tuple(r) for r in frame.collect())


def test_popular_cells_of_a_batch(spark, rows):
    timed = celled(spark, RIDES).withColumn("ts", F.col("pickup_datetime").cast("timestamp"))
    assert rows(jobs.popular_counts(timed, threshold=3)) == POPULAR


def test_popular_cells_of_a_stream(spark):
    topics = Topics(spark)
    topics.send(RIDES)
    topics.run(threshold=3)
    assert topics.result() == POPULAR


def test_threshold_is_inclusive_and_stamped(spark, rows):
    counts = count_by_window(minutes(spark, 6, 6, 6, 17, 18))
    assert rows(stamp_windows(popular(counts, 5))) == [("1970-01-01T00:19:59.999Z", 10, 5)]


def test_late_rides_count_only_in_open_windows(spark):
    day = "2014-05-07 "
    topics = Topics(spark)
    for batch in (("00:06:00", "00:16:00"), ("00:16:30",), ("00:07:00", "00:01:00"), ("03:00:00",)):
        topics.send([(day + t, 10) for t in batch])
        topics.run(threshold=1)
    assert topics.result() == sorted([
        ("2014-05-07T00:09:59.999Z", 10, 1), ("2014-05-07T00:14:59.999Z", 10, 1),
        ("2014-05-07T00:19:59.999Z", 10, 4), ("2014-05-07T00:24:59.999Z", 10, 2),
        ("2014-05-07T00:29:59.999Z", 10, 2)])


def test_watermark_resumes_from_the_checkpoint(spark):
    topics = Topics(spark)
    topics.send([("2014-05-07 09:00:00", 10), ("2014-05-07 12:00:00", 10)])
    topics.run(threshold=1)
    before = topics.result()
    # Far behind the stored watermark, so it must not appear in any window.
    topics.send([("2014-05-07 08:00:00", 10)])
    topics.run(threshold=1)
    assert topics.result() == before != []


def test_dropped_rides_move_the_watermark(spark):
    base = shared_folder(spark, "guard")
    how = {"fmt": "parquet", "options": {"path": base}}
    rides = [("2014-05-07 09:00:00", 40.7, -73.9), ("2014-05-07 12:00:00", 0.0, 0.0)]
    write_topic(spark.createDataFrame(rides, RAW_RIDE), "rides", **how)
    jobs.run_popular_documents(spark, "rides", f"{base}/index", threshold=1,
                               checkpoint=f"{base}/c", **how).awaitTermination()
    times = sorted(r.time for r in spark.read.schema(DOCUMENT).json(f"{base}/index").collect())
    assert times == [f"2014-05-07T09:{m}:59.999Z" for m in ("04", "09", "14")]


def test_enrichment_keys_by_cell_and_counts_the_dropped(spark):
    base = shared_folder(spark, "enrich")
    how = {"fmt": "parquet", "options": {"path": base}}
    rides = [("a", 40.999875, -74.04994), ("b", 40.50004, -73.70113), ("c", 0.0, -73.9),
             ("d", None, None)]
    write_topic(spark.createDataFrame(rides, RAW_RIDE), "rides", **how)
    query = jobs.run_enrichment(spark, "rides", "celled", checkpoint=f"{base}/c", **how)
    query.awaitTermination()
    found = read_topic(spark, "celled", CELLED_RIDE, key_type="int", streaming=False, **how)
    assert sorted((r.key, r.pickup_datetime, r.pickup_cellid) for r in found.collect()) == [
        (0, "a", 0), (99_999, "b", 99_999)]
    metrics = [p.observedMetrics["rides without a cell"] for p in query.recentProgress
               if p.observedMetrics]
    assert sum(m["dropped"] for m in metrics) == 2


def test_predictions_run_as_a_stream_over_the_whole_grid(spark):
    base = shared_folder(spark, "predict")
    how = {"fmt": "parquet", "options": {"path": base}}
    weather = [("2014-05-07 09:51", 61.0, 0.0), ("2014-05-07 09:21", 90.0, 0.5)]
    write_topic(spark.createDataFrame(weather, WEATHER_REPORT), "weather", **how)

    def scorer(frame):
        return frame.withColumn("prediction", F.col("temperature") + 0.5)

    jobs.run_prediction(spark, "weather", "predicted", scorer, checkpoint=f"{base}/c",
                        **how).awaitTermination()
    counts = jobs.topic_values(spark, "predicted", CELL_COUNT, **how).groupBy("datetime").agg(
        F.count_distinct("cell_id"), F.min("count"), F.max("count"))
    assert sorted(tuple(r) for r in counts.collect()) == [
        ("2014-05-07 09:21", 100_000, 5, 5), ("2014-05-07 09:51", 100_000, 3, 3)]


def _days(*clock, day="2014-05-07"):
    return [(f"{day} {c}", cell) for c, cell in clock]


def _lagging(spark):
    """Two partitions of alternating files; the second is hours behind the first."""
    topics = Topics(spark)
    ahead = [[("10:00:00", 10), ("10:03:00", 10)], [("11:00:00", 10)], [("12:00:00", 10)], [("13:00:00", 10)]]
    behind = [[("07:01:00", 20), ("07:00:00", 20)], [("08:01:00", 20), ("08:02:00", 10)], [("09:01:00", 20)], [("12:30:00", 20)]]
    for files in zip(ahead, behind):
        for number, rides in enumerate(files):
            write_topic(celled(spark, _days(*rides)).coalesce(1), f"celled/partition={number}", key="pickup_cellid", **topics.how)
    topics.how["options"]["maxFilesPerTrigger"] = "1"
    return topics, [r for files in (*ahead, *behind) for r in files]


def test_the_slowest_partition_closes_windows(spark, rows):
    topics, rides = _lagging(spark)
    topics.run(threshold=1, partitions=[0, 1])
    timed = celled(spark, _days(*rides)).withColumn("ts", F.col("pickup_datetime").cast("timestamp"))
    batch = rows(jobs.popular_counts(timed, threshold=1))
    assert topics.result() == [r for r in batch if r[0] <= "2014-05-07T12:30:00"]  # the last time of the slower one
    one_mark, _ = _lagging(spark)
    one_mark.run(threshold=1)
    lost = set(topics.result()) - set(one_mark.result())
    assert lost and all("07:00" < r[0][11:] < "10:00" for r in lost)  # rides of the slower one came too late there


def test_an_empty_partition_holds_windows_open(spark):
    topics = Topics(spark)
    write_topic(celled(spark, RIDES).coalesce(1), "celled/partition=0", key="pickup_cellid", **topics.how)
    write_topic(celled(spark, []), "celled/partition=1", key="pickup_cellid", **topics.how)
    topics.run(threshold=1, partitions=[0, 1])
    assert topics.result() == []


def test_partitions_need_the_slowest_mark(spark):
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    spark.conf.set(name, "max")
    try:
        with pytest.raises(ValueError, match="min"):
            Topics(spark).run(partitions=[0])
    finally:
        spark.conf.unset(name)


def test_records_are_dealt_to_partitions_by_key(spark):
    base = shared_folder(spark, "dealt")
    how = {"fmt": "parquet", "options": {"path": base}}
    records = spark.range(60).select((F.col("id") % 9).cast("int").alias("cell"), F.col("id"))
    write_topic(records, "numbers", key="cell", partitions=3, **how)
    write_topic(records.filter("id < 5"), "numbers", partitions=3, **how)
    stored = spark.read.parquet(f"{base}/numbers")
    keyed = stored.filter("key is not null")
    assert keyed.count() == 60 and keyed.select("key", "partition").distinct().count() == 9
    assert {r[0] for r in stored.filter("key is null").select("partition").distinct().collect()} == {0}
    parts = read_topic(spark, "numbers", "cell int, id long", streaming=False, partitions=[0, 1, 2], **how)
    assert parts.count() == 65


def _states(query):
    last = {}
    for p in query.recentProgress:
        for i, op in enumerate(p.stateOperators):
            last[i] = max(last.get(i, 0), op.numRowsUpdated)
    return last


def test_panes_on_a_stream_give_what_windows_give(spark):
    results, states = [], []
    for by_panes in (False, True):
        topics = Topics(spark)
        for rides in ([("09:00:01", 10), ("09:04:00", 10), ("09:14:59", 10), ("09:16:00", 20)],
                      [("09:03:00", 10), ("09:12:00", 10), ("09:20:00", 10)],  # late by less than the delay
                      [("10:00:00", 10)], [("11:00:00", 10)]):
            topics.send(_days(*rides))
            states.append(_states(topics.run(threshold=1, delay="20 minutes", by_panes=by_panes)))
        results.append(topics.result())
    assert results[0] == results[1] and len(results[0]) > 5
    assert results[0] == [r for r in results[0] if r[0] < "2014-05-07T10:40"]


def test_a_ride_changes_one_pane_and_three_windows(spark):
    updated = []
    for by_panes in (False, True):
        topics = Topics(spark)
        topics.send([(f"2014-05-07 09:{m:02}:00", 10) for m in range(60)])
        updated.append(max(_states(topics.run(threshold=1, delay="2 hours", by_panes=by_panes)).values()))
    assert updated == [14, 12]  # windows that touch an hour, and its panes


def test_emitted_and_open_windows_are_those_of_a_batch(spark, rows):
    topics = Topics(spark)
    topics.send(RIDES)
    topics.run(threshold=1)
    still_open = stamp_windows(jobs.open_windows(spark, f"{topics.base}/c"))
    timed = celled(spark, RIDES).withColumn("ts", F.col("pickup_datetime").cast("timestamp"))
    assert sorted(topics.result() + rows(still_open)) == rows(jobs.popular_counts(timed, threshold=1))
    assert still_open.count() == 3  # those that hold the last ride


def test_open_windows_of_an_earlier_batch(spark):
    topics = Topics(spark)
    topics.send(RIDES[:3])
    topics.run(threshold=1)
    first = jobs.open_windows(spark, f"{topics.base}/c", batch=0).count()
    topics.send([("2014-05-08 09:00:00", 10)])
    topics.run(threshold=1)
    assert first == 6 and jobs.open_windows(spark, f"{topics.base}/c").count() == 3


def test_unusable_records_go_to_a_topic_of_their_own(spark):
    topics = Topics(spark)
    good = '{"pickup_datetime":"2014-05-07 09:00:00","pickup_latitude":40.7,"pickup_longitude":-73.9}'
    bad = {'{"pickup_datetime":"2014-05-': "broken value", "": "broken value", "  ": "broken value", None: "broken value", "[1": "broken value",
           '{"pickup_datetime":"2014-05-07 09:00:00","pickup_latitude":"far","pickup_longitude":-73.9}': "broken value",
           good.replace("05-07", "15-07"): "no time", "{}": "no time", good.replace("40.7", "0.0"): "bad place",
           '{"pickup_datetime":"2014-05-07 09:00:00","pickup_latitude":40.7}': "bad place"}
    values = [(None, v) for v in (good, *bad, good)]
    spark.createDataFrame(values, "key string, value string").coalesce(1).write.parquet(f"{topics.base}/rides")
    for _ in range(2):
        jobs.run_rejected(spark, "rides", "rejected", checkpoint=f"{topics.base}/r", **topics.how).awaitTermination()
    found = jobs.topic_values(spark, "rejected", REJECTED, **topics.how).collect()
    assert {r["value"]: r["reason"] for r in found} == bad and len(found) == len(bad)
    assert sorted(r["offset"] for r in found) == list(range(1, len(bad) + 1))
    checked = jobs.checked_rides(spark, "rides", streaming=False, **topics.how)
    assert checked.filter("reason is null").select("pickup_latitude").collect() == [(40.7,), (40.7,)]


def test_documents_by_the_slowest_partition(spark):
    base = shared_folder(spark, "slow-documents")
    how = {"fmt": "parquet", "options": {"path": base}}
    for number, last in enumerate(("12:00:00", "10:00:00")):
        rides = [(f"2014-05-07 {t}", 40.7, -73.9) for t in ("09:00:00", last)]
        write_topic(spark.createDataFrame(rides, RAW_RIDE), f"rides/partition={number}", **how)
    for by_panes in (False, True):
        index = f"{base}/index-{by_panes}"
        jobs.run_popular_documents(spark, "rides", index, threshold=1, partitions=[0, 1], by_panes=by_panes,
                                   checkpoint=f"{base}/c-{by_panes}", **how).awaitTermination()
        found = sorted((r.time, r.cnt) for r in spark.read.schema(DOCUMENT).json(index).collect())
        assert found == [(f"2014-05-07T09:{m}:59.999Z", 2) for m in ("04", "09", "14")]
