"""Queries over file and topic sources, sinks and streaming jobs.

Topics are folders of Parquet files here; on a cluster they lie below
``spark.checkpoint.dir``.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridecells.catalog import sql
from ridecells.catalog.tables import RADIUS
from ridecells.functions.numbers import clean_number
from ridecells.operators import cleaning
from ridecells.operators.counts import popular, stamp_windows
from ridecells.plans import batch
from ridecells.plans import derived_tables as derived
from ridecells.schemas import (
    CELL_COUNT, CELLED_RIDE, DOCUMENT, RAW_RIDE, REJECTED, RIDE_FILE, RIDE_TIME_FORMAT, WEATHER_REPORT,
)
from ridecells.session import shared_folder
from ridecells.sinks.bulk import read_index
from ridecells.sinks.tables import index_documents, replace_table, write_csv
from ridecells.sinks.topics import publish_rides, write_topic
from ridecells.sources import files, topics
from ridecells.streaming import jobs
from ridecells.streaming.event_time import pickup_time, with_watermark


class Place:
    """A working folder with topics and checkpoints in it."""

    def __init__(self, spark, name):
        self.spark = spark
        self.folder = shared_folder(spark, name)
        self.topic = {"fmt": "parquet", "options": {"path": f"{self.folder}/topics"}}

    def path(self, name):
        return f"{self.folder}/{name}"

    def publish(self, df, topic, key=None):
        write_topic(df, topic, key=key, **self.topic)

    def values(self, topic, schema):
        return jobs.topic_values(self.spark, topic, schema, **self.topic)


def _records(spark, folder):
    return derived.ride_records(derived.busy_rides(spark, folder))


def _celled_records(spark, folder):
    return cleaning.enrich_or_drop(_records(spark, folder))[0]


def _write_raw_csv(df, path):
    """Raw files keep the blanks in front of their column names."""
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)


def _ride_csv(spark, folder, place):
    path = place.path("rides")
    _write_raw_csv(derived.ride_file(spark, folder), path)
    return path


def _weather_csv(spark, folder, place, strict):
    path = place.path("weather")
    _write_raw_csv(derived.weather_file(spark, folder, strict), path)
    return path


def csv_scan_inferred(spark, folder):
    place = Place(spark, "csv-scan")
    rides = files.read_csv(spark, _ride_csv(spark, folder, place))
    return rides.select(
        F.date_format(" pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
        F.col(" passenger_count").alias("passenger_count"),
        F.col(" trip_distance").alias("trip_distance"), "vendor_id")


def ride_loader(spark, folder):
    place = Place(spark, "ride-loader")
    rides = files.load_rides(spark, _ride_csv(spark, folder, place), RIDE_FILE)
    return rides.select(
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "lat", "lon")


def weather_loader(spark, folder):
    place = Place(spark, "weather-loader")
    weather = files.load_weather(spark, _weather_csv(spark, folder, place, strict=False))
    return weather.select(
        F.date_format("valid", "yyyy-MM-dd HH:mm").alias("valid"),
        F.col("tmpf").cast("string").alias("tmpf"), clean_number("p01i").alias("p01i"))


def ride_rows_by_position(spark, folder):
    place = Place(spark, "ride-rows")
    return files.ride_rows(spark, _ride_csv(spark, folder, place))


def weather_rows_by_position(spark, folder):
    place = Place(spark, "weather-rows")
    return files.weather_rows(spark, _weather_csv(spark, folder, place, strict=True))


def _drain(stream, place, name):
    """Rows of a stream once its input is done."""
    (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", place.path(name))
        .option("checkpointLocation", place.path(f"{name}-checkpoint"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return place.spark.read.schema(stream.schema).parquet(place.path(name))


def topic_stream(spark, folder):
    place = Place(spark, "topic-stream")
    place.publish(_celled_records(spark, folder), "celled", key="pickup_cellid")
    rows = topics.read_topic(spark, "celled", CELLED_RIDE, key_type="int",
                             event_time=pickup_time(), **place.topic)
    return _drain(rows, place, "rows").select(
        "key", "pickup_datetime", "pickup_latitude", "pickup_longitude",
        F.unix_seconds("ts").alias("seconds"))


def topic_key_stream(spark, folder):
    place = Place(spark, "topic-keys")
    place.publish(_celled_records(spark, folder), "celled", key="pickup_cellid")
    keys = topics.read_topic_keys(spark, "celled", key_type="int", **place.topic)
    return _drain(keys, place, "keys")


def weather_stream(spark, folder):
    place = Place(spark, "weather-stream")
    place.publish(derived.weather_records(spark, folder), "weather")
    rows = topics.read_topic(spark, "weather", WEATHER_REPORT, **place.topic)
    return _drain(rows, place, "rows").drop("key")


def whole_topic(spark, folder):
    place = Place(spark, "whole-topic")
    place.publish(_celled_records(spark, folder), "celled", key="pickup_cellid")
    log = topics.read_whole_topic(spark, "celled", CELLED_RIDE, key_type="int", **place.topic)
    return log.select("key", "pickup_datetime")


def topic_end_offsets(spark, folder):
    """A topic that was sent to twice; offsets summed over the partitions."""
    place = Place(spark, "end-offsets")
    place.publish(_records(spark, folder), "rides")
    place.publish(_records(spark, folder), "rides")
    log = topics.read_whole_topic(spark, "rides", **place.topic)
    return topics.end_offsets(log).agg(F.sum("end_offset").alias("end_offset"))


def topic_head(spark, folder):
    place = Place(spark, "topic-head")
    rides = derived.busy_rides(spark, folder).orderBy("event_id")
    place.publish(derived.ride_records(rides), "rides")
    _, head = batch.inspect_topic(spark, "rides", RAW_RIDE, **place.topic)
    return head.drop("key", "partition", "offset")


def ride_file_to_topic(spark, folder):
    place = Place(spark, "ride-file-topic")
    bad = batch.publish_ride_file(spark, _ride_csv(spark, folder, place), "rides", **place.topic)
    return place.values("rides", RAW_RIDE).withColumn("bad", F.lit(bad).cast("bigint"))


def weather_file_to_topic(spark, folder):
    place = Place(spark, "weather-file-topic")
    path = _weather_csv(spark, folder, place, strict=True)
    batch.publish_weather_file(spark, path, "weather", **place.topic)
    return place.values("weather", WEATHER_REPORT)


def rides_to_topic(spark, folder):
    place = Place(spark, "rides-topic")
    publish_rides(_records(spark, folder), "rides", **place.topic)
    return place.values("rides", RAW_RIDE)


def indexed_documents(spark, folder):
    place = Place(spark, "documents")
    celled = _celled_records(spark, folder).withColumn("ts", pickup_time())
    counted = jobs.popular_counts(celled, threshold=2)
    index_documents(jobs.cell_documents(counted), place.path("index"))
    return spark.read.schema(DOCUMENT).json(place.path("index"))


def sorted_ride_file(spark, folder):
    """Sorted part files, with the number of files that start too early.

    A file starts too early if its first time is before the last time of the
    file before it. The window runs over one row per part file.
    """
    place = Place(spark, "sorted-rides")
    batch.sort_rides(spark, _ride_csv(spark, folder, place), place.path("sorted"), schema=RIDE_FILE)
    rides = spark.read.option("header", True).csv(place.path("sorted"))
    spans = rides.select(
        F.col("_metadata.file_name").alias("file"), F.col("pickup_datetime").alias("time"),
    ).groupBy("file").agg(F.min("time").alias("first"), F.max("time").alias("last"),
                          F.count("*").alias("rows"))
    before = F.lag("last").over(Window.orderBy("file"))
    return spans.withColumn("before", before).agg(
        F.sum("rows").alias("rows"),
        F.count_if(F.col("first") < F.col("before")).alias("out_of_order"))


def zip_table_file(spark, folder):
    place = Place(spark, "zip-table")
    rides = derived.dated_rides(derived.busy_rides(spark, folder))
    batch.save_zip_training_table(
        rides, derived.weather_reports(spark, folder), derived.zip_centroids(spark, folder),
        place.path("counts"), RADIUS)
    return files.read_csv(spark, place.path("counts"),
                          "hour int, weekday int, zip string, temperature int,"
                          " precipitation int, count bigint")


def zipped_ride_file(spark, folder):
    place = Place(spark, "zipped-rides")
    rides = files.load_rides(spark, _ride_csv(spark, folder, place), RIDE_FILE)
    write_csv(batch.add_zip(rides, derived.zip_centroids(spark, folder), RADIUS),
              place.path("zipped"))
    stored = files.read_csv(spark, place.path("zipped"),
                            "date timestamp, lat double, lon double, zip string")
    return stored.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def replaced_table(spark, folder):
    place = Place(spark, "replaced")
    for _ in range(2):
        replace_table(_celled_records(spark, folder), place.path("celled"))
    return spark.read.parquet(place.path("celled"))


def training_table_from_files(spark, folder):
    place = Place(spark, "training-files")
    return batch.training_table_from_files(
        spark, _ride_csv(spark, folder, place), _weather_csv(spark, folder, place, strict=False),
        rides_schema=RIDE_FILE)


def event_time(spark, folder):
    """Event time and watermark set on a stream read from the event files."""
    events = spark.readStream.schema(derived.table(spark, folder, "events").schema).parquet(
        f"{folder}/event[s].parquet")
    rides = events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"))
    timed = with_watermark(rides.withColumn("ts", pickup_time()))
    return _drain(timed, Place(spark, "event-time"), "rides").select(
        "event_id", F.unix_seconds("ts").alias("seconds"))


def enrichment_stream(spark, folder):
    place = Place(spark, "enrichment")
    place.publish(_records(spark, folder), "rides")
    jobs.run_enrichment(spark, "rides", "celled", checkpoint=place.path("c"),
                        **place.topic).awaitTermination()
    return place.values("celled", CELLED_RIDE)


def popular_cells_stream(spark, folder):
    place = Place(spark, "popular-stream")
    place.publish(_celled_records(spark, folder), "celled", key="pickup_cellid")
    jobs.run_popular_cells(spark, "celled", "popular", threshold=2, checkpoint=place.path("c"),
                           **place.topic).awaitTermination()
    return place.values("popular", CELL_COUNT)


def popular_cells_resumed(spark, folder):
    """The job run on an earlier part of the rides and again when more came."""
    place = Place(spark, "popular-resumed")
    celled = _celled_records(spark, folder)
    early = F.col("pickup_datetime") < "2024-01-16"
    for part in (early, ~early):
        place.publish(celled.filter(part), "celled", key="pickup_cellid")
        jobs.run_popular_cells(
            spark, "celled", "popular", threshold=2, checkpoint=place.path("c"), **place.topic,
        ).awaitTermination()
    return place.values("popular", CELL_COUNT)


def _partition(cell="pickup_cellid"):
    return F.col(cell) % 2


def popular_cells_by_partition(spark, folder):
    """A topic of two partitions, read a file of each at a time; the second one lags by ten days."""
    place = Place(spark, "popular-partitions")
    celled = _celled_records(spark, folder)
    day = F.col("pickup_datetime")
    thirds = [day < "2024-01-11", (day >= "2024-01-11") & (day < "2024-01-21"), day >= "2024-01-21"]
    odd_minutes = F.substring("pickup_datetime", 16, 1).cast("int") % 2 == 1
    slow = [thirds[0] & odd_minutes, thirds[0] & ~odd_minutes, *thirds[1:]]
    for number, parts in enumerate((thirds, slow)):
        for part in parts:
            own = celled.filter((_partition() == number) & part).coalesce(1)  # one file for each trigger
            place.publish(own, f"celled/partition={number}", key="pickup_cellid")
    options = {**place.topic["options"], "maxFilesPerTrigger": "1"}
    jobs.run_popular_cells(
        spark, "celled", "popular", threshold=2, partitions=[0, 1], checkpoint=place.path("c"),
        fmt="parquet", options=options).awaitTermination()
    return place.values("popular", CELL_COUNT)


def popular_cells_by_panes(spark, folder):
    place = Place(spark, "popular-panes")
    place.publish(_celled_records(spark, folder), "celled", key="pickup_cellid")
    jobs.run_popular_cells(spark, "celled", "popular", threshold=2, by_panes=True,
                           checkpoint=place.path("c"), **place.topic).awaitTermination()
    return place.values("popular", CELL_COUNT)


def popular_and_open_cells(spark, folder):
    """What the job emitted and the windows still open in its state, together those of a batch."""
    place = Place(spark, "popular-open")
    place.publish(_celled_records(spark, folder), "celled", key="pickup_cellid")
    jobs.run_popular_cells(spark, "celled", "popular", threshold=2, checkpoint=place.path("c"),
                           **place.topic).awaitTermination()
    still_open = stamp_windows(popular(jobs.open_windows(spark, place.path("c")), 2))
    closed = place.values("popular", CELL_COUNT)
    return closed.withColumn("closed", F.lit(True)).union(still_open.withColumn("closed", F.lit(False)))


def popular_documents_stream(spark, folder):
    place = Place(spark, "popular-documents")
    place.publish(_records(spark, folder), "rides")
    jobs.run_popular_documents(
        spark, "rides", place.path("index"), threshold=2, checkpoint=place.path("c"),
        **place.topic).awaitTermination()
    return spark.read.schema(DOCUMENT).json(place.path("index"))


def rejected_rides(spark, folder):
    """A topic with broken values, bad times and bad places among the rides: events per reason, from what the job wrote."""
    place = Place(spark, "rejected")
    rides = derived.busy_rides(spark, folder)
    number, value = F.col("event_id"), F.to_json(F.struct("pickup_datetime", "pickup_latitude", "pickup_longitude"))
    time = F.when(number % 37 == 0, F.lit("some day")).otherwise(F.date_format("ts", RIDE_TIME_FORMAT))
    records = rides.withColumns({"pickup_datetime": time, "pickup_latitude": F.col("lat"), "pickup_longitude": F.col("lon")})
    whole = F.when(number % 31 == 0, F.substring(value, 1, 40)).otherwise(value)
    records.select(F.lit(None).cast("string").alias("key"), whole.alias("value")).write.parquet(place.path("topics/rides"))
    jobs.run_rejected(spark, "rides", "rejected", checkpoint=place.path("c"), **place.topic).awaitTermination()
    return place.values("rejected", REJECTED).groupBy("reason").agg(F.count("*").alias("records"), F.count_distinct("partition", "offset").alias("places"))


def indexed_by_id(spark, folder):
    """The stream run a second time from a new checkpoint over the same index: nothing is repeated."""
    place = Place(spark, "indexed-by-id")
    place.publish(_records(spark, folder), "rides")
    for attempt in ("first", "second"):
        jobs.run_popular_documents(
            spark, "rides", place.path("index"), threshold=2, by_id=True, checkpoint=place.path(attempt),
            **place.topic).awaitTermination()
    return read_index(spark, place.path("index"), DOCUMENT)


_RECORD = f"""SELECT {sql.RIDE_TIME} AS pickup_datetime, lat AS pickup_latitude,
    lon AS pickup_longitude FROM {sql.BUSY} r"""
_CELLED = f"""SELECT {sql.RIDE_TIME} AS pickup_datetime, lat AS pickup_latitude,
    lon AS pickup_longitude, cell_id AS pickup_cellid FROM {sql.cells(sql.BUSY)} r"""
_REPORT = f"SELECT datetime, fahrenheit, precip_in FROM {sql.WEATHER_RECORDS} w"
_POPULAR = f"""(SELECT {sql.STAMP} AS datetime, cell_id, "count", window_end
    FROM {sql.windows(sql.cells(sql.BUSY))} w WHERE "count" >= 2)"""
_CLOSED = f"""SELECT datetime, cell_id, "count" FROM {_POPULAR} p
    WHERE window_end <= {sql.LAST_CELLED_TIME}"""
_LAT, _LON = sql.center("cell_id")
_DOCUMENT = f"""datetime AS time,
    CAST({_LAT} AS VARCHAR) || ',' || CAST({_LON} AS VARCHAR) AS location, "count" AS cnt
    FROM {_POPULAR} p"""
_DOCUMENTS = f"SELECT {_DOCUMENT}"

QUERIES = [
    ("csv_scan_inferred", csv_scan_inferred,
     f"""SELECT {sql.RIDE_TIME} AS pickup_datetime,
         CAST(1 + user_id % 6 AS INTEGER) AS passenger_count, value AS trip_distance,
         event_type AS vendor_id FROM events"""),
    ("ride_loader", ride_loader,
     f"SELECT {sql.RIDE_TIME} AS date, lat, lon FROM {sql.BUSY} r"),
    ("weather_loader", weather_loader,
     f"""SELECT strftime(valid, '%Y-%m-%d %H:%M') AS valid,
         coalesce(CAST(tmpf AS VARCHAR), 'M') AS tmpf, p01i FROM {sql.WEATHER} w"""),
    ("ride_rows_by_position", ride_rows_by_position, _RECORD),
    ("weather_rows_by_position", weather_rows_by_position, _REPORT),
    ("topic_stream", topic_stream,
     f"""SELECT cell_id AS key, {sql.RIDE_TIME} AS pickup_datetime, lat AS pickup_latitude,
         lon AS pickup_longitude, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds
         FROM {sql.cells(sql.BUSY)} r"""),
    ("topic_key_stream", topic_key_stream, f"SELECT cell_id AS key FROM {sql.cells(sql.BUSY)} r"),
    ("weather_stream", weather_stream, _REPORT),
    ("whole_topic", whole_topic,
     f"""SELECT cell_id AS key, {sql.RIDE_TIME} AS pickup_datetime
         FROM {sql.cells(sql.BUSY)} r"""),
    ("topic_end_offsets", topic_end_offsets, "SELECT 2 * count(*) AS end_offset FROM events"),
    ("topic_head", topic_head,
     f"""SELECT {sql.RIDE_TIME} AS pickup_datetime, lat AS pickup_latitude,
         lon AS pickup_longitude FROM {sql.BUSY} r ORDER BY event_id LIMIT 20"""),
    ("ride_file_to_topic", ride_file_to_topic,
     f"""SELECT g.*, (SELECT count(*) FROM {sql.BUSY} r WHERE {sql.BAD}) AS bad
         FROM ({_RECORD} WHERE NOT {sql.BAD}) g"""),
    ("weather_file_to_topic", weather_file_to_topic, _REPORT),
    ("rides_to_topic", rides_to_topic, f"{_RECORD} WHERE NOT {sql.BAD}"),
    ("indexed_documents", indexed_documents, _DOCUMENTS),
    ("sorted_ride_file", sorted_ride_file,
     "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM events"),
    ("zip_table_file", zip_table_file, f"SELECT * FROM {sql.zip_counts(RADIUS)} t"),
    ("zipped_ride_file", zipped_ride_file,
     f"""SELECT {sql.RIDE_TIME} AS date, lat, lon, zip FROM {sql.zipped(sql.BUSY, RADIUS)} r
         WHERE zip <> 'missing'"""),
    ("replaced_table", replaced_table, _CELLED),
    ("training_table_from_files", training_table_from_files, f"SELECT * FROM {sql.TRAINING} t"),
    ("event_time", event_time,
     """SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds
        FROM events"""),
    ("enrichment_stream", enrichment_stream, _CELLED),
    ("popular_cells_stream", popular_cells_stream, _CLOSED),
    ("popular_cells_resumed", popular_cells_resumed, _CLOSED),
    ("popular_cells_by_partition", popular_cells_by_partition,
     f"""SELECT datetime, cell_id, "count" FROM {_POPULAR} p WHERE window_end <= (SELECT min(last) FROM (
         SELECT max(date_trunc('second', ts)) AS last FROM {sql.cells(sql.BUSY)} r GROUP BY cell_id % 2) x)"""),
    ("popular_cells_by_panes", popular_cells_by_panes, _CLOSED),
    ("popular_and_open_cells", popular_and_open_cells,
     f"""SELECT datetime, cell_id, "count", window_end <= {sql.LAST_CELLED_TIME} AS closed FROM {_POPULAR} p"""),
    ("popular_documents_stream", popular_documents_stream,
     f"{_DOCUMENTS} WHERE window_end <= {sql.LAST_RIDE_TIME}"),
    ("rejected_rides", rejected_rides,
     f"""SELECT CASE WHEN event_id % 31 = 0 THEN 'broken value' WHEN event_id % 37 = 0 THEN 'no time' ELSE 'bad place' END AS reason,
         count(*) AS records, count(*) AS places FROM {sql.BUSY} r
         WHERE event_id % 31 = 0 OR event_id % 37 = 0 OR NOT {sql.INSIDE} GROUP BY reason"""),
    ("indexed_by_id", indexed_by_id,
     f"SELECT cell_id || '@' || datetime AS id, {_DOCUMENT} WHERE window_end <= {sql.LAST_RIDE_TIME}"),
]
