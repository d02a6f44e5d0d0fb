"""Streaming jobs. Each gives a started query.

By default a query stops when the input present at its start is done; another
``trigger`` lets it run on. ``encoding`` (with ``key_encoding`` for keys) names
how records are stored in topics, "json" or "avro".
``checkpoint`` is a folder all executors see; a restarted job goes on from it.
A new run over an emptied sink takes a new one.
"""

from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ridecells.functions.grid import in_box
from ridecells.functions.text import cell_document
from ridecells.functions.times import minute_of_hour, parse_weather_time
from ridecells.models.forest import predicted_counts, weather_features
from ridecells.models.lattice import CONDITIONS, Lattice
from ridecells.operators.cleaning import enrich_or_drop
from ridecells.operators.counts import count_by_window, popular, stamp_windows
from ridecells.operators.joins import BROADCAST_ROWS, known_cells, with_all_cells
from ridecells.schemas import (
    CELLED_RIDE, POPULAR_COUNT, RAIN_MINUTE, RAW_RIDE, SLIDE_MINUTES, UNTIL_DONE,
    WEATHER_REPORT, WINDOW_MINUTES,
)
from ridecells.session import stored
from ridecells.sinks.bulk import index_by_id
from ridecells.sinks.tables import index_documents
from ridecells.sinks.topics import write_topic
from ridecells.sources.topics import checked_topic, read_topic
from ridecells.streaming.event_time import pickup_time


def celled_rides(rides, event_time=None):
    """Raw ride records with their cell, those without one dropped."""
    return enrich_or_drop(rides, event_time=event_time)[0]


def popular_counts(celled, size=WINDOW_MINUTES, every=SLIDE_MINUTES, threshold=POPULAR_COUNT, by_panes=False):
    """Records ``datetime, cell_id, count`` of popular cells, batch or stream.

    A stream emits a window once, when the watermark has passed its end.
    """
    counts = count_by_window(celled, size, every, cell="pickup_cellid", by_panes=by_panes)
    return stamp_windows(popular(counts, threshold))


def run_enrichment(spark, source, sink, *, fmt="kafka", options=None, encoding="json",
                   key_encoding="text", checkpoint, trigger=UNTIL_DONE):
    """Raw rides topic to celled rides topic, keyed by cell."""
    rides = read_topic(spark, source, RAW_RIDE, fmt=fmt, options=options,
                       encoding=encoding).drop("key")
    return write_topic(celled_rides(rides), sink, key="pickup_cellid", fmt=fmt, options=options,
                       encoding=encoding, key_encoding=key_encoding, checkpoint=checkpoint,
                       trigger=trigger)


def checked_rides(spark, source, *, fmt="kafka", options=None, streaming=True):
    """Raw rides of a topic, each with the ``reason`` for which no job can use it, or null."""
    return checked_topic(spark, source, RAW_RIDE, event_time=pickup_time(), usable=in_box("pickup_latitude", "pickup_longitude"),
                         fmt=fmt, options=options, streaming=streaming)


def run_rejected(spark, source, sink, *, fmt="kafka", options=None, checkpoint, trigger=UNTIL_DONE):
    """Raw rides that no job can use to a topic of their own, keyed by reason: the side output of the enrichment.

    A query beside the others, with its own checkpoint: neither holds the other
    up, and each writes its records once.
    """
    bad = checked_rides(spark, source, fmt=fmt, options=options).filter(F.col("reason").isNotNull())
    return write_topic(bad.select("reason", "value", "partition", "offset"), sink, key="reason", fmt=fmt, options=options,
                       checkpoint=checkpoint, trigger=trigger)


def run_popular_cells(spark, source, sink, *, size=WINDOW_MINUTES, every=SLIDE_MINUTES,
                      threshold=POPULAR_COUNT, delay="0 seconds", partitions=None, by_panes=False,
                      fmt="kafka", options=None, encoding="json", key_encoding="text", checkpoint,
                      trigger=UNTIL_DONE):
    """Celled rides topic to popular cells topic, keyed by cell.

    With the ``partitions`` of the source the slowest of them closes windows;
    see :func:`ridecells.sources.topics.read_topic`, and for ``by_panes``
    :func:`ridecells.operators.counts.count_by_window`.
    """
    celled = read_topic(spark, source, CELLED_RIDE, fmt=fmt, options=options, key_type="int",
                        key_encoding=key_encoding, encoding=encoding,
                        event_time=pickup_time(), delay=delay, partitions=partitions)
    counts = popular_counts(celled, size, every, threshold, by_panes)
    return write_topic(counts, sink, key="cell_id", fmt=fmt, options=options,
                       encoding=encoding, key_encoding=key_encoding, checkpoint=checkpoint,
                       trigger=trigger)


def open_windows(spark, checkpoint, batch=None):
    """Counts of windows that a popular-cells job hasn't closed: ``cell_id, window_start, window_end, count``.

    They are read from the state that the job stored in its checkpoint, as of
    its last batch or of the one given. A job with ``by_panes`` keeps open panes
    too; their rides are not in these counts yet.
    """
    reader = spark.read.format("statestore").option("path", checkpoint)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load()
    window, cell = [F.col("key").getField(f.name) for f in state.schema["key"].dataType.fields][:2]
    count = F.col("value").getField(state.schema["value"].dataType.fields[0].name)
    return state.select(
        cell.alias("cell_id"), window["start"].alias("window_start"), window["end"].alias("window_end"), count.alias("count"))


def cell_documents(counts):
    return counts.select(cell_document("datetime", "cell_id", "count").alias("document"))


def documents_by_id(counts):
    """``id``, made from cell and window, and the cell's ``document``."""
    key = F.concat_ws("@", F.col("cell_id").cast("string"), "datetime")
    return counts.select(key.alias("id"), cell_document("datetime", "cell_id", "count").alias("document"))


def run_popular_documents(spark, source, index_path, *, size=WINDOW_MINUTES, every=SLIDE_MINUTES,
                          threshold=POPULAR_COUNT, delay="0 seconds", partitions=None, by_panes=False,
                          fmt="kafka", options=None, encoding="json", index_format="text", index_options=None, by_id=False,
                          checkpoint, trigger=UNTIL_DONE):
    """Raw rides topic to index documents of popular cells, in one query.

    ``partitions`` and ``by_panes`` are those of :func:`run_popular_cells`.
    With ``by_id`` the documents go to a bulk index (:mod:`ridecells.sinks.bulk`),
    where a repeated batch or window replaces what it wrote before.
    """
    rides = read_topic(spark, source, RAW_RIDE, fmt=fmt, options=options, encoding=encoding,
                       event_time=pickup_time(), delay=delay, partitions=partitions)
    counts = popular_counts(celled_rides(rides, event_time="ts"), size, every, threshold, by_panes)
    if by_id:
        return index_by_id(documents_by_id(counts), index_path, checkpoint=checkpoint, trigger=trigger)
    return index_documents(cell_documents(counts), index_path, fmt=index_format,
                           options=index_options, checkpoint=checkpoint, trigger=trigger)


def _worth_sharing(reports, most=BROADCAST_ROWS):
    combinations = reports.groupBy(*CONDITIONS).agg(F.count("*").alias("n"))
    facts = combinations.agg(F.count("*").alias("kinds"), F.sum("n").alias("rows")).first()
    return 0 < facts["kinds"] * 4 <= (facts["rows"] or 0) <= most


INCOMPLETE = "reports without a time or reading"


def complete_reports(weather, only_rain_minute=False):
    """Reports with all their conditions, and the observation of those dropped.

    A report without a readable time, or with a null reading, has no
    prediction, whatever the scorer. A stream reports the number ``dropped``
    in its progress, a batch in the observation, after an action.
    """
    timed = weather.withColumn("ts", parse_weather_time("datetime"))
    if only_rain_minute:
        timed = timed.filter(minute_of_hour("ts") == RAIN_MINUTE)
    reports = weather_features(timed).select("datetime", *CONDITIONS)
    lost = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in CONDITIONS])
    observed = INCOMPLETE if weather.isStreaming else Observation(INCOMPLETE)
    kept = reports.observe(observed, F.count_if(lost).alias("dropped")).filter(~lost)
    return kept, (None if weather.isStreaming else observed)


def predicted_demand(weather, scorer, cells=None, only_rain_minute=False, cuts=None):
    """Predicted count of every cell for every weather report, batch or stream.

    ``weather`` has ``datetime, fahrenheit, precip_in``; ``scorer`` adds the
    column ``prediction``. ``cells`` restricts the cells, and
    ``only_rain_minute`` the reports to those the training used.

    ``cuts`` are the numbers that a model of trees compares its features with
    (``ensemble_cuts``, ``forest_cuts``). With them the model is scored once for
    each class of conditions and cells, before any report is read, and reports,
    those of a stream too, only look their counts up.

    Without cuts: the features of a report take few values (weekdays, hours,
    buckets). If a count shows that a batch of reports has few combinations of them, and is
    small enough to broadcast, each combination is scored once and handed to
    its reports. Otherwise, and on a stream, each report is scored. Incomplete
    reports are left out (:func:`complete_reports`).
    """
    reports, _ = complete_reports(weather, only_rain_minute)
    if cells is not None:
        cells = known_cells(cells)
    if cuts is not None:
        lattice = Lattice(cuts)
        return lattice.predict(reports, lattice.counts(weather.sparkSession, scorer), cells)
    if not weather.isStreaming:
        reports = stored(reports, "reports")
    if weather.isStreaming or not _worth_sharing(reports):
        return predicted_counts(scorer(with_all_cells(reports, cells)))
    scored = scorer(with_all_cells(reports.select(*CONDITIONS).distinct(), cells)).alias("s")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in CONDITIONS]
    matched = scored.join(F.broadcast(reports.alias("r")), same).select("s.*", "r.datetime")
    return predicted_counts(matched)


def run_prediction(spark, source, sink, scorer, *, cells=None, only_rain_minute=False, cuts=None,
                   fmt="kafka", options=None, encoding="json", key_encoding="text", checkpoint,
                   trigger=UNTIL_DONE):
    """Weather topic to predicted counts topic, keyed by cell."""
    weather = read_topic(spark, source, WEATHER_REPORT, fmt=fmt, options=options,
                         encoding=encoding)
    predictions = predicted_demand(weather, scorer, cells, only_rain_minute, cuts)
    return write_topic(predictions, sink, key="cell_id", fmt=fmt, options=options,
                       encoding=encoding, key_encoding=key_encoding, checkpoint=checkpoint,
                       trigger=trigger)


def topic_values(spark, topic, schema, *, fmt="kafka", options=None):
    """Everything in a topic now, as records: to look at what a job wrote."""
    return read_topic(spark, topic, schema, fmt=fmt, options=options, streaming=False).select(
        *[F.col(f.name) for f in schema.fields])
