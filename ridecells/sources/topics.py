"""Keyed record logs: Kafka, or a folder of Parquet files with key and value.

The format is a parameter, so a job can be tried on files and then pointed at
a broker. For files, Spark's own metadata gives what a broker gives: the file
is the partition and the row index in it is the offset. A topic in files may
also have numbered partitions, one folder each.
"""

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridecells.functions.numbers import int_from_bytes
from ridecells.schemas import avro_schema

UNDATED = "records without a time"
_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"

KEY_VALUE = StructType([
    StructField("key", StringType(), True),
    StructField("value", StringType(), True),
])


def _open(spark, topic, fmt, options, streaming, partition=None):
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    options = dict(options or {})
    if fmt != "kafka":
        folder = options.pop("path").rstrip("/")
        part = "" if partition is None else f"/partition={partition}"
        return reader.schema(KEY_VALUE).options(**options).load(f"{folder}/{topic}{part}")
    options.setdefault("startingOffsets", "earliest")
    if not streaming:
        options.setdefault("endingOffsets", "latest")
    reader = reader.options(**options)
    if partition is None:
        return reader.option("subscribe", topic).load()
    return reader.option("assign", json.dumps({topic: [partition]})).load()


def _key(key_type, key_encoding):
    if key_encoding == "int32":
        return int_from_bytes(F.col("key").cast("binary"))
    return F.col("key").cast("string").cast(key_type)


def _value(schema, encoding):
    if encoding == "json":
        return F.from_json(F.col("value").cast("string"), schema)
    from pyspark.sql.avro.functions import from_avro

    return from_avro(F.col("value"), avro_schema(schema))


def read_topic(spark, topic, value_schema, *, fmt="kafka", options=None, key_type="string",
               key_encoding="text", encoding="json", streaming=True, event_time=None,
               delay="0 seconds", partitions=None):
    """Records of a topic as ``key`` and the fields of the value.

    ``options`` are connector options (``kafka.bootstrap.servers``, or
    ``path`` for files). Values are "json" or "avro", keys "text" or "int32"
    (four bytes). ``event_time`` is a timestamp column over the fields; it is
    added as ``ts`` and, on a stream, carries the watermark. Records without
    such a time are dropped; a stream reports their number in its progress, as
    ``dropped`` of "records without a time".

    ``partitions`` are numbers of the topic's partitions. Each is then a source
    of its own, and a stream has a watermark for each and goes by the slowest:
    records of a partition that lags are not late because another is ahead, and
    a partition without a record holds all windows open.
    """
    def decoded(partition):
        log = _open(spark, topic, fmt, options, streaming, partition)
        records = log.select(
            _key(key_type, key_encoding).alias("key"), _value(value_schema, encoding).alias("_value"),
        ).select("key", "_value.*")
        return records if event_time is None else records.withColumn("ts", event_time)

    def timed(records, name=UNDATED):
        if not streaming:
            return records.filter(F.col("ts").isNotNull())
        records = records.observe(name, F.count_if(F.col("ts").isNull()).alias("dropped"))
        return records.filter(F.col("ts").isNotNull()).withWatermark("ts", delay)

    if partitions is None:
        return decoded(None) if event_time is None else timed(decoded(None))
    if event_time is None:
        return reduce(DataFrame.union, map(decoded, partitions))
    if spark.conf.get(_POLICY, "min") != "min":
        raise ValueError(f"partitions need {_POLICY} to be min")
    return reduce(DataFrame.union, [timed(decoded(p), f"{UNDATED} in partition {p}") for p in partitions])


def read_topic_keys(spark, topic, *, fmt="kafka", options=None, key_type="string",
                    key_encoding="text", streaming=True):
    """Keys of a topic; the values are never read."""
    log = _open(spark, topic, fmt, options, streaming)
    return log.select(_key(key_type, key_encoding).alias("key"))


def read_whole_topic(spark, topic, value_schema=None, *, fmt="kafka", options=None,
                     key_type="string", key_encoding="text", encoding="json"):
    """Everything in a topic now, with ``partition`` and ``offset``.

    Values are text unless their schema is given.
    """
    log = _open(spark, topic, fmt, options, streaming=False)
    if fmt == "kafka":
        place = [F.col("partition"), "offset"]
    else:
        place = [
            F.col("_metadata.file_name").alias("partition"),
            F.col("_metadata.row_index").alias("offset"),
        ]
    key = _key(key_type, key_encoding).alias("key")
    if value_schema is None:
        return log.select(key, F.col("value").cast("string").alias("value"), *place)
    decoded = log.select(key, _value(value_schema, encoding).alias("_value"), *place)
    return decoded.select("key", "_value.*", "partition", "offset")


def end_offsets(log):
    """Next offset of every partition that holds records."""
    return log.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def first_records(log, n=20):
    return log.orderBy("partition", "offset").limit(n)


BROKEN, NO_TIME, BAD_PLACE = "broken value", "no time", "bad place"


def checked_topic(spark, topic, value_schema, *, event_time, usable, fmt="kafka", options=None, encoding="json", streaming=True):
    """Records of a topic with what a reader would drop: the raw ``value``, its place and the ``reason``.

    ``partition`` and ``offset`` are the place in the topic (file and row for
    files), ``ts`` is the event time over the fields, ``usable`` a condition
    over the fields. The first that fails is the reason; a record without one is
    good. A null value is broken. Values are JSON here.
    """
    if encoding != "json":
        raise ValueError("only JSON values are checked one by one")
    log = _open(spark, topic, fmt, options, streaming)
    place = [F.col("partition").cast("string"), "offset"] if fmt == "kafka" else [
        F.col("_metadata.file_name").alias("partition"), F.col("_metadata.row_index").alias("offset")]
    text = F.col("value").cast("string")
    layout = StructType([*value_schema.fields, StructField("_broken", StringType())])
    parsed = F.from_json(text, layout, {"columnNameOfCorruptRecord": "_broken"})
    records = log.select(text.alias("value"), *place, parsed.alias("_parsed")).select("value", "partition", "offset", "_parsed.*")
    records = records.withColumn("ts", event_time)
    broken = F.col("value").isNull() | (F.trim("value") == "") | F.col("_broken").isNotNull()
    reason = F.when(broken, BROKEN).when(F.col("ts").isNull(), NO_TIME).when(~F.coalesce(usable, F.lit(False)), BAD_PLACE)
    return records.withColumn("reason", reason).drop("_broken")
