"""Topic sinks, the counterpart of :mod:`ridecells.sources.topics`."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ridecells.functions.grid import bad_coordinate
from ridecells.functions.numbers import bytes_from_int
from ridecells.schemas import UNTIL_DONE, avro_schema


def keyed_records(df, key=None, encoding="json", key_encoding="text"):
    """Two columns, key and value; the value holds all columns of ``df``."""
    value = F.struct(*[F.col(c) for c in df.columns])
    if encoding == "json":
        value = F.to_json(value)
    else:
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(value, avro_schema(df.schema))
    if key is None:
        name = F.lit(None).cast("string")
    elif key_encoding == "int32":
        name = bytes_from_int(F.col(key))
    else:
        name = F.col(key).cast("string")
    return df.select(name.alias("key"), value.alias("value"))


def _target(writer, topic, fmt, options):
    options = dict(options or {})
    if fmt == "kafka":
        return writer.format(fmt).options(**options).option("topic", topic)
    folder = options.pop("path").rstrip("/")
    return writer.format(fmt).options(**options).option("path", f"{folder}/{topic}")


def write_topic(df, topic, *, key=None, fmt="kafka", options=None, encoding="json",
                key_encoding="text", checkpoint=None, trigger=UNTIL_DONE, partitions=None):
    """Append the rows to a topic.

    ``partitions`` deals records in files out to so many numbered partitions by
    their key, as a broker does by itself; records without a key go to the first.

    A stream needs a checkpoint folder and gives back the started query. By
    default it stops when the input present at the start is done.
    """
    records = keyed_records(df, key, encoding, key_encoding)
    dealt = partitions is not None and fmt != "kafka"
    if dealt:
        place = F.pmod(F.xxhash64("key"), F.lit(partitions))
        records = records.withColumn("partition", F.when(F.col("key").isNull(), 0).otherwise(place).cast("int"))

    def onto(writer):
        return _target(writer.partitionBy("partition") if dealt else writer, topic, fmt, options)

    if not df.isStreaming:
        onto(records.write.mode("append")).save()
        return None
    return (
        onto(records.writeStream.outputMode("append"))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def publish_rides(rides, topic, *, fmt="kafka", options=None, encoding="json"):
    """Append the rides with good coordinates; gives the number of bad ones."""
    seen = Observation("rides with bad coordinates")
    bad = bad_coordinate("pickup_latitude", "pickup_longitude")
    good = rides.observe(seen, F.count_if(bad).alias("bad")).filter(~bad)
    write_topic(good, topic, fmt=fmt, options=options, encoding=encoding)
    return seen.get["bad"]
