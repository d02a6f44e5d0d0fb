"""Session settings and the shared working folder."""

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name="ridecells", master=None, **conf):
    """A session with the settings the jobs assume.

    UTC makes event times and hour keys independent of the machine; adaptive
    execution picks join sides from real sizes, merges small shuffle
    partitions and splits hot ones. The state store is left as it is: window
    counts hold one row per cell and open window, which a grid bounds.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_folder():
    """One temporary folder of this process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="ridecells-")


def shared_folder(spark, name):
    """A new folder below ``spark.checkpoint.dir``, seen by all executors.

    Only a local session may do without the setting; it gets a temporary
    folder that goes when the process ends. A cluster session without it is
    refused, since a folder on one machine would be lost with that machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_folder().name
    return f"{base.rstrip('/')}/ridecells/{name}-{uuid.uuid4().hex}"


def stored(frame, name):
    """The frame, written once to a shared folder and read back."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
