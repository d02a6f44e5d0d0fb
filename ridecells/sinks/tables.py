"""File sinks."""

from pyspark.sql import functions as F

from ridecells.operators.ordering import stable_order
from ridecells.schemas import RIDE_TIME_FORMAT, UNTIL_DONE


def write_sorted_csv(rides, path, by):
    """Rows in total order as CSV part files, replacing what was there.

    The part files follow each other in name order, so reading them in that
    order gives the whole sorted table. They are not merged: one file would
    pull the table through one task.
    """
    (
        stable_order(rides, by)
        .write.mode("overwrite").option("header", True)
        .option("timestampFormat", RIDE_TIME_FORMAT).csv(path)
    )


def write_csv(df, path):
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_table(df, path):
    """Empty the sink and write it anew."""
    df.write.mode("overwrite").parquet(path)


def index_documents(documents, path, *, fmt="text", options=None, checkpoint=None,
                    trigger=UNTIL_DONE):
    """Send JSON documents to an index or, by default, to a folder of JSON lines.

    ``documents`` has one text column. A stream needs a checkpoint folder and
    gives back the started query.
    """
    lines = documents.select(F.col(documents.columns[0]).alias("value"))
    options = {"path": path, **(options or {})}
    if not documents.isStreaming:
        lines.write.format(fmt).mode("overwrite").options(**options).save()
        return None
    return (
        lines.writeStream.format(fmt).outputMode("append")
        .options(**options).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )
