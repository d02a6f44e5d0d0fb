"""Documents with ids for an index, as files that are safe to write again.

A Python data source. Each task writes one file of lines ``{"_id": ..., "_source":
...}`` and reports its name; the commit of a batch writes a manifest of those
names under the batch's number. Only files in a manifest count, so what failed
or repeated tasks leave behind is never read, and a batch that is committed
again replaces its former self. A document of a later batch replaces that of
the same id before it.
"""

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from ridecells.schemas import UNTIL_DONE

_LINES, _DONE = "lines", "manifests"


@dataclass
class _Written(WriterCommitMessage):
    file: str
    documents: int


class _Folder:
    """The folder of an index; files and manifests in it."""

    def __init__(self, path):
        self.path = path

    def _open(self):
        return fs.FileSystem.from_uri(self.path)

    def write(self, batches):
        store, top = self._open()
        store.create_dir(f"{top}/{_LINES}")
        name, documents = f"{uuid.uuid4().hex}.json", 0
        with store.open_output_stream(f"{top}/{_LINES}/{name}") as out:
            for batch in batches:
                for key, document in zip(batch.column("id").to_pylist(), batch.column("document").to_pylist()):
                    out.write(f'{{"_id":{json.dumps(key)},"_source":{document or "null"}}}\n'.encode())
                documents += batch.num_rows
        return _Written(name, documents)

    def commit(self, messages, number):
        """Name the batch's files in its manifest, which appears as a whole; files of its former self go."""
        store, top = self._open()
        store.create_dir(f"{top}/{_DONE}")
        place = f"{top}/{_DONE}/{number:020d}.json"
        former = []
        if store.get_file_info(place).type == fs.FileType.File:
            with store.open_input_stream(place) as old:
                former = json.loads(old.read())["files"]
        files = [m.file for m in messages if m is not None and m.documents]
        draft = f"{top}/{_LINES}/{uuid.uuid4().hex}.draft"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps({"batch": number, "files": files}).encode())
        store.move(draft, place)
        self.drop(former)

    def drop(self, files):
        store, top = self._open()
        for name in files:
            if store.get_file_info(f"{top}/{_LINES}/{name}").type == fs.FileType.File:
                store.delete_file(f"{top}/{_LINES}/{name}")


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.folder, self.number = _Folder(options["path"]), int(options.get("batch", 0))

    def write(self, iterator):
        return self.folder.write(iterator)

    def commit(self, messages):
        self.folder.commit(messages, self.number)

    def abort(self, messages):
        self.folder.drop([m.file for m in messages if m is not None])


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options):
        self.folder = _Folder(options["path"])

    def write(self, iterator):
        return self.folder.write(iterator)

    def commit(self, messages, batchId):
        self.folder.commit(messages, batchId)

    def abort(self, messages, batchId):
        self.folder.drop([m.file for m in messages if m is not None])


class BulkIndex(DataSource):
    """Format "bulk_index"; options ``path`` and, for a batch, ``batch``: its number."""

    @classmethod
    def name(cls):
        return "bulk_index"

    def writer(self, schema, overwrite):
        return _BatchWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options)


def index_by_id(documents, path, *, batch=0, checkpoint=None, trigger=UNTIL_DONE):
    """Send ``id`` and ``document`` (JSON text) to the index below ``path``.

    A batch has a number, and writing it again replaces it. A stream numbers its
    batches itself, needs a checkpoint folder and gives back the started query.
    """
    spark = documents.sparkSession
    spark.dataSource.register(BulkIndex)
    rows = documents.select(F.col("id").cast("string").alias("id"), F.col("document").cast("string").alias("document"))
    if not documents.isStreaming:
        rows.write.format("bulk_index").mode("append").option("path", path).option("batch", batch).save()
        return None
    return rows.writeStream.format("bulk_index").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(**trigger).start()


def read_index(spark, path, schema):
    """``id`` and the document's fields, one row per id: that of the latest batch."""
    top = path.rstrip("/")
    done = spark.read.schema("batch bigint, files array<string>").json(f"{top}/{_DONE}")
    files = done.select("batch", F.explode("files").alias("file"))
    source = F.col("_source")
    lines = spark.read.schema(f"_id string, _source {schema.simpleString()}").json(f"{top}/{_LINES}")
    known = lines.select("_id", source, F.col("_metadata.file_name").alias("file")).join(files, "file")
    latest = known.groupBy(F.col("_id").alias("id")).agg(F.max_by("_source", "batch").alias("document"))
    return latest.select("id", "document.*")
