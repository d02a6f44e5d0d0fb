"""The index sink that is safe to write again."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ridecells.session import shared_folder
from ridecells.sinks.bulk import _Folder, index_by_id, read_index

COUNT = StructType([StructField("n", IntegerType())])


def documents(spark, *rows):
    frame = spark.createDataFrame(rows, "id string, n int")
    return frame.select("id", F.to_json(F.struct("n")).alias("document")).repartition(3)


@pytest.fixture
def index(spark):
    return shared_folder(spark, "index")


def test_a_batch_written_twice_leaves_each_document_once(spark, rows, index, tmp_path):
    for _ in range(2):
        index_by_id(documents(spark, ("a", 1), ("b", 2), ('q"\\é', 3)), index, batch=7)
    assert rows(read_index(spark, index, COUNT)) == [("a", 1), ("b", 2), ('q"\\é', 3)]
    lines = spark.read.text(f"{index}/lines")
    assert lines.count() == 3  # those of the former attempt are gone


def test_later_batches_replace_documents(spark, rows, index):
    index_by_id(documents(spark, ("a", 1), ("b", 2)), index, batch=1)
    index_by_id(documents(spark, ("b", 5), ("c", 3)), index, batch=2)
    index_by_id(documents(spark, ("a", 9)), index, batch=0)
    assert rows(read_index(spark, index, COUNT)) == [("a", 1), ("b", 5), ("c", 3)]


def test_files_of_no_manifest_do_not_count(spark, rows, index):
    index_by_id(documents(spark, ("a", 1)), index)
    batch = documents(spark, ("stray", 2)).toArrow().to_batches()
    left = _Folder(index).write(batch)
    assert rows(read_index(spark, index, COUNT)) == [("a", 1)]
    _Folder(index).drop([left.file])
    assert spark.read.text(f"{index}/lines").count() == 1


def test_an_empty_batch(spark, rows, index):
    index_by_id(documents(spark, ("a", 1)), index, batch=1)
    index_by_id(documents(spark, ("a", 1)).filter("false"), index, batch=2)
    assert rows(read_index(spark, index, COUNT)) == [("a", 1)]
    manifest = json.loads(spark.read.text(f"{index}/manifests/{2:020d}.json").first()[0])
    assert manifest == {"batch": 2, "files": []}
