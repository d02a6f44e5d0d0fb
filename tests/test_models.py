import json

import pytest
from pyspark.sql import functions as F

from ridecells.catalog.ensembles import DEMAND_DOCUMENT, ZIP_ENSEMBLE
from ridecells.models import ensemble, forest, lattice
from ridecells.schemas import CELL_COUNT, CELLED_RIDE, WEATHER_REPORT
from ridecells.session import shared_folder
from ridecells.sinks.topics import write_topic
from ridecells.streaming import jobs

# Scores of the two-tree ensemble.
SCORES = [
    (10014, 3, 10, (2.485294117647059 + 2.103235294117647) / 2),
    (10014, 3, 23, (4.0 + 2.103235294117647) / 2),
    (10014, 4, 5, (3.253968253968254 + 1.55678391959799) / 2),
    (10119, 1, 1, (4.071895424836601 + 3.9565217391304346) / 2),
]


def test_known_scores(spark):
    frame = spark.createDataFrame(SCORES, "zip int, weekday int, hour int, expected double")
    for row in ensemble.score_ensemble(ZIP_ENSEMBLE, frame).collect():
        assert row.prediction == row.expected


def test_null_inputs_and_unknown_categories_give_null(spark):
    frame = spark.createDataFrame(
        [(None, 3, 10), (10014, None, 10), (10119, None, None), (99999, 1, 1)],
        "zip int, weekday int, hour int")
    free = ZIP_ENSEMBLE._replace(categories={})
    plain = [r.prediction for r in ensemble.score_ensemble(free, frame).collect()]
    assert ensemble.score_ensemble(ZIP_ENSEMBLE, frame).collect()[3].prediction is None
    assert plain[:2] == [None, None] and plain[2] is not None and plain[3] is not None
    declared = ZIP_ENSEMBLE._replace(categories={"zip": (10014, 10119)})
    strict = [r.prediction for r in ensemble.score_ensemble(declared, frame).collect()]
    assert strict[3] is None and strict[2] == plain[2]


def test_document(spark, tmp_path):
    path = tmp_path / "model.pmml"
    path.write_text(DEMAND_DOCUMENT)
    model = ensemble.read_ensemble(spark, str(path))
    assert len(model.trees) == 3 and model.categories == {}
    frame = spark.createDataFrame(
        [(10, 3, 2, 0, 100, 100), (3, 7, 0, 2, 200, 300)],
        ", ".join(f"{f} int" for f in forest.FEATURES))
    assert [r.prediction for r in ensemble.score_ensemble(model, frame).collect()] == [
        (4.5 + 3.0 + 2.0) / 3, (0.5 + 1.75 + 1.0) / 3]


def test_document_with_categories(spark, tmp_path):
    path = tmp_path / "model.pmml"
    path.write_text("""<PMML><DataDictionary>
      <DataField name="zip" optype="categorical" dataType="integer">
        <Value value="10014"/><Value value="10016"/></DataField>
      <DataField name="kind" optype="categorical" dataType="string"><Value value="a"/></DataField>
      </DataDictionary><TreeModel><Node><True/>
        <Node score="1.5"><SimplePredicate field="zip" operator="notEqual" value="10014"/></Node>
        <Node score="2.5"><SimplePredicate field="zip" operator="equal" value="10014"/></Node>
      </Node></TreeModel></PMML>""")
    model = ensemble.read_ensemble(spark, str(path))
    assert model.categories == {"zip": (10014, 10016)}
    frame = spark.createDataFrame([(10014,), (10016,), (7,)], "zip int")
    assert [r.prediction for r in ensemble.score_ensemble(model, frame).collect()] == [
        2.5, 1.5, None]


@pytest.mark.parametrize("old, new", [
    ('multipleModelMethod="average"', 'multipleModelMethod="sum"'),
    ('<Segment id="1"><True/>', '<Segment id="1">'),
    ('<SimplePredicate field="hour" operator="lessOrEqual" value="6.5"/>', "<CompoundPredicate/>")])
def test_other_documents_are_refused(spark, tmp_path, old, new):
    path = tmp_path / "model.pmml"
    assert old in DEMAND_DOCUMENT
    path.write_text(DEMAND_DOCUMENT.replace(old, new))
    with pytest.raises(ValueError):
        ensemble.read_ensemble(spark, str(path))


@pytest.fixture(scope="module")
def conditions(spark):
    rows = [(h, d, t, p, x, y, (h * 3 + d * t + p * x + y) % 17 + 1)
            for h in range(0, 24, 3) for d in (1, 4, 7) for t in range(5) for p in range(3)
            for x, y in ((0, 0), (100, 20), (249, 399))]
    names = ", ".join(f"{f} int" for f in forest.FEATURES)
    return spark.createDataFrame(rows, names + ", count int").cache()


def test_saved_forest_scores_the_same(spark, conditions):
    schema, model = forest.train_forest(conditions, trees=3, depth=3)
    path = shared_folder(spark, "forest")
    forest.save_model(model, path)
    forest.save_model(model, path)
    loaded = forest.load_model(path)
    assert schema == conditions.schema
    apart = forest.parity(forest.score(model, conditions), forest.score(loaded, conditions),
                          forest.FEATURES, tolerance=0.0).first()
    assert tuple(apart) == (conditions.count(), 0)


def test_forest_as_columns_scores_the_same(spark, conditions):
    _, model = forest.train_forest(conditions, trees=8, depth=6)
    trees = ensemble.ensemble_of_forest(
        spark, model.stages[-1], shared_folder(spark, "nodes"), forest.FEATURES)
    assert len(trees.trees) == 8
    apart = forest.parity(forest.score(model, conditions),
                          ensemble.score_ensemble(trees, conditions), forest.FEATURES).first()
    assert tuple(apart) == (conditions.count(), 0)


def test_large_forests_become_flat_arrays(spark, conditions):
    _, model = forest.train_forest(conditions, trees=20, depth=8)
    trees = ensemble.ensemble_of_forest(
        spark, model.stages[-1], shared_folder(spark, "nodes"), forest.FEATURES)
    assert sum(len(ensemble._tests(t)) for t in trees.trees) > ensemble.MOST_TESTS
    apart = forest.parity(forest.score(model, conditions),
                          ensemble.score_ensemble(trees, conditions), forest.FEATURES).first()
    assert tuple(apart) == (conditions.count(), 0)
    hole = conditions.limit(1).withColumn("hour", F.lit(None).cast("int"))
    assert ensemble.score_ensemble(trees, hole).first()["prediction"] is None


BOTH_WAYS = pytest.mark.parametrize("most_tests", [0, 1_000_000])
INF, NAN = float("inf"), float("nan")


@BOTH_WAYS
def test_unknown_inputs_and_categories(spark, monkeypatch, most_tests):
    """One rule for a test, whichever form the trees take."""
    monkeypatch.setattr(ensemble, "MOST_TESTS", most_tests)
    split = ensemble.Ensemble([ensemble.Branches([(("x", "lessOrEqual", 1.5), ensemble.Leaf(1.0)), (("x", "greaterThan", 1.5), ensemble.Leaf(2.0))])], {})
    rest = ensemble.Ensemble([ensemble.Branches([(("x", "notEqual", 2), ensemble.Leaf(1.0)), (None, ensemble.Leaf(2.0))])], {})
    kinds = ensemble.Ensemble([ensemble.Branches([
        (("kind", "equal", "b"), ensemble.Branches([(("x", "greaterOrEqual", 0), ensemble.Leaf(1.0)), (("x", "lessThan", 0), ensemble.Leaf(2.0))])),
        (("kind", "greaterThan", "d"), ensemble.Leaf(3.0)), (("kind", "notEqual", "c"), ensemble.Leaf(4.0))])], {})
    frame = spark.createDataFrame([(0, NAN, "b"), (1, None, "b"), (2, INF, None), (3, -INF, "b"), (4, 1.5, "b"), (5, 2.0, "c"), (6, 0.0, "e"),
                                   (7, 0.0, "a"), (8, 0.0, "d"), (9, -0.0, "b"), (10, 0.0, "")], "id int, x double, kind string")

    def scores(model, rows=frame):
        return [r["prediction"] for r in ensemble.score_ensemble(model, rows).orderBy("id").collect()]

    assert scores(split) == [None, None, 2.0, 1.0, 1.0, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0]
    assert scores(rest) == [2.0, 2.0, 1.0, 1.0, 1.0, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0]
    assert scores(kinds) == [None, None, None, 2.0, 1.0, None, 3.0, 4.0, 4.0, 1.0, 4.0]
    declared = kinds._replace(categories={"kind": ("b", "d", "e")})
    assert scores(declared) == [None, None, None, 2.0, 1.0, None, 3.0, None, 4.0, 1.0, None]
    assert scores(split, frame.withColumn("x", F.col("x").cast("float")))[:3] == [None, None, 2.0]


def test_the_number_of_trees_does_not_change_a_score(spark):
    tree = ensemble.Branches([(("x", "lessOrEqual", 1.5), ensemble.Leaf(1.0)), (("x", "greaterThan", 1.5), ensemble.Leaf(2.0))])
    frame = spark.createDataFrame([(NAN,), (None,), (1.0,), (INF,)], "x double")
    one, many = ([r["prediction"] for r in ensemble.score_ensemble(ensemble.Ensemble([tree] * n, {}), frame).collect()] for n in (1, 150))
    assert one == many == [None, None, 1.0, 2.0]


def test_a_field_is_text_or_a_number():
    model = ensemble.Ensemble([ensemble.Branches([(("a", "equal", "1"), ensemble.Leaf(1.0)), (("a", "equal", 1), ensemble.Leaf(2.0))])], {})
    with pytest.raises(ValueError, match="text and as numbers"):
        ensemble.ensemble_column(model)


@BOTH_WAYS
def test_flat_arrays_score_as_nested_columns_do(spark, monkeypatch, most_tests):
    monkeypatch.setattr(ensemble, "MOST_TESTS", most_tests)
    model = ensemble.Ensemble([
        ensemble.Branches([(("a", "notEqual", 2), ensemble.Branches([
            (("b", "greaterOrEqual", 1.5), ensemble.Leaf(1.0)), (("b", "lessThan", 0.5), ensemble.Leaf(2.0))])),
            (("a", "equal", 2), ensemble.Leaf(3.0))]),
        ensemble.Branches([(("b", "greaterThan", 1), ensemble.Leaf(0.25)), (None, ensemble.Leaf(0.75))])], {"a": (1, 2, 3)})
    values = [(a, b) for a in (None, 1, 2, 3, 4) for b in (None, 0.0, 0.5, 1.0, 1.5, 2.0)]

    def expected(a, b):
        first = 3.0 if a == 2 else None if b is None else 1.0 if b >= 1.5 else 2.0 if b < 0.5 else None
        return None if first is None or a in (None, 4) else (first + (0.25 if b is not None and b > 1 else 0.75)) / 2

    frame = spark.createDataFrame(values, "a int, b double")
    assert [r["prediction"] for r in ensemble.score_ensemble(model, frame).collect()] == [expected(a, b) for a, b in values]


def test_forests_with_categories_are_refused(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.regression import RandomForestRegressor

    frame = spark.createDataFrame([(i % 3, float(i % 3 == 1)) for i in range(60)], "zip int, count double")
    stages = [VectorAssembler(inputCols=["zip"], outputCol="v"), VectorIndexer(inputCol="v", outputCol="features"),
              RandomForestRegressor(labelCol="count", numTrees=1, maxDepth=2)]
    model = Pipeline(stages=stages).fit(frame)
    with pytest.raises(ValueError, match="categorical"):
        ensemble.ensemble_of_forest(spark, model.stages[-1], shared_folder(spark, "nodes"), ["zip"])


def test_one_document_only(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_text(DEMAND_DOCUMENT)
    with pytest.raises(ValueError, match="several"):
        ensemble.read_ensemble(spark, str(tmp_path))


def test_incomplete_reports_have_no_predictions(spark, conditions, tmp_path):
    reports = spark.createDataFrame([
        ("2014-05-07 09:51", 60.0, 0.1), ("2014-05-07 10:51", None, 0.1), ("2014-05-07 11:51", 50.0, None),
        ("no time", 50.0, 0.0), (None, 50.0, 0.0), ("2014-05-07 12:51", 70.0, 0.0)], WEATHER_REPORT)
    (tmp_path / "model.pmml").write_text(DEMAND_DOCUMENT)
    document = ensemble.read_ensemble(spark, str(tmp_path / "model.pmml"))
    _, model = forest.train_forest(conditions, trees=2, depth=2)
    cells = spark.createDataFrame([(5,), (70_000,)], "cell_id int")
    found = []
    for scorer in (lambda rows: ensemble.score_ensemble(document, rows), lambda rows: forest.score(model, rows)):
        predicted = jobs.predicted_demand(reports, scorer, cells).collect()
        assert all(r["count"] is not None for r in predicted)
        found.append(sorted((r.datetime, r.cell_id) for r in predicted))
    assert found[0] == found[1] == [(d, c) for d in ("2014-05-07 09:51", "2014-05-07 12:51") for c in (5, 70_000)]
    kept, seen = jobs.complete_reports(reports)
    kept.collect()
    assert seen.get["dropped"] == 4


def test_a_stream_goes_on_past_bad_records(spark):
    folder = shared_folder(spark, "bad-records")
    topic = {"fmt": "parquet", "options": {"path": f"{folder}/topics"}}
    reports = spark.createDataFrame([("bad", 60.0, 0.1), ("2014-05-07 09:51", 60.0, 0.1)], WEATHER_REPORT)
    write_topic(reports, "weather", **topic)
    cells = spark.createDataFrame([(5,)], "cell_id int")
    query = jobs.run_prediction(spark, "weather", "predicted", lambda rows: rows.withColumn("prediction", F.lit(1.0)),
                                cells=cells, checkpoint=f"{folder}/c", **topic)
    query.awaitTermination()
    assert [r.datetime for r in jobs.topic_values(spark, "predicted", CELL_COUNT, **topic).collect()] == ["2014-05-07 09:51"]
    assert sum(p["observedMetrics"][jobs.INCOMPLETE]["dropped"] for p in map(_progress, query.recentProgress)
               if jobs.INCOMPLETE in p["observedMetrics"]) == 1

    rides = spark.createDataFrame([("no time", 40.7, -73.9, 5), ("2014-05-07 09:51:00", 40.7, -73.9, 5)], CELLED_RIDE)
    write_topic(rides, "celled", key="pickup_cellid", **topic)
    later = spark.createDataFrame([("2014-05-08 09:51:00", 40.7, -73.9, 5)], CELLED_RIDE)
    write_topic(later, "celled", key="pickup_cellid", **topic)
    query = jobs.run_popular_cells(spark, "celled", "popular", threshold=1, checkpoint=f"{folder}/p", **topic)
    query.awaitTermination()
    found = jobs.topic_values(spark, "popular", CELL_COUNT, **topic).collect()
    assert len(found) == 3 and all(r["count"] == 1 for r in found)


def _progress(progress):
    return progress if isinstance(progress, dict) else json.loads(progress.json)


def test_parity_notices_differences(spark, conditions):
    _, model = forest.train_forest(conditions, trees=2, depth=2)
    scored = forest.score(model, conditions)
    moved = scored.withColumn("prediction", scored.prediction + 0.002)
    assert forest.parity(scored, moved, forest.FEATURES).first()["apart"] == conditions.count()
    fewer = scored.filter("hour > 0")
    assert forest.parity(scored, fewer, forest.FEATURES).first()["apart"] == 135


def test_rows_with_a_null_feature_are_skipped(spark, conditions):
    holes = conditions.limit(5).union(spark.createDataFrame(
        [(1, 1, None, 0, 0, 0, 3)], conditions.schema))
    assert forest.assembler().transform(holes).count() == 5


def test_no_task_learns_from_a_whole_file(spark, monkeypatch):
    rows = spark.range(0, 4000, 1, 1).select(*[
        (F.col("id") * k % 11).cast("int").alias(name) for k, name in enumerate(forest.FEATURES, 2)],
        (F.col("id") % 7).alias("count"))
    monkeypatch.setattr(forest, "TASK_ROWS", 100)
    seen, fit = [], forest.Pipeline.fit
    monkeypatch.setattr(forest.Pipeline, "fit", lambda self, frame: seen.append(frame) or fit(self, frame))
    forest.train_forest(rows, trees=2, depth=2)
    forest.train_stump(rows)
    forest.train_categorical(rows.withColumn("zip", F.col("hour").cast("string")))
    for frame in seen:
        sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 200
    assert len(seen) == 3


def test_categorical_forest(spark):
    rows = [(str(10001 + i % 9), 1 + i % 7, i % 24, 1 + i % 5) for i in range(600)]
    frame = spark.createDataFrame(rows, "zip string, weekday int, hour int, count int")
    model = forest.train_categorical(frame)
    assert model.stages[-1].getNumTrees == 2
    assert forest.score(model, frame).filter("prediction is null").count() == 0


def test_scores_are_shared_only_if_that_saves_work(spark):
    few = spark.range(100).selectExpr(
        "1 AS weekday", "cast(id % 24 AS int) AS hour", "0 AS temperature", "0 AS precipitation")
    assert jobs._worth_sharing(few) and not jobs._worth_sharing(few, most=99)
    assert not jobs._worth_sharing(few.limit(90)) and not jobs._worth_sharing(few.limit(0))


def test_classes_between_cuts():
    first, numbers = lattice._classes([2.0, 4.5], range(8))
    assert (first, numbers) == ([0, 2, 3, 5], [0, 0, 1, 2, 2, 3, 3, 3])
    whole = lattice.Lattice({})
    assert len(whole.xs) == len(whole.ys) == 1 and len({c[4:] for c in whole.conditions}) == 1
    assert len(whole.conditions) == 7 * 24 * 5 * 3


@pytest.fixture(scope="module")
def reports(spark):
    return spark.createDataFrame(
        [("2014-05-07 09:51", 61.0, 0.0), ("2014-05-14 21:51", 12.0, 0.05), ("2014-05-07 09:21", 30.0, None),
         ("2014-05-07 09:51", 61.0, 0.0), ("2014-05-11 03:51", 99.0, 2.0)], WEATHER_REPORT)


def test_demand_from_the_lattice_is_that_of_every_cell(spark, conditions, reports, monkeypatch):
    _, model = forest.train_forest(conditions, trees=6, depth=6)
    trees = ensemble.ensemble_of_forest(spark, model.stages[-1], shared_folder(spark, "nodes"), forest.FEATURES)
    cuts = forest.forest_cuts(spark, model.stages[-1], shared_folder(spark, "cuts"))
    assert cuts == ensemble.ensemble_cuts(trees)

    def scorer(frame):
        return forest.score(model, frame)

    fast, slow = (jobs.predicted_demand(reports, scorer, cuts=c) for c in (cuts, None))
    assert fast.columns == slow.columns and fast.count() == slow.count() == 400_000
    assert fast.exceptAll(slow).count() == 0
    cells = spark.createDataFrame([(0,), (99_999,), (50_552,), (50_552,), (-1,)], "cell_id int")
    some = jobs.predicted_demand(reports, scorer, cells, only_rain_minute=True, cuts=cuts)
    assert sorted(some.collect()) == sorted(jobs.predicted_demand(reports, scorer, cells, only_rain_minute=True).collect())
    monkeypatch.setattr(lattice, "_BROADCAST_COUNTS", 0)
    assert sorted(jobs.predicted_demand(reports, scorer, cells, only_rain_minute=True, cuts=cuts).collect()) == sorted(some.collect())


def test_a_scorer_that_drops_cells_is_noticed(spark, reports):
    with pytest.raises(Exception, match="left cells out"):
        jobs.predicted_demand(reports, lambda rows: rows.filter("cell_index_x < 9").withColumn("prediction", F.lit(1.0)), cuts={"cell_index_x": [8.5]})


def test_a_restarted_prediction_stream_repeats_nothing(spark, reports, tmp_path):
    folder = shared_folder(spark, "restart")
    topic = {"fmt": "parquet", "options": {"path": f"{folder}/topics"}}
    (tmp_path / "model.pmml").write_text(DEMAND_DOCUMENT)
    model = ensemble.read_ensemble(spark, str(tmp_path / "model.pmml"))
    cells = spark.createDataFrame([(0,), (70_000,)], "cell_id int")

    def scorer(rows):
        return ensemble.score_ensemble(model, rows)

    for part in ("datetime < '2014-05-08'", "datetime >= '2014-05-08'", "false"):
        write_topic(reports.filter(part), "weather", **topic)
        jobs.run_prediction(spark, "weather", "predicted", scorer, cells=cells, cuts=ensemble.ensemble_cuts(model),
                            checkpoint=f"{folder}/c", **topic).awaitTermination()
    found = jobs.topic_values(spark, "predicted", CELL_COUNT, **topic)
    assert sorted(found.collect()) == sorted(jobs.predicted_demand(reports, scorer, cells).collect())


def test_demand_by_combination_and_by_report(spark, tmp_path, rows, monkeypatch):
    path = tmp_path / "model.pmml"
    path.write_text(DEMAND_DOCUMENT)
    model = ensemble.read_ensemble(spark, str(path))

    def scorer(frame):
        return ensemble.score_ensemble(model, frame)

    weather = spark.createDataFrame(
        [("2014-05-07 09:51", 61.0, 0.0), ("2014-05-14 09:51", 62.0, 0.05),
         ("2014-05-07 09:21", 30.0, None), ("2014-05-07 09:51", 61.0, 0.0)], WEATHER_REPORT)
    cells = spark.createDataFrame([(0,), (99_999,), (50_552,)], "cell_id int")
    results = []
    for sharing in (True, False):
        monkeypatch.setattr(jobs, "_worth_sharing", lambda frame, sharing=sharing: sharing)
        results.append(rows(jobs.predicted_demand(weather, scorer, cells).na.fill(-1)))
    shared = results[0]
    assert shared == results[1]
    # The report without a rain reading has no prediction.
    assert shared == sorted(
        (day, cell, 3) for day in ("2014-05-07 09:51", "2014-05-07 09:51", "2014-05-14 09:51")
        for cell in (0, 50_552, 99_999))
    only = jobs.predicted_demand(weather, scorer, cells, only_rain_minute=True)
    assert only.count() == 9
