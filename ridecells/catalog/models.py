"""Queries over forests and tree ensembles."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridecells.catalog import sql
from ridecells.catalog.ensembles import DEMAND_DOCUMENT, ZIP_ENSEMBLE, ZIPS
from ridecells.catalog.streams import Place
from ridecells.catalog.tables import RADIUS, training_table, zip_training_table
from ridecells.functions.times import hour_of_day, parse_weather_time, weekday_from_one
from ridecells.models import ensemble, forest
from ridecells.operators.cleaning import enrich_rides
from ridecells.plans import batch
from ridecells.plans import derived_tables as derived
from ridecells.schemas import CELL_COUNT, RIDE_FILE
from ridecells.session import stored
from ridecells.sources import files
from ridecells.streaming import jobs

_KEY = [*forest.FEATURES, "count"]


def _demand_model(spark, place):
    """The ensemble read from an exchange document in the shared folder."""
    path = place.path("document")
    spark.createDataFrame([(DEMAND_DOCUMENT,)], "value string").write.option(
        "lineSep", "\n").text(path)
    return ensemble.read_ensemble(spark, path)


def _demand_scorer(spark, place):
    model = _demand_model(spark, place)
    return lambda rows: ensemble.score_ensemble(model, rows)


def assembled_features(spark, folder):
    rows = forest.assembler().transform(training_table(spark, folder))
    array = vector_to_array("features")
    return rows.select(*[
        array[i].alias(name) for i, name in enumerate(forest.FEATURES)], "count")


def trained_forest(spark, folder):
    """Facts about the full-size forest's predictions for the table it was trained on."""
    counts = stored(training_table(spark, folder), "counts")
    _, model = forest.train_forest(counts)
    return forest.fit_facts(forest.score(model, counts))


def spread_training_table(spark, folder):
    rides = derived.dated_rides(derived.spread_rides(spark, folder))
    return batch.training_table(rides, derived.weather_reports(spark, folder))


def trained_spread_forest(spark, folder):
    """The same for rides spread over all cells of the grid."""
    counts = stored(spread_training_table(spark, folder), "counts")
    _, model = forest.train_forest(counts)
    return forest.fit_facts(forest.score(model, counts))


def trained_categorical_forest(spark, folder):
    counts = stored(zip_training_table(spark, folder), "counts")
    return forest.fit_facts(forest.score(forest.train_categorical(counts), counts))


def trained_stump(spark, folder):
    """The two leaves of a single split: their means and rows."""
    counts = stored(training_table(spark, folder), "counts")
    return forest.score(forest.train_stump(counts), counts).groupBy("prediction").agg(F.count("*").alias("rows"))


def train_save_and_load(spark, folder):
    """The forest trained from files and saved; counts of equal scores."""
    place = Place(spark, "train-save")
    rides, weather = place.path("rides"), place.path("weather")
    derived.ride_file(spark, folder).write.option("header", True).csv(rides)
    derived.weather_file(spark, folder).write.option("header", True).csv(weather)
    model = batch.train_and_save(spark, rides, weather, place.path("model"), rides_schema=RIDE_FILE)
    loaded = forest.load_model(place.path("model"))
    counts = batch.training_table_from_files(spark, rides, weather, RIDE_FILE)
    return forest.parity(forest.score(model, counts), forest.score(loaded, counts), _KEY)


def forest_parity(spark, folder):
    """A Spark forest against the same trees as a column of the library."""
    place = Place(spark, "parity")
    counts = stored(training_table(spark, folder), "counts")
    _, model = forest.train_forest(counts)
    trees = ensemble.ensemble_of_forest(
        spark, model.stages[-1], place.path("forest"), forest.FEATURES)
    complete = counts.dropna(subset=forest.FEATURES)
    return forest.parity(
        forest.score(model, counts), ensemble.score_ensemble(trees, complete), _KEY)


def ensemble_scores(spark, folder):
    """The zip ensemble on one row per event."""
    rows = derived.busy_rides(spark, folder).select(
        "event_id", (F.lit(10001) + F.col("user_id") % 150).cast("int").alias("zip"),
        weekday_from_one("ts").alias("weekday"), hour_of_day("ts").alias("hour"))
    return ensemble.score_ensemble(ZIP_ENSEMBLE, rows)


def document_ensemble_scores(spark, folder):
    """The demand ensemble, read from its document, on the training table."""
    score = _demand_scorer(spark, Place(spark, "document"))
    return score(training_table(spark, folder))


def weather_features(spark, folder):
    records = derived.weather_records(spark, folder)
    timed = records.withColumn("ts", parse_weather_time("datetime"))
    return forest.weather_features(timed).drop("ts")


def predicted_demand(spark, folder):
    """Every report times all 100,000 cells, scored; summed up per report."""
    score = _demand_scorer(spark, Place(spark, "demand"))
    return _per_report(jobs.predicted_demand(derived.weather_records(spark, folder), score))


def _per_report(predicted):
    return predicted.groupBy("datetime").agg(
        F.count("*").alias("cells"), F.sum("count").alias("total"), F.max("count").alias("most"))


def predicted_demand_by_forest(spark, folder):
    """Every report times all cells, scored by the full-size Spark forest.

    Per report the cells, and those whose count lies within that of the labels.
    """
    counts = stored(training_table(spark, folder), "counts")
    _, model = forest.train_forest(counts)
    cuts = forest.forest_cuts(spark, model.stages[-1], Place(spark, "cuts").path("forest"))
    predicted = jobs.predicted_demand(
        derived.weather_records(spark, folder), lambda rows: forest.score(model, rows), cuts=cuts)
    bounds = counts.agg(F.min("count").alias("low"), F.max("count").alias("high"))
    return predicted.crossJoin(F.broadcast(bounds)).groupBy("datetime").agg(  # one row
        F.count("*").alias("cells"), F.count_if(F.col("count").between(F.col("low"), F.col("high"))).alias("within"))


def prediction_stream(spark, folder):
    """The prediction job over all reports and cells; what it wrote, summed up per report."""
    place = Place(spark, "prediction-stream")
    place.publish(derived.weather_records(spark, folder), "weather")
    model = _demand_model(spark, place)
    jobs.run_prediction(
        spark, "weather", "predicted", lambda rows: ensemble.score_ensemble(model, rows), cuts=ensemble.ensemble_cuts(model),
        checkpoint=place.path("c"), **place.topic).awaitTermination()
    return _per_report(place.values("predicted", CELL_COUNT))


def prediction_stream_known_cells(spark, folder):
    """The prediction job for the cells seen in training and rain-minute reports."""
    place = Place(spark, "prediction-stream")
    place.publish(derived.weather_records(spark, folder), "weather")
    cells = enrich_rides(derived.busy_rides(spark, folder))
    jobs.run_prediction(
        spark, "weather", "predicted", _demand_scorer(spark, place), cells=cells,
        only_rain_minute=True, checkpoint=place.path("c"), **place.topic).awaitTermination()
    return place.values("predicted", CELL_COUNT)


def scored_file(spark, folder):
    """A table of conditions read from CSV and scored."""
    place = Place(spark, "scored-file")
    training_table(spark, folder).write.option("header", True).csv(place.path("counts"))
    rows = files.read_csv(
        spark, place.path("counts"), "weekday int, hour int, temperature int, precipitation int,"
        " count bigint, cell_index_x int, cell_index_y int")
    return _demand_scorer(spark, place)(rows)


_DEMAND = """((CASE WHEN hour <= 65e-1 THEN CASE WHEN cell_index_y <= 1805e-1 THEN 125e-2
                                    WHEN cell_index_y > 1805e-1 THEN 5e-1 END
         WHEN hour > 65e-1 THEN CASE WHEN temperature <= 15e-1 THEN 275e-2
           WHEN temperature > 15e-1 THEN CASE WHEN precipitation <= 5e-1 THEN 45e-1
                                              WHEN precipitation > 5e-1 THEN 325e-2 END END END
    + CASE WHEN cell_index_x <= 1105e-1 THEN CASE WHEN weekday <= 55e-1 THEN 3e0
                                                  WHEN weekday > 55e-1 THEN 55e-1 END
           WHEN cell_index_x > 1105e-1 THEN 175e-2 END
    + CASE WHEN cell_index_y <= 2005e-1 THEN CASE WHEN hour <= 185e-1 THEN 2e0
                                                  WHEN hour > 185e-1 THEN 625e-2 END
           WHEN cell_index_y > 2005e-1 THEN CASE WHEN precipitation <= 15e-1 THEN 25e-1
                                                 WHEN precipitation > 15e-1 THEN 1e0 END END)
    / 3e0)"""
_ZIP_SCORE = """((CASE WHEN zip = 10014 THEN CASE WHEN weekday > 35e-1 THEN 3.253968253968254e0
               WHEN hour > 225e-1 THEN 4e0 ELSE 2.485294117647059e0 END
         WHEN zip = 10016 THEN 2.793388429752066e0 WHEN zip = 10119 THEN 4.071895424836601e0
         ELSE 1.9247287522603977e0 END
    + CASE WHEN zip = 10119 THEN 3.9565217391304346e0
           WHEN hour <= 75e-1 THEN CASE WHEN zip = 10012 THEN 3.6363636363636362e0
                                        ELSE 1.55678391959799e0 END
           WHEN zip = 10023 THEN 3.7373737373737375e0 ELSE 2.103235294117647e0 END) / 2e0)"""
_FEATURES = f"""(SELECT datetime, fahrenheit, precip_in, {sql.weekday1('valid')} AS weekday,
    {sql.hour('valid')} AS hour, {sql.warm('fahrenheit')} AS temperature,
    {sql.wet('precip_in')} AS precipitation, valid FROM {sql.WEATHER_RECORDS} w)"""
_COMPLETE = "temperature IS NOT NULL AND precipitation IS NOT NULL"
_BUSY_CELLS = f"(SELECT DISTINCT cell_id FROM {sql.cells(sql.BUSY)} r)"


def _predictions(cells, cell):
    return f"""(SELECT datetime, CAST({cell} AS INTEGER) AS cell_id, valid,
        CAST(floor({_DEMAND} + 5e-1) AS BIGINT) AS "count" FROM (
          SELECT f.*, {cell}, {cell} % 250 AS cell_index_x, {cell} // 250 AS cell_index_y
          FROM {_FEATURES} f, {cells}) x)"""


# The training table over spread rides: the same text with the other rides in it.
_SPREAD_TRAINING = sql.TRAINING.replace(sql.BUSY, sql.SPREAD)
# Of all splits between neighbouring values of a feature, that with the least squared error.
_STUMP = f"""WITH t AS (SELECT * FROM {sql.TRAINING} t WHERE {_COMPLETE}),
    v AS ({" UNION ALL ".join(f"SELECT '{f}' AS f, {f} AS v, count(*) AS n, sum(count) AS s FROM t GROUP BY {f}" for f in forest.FEATURES)}),
    c AS (SELECT sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER p AS all_n, sum(s) OVER p AS all_s
          FROM v WINDOW w AS (PARTITION BY f ORDER BY v), p AS (PARTITION BY f)),
    best AS (SELECT * FROM c WHERE n < all_n ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC LIMIT 1)
    SELECT CAST(s AS DOUBLE) / n AS prediction, CAST(n AS BIGINT) AS rows FROM best
    UNION ALL SELECT CAST(all_s - s AS DOUBLE) / (all_n - n), CAST(all_n - n AS BIGINT) FROM best"""

QUERIES = [
    ("assembled_features", assembled_features,
     f"""SELECT CAST(hour AS DOUBLE) AS hour, CAST(weekday AS DOUBLE) AS weekday,
         CAST(temperature AS DOUBLE) AS temperature,
         CAST(precipitation AS DOUBLE) AS precipitation,
         CAST(cell_index_x AS DOUBLE) AS cell_index_x,
         CAST(cell_index_y AS DOUBLE) AS cell_index_y, "count"
         FROM {sql.TRAINING} t WHERE {_COMPLETE}"""),
    ("trained_forest", trained_forest,
     f"SELECT count(*) AS rows, count(*) AS within, TRUE AS better FROM {sql.TRAINING} t WHERE {_COMPLETE}"),
    ("trained_spread_forest", trained_spread_forest,
     f"SELECT count(*) AS rows, count(*) AS within, TRUE AS better FROM {_SPREAD_TRAINING} t WHERE {_COMPLETE}"),
    ("trained_categorical_forest", trained_categorical_forest,
     f"SELECT count(*) AS rows, count(*) AS within, TRUE AS better FROM {sql.zip_counts(RADIUS)} t"),
    ("trained_stump", trained_stump, _STUMP),
    ("train_save_and_load", train_save_and_load,
     f"""SELECT count(*) AS rows, CAST(0 AS BIGINT) AS apart FROM {sql.TRAINING} t
         WHERE {_COMPLETE}"""),
    ("forest_parity", forest_parity,
     f"""SELECT count(*) AS rows, CAST(0 AS BIGINT) AS apart FROM {sql.TRAINING} t
         WHERE {_COMPLETE}"""),
    ("ensemble_scores", ensemble_scores,
     f"""SELECT *, CASE WHEN zip IN {ZIPS} THEN {_ZIP_SCORE} END AS prediction FROM (SELECT event_id,
         CAST(10001 + user_id % 150 AS INTEGER) AS zip, {sql.weekday1('ts')} AS weekday,
         {sql.hour('ts')} AS hour FROM events) e"""),
    ("document_ensemble_scores", document_ensemble_scores,
     f"SELECT *, {_DEMAND} AS prediction FROM {sql.TRAINING} t"),
    ("weather_features", weather_features, f"SELECT * EXCLUDE (valid) FROM {_FEATURES} f"),
    ("predicted_demand", predicted_demand,
     f"""SELECT datetime, count(*) AS cells, CAST(sum("count") AS BIGINT) AS total,
         max("count") AS most FROM {_predictions('range(100000) c(id)', 'id')} p
         GROUP BY datetime"""),
    ("predicted_demand_by_forest", predicted_demand_by_forest,
     f"SELECT datetime, CAST(100000 AS BIGINT) AS cells, CAST(100000 AS BIGINT) AS within FROM {_FEATURES} f WHERE {_COMPLETE}"),
    ("prediction_stream", prediction_stream,
     f"""SELECT datetime, count(*) AS cells, CAST(sum("count") AS BIGINT) AS total,
         max("count") AS most FROM {_predictions('range(100000) c(id)', 'id')} p
         GROUP BY datetime"""),
    ("prediction_stream_known_cells", prediction_stream_known_cells,
     f"""SELECT datetime, cell_id, "count" FROM {_predictions(_BUSY_CELLS + ' c', 'cell_id')} p
         WHERE minute(valid) = 51"""),
    ("scored_file", scored_file, f"SELECT *, {_DEMAND} AS prediction FROM {sql.TRAINING} t"),
]
