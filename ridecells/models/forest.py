"""Random forests over the training table, with Spark ML."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ridecells.functions.grid import cell_from_index
from ridecells.functions.numbers import clean_number, round_half_up, within
from ridecells.functions.times import hour_of_day, weekday_from_one
from ridecells.functions.weather import rain_bucket, temperature_bucket

# The features in the order of the model.
FEATURES = ["hour", "weekday", "temperature", "precipitation", "cell_index_x", "cell_index_y"]

# Size and seed of the forest.
TREES = 50
DEPTH = 10
SEED = 235498149

# Rows that one task learns from; each carries its bins and its weight in every tree.
TASK_ROWS = 50_000


def assembler(features=FEATURES, invalid="skip"):
    """Features as one vector; rows with a null feature are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)


def forest(trees=TREES, depth=DEPTH, seed=SEED):
    # Node ids kept with the rows spare each level a walk from the root.
    return RandomForestRegressor(
        featuresCol="features", labelCol="count", numTrees=trees, maxDepth=depth, seed=seed,
        cacheNodeIds=True,
    )


def dealt(rows):
    """The rows dealt evenly over tasks, about ``TASK_ROWS`` to each at most.

    A learner reads its input as it is partitioned, again at every level, and
    a small file can hold rows that are large once they are unpacked.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return rows.repartition(tasks)


def train_forest(counts, trees=TREES, depth=DEPTH, seed=SEED):
    """Schema of the input and the fitted pipeline."""
    model = Pipeline(stages=[assembler(), forest(trees, depth, seed)]).fit(dealt(counts))
    return counts.schema, model


def train_categorical(counts, category="zip", numeric=("weekday", "hour"), trees=2, depth=3,
                      seed=SEED):
    """Forest over an indexed and one-hot encoded category and numeric columns."""
    index = StringIndexer(inputCol=category, outputCol=f"{category}_index", handleInvalid="keep")
    one_hot = OneHotEncoder(inputCols=[f"{category}_index"], outputCols=[f"{category}_vector"])
    stages = [
        index, one_hot, assembler([f"{category}_vector", *numeric]), forest(trees, depth, seed),
    ]
    return Pipeline(stages=stages).fit(dealt(counts))


def train_stump(counts, seed=SEED):
    """One split of one tree over all rows and features: what a search over all splits finds."""
    stump = forest(1, 1, seed).setBootstrap(False).setFeatureSubsetStrategy("all").setMaxBins(512)
    return Pipeline(stages=[assembler(), stump]).fit(dealt(counts))


def fit_facts(scored, label="count", prediction="prediction"):
    """Rows, predictions within the labels' range, and whether they are no worse than the labels' mean."""
    bounds = scored.agg(F.min(label).alias("low"), F.max(label).alias("high"))
    both = scored.crossJoin(F.broadcast(bounds))  # one row
    error = F.sum(F.pow(F.col(label) - F.col(prediction), F.lit(2)))
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(prediction).between(F.col("low"), F.col("high"))).alias("within"),
        (error <= F.var_pop(label) * F.count("*") + 1e-9).alias("better"))


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(path):
    return PipelineModel.load(path)


def score(model, rows):
    """Rows with their prediction."""
    return model.transform(rows).drop("features")


def forest_cuts(spark, forest_model, path, features=FEATURES):
    """Feature to its sorted split points; between them predictions don't change.

    The model is saved to ``path``. A fitted forest splits a feature at a bin's
    end, so there are at most as many points as bins.
    """
    forest_model.write().overwrite().save(path)
    splits = spark.read.parquet(f"{path}/data").filter("nodeData.leftChild >= 0").select("nodeData.split.*")
    points = splits.select(
        "featureIndex", F.when(F.col("numCategories") < 0, F.col("leftCategoriesOrThreshold")[0]).alias("point"))
    cuts = {}
    for row in points.distinct().collect():
        if row["point"] is None:
            raise ValueError("a forest with categorical splits")
        cuts.setdefault(features[row["featureIndex"]], []).append(row["point"])
    return {feature: sorted(found) for feature, found in cuts.items()}


def weather_features(weather, ts="ts", fahrenheit="fahrenheit", inches="precip_in"):
    """Weekday, hour and buckets of weather reports, beside their own columns."""
    return (
        weather.withColumn("_f", clean_number(fahrenheit)).withColumn("_p", clean_number(inches))
        .withColumns({
            "weekday": weekday_from_one(ts), "hour": hour_of_day(ts),
            "temperature": temperature_bucket("_f"), "precipitation": rain_bucket("_p"),
        }).drop("_f", "_p")
    )


def predicted_counts(scored, datetime="datetime"):
    """Scored rows as records ``datetime, cell_id, count``."""
    return scored.select(
        F.col(datetime).alias("datetime"),
        cell_from_index("cell_index_x", "cell_index_y").alias("cell_id"),
        round_half_up("prediction").alias("count"),
    )


def parity(first, second, key, tolerance=0.001, prediction="prediction"):
    """How many predictions of two scorers differ by more than the tolerance.

    ``key`` is the list of columns that tell rows apart.
    """
    both = (
        first.select(*key, F.col(prediction).alias("_a"))
        .join(second.select(*key, F.col(prediction).alias("_b")), list(key), "full")
    )
    close = F.coalesce(within("_a", "_b", tolerance), F.lit(False))
    return both.agg(F.count("*").alias("rows"), F.count_if(~close).alias("apart"))
