import pytest
from pyspark.sql import functions as F

from ridecells.functions import grid
from ridecells.schemas import GRID_CELLS, LON_STEP

# Points and their cells.
POINTS = [
    ("north-west", 40.999875000002795, -74.0499405517592, 0),
    ("north-east", 40.999875000002795, -73.70062194822822, 249),
    ("south-west", 40.50083333331471, -74.04937805177178, 99750),
    ("south-east", 40.50004166666574, -73.70113331185316, 99999),
    ("second row", 40.99812500004191, -74.04886668814684, 250),
    ("near", 40.87062454223633, -74.00870513916016, 25779),
    ("nearer", 40.870687042234934, -74.00875180664006, 25779),
    ("sample ride", 40.747166999999997, -73.977132999999995, 50552),
    ("north border", 41.0, -73.9, None),
    ("south border", 40.5, -73.9, None),
    ("west border", 40.7, -74.05, None),
    ("east border", 40.7, -73.70, None),
    ("not a number", float("nan"), -73.9, None),
    ("null", None, -73.9, None),
    ("zero", 0.0, 0.0, None),
]


def test_cell_of_known_points(spark):
    points = spark.createDataFrame(POINTS, "name string, lat double, lon double, cell int")
    got = points.select(
        "name", "cell", grid.grid_cell("lat", "lon").alias("got"),
        grid.in_box("lat", "lon").alias("inside"))
    for row in got.collect():
        assert row.got == row.cell, row.name
        assert row.inside == (row.cell is not None), row.name


def test_every_cell_contains_its_center(spark):
    cells = spark.range(GRID_CELLS).select(F.col("id").cast("int").alias("cell"))
    centers = cells.select("cell", grid.cell_center_lat("cell").alias("lat"),
                           grid.cell_center_lon("cell").alias("lon"))
    assert centers.filter(grid.grid_cell("lat", "lon") == F.col("cell")).count() == GRID_CELLS
    back = cells.select("cell", grid.cell_index("cell").alias("i")).select("cell", "i.*")
    assert back.filter(grid.cell_from_index("x", "y") == F.col("cell")).count() == GRID_CELLS


def test_known_centers(spark):
    cells = spark.createDataFrame([(0,), (20019,)], "cell int")
    got = cells.select(grid.cell_center_lat("cell"), grid.cell_center_lon("cell")).collect()
    assert [tuple(r) for r in got] == [
        (pytest.approx(40.999375), pytest.approx(-74.0493)),
        (pytest.approx(40.899375), pytest.approx(-74.0227))]
    assert LON_STEP == 0.0013999999999999772


def test_bad_coordinates_are_zero_on_either_side(spark):
    points = spark.createDataFrame(
        [(0.0, -73.9), (40.7, 0.0), (0.0, 0.0), (40.7, -73.9), (10.0, 10.0), (None, 1.0)],
        "lat double, lon double")
    flags = [r[0] for r in points.select(grid.bad_coordinate("lat", "lon")).collect()]
    assert flags == [True, True, True, False, False, False]
