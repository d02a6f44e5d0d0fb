"""Joins of rides with weather and zip codes, and weather with all cells."""

from copy import copy
from functools import reduce
from math import asin, cos, degrees, hypot, pi, radians, sin

from pyspark.sql import functions as F

from ridecells.functions.grid import cell_x, cell_y
from ridecells.functions.times import hour_of_day, weekday_from_one
from ridecells.schemas import GRID_CELLS, MISSING_ZIP
from ridecells.session import stored

# Rows of at most three small columns; about 50 MB as a hash table.
BROADCAST_ROWS = 500_000

# A square of a large zip table is cut no further with as few centroids or points.
FEW_RIVALS = 32
FEW_POINTS = 8
MOST_CUTS = 24

# Mean radius of the earth and miles per kilometre.
EARTH_MILES = 6371.0 * 0.621371


def sized(df, most=BROADCAST_ROWS):
    """The side, stored once, and whether it may be broadcast, by its rows.

    What is counted is what is joined: neither reads the side's inputs again.
    """
    kept = stored(df, "side")
    return kept, kept.count() <= most


def join_weather(rides, weather, most=BROADCAST_ROWS):
    """Rides with the weather of their hour (inner); the hour is dropped.

    The weather side is one row per station and hour. If a count shows it is
    small it goes to every task and the rides are not moved. Otherwise the
    rides are shuffled by hour, and adaptive execution splits hot hours.
    """
    side, small = sized(weather, most)
    return rides.join(F.broadcast(side) if small else side, "hour_ts").drop("hour_ts")


def weather_counts(rides, weather, most=BROADCAST_ROWS):
    """Rides per cell, weekday, hour and weather buckets.

    The result of counting :func:`join_weather`. With few weather rows that
    is one pass over the rides and one shuffle of partial counts. With many,
    rides are first counted per cell and hour, so that the join moves at most
    one row per cell and hour however hot an hour or a cell is; reports that
    fall together in an hour and buckets carry their number along.
    """
    keys = ["cell_id", "weekday", "hour", "temperature", "precipitation"]
    weather, small = sized(weather, most)
    if small:
        # Weekday and hour come from the few weather rows, not from each ride.
        timed = weather.withColumn("weekday", weekday_from_one("hour_ts")).withColumn(
            "hour", hour_of_day("hour_ts"))
        joined = rides.select("cell_id", "hour_ts").join(F.broadcast(timed), "hour_ts")
        return joined.groupBy(*keys).count()
    per_hour = rides.groupBy("cell_id", "hour_ts").agg(F.count("*").alias("rides"))
    reports = (
        weather.groupBy("hour_ts", "temperature", "precipitation")
        .agg(F.count("*").alias("reports"))
    )
    return (
        per_hour.join(reports, "hour_ts")
        .withColumn("weekday", weekday_from_one("hour_ts"))
        .withColumn("hour", hour_of_day("hour_ts"))
        .groupBy(*keys).agg(F.sum(F.col("rides") * F.col("reports")).alias("count"))
    )


def join_by_row_key(table, derived, key):
    """Left join of a derived series back to its table, one to one."""
    return table.join(derived, key, "left")


def with_all_cells(weather, cells=None, most=GRID_CELLS, beside=None):
    """Every weather row beside every cell, with the position of the cell.

    The weather rows are dealt out evenly first, because each becomes 100,000
    rows and adaptive execution, which sees only their own size, would leave
    them in one task. The cells are then made inside each row and flow on. A
    table of ``cells`` (column ``cell_id``, such as those seen in training)
    restricts them to the ids in it that are cells of the grid, so at most
    ``most`` ids are broadcast. A stream wants them stored (``known_cells``),
    since it reads them at every trigger. ``beside`` adds columns to the dealt
    rows, before they are multiplied.
    """
    tasks = int(weather.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weather = weather.repartition(tasks)
    weather = beside(weather) if beside else weather
    if cells is None:
        crossed = weather.withColumn("cell_id", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    else:
        crossed = weather.crossJoin(F.broadcast(_grid_cells(cells, most)))
    return (
        crossed.withColumn("cell_index_x", cell_x("cell_id"))
        .withColumn("cell_index_y", cell_y("cell_id"))
    )


def _grid_cells(cells, most=GRID_CELLS):
    ids = cells.select(F.col("cell_id").cast("int").alias("cell_id"))
    return ids.filter(F.col("cell_id").between(0, most - 1)).distinct()


def known_cells(cells):
    """The different cells of a table, stored: at most the grid's cells."""
    return stored(_grid_cells(cells), "cells")


def _unit_vector(lat, lon):
    phi, theta = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi)


def _squared_chord(a, b):
    return sum(((p - q) * (p - q) for p, q in zip(a[1:], b[1:])), (a[0] - b[0]) * (a[0] - b[0]))


class _Squares:
    """Squares around the globe, ``parts`` of them to the radius.

    Points within the radius of each other are at most ``parts`` squares apart
    in both directions, so an equi-join over that neighbourhood finds all of
    them. ``half`` bounds the chord from the centre of a square to its points.
    """

    def __init__(self, radius_miles, most_lat, parts):
        self.parts = parts
        reach = degrees(radius_miles / EARTH_MILES)
        ratio = min(1.0, sin(radians(reach) / 2) / cos(radians(min(89.9, most_lat + reach))))
        self.height = reach / parts * 1.000001
        self.columns = max(1, int(360.0 // (degrees(2 * asin(ratio)) / parts * 1.000001)))
        self.width = 360.0 / self.columns
        self.half = radians(hypot(self.height, self.width)) / 2

    def finer(self, cuts):
        """The same squares, each cut that many times into four."""
        fine = copy(self)
        fine.height, fine.width = self.height / 2 ** cuts, self.width / 2 ** cuts
        fine.columns, fine.half = self.columns * 2 ** cuts, self.half / 2 ** cuts
        return fine

    def row(self, lat):
        return F.floor(lat / self.height)

    def column(self, lon):
        return F.pmod(F.floor(lon / self.width), F.lit(self.columns))

    def neighbours(self, lat, lon):
        steps = F.sequence(F.lit(-self.parts), F.lit(self.parts))
        rows = F.transform(steps, lambda d: self.row(lat) + d)
        columns = F.array_distinct(F.transform(
            steps, lambda d: F.pmod(F.floor(lon / self.width) + d, F.lit(self.columns))))
        return rows, columns

    def center(self, row, column):
        return (row + 0.5) * self.height, (column + 0.5) * self.width


def _placed(zips, squares):
    """Centroids as unit vectors, once per square they may be in reach of."""
    rows, columns = squares.neighbours(F.col("lat"), F.col("lon"))
    x, y, z = _unit_vector(F.col("lat"), F.col("lon"))
    return (
        zips.select("zip", x.alias("x"), y.alias("y"), z.alias("z"),
                    F.explode(rows).alias("_row"), columns.alias("_columns"))
        .withColumn("_column", F.explode("_columns")).drop("_columns")
    )


def _rivals(placed, squares, reach):
    """Per square, the centroids that are nearest to some point of it.

    By the triangle inequality a centroid can be left out if it is further
    from the centre of the square than the closest one by more than twice the
    half size of the square, or out of reach by more than the half size.
    """
    spread = squares.half * 1.000001
    center = _unit_vector(*squares.center(F.col("_row"), F.col("_column")))
    off = F.sqrt(_squared_chord(center, (F.col("x"), F.col("y"), F.col("z"))))
    return (
        placed.withColumn("_off", off).filter(F.col("_off") <= reach + spread)
        .groupBy("_row", "_column")
        .agg(F.min("_off").alias("_least"),
             F.collect_list(F.struct("zip", "x", "y", "z", "_off")).alias("_near"))
        .select("_row", "_column", F.sort_array(F.filter(
            "_near", lambda c: c["_off"] <= F.col("_least") + 2 * spread)).alias("_near"))
    )


def _nearest_in_array(matched, unrolled=8):
    """The struct (_d, zip) of the nearest entry of the array ``_near``.

    Most arrays are short. Their first entries are compared by plain columns,
    which become generated code; an array function, which is interpreted,
    looks at the entries after those. Entries are in zip order, so the first
    of equally near ones has the smallest zip.
    """
    spot = (F.col("_x"), F.col("_y"), F.col("_z"))
    far = F.lit(float("inf"))

    def distance(c):
        return F.coalesce(_squared_chord(spot, (c["x"], c["y"], c["z"])), far)

    entries = [F.get("_near", F.lit(i)) for i in range(unrolled)]
    rest = F.slice("_near", unrolled + 1, F.greatest(F.size("_near") - unrolled, F.lit(0)))
    later = F.when(F.size("_near") > unrolled, F.array_min(F.transform(
        rest, lambda c: F.struct(distance(c).alias("_d"), c["zip"].alias("zip")))))
    measured = matched.withColumns({
        **{f"_d{i}": distance(entry) for i, entry in enumerate(entries)}, "_later": later})
    least = F.least(*[F.col(f"_d{i}") for i in range(unrolled)])
    first = F.coalesce(*[
        F.when(F.col(f"_d{i}") == F.col("_least"), entry["zip"]) for i, entry in enumerate(entries)
    ])
    early = F.struct(F.col("_least").alias("_d"), first.alias("zip"))
    return measured.withColumn("_least", least).withColumn(
        "_best", F.when(F.col("_later").isNull() | (early <= F.col("_later")), early)
        .otherwise(F.col("_later")))


def _in_reach(placed, squares, reach):
    """Centroids per square that some point of it may have in reach, with their way to its centre."""
    center = _unit_vector(*squares.center(F.col("_row"), F.col("_column")))
    off = F.sqrt(_squared_chord(center, (F.col("x"), F.col("y"), F.col("z"))))
    return placed.withColumn("_off", off).filter(F.col("_off") <= reach + _spread(squares))


def _spread(squares):
    return squares.half * 1.000001 + 1e-12


def _quartered(placed):
    """Each square's centroids in each of its four parts."""
    two = F.array(F.lit(0), F.lit(1))
    return (
        placed.withColumn("_down", F.explode(two)).withColumn("_right", F.explode(two))
        .select("zip", "x", "y", "z", (F.col("_row") * 2 + F.col("_down")).alias("_row"),
                (F.col("_column") * 2 + F.col("_right")).alias("_column"))
    )


def _nearest_by_cutting(points, zips, squares, reach, lat, lon):
    """The different places of the points that have a centroid in reach, with its zip.

    Squares that hold many places and many rivals are cut into four, and again,
    and each part keeps those of its whole's rivals that may be nearest in it.
    So a centroid stands in a few squares of each size, and a place meets few
    rivals, however dense either lie. No square's rivals are gathered in one
    row unless they are few.
    """
    square, place = ["_row", "_column"], [lat, lon]
    x, y, z = _unit_vector(F.col(lat), F.col(lon))
    left = stored(points.select(lat, lon).dropna().distinct().select(
        lat, lon, x.alias("_x"), y.alias("_y"), z.alias("_z")), "places")
    # Of centroids at one place the smallest zip is the nearest.
    one_each = zips.groupBy("lat", "lon").agg(F.min(F.struct("zip"))["zip"].alias("zip"))
    placed, found = _placed(one_each, squares), []
    spot = (F.col("_x"), F.col("_y"), F.col("_z"))
    chord = _squared_chord(spot, (F.col("x"), F.col("y"), F.col("z")))
    for cuts in range(MOST_CUTS + 1):
        fine = squares.finer(cuts)
        where = {"_row": fine.row(F.col(lat)), "_column": fine.column(F.col(lon))}
        left = left.withColumns(where)
        held = left.groupBy(*square).agg(F.count("*").alias("_points"))
        near = stored(_in_reach(placed.join(held, square), fine, reach), "near")
        least = near.groupBy(*square).agg(F.min("_off").alias("_least"))
        rivals = near.join(least, square).filter(
            F.col("_off") <= F.col("_least") + 2 * _spread(fine)).drop("_off", "_least")
        rivals = stored(rivals, "rivals")
        sizes = stored(rivals.groupBy(*square).agg(
            F.first("_points").alias("_points"), F.count("*").alias("_rivals")), "sizes")
        rivals = rivals.drop("_points")
        few = F.col("_rivals") <= FEW_RIVALS
        many = ~few & (F.col("_points") > FEW_POINTS) & F.lit(cuts < MOST_CUTS)
        facts = sizes.agg(F.count_if(few).alias("few"), F.count_if(many).alias("many"),
                          F.count_if(~few & ~many).alias("rest")).first()

        if facts["few"] or not found:
            near = rivals.join(sizes.filter(few), square, "left_semi").groupBy(*square).agg(
                F.sort_array(F.collect_list(F.struct("zip", "x", "y", "z"))).alias("_near"))
            best = _nearest_in_array(left.join(near, square)).select(
                *place, F.explode(F.array("_best")).alias("_b"))
            found.append(stored(best.filter(F.col("_b._d") <= reach ** 2).select(
                *place, "_b.zip"), "nearest"))
        if facts["rest"]:
            met = rivals.join(sizes.filter(~few & ~many), square, "left_semi")
            met = left.join(met, square).withColumn("_d", chord)
            found.append(stored(met.filter(F.col("_d") <= reach ** 2).groupBy(*place).agg(
                F.min(F.struct("_d", "zip"))["zip"].alias("zip")), "nearest"))
        if not facts["many"]:
            break
        opened = sizes.filter(many)
        left = stored(left.join(opened, square, "left_semi").drop(*square), "places")
        placed = _quartered(rivals.join(opened, square, "left_semi"))
    return reduce(lambda a, b: a.union(b), found)


def nearest_zip(points, zips, radius_miles=1.0, lat="lat", lon="lon", most=BROADCAST_ROWS):
    """Points with the column ``zip``: the nearest centroid within the radius.

    Ties go to the smaller zip; without a centroid in reach the zip is
    "missing". ``zips`` has ``zip, lat, lon``. The map is cut into squares, as
    fine as ``most`` rows allow, and each square holds the centroids that may
    be nearest in it as an array. If a count shows that the zip table is
    small, the squares are broadcast and every point finds its zip in place:
    no shuffle and no row key. Beyond that the different coordinates are
    matched by ordinary joins over squares that are cut where they are full.
    """
    facts = zips.agg(F.count("*").alias("n"), F.max(F.abs("lat")).alias("lat")).first()
    fits = [p for p in (8, 4, 2, 1) if facts["n"] * (2 * p + 1) ** 2 <= most]
    squares = _Squares(radius_miles, facts["lat"] or 0.0, fits[0] if fits else 1)
    reach = 2 * sin(min(radius_miles / EARTH_MILES, pi) / 2)
    placed = _placed(zips, squares)
    where = {"_row": squares.row(F.col(lat)), "_column": squares.column(F.col(lon))}
    here = _unit_vector(F.col(lat), F.col(lon))
    columns = [c for c in points.columns if c != "zip"]

    if fits:
        matched = (
            points.select(*columns).withColumns(
                {**where, "_x": here[0], "_y": here[1], "_z": here[2]})
            .join(F.broadcast(_rivals(placed, squares, reach)), ["_row", "_column"], "left")
        )
        # Exploding the one result keeps later filters on the zip from moving
        # below this point, where each would search again.
        found = _nearest_in_array(matched).select(*columns, F.explode(F.array("_best")).alias("_b"))
        zip_code = F.when(F.col("_b._d") <= reach ** 2, F.col("_b.zip"))
        return found.select(*columns, F.coalesce(zip_code, F.lit(MISSING_ZIP)).alias("zip"))

    best = _nearest_by_cutting(points, zips, squares, reach, lat, lon)
    return points.select(*columns).join(best, [lat, lon], "left").select(
        *columns, F.coalesce("zip", F.lit(MISSING_ZIP)).alias("zip"))
