"""Columns over coordinates and grid cells."""

from pyspark.sql import functions as F

from ridecells.schemas import (
    GRID_COLUMNS, LAT_NORTH, LAT_SOUTH, LAT_STEP, LON_EAST, LON_STEP, LON_WEST,
)


def inside_box(lat, lon):
    """Strictly inside the box; null for null. A filter on it reaches the scan."""
    lat, lon = F.col(lat), F.col(lon)
    return (lat > LAT_SOUTH) & (lat < LAT_NORTH) & (lon > LON_WEST) & (lon < LON_EAST)


def in_box(lat, lon):
    """True strictly inside the box; false for null and NaN."""
    return F.coalesce(inside_box(lat, lon), F.lit(False))


def bad_coordinate(lat, lon):
    """True when either coordinate is zero."""
    return F.col(lat).eqNullSafe(0.0) | F.col(lon).eqNullSafe(0.0)


def grid_cell(lat, lon):
    """Cell id counted from the north-west corner, row by row southwards.

    Null outside the box.
    """
    row = F.floor((F.lit(LAT_NORTH) - F.col(lat)) / LAT_STEP)
    column = F.floor((F.col(lon) - LON_WEST) / LON_STEP)
    return F.when(inside_box(lat, lon), (row * GRID_COLUMNS + column).cast("int"))


def cell_x(cell_id):
    return (F.col(cell_id) % GRID_COLUMNS).cast("int")


def cell_y(cell_id):
    return F.floor(F.col(cell_id) / GRID_COLUMNS).cast("int")


def cell_index(cell_id):
    """Struct (x, y) of a cell id."""
    return F.struct(cell_x(cell_id).alias("x"), cell_y(cell_id).alias("y"))


def cell_from_index(x, y):
    return (F.col(y) * GRID_COLUMNS + F.col(x)).cast("int")


def cell_center_lat(cell_id):
    return F.lit(LAT_NORTH) - cell_y(cell_id) * LAT_STEP - LAT_STEP / 2


def cell_center_lon(cell_id):
    return -(F.lit(abs(LON_WEST)) - cell_x(cell_id) * LON_STEP - LON_STEP / 2)


def lat_lon_text(lat, lon):
    """The text "lat,lon"."""
    return F.concat_ws(",", lat.cast("string"), lon.cast("string"))
