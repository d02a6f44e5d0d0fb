"""Record layouts and the fixed numbers of the grid."""

import json

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, MapType, StringType, StructField,
    StructType,
)

# The grid. The steps are computed, not typed in, because the
# longitude step is 0.0013999999999999772 in doubles and 0.0014 moves points.
LAT_SOUTH = 40.5
LAT_NORTH = 41.0
LON_WEST = -74.05
LON_EAST = -73.70
GRID_ROWS = 400
GRID_COLUMNS = 250
GRID_CELLS = GRID_ROWS * GRID_COLUMNS
LAT_STEP = (LAT_NORTH - LAT_SOUTH) / GRID_ROWS
LON_STEP = (LON_EAST - LON_WEST) / GRID_COLUMNS

# Bucket edges and the defaults of the popular-cell count.
TEMPERATURE_EDGES = (40.0, 55.0, 70.0, 85.0)
RAIN_EDGES = (0.1, 0.3)
WINDOW_MINUTES = 15
SLIDE_MINUTES = 5
POPULAR_COUNT = 20
RAIN_MINUTE = 51

RIDE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
WEATHER_TIME_FORMAT = "yyyy-MM-dd HH:mm"

MISSING_ZIP = "missing"

# Default trigger of streaming jobs; {"processingTime": "10 seconds"} runs on.
UNTIL_DONE = {"availableNow": True}


def _struct(*fields):
    return StructType([StructField(name, kind, True) for name, kind in fields])


RAW_RIDE = _struct(
    ("pickup_datetime", StringType()),
    ("pickup_latitude", DoubleType()),
    ("pickup_longitude", DoubleType()),
)

CELLED_RIDE = _struct(
    ("pickup_datetime", StringType()),
    ("pickup_latitude", DoubleType()),
    ("pickup_longitude", DoubleType()),
    ("pickup_cellid", IntegerType()),
)

CELL_COUNT = _struct(
    ("datetime", StringType()),
    ("cell_id", IntegerType()),
    ("count", LongType()),
)

WEATHER_REPORT = _struct(
    ("datetime", StringType()),
    ("fahrenheit", DoubleType()),
    ("precip_in", DoubleType()),
)

REJECTED = _struct(
    ("reason", StringType()),
    ("value", StringType()),
    ("partition", StringType()),
    ("offset", LongType()),
)

DOCUMENT = _struct(
    ("time", StringType()),
    ("location", StringType()),
    ("cnt", LongType()),
)

# The 18 columns of a ride file, in file order.
RIDE_FILE = _struct(
    ("vendor_id", StringType()),
    ("pickup_datetime", StringType()),
    ("dropoff_datetime", StringType()),
    ("passenger_count", IntegerType()),
    ("trip_distance", DoubleType()),
    ("pickup_longitude", DoubleType()),
    ("pickup_latitude", DoubleType()),
    ("rate_code", IntegerType()),
    ("store_and_fwd_flag", StringType()),
    ("dropoff_longitude", DoubleType()),
    ("dropoff_latitude", DoubleType()),
    ("payment_type", StringType()),
    ("fare_amount", DoubleType()),
    ("surcharge", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("total_amount", DoubleType()),
)

# A weather file by position; only positions 1, 2 and 4 are used.
WEATHER_FILE = _struct(
    ("station", StringType()),
    ("valid", StringType()),
    ("tmpf", DoubleType()),
    ("unused_3", StringType()),
    ("p01i", DoubleType()),
)

# The fields of a reverse geocoder's answer.
REVERSE_GEOCODE = _struct(
    ("place_id", IntegerType()),
    ("licence", StringType()),
    ("osm_type", StringType()),
    ("osm_id", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("display_name", StringType()),
    ("address", MapType(StringType(), StringType())),
)


def avro_schema(struct, name="record"):
    """Avro record with the fields of a flat struct, none of them nullable."""
    kinds = {"integer": "int", "long": "long", "double": "double", "string": "string"}
    fields = [{"name": f.name, "type": kinds[f.dataType.typeName()]} for f in struct.fields]
    return json.dumps({"type": "record", "name": name, "fields": fields})
