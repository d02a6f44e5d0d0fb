"""Columns over text and JSON."""

from pyspark.sql import functions as F

from ridecells.functions.grid import cell_center_lat, cell_center_lon, lat_lon_text
from ridecells.schemas import REVERSE_GEOCODE


def hour_prefix(text):
    """First 13 characters with every run of blanks replaced by one dash."""
    return F.regexp_replace(F.substring(F.col(text), 1, 13), r"\s+", "-")


def cell_document(time, cell_id, count):
    """Index document {time, location, cnt} with the centre of the cell."""
    location = lat_lon_text(cell_center_lat(cell_id), cell_center_lon(cell_id))
    return F.to_json(F.struct(
        F.col(time).alias("time"), location.alias("location"), F.col(count).alias("cnt"),
    ))


def postcode(reverse_geocode_json):
    """``address.postcode`` of a reverse-geocoding answer."""
    return F.from_json(F.col(reverse_geocode_json), REVERSE_GEOCODE)["address"]["postcode"]


def reverse_geocode_url(host, port, lat, lon):
    return F.concat(
        F.lit(f"http://{host}:{port}/reverse.php?format=json&lat="), F.col(lat).cast("string"),
        F.lit("&lon="), F.col(lon).cast("string"),
    )


def without_leading_blank(name):
    return name[1:] if name.startswith(" ") else name


def without_blanks(name):
    return name.replace(" ", "")
