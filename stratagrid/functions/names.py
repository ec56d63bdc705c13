"""Names of tiles and latitude bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: the format of the elevation tiles' names.
TILE = r"Copernicus_DSM_COG_10_([NS])(\d+)_00_([EW])(\d+)_00_DEM"


def tile_name(lat: Column, lng: Column) -> Column:
    """The name of the one-degree tile that holds a point: its south-west corner, signs as letters."""
    south, west = F.floor(lat).cast("int"), F.floor(lng).cast("int")
    part = lambda x, plus, minus, width: F.concat(F.when(x >= 0, F.lit(plus)).otherwise(F.lit(minus)), F.lpad(F.abs(x).cast("string"), width, "0"))
    return F.concat(F.lit("Copernicus_DSM_COG_10_"), part(south, "N", "S", 2), F.lit("_00_"), part(west, "E", "W", 3), F.lit("_00_DEM"))


def tile_corner(name: Column) -> Column:
    """(lat, lon) of a tile's south-west corner; null of names that aren't a tile's."""
    part = lambda letter, number, minus: F.regexp_extract(name, TILE, number).cast("int") * F.when(F.regexp_extract(name, TILE, letter) == minus, -1).otherwise(1)
    return F.when(name.rlike(TILE), F.struct(part(1, 2, "S").alias("lat"), part(3, 4, "W").alias("lon")))


def _signed(x: Column) -> Column:
    return F.concat(F.when(x >= 0, F.lit("+")).otherwise(F.lit("-")), F.abs(x).cast("string"))


def band_label(lat: Column) -> Column:
    """lat_<north edge>_<south edge> of the band whose south edge is lat, with signs."""
    return F.concat(F.lit("lat_"), _signed(lat + 1), F.lit("_"), _signed(lat))


def band_of_key(key: Column) -> Column:
    """The band of an object's key, v1/<band>/...; null of other keys."""
    found = F.regexp_extract(key, r"^v1/([^/]+)/", 1)
    return F.when(found != "", found)


def res1_of_path(path: Column) -> Column:
    found = F.regexp_extract(path, r"r1=(\d+)", 1)
    return F.when(found != "", found.cast("long"))
