"""Geometry and colour arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRES_LAT, METRES_LNG = 110540.0, 111320.0
EARTH_RADIUS = 6371000.0


def above_ground(ellipsoidal: Column, ground: Column, undulation: Column) -> Column:
    """Height above ground of an ellipsoidal height, over a mean elevation and the geoid."""
    return ellipsoidal - ground - undulation


def undulation(ellipsoidal: Column, orthometric: Column) -> Column:
    """The geoid's height above the ellipsoid: an ellipsoidal height less the height above sea level at the same place."""
    return ellipsoidal - orthometric


def valid_elevation(elev: Column, nodata: Column | float | None = None) -> Column:
    """Finite and not the nodata value."""
    good = elev.isNotNull() & ~F.isnan(elev) & (F.abs(elev) != float("inf"))
    if nodata is None:
        return good
    nodata = F.lit(float(nodata)) if isinstance(nodata, (int, float)) else nodata
    return good & (nodata.isNull() | (elev != nodata))


def pixel_centre(origin: Column, step: Column, index: Column) -> Column:
    return origin + (index + 0.5) * step


def sphere(lat: Column, lng: Column, radius: Column) -> Column:
    """(x, y, z) of a point at a distance from the centre."""
    la, lo = F.radians(lat), F.radians(lng)
    return F.struct((radius * F.cos(la) * F.cos(lo)).alias("x"), (radius * F.cos(la) * F.sin(lo)).alias("y"), (radius * F.sin(la)).alias("z"))


def geoid_radius(undulation: Column, exaggeration: float = 8000.0) -> Column:
    return 1.0 + undulation * exaggeration / EARTH_RADIUS


def illumination(x: Column, y: Column, z: Column, light: tuple[float, float, float] = (0.55, 0.3, 0.78)) -> Column:
    """Diffuse light on a unit normal, 0 to 1."""
    n = sum(v * v for v in light) ** 0.5
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x * (light[0] / n) + y * (light[1] / n) + z * (light[2] / n)))


def local_metres(lat: Column, lng: Column, lat0: Column, lng0: Column) -> Column:
    """(x, y) in metres from a nearby origin, equirectangular."""
    return F.struct(((lng - lng0) * METRES_LNG * F.cos(F.radians(lat0))).alias("x"), ((lat - lat0) * METRES_LAT).alias("y"))


def camera_angles(x: Column, y: Column, z: Column) -> Column:
    """(lat, lng) in degrees at which a camera at (x, y, z) looks onto the sphere's middle."""
    r = F.sqrt(x * x + y * y + z * z)
    return F.struct(F.degrees(F.asin(z / r)).alias("lat"), F.degrees(F.atan2(y, x)).alias("lng"))


def normalise(value: Column, low: Column, high: Column) -> Column:
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))


def colour_ramp(t: Column, stops: list[tuple[float, float, float]]) -> Column:
    """A colour between equally spaced stops, piecewise linear, for t from 0 to 1."""
    n = len(stops) - 1
    at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)) * n
    i = F.least(F.floor(at), F.lit(n - 1)).cast("int")
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in stops])
    return F.array(*[F.element_at(F.element_at(rows, i + 1), k) + (at - i) * (F.element_at(F.element_at(rows, i + 2), k) - F.element_at(F.element_at(rows, i + 1), k)) for k in (1, 2, 3)])


def edges(polygon: Column) -> Column:
    """Pairs of consecutive corners of an outline, the last with the first."""
    n = F.size(polygon)
    return F.transform(polygon, lambda p, i: F.struct(p.alias("a"), F.element_at(polygon, F.pmod(i + 1, n) + 1).alias("b")))
