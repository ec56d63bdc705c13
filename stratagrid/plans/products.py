"""Derived data products: the tables behind maps, curves and three-dimensional views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bits, geo, grid_udfs
from ..operators import joins


def cell_map(cells: DataFrame, column: str = "elevation_mean") -> DataFrame:
    """(h3_cell, lat, lon, value) at cell centres."""
    return cells.withColumn("_at", grid_udfs.cell_to_latlng(F.col("h3_cell"))).select("h3_cell", F.col("_at.lat").alias("lat"), F.col("_at.lng").alias("lon"), F.col(column).alias("value"))


def polygons(cells: DataFrame) -> DataFrame:
    """(h3_cell, p, e): outlines as [lon, lat] pairs rounded to 5 places, and the mean elevation to 1."""
    outline = F.transform(grid_udfs.cell_to_boundary(F.col("h3_cell")), lambda v: F.array(F.bround(v["lng"], 5), F.bround(v["lat"], 5)))
    return cells.select("h3_cell", outline.alias("p"), F.bround(F.col("elevation_mean").cast("double"), 1).alias("e"))


#: Outlines of one view.
VIEW = 200_000


def polygons_json(polys: DataFrame, at_most: int = VIEW) -> DataFrame:
    """One row of JSON, [{"p": ..., "e": ...}, ...] in order of cells: a view's data, of a region's size. More rows than
    at_most raise an error; write_polygons takes any number."""
    if polys.limit(at_most + 1).count() > at_most:
        raise ValueError(f"more than {at_most} outlines for one row; use write_polygons")
    rows = F.array_sort(F.collect_list(F.struct("h3_cell", "p", "e")))
    return polys.agg(rows.alias("r")).select(F.to_json(F.transform("r", lambda x: F.struct(x["p"].alias("p"), x["e"].alias("e")))).alias("json"))


def write_polygons(polys: DataFrame, path: str) -> None:
    """Files of JSON rows, {"p": ..., "e": ...}, in order of cells."""
    polys.repartitionByRange("h3_cell").sortWithinPartitions("h3_cell").select("p", "e").write.mode("overwrite").json(path)


def columns_3d(cells: DataFrame, lat0: float, lon0: float, floor_below: float = 40.0) -> DataFrame:
    """Faces of cells extruded from a common floor to their elevation: (h3_cell, kind, shade, face). A top face, and a wall
    for each side; walls have 0.62 of the top's shade. shade is the elevation's place between the lowest and highest."""
    range_ = cells.agg(F.min("elevation_mean").alias("lo"), F.max("elevation_mean").alias("hi"))
    flat = F.transform(grid_udfs.cell_to_boundary(F.col("h3_cell")), lambda v: geo.local_metres(v["lat"], v["lng"], F.lit(lat0), F.lit(lon0)))
    placed = cells.select("h3_cell", F.col("elevation_mean").cast("double").alias("e"), flat.alias("xy")).crossJoin(range_)
    shade = geo.normalise(F.col("e"), F.col("lo").cast("double"), F.col("hi").cast("double"))
    z0 = F.col("lo").cast("double") - floor_below
    point = lambda p, z: F.struct(p["x"].alias("x"), p["y"].alias("y"), z.alias("z"))
    top = F.array(F.struct(F.lit("top").alias("kind"), shade.alias("shade"), F.transform("xy", lambda p: point(p, F.col("e"))).alias("face")))
    walls = F.transform(geo.edges(F.col("xy")), lambda s: F.struct(F.lit("wall").alias("kind"), (shade * 0.62).alias("shade"), F.array(point(s["a"], z0), point(s["b"], z0), point(s["b"], F.col("e")), point(s["a"], F.col("e"))).alias("face")))
    return placed.select("h3_cell", F.explode(F.concat(top, walls)).alias("f")).select("h3_cell", "f.*")


def descendants(parents: DataFrame, cells: DataFrame, from_res: int, res: int) -> DataFrame:
    """Cells of a resolution below the parents (h3_cell), with their elevation; those without land have none and are left out."""
    below = parents.select(F.explode(bits.children(F.col("h3_cell"), from_res, res)).alias("h3_cell"))
    return joins.bulk_join(below, cells.select("h3_cell", "elevation_mean", *(["base"] if "base" in cells.columns else [])))


def ring_descendants(spark: SparkSession, lat: float, lon: float, cells: DataFrame, ring: int = 1, from_res: int = 4, res: int = 8) -> DataFrame:
    """As descendants() of the disk around a place."""
    from ..functions import grid

    around = grid.grid_disk(int(grid.latlng_to_cell([lat], [lon], from_res)[0]), ring)
    return descendants(spark.createDataFrame([(c,) for c in around], "h3_cell long"), cells, from_res, res)


def regular_grid(spark: SparkSession, step: float = 1.0) -> DataFrame:
    """Points of a regular grid, rows from -89.5 to 89.5 and columns from -180 to 180: (i, j, lat, lon)."""
    rows, cols = int(179.0 / step + 1e-9) + 1, int(360.0 / step + 1e-9) + 1
    i, j = spark.range(rows).select(F.col("id").cast("int").alias("i")), spark.range(cols).select(F.col("id").cast("int").alias("j"))
    return i.crossJoin(j).select("i", "j", (F.col("i") * step - 89.5).alias("lat"), (F.col("j") * step - 180.0).alias("lon"))


def geoid_json(sampled: DataFrame, column: str = "value", at_most: int = 1_000_000) -> DataFrame:
    """One row: the rounded samples row by row as a JSON array, and their range. A grid of a degree has 64,980 samples;
    more than at_most raise an error."""
    if sampled.limit(at_most + 1).count() > at_most:
        raise ValueError(f"more than {at_most} samples for one row")
    rows = F.array_sort(F.collect_list(F.struct("i", "j", F.rint(column).cast("int").alias("n"))))
    return sampled.agg(rows.alias("r"), F.min(column).cast("int").alias("low"), F.max(column).cast("int").alias("high")).select(F.to_json(F.transform("r", lambda x: x["n"])).alias("json"), "low", "high")


def geoid_sphere(sampled: DataFrame, column: str = "value", exaggeration: float = 8000.0) -> DataFrame:
    """Points of a sphere displaced by the geoid, with the light on them."""
    r = geo.geoid_radius(F.col(column), exaggeration)
    at = sampled.withColumn("_p", geo.sphere(F.col("lat"), F.col("lon"), r)).withColumn("_r", r)
    light = geo.illumination(F.col("_p.x") / F.col("_r"), F.col("_p.y") / F.col("_r"), F.col("_p.z") / F.col("_r"))
    return at.select("lat", "lon", "_p.x", "_p.y", "_p.z", light.alias("light"))


def relief(cells: DataFrame, sites: DataFrame, low: float = -200.0, high: float = 3500.0) -> tuple[DataFrame, DataFrame]:
    """(points, spots): cells with their centres (h3_cell, lat, lon, elevation_mean, pixel_count), elevations held within
    the scale's range as shade from 0 to 1, and the sites' weighted means with their verdicts."""
    placed = cells if "lat" in cells.columns else cells.withColumn("_at", grid_udfs.cell_to_latlng(F.col("h3_cell"))).withColumn("lat", F.col("_at.lat")).withColumn("lon", F.col("_at.lng"))
    held = F.greatest(F.lit(low), F.least(F.lit(high), F.col("elevation_mean").cast("double")))
    points = placed.select("h3_cell", "lat", "lon", "elevation_mean", "pixel_count", geo.normalise(held, F.lit(low), F.lit(high)).alias("shade"))
    return points, joins.weighted_regions(sites, placed)


def boomerang(frames: int) -> list[int]:
    """Frame numbers there and back."""
    return [*range(frames), *range(frames - 2, 0, -1)]
