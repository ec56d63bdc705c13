"""Queries of the grid operators over the general test tables, each with the same thing in SQL where SQL can say it."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import synth
from .functions import bits, geo, grid_udfs, names
from .operators import checks, joins, stats
from .plans import planning, products
from .sources import table, tiles

QUERIES: dict = {}
SQL: dict[str, str] = {}
PX, P = synth.PX, synth.sql_parent


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def at_res(spark: SparkSession, sf_dir: str, res: int) -> DataFrame:
    return synth.pixels(spark, sf_dir).withColumn("h3_cell", bits.parent(F.col("h3_cell"), res))


_PARTIAL = "count(*) AS count, sum(elev) AS sum, sum(elev * elev) AS sumsq, min(elev) AS min, max(elev) AS max"


# ---- statistics --------------------------------------------------------------------------------------------------


@query(f"WITH {PX} SELECT h3_cell, {_PARTIAL} FROM px GROUP BY h3_cell")
def partial_res9(spark, sf_dir):
    return stats.partial(synth.pixels(spark, sf_dir), "h3_cell")


@query(f"WITH {PX} SELECT res, h3_cell, {synth.STATS_SQL} FROM (SELECT res, h3_cell, {synth.AGG_SQL} FROM (" + " UNION ALL ".join(f"SELECT {r} AS res, {P('h3_cell', r)} AS h3_cell, elev FROM px" for r in range(2, 10)) + ") GROUP BY 1, 2)")
def multi_res_stats(spark, sf_dir):
    return stats.pyramid(synth.pixels(spark, sf_dir).select("h3_cell", "elev"), tuple(range(2, 10)))


@query(f"WITH {PX} SELECT h3_cell, {synth.STATS_SQL} FROM (SELECT {P('h3_cell', 5)} AS h3_cell, {synth.AGG_SQL} FROM px GROUP BY 1)")
def finalize_stats(spark, sf_dir):
    return stats.aggregate(at_res(spark, sf_dir, 5), "h3_cell")


@query(f"WITH {PX} SELECT h3_cell, {_PARTIAL} FROM px GROUP BY h3_cell")
def merge_partials(spark, sf_dir):
    return stats.merge(stats.partial(synth.pixels(spark, sf_dir), "lat_band", "h3_cell"), "h3_cell")


@query("SELECT CAST(0 AS BIGINT) AS differences")
def merge_exactness(spark, sf_dir):
    px = synth.pixels(spark, sf_dir)
    merged = stats.merge(stats.partial(px, "lat_band", "h3_cell"), "h3_cell")
    return stats.differences(merged, stats.partial(px, "h3_cell"), "h3_cell").agg(F.count(F.lit(1)).alias("differences"))


_BANDS = f"""{PX}, bands AS (SELECT lat_band, h3_cell, {synth.STATS_SQL} FROM (SELECT lat_band, {P('h3_cell', 3)} AS h3_cell, {synth.AGG_SQL} FROM px GROUP BY 1, 2))"""


@query(f"""WITH {_BANDS} SELECT h3_cell, max(elevation_max) AS elevation_max, min(elevation_min) AS elevation_min, CAST(sum(pixel_count) AS BIGINT) AS pixel_count,
  round(sum(CAST(elevation_mean AS DOUBLE) * pixel_count) / sum(pixel_count), 3) AS mean FROM bands GROUP BY h3_cell""")
def boundary_merge(spark, sf_dir):
    bands = stats.aggregate(at_res(spark, sf_dir, 3), "lat_band", "h3_cell")
    merged = stats.boundary_merge(bands, "h3_cell")
    weighted = bands.groupBy("h3_cell").agg(F.round(F.sum(F.col("elevation_mean").cast("double") * F.col("pixel_count")) / F.sum("pixel_count"), 3).alias("mean"))
    return merged.join(weighted, "h3_cell").select("h3_cell", "elevation_max", "elevation_min", "pixel_count", "mean")


@query(f"""WITH {_BANDS}, m AS (SELECT h3_cell, sum(pixel_count) AS n, sum(CAST(elevation_mean AS DOUBLE) * pixel_count) / sum(pixel_count) AS a,
  sum((CAST(elevation_stddev AS DOUBLE) * elevation_stddev + CAST(elevation_mean AS DOUBLE) * elevation_mean) * pixel_count) / sum(pixel_count) AS q FROM bands GROUP BY h3_cell)
  SELECT h3_cell, round(sqrt(greatest(q - a * a, 0.0)), 1) AS deviation FROM m""")
def boundary_merge_deviation(spark, sf_dir):
    merged = stats.boundary_merge(stats.aggregate(at_res(spark, sf_dir, 3), "lat_band", "h3_cell"), "h3_cell")
    return merged.select("h3_cell", F.round(F.col("elevation_stddev").cast("double"), 1).alias("deviation"))


@query(f"WITH {_BANDS} SELECT count(*) AS rows_in, count(DISTINCT h3_cell) AS rows_out, count(*) - count(DISTINCT h3_cell) AS merged FROM bands")
def merged_rows(spark, sf_dir):
    bands = stats.aggregate(at_res(spark, sf_dir, 3), "lat_band", "h3_cell")
    return stats.merged_rows(bands, stats.boundary_merge(bands, "h3_cell"))


@query(f"WITH {PX} SELECT h3_cell, count(DISTINCT lat_band) AS parts FROM px GROUP BY h3_cell HAVING count(DISTINCT lat_band) > 1")
def straddle_cells(spark, sf_dir):
    return stats.straddling(stats.partial(synth.pixels(spark, sf_dir), "lat_band", "h3_cell"), "lat_band")


@query(f"WITH {PX} SELECT {P('h3_cell', 4)} AS h3_cell, {_PARTIAL} FROM px GROUP BY 1")
def cell_parent_rollup(spark, sf_dir):
    return stats.rollup(stats.partial(synth.pixels(spark, sf_dir), "h3_cell"), 4)


@query(f"WITH {PX} SELECT {P('h3_cell', 6)} AS h3_cell, count(*) AS up_count, count(*) AS count, sum(elev) AS up_sum, sum(elev) AS sum, true AS same_count FROM px GROUP BY 1")
def cross_res_consistency(spark, sf_dir):
    return checks.cross_resolution(stats.partial(synth.pixels(spark, sf_dir), "h3_cell"), stats.partial(at_res(spark, sf_dir, 6), "h3_cell"), 6)


@query(f"""WITH {PX}, a AS (SELECT h3_cell, count(*) AS n, sum(elev) AS s FROM px WHERE lat_band = 1 GROUP BY 1), b AS (SELECT h3_cell, count(*) AS n, sum(elev) AS s FROM px GROUP BY 1)
  SELECT count(*) AS keys, count(b.n) AS found, max(abs(a.n - b.n)) AS max_count_diff, max(abs(a.s - b.s)) AS max_sum_diff, count(*) FILTER (WHERE b.n > a.n) AS gained FROM a LEFT JOIN b USING (h3_cell)""")
def aligned_compare(spark, sf_dir):
    px = synth.pixels(spark, sf_dir)
    return stats.aligned(stats.partial(px.filter("lat_band = 1"), "h3_cell"), stats.partial(px, "h3_cell"), "h3_cell")


@query(f"WITH {PX} SELECT lat_band, h3_cell, {_PARTIAL} FROM px GROUP BY 1, 2")
def union_partials(spark, sf_dir):
    px = synth.pixels(spark, sf_dir)
    parts = [stats.partial(px.filter(F.col("lat_band") == b), "lat_band", "h3_cell") for b in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- ids ---------------------------------------------------------------------------------------------------------

_LEAD = "CASE " + " ".join(f"WHEN (h3_cell >> {45 - 3 * r}) & 7 <> 0 THEN (h3_cell >> {45 - 3 * r}) & 7" for r in range(1, 10)) + " ELSE 0 END"


@query(f"""WITH {PX} SELECT DISTINCT h3_cell, (h3_cell >> 45) & 127 AS base, (h3_cell >> 52) & 15 AS res, lower(to_hex(h3_cell)) AS hex,
  NOT ((h3_cell >> 45) & 127 IN {bits.PENTAGON_BASES} AND {_LEAD} = 1) AS valid FROM px""")
def cell_bits(spark, sf_dir):
    cell = F.col("h3_cell")
    return synth.pixels(spark, sf_dir).select("h3_cell").distinct().select("h3_cell", bits.base_cell(cell).alias("base"), bits.resolution(cell).alias("res"), bits.to_hex(cell).alias("hex"), bits.is_valid(cell).alias("valid"))


_ONE = 1 << (45 - 9)


@query(f"""WITH {PX}, p AS (SELECT DISTINCT {P('h3_cell', 2)} AS c FROM px), k AS (SELECT c, ((c & {~((15 << 52) | (7 << 36))}) | {3 << 52}) + d.range * {_ONE} AS child, d.range AS d FROM p CROSS JOIN range(7) d)
  SELECT c AS h3_cell, child FROM k WHERE NOT (d = 1 AND (c >> 45) & 127 IN {bits.PENTAGON_BASES} AND (c >> 39) & 63 = 0)""")
def children_expand(spark, sf_dir):
    own = at_res(spark, sf_dir, 2).select("h3_cell").distinct()
    return own.select("h3_cell", F.explode(bits.children(F.col("h3_cell"), 2, 3)).alias("child"))


@query(f"WITH {PX} SELECT lower(to_hex(h3_cell)) AS hex, h3_cell FROM px GROUP BY h3_cell")
def hex_round_trip(spark, sf_dir):
    own = synth.pixels(spark, sf_dir).select(bits.to_hex(F.col("h3_cell")).alias("hex")).distinct()
    return own.select("hex", bits.from_hex(F.col("hex")).alias("h3_cell"))


@query(f"WITH {PX} SELECT DISTINCT CAST((h3_cell >> 45) & 127 AS BIGINT) AS base FROM px")
def distinct_shards(spark, sf_dir):
    return synth.pixels(spark, sf_dir).select(bits.base_cell(F.col("h3_cell")).alias("base")).distinct()


@query()
def latlng_to_cell(spark, sf_dir):
    px = synth.pixels(spark, sf_dir)
    return px.select("l_orderkey", "l_linenumber", "lat", "lon", grid_udfs.latlng_to_cell(F.col("lat"), F.col("lon"), 7).alias("h3_cell"))


@query()
def located_stats(spark, sf_dir):
    own = stats.located(synth.pixels(spark, sf_dir).select("lat", "lon", "elev"), tuple(range(2, 10)))
    return stats.aggregate(own, "res", "h3_cell")


@query()
def cell_centres(spark, sf_dir):
    return products.cell_map(stats.aggregate(stats.located(synth.pixels(spark, sf_dir).select("lat", "lon", "elev"), (5,)), "h3_cell"))


def _few_cells(spark, sf_dir, res: int) -> DataFrame:
    own = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("(c_custkey * 7919 % 168000) / 1000.0D - 84.0D AS lat", "(c_custkey * 6151 % 360000) / 1000.0D - 180.0D AS lon", "CAST(c_acctbal AS float) AS elevation_mean")
    return own.withColumn("h3_cell", grid_udfs.latlng_to_cell(F.col("lat"), F.col("lon"), res)).groupBy("h3_cell").agg(F.min("elevation_mean").alias("elevation_mean"))


@query()
def cell_boundary(spark, sf_dir):
    return products.polygons(_few_cells(spark, sf_dir, 5))


@query()
def cell_south(spark, sf_dir):
    return _few_cells(spark, sf_dir, 5).select("h3_cell", grid_udfs.cell_south(F.col("h3_cell")).alias("south"))


@query()
def grid_disk(spark, sf_dir):
    return _few_cells(spark, sf_dir, 5).select("h3_cell", F.explode(grid_udfs.grid_disk(F.col("h3_cell"), 1)).alias("around"))


_VALID = f"NOT ((h3_cell >> 45) & 127 IN {bits.PENTAGON_BASES} AND {_LEAD} = 1)"


def _cells_of(res: int) -> str:
    return f"SELECT DISTINCT {P('h3_cell', res)} AS h3_cell FROM px"


@query(f"WITH {PX}, c AS ({_cells_of(9)}) SELECT h3_cell, CASE WHEN {_VALID} THEN h3_cell END AS back, {_VALID} AS located FROM c")
def centre_round_trip(spark, sf_dir):
    """A cell's centre lies in it; ids that aren't cells have none."""
    at = synth.pixels(spark, sf_dir).select("h3_cell").distinct().withColumn("at", grid_udfs.cell_to_latlng(F.col("h3_cell")))
    return at.select("h3_cell", grid_udfs.latlng_to_cell(F.col("at.lat"), F.col("at.lng"), 9).alias("back"), F.col("at").isNotNull().alias("located"))


def _some_cells(spark, sf_dir) -> DataFrame:
    return at_res(spark, sf_dir, 2).select("h3_cell").unionByName(at_res(spark, sf_dir, 3).select("h3_cell")).distinct()


_SOME = f"c AS ({_cells_of(2)} UNION {_cells_of(3)})"
_FIVE = f"((h3_cell >> 45) & 127 IN {bits.PENTAGON_BASES} AND (h3_cell >> (45 - 3 * ((h3_cell >> 52) & 15))) & ((1 << CAST(3 * ((h3_cell >> 52) & 15) AS INT)) - 1) = 0)"


@query(f"WITH {PX}, {_SOME} SELECT h3_cell, true AS inside, true AS southmost, (h3_cell >> 52) & 15 AS res FROM c WHERE {_VALID}")
def outlines_hold(spark, sf_dir):
    """Each corner of an outline, moved a little toward the centre, lies in the cell; the southern extent is the least."""
    xyz = lambda p: [F.cos(F.radians(p["lat"])) * F.cos(F.radians(p["lng"])), F.cos(F.radians(p["lat"])) * F.sin(F.radians(p["lng"])), F.sin(F.radians(p["lat"]))]
    cell = F.col("h3_cell")
    own = _some_cells(spark, sf_dir).select(cell, grid_udfs.cell_to_latlng(cell).alias("m"), grid_udfs.cell_to_boundary(cell).alias("o"), grid_udfs.cell_south(cell).alias("south"))
    corner = own.select("h3_cell", "m", "south", F.array_min(F.transform("o", lambda p: p["lat"])).alias("low"), F.explode("o").alias("p"))
    x, y, z = (0.97 * a + 0.03 * b for a, b in zip(xyz(F.col("p")), xyz(F.col("m")), strict=True))
    moved = corner.select("h3_cell", "south", "low", F.degrees(F.atan2(z, F.sqrt(x * x + y * y))).alias("lat"), F.degrees(F.atan2(y, x)).alias("lng"), bits.resolution(cell).alias("res"))
    back = F.when(F.col("res") == 2, grid_udfs.latlng_to_cell(F.col("lat"), F.col("lng"), 2)).otherwise(grid_udfs.latlng_to_cell(F.col("lat"), F.col("lng"), 3))
    return moved.withColumn("back", back).groupBy("h3_cell", "res").agg(F.min(F.col("back") == cell).alias("inside"), F.min(F.abs(F.col("south") - F.col("low")) < 1e-9).alias("southmost")).select("h3_cell", "inside", "southmost", "res")


@query(f"WITH {PX}, {_SOME} SELECT h3_cell, CASE WHEN {_FIVE} THEN 6 ELSE 7 END AS held, true AS own, true AS mutual FROM c WHERE {_VALID}")
def disks_hold(spark, sf_dir):
    """A cell has six neighbours, a pentagon five, and is a neighbour of each."""
    disk = _some_cells(spark, sf_dir).withColumn("d", grid_udfs.grid_disk(F.col("h3_cell"), 1)).filter("d IS NOT NULL")
    each = disk.select("h3_cell", "d", F.explode("d").alias("n")).withColumn("back", grid_udfs.grid_disk(F.col("n"), 1))
    return each.groupBy("h3_cell").agg(F.count(F.lit(1)).cast("int").alias("held"), F.max(F.col("n") == F.col("h3_cell")).alias("own"), F.min(F.array_contains("back", F.col("h3_cell"))).alias("mutual"))


@query(f"WITH {PX}, {synth.cells_sql(3, 'cells')} SELECT h3_cell, round_even(CAST(elevation_mean AS DOUBLE), 1) AS e, true AS whole FROM cells WHERE {_VALID}")
def polygon_rows(spark, sf_dir):
    cells = synth.cells(spark, sf_dir, 3)
    corners = F.size("p")
    return products.polygons(cells).filter("p IS NOT NULL").select("h3_cell", "e", (corners.between(5, 10) & F.forall("p", lambda q: (F.abs(q[0]) <= 180) & (F.abs(q[1]) <= 90))).alias("whole"))


@query(f"WITH {PX}, {synth.cells_sql(3, 'cells')}, r AS (SELECT min(elevation_mean) AS lo, max(elevation_mean) AS hi FROM cells) SELECT h3_cell, CAST(1 AS BIGINT) AS tops, true AS walled, round((CAST(elevation_mean AS DOUBLE) - lo) / (CAST(hi AS DOUBLE) - lo), 9) AS shade FROM cells, r WHERE {_VALID}")
def column_faces(spark, sf_dir):
    """A column has a top, and a wall for each of its corners."""
    faces = products.columns_3d(synth.cells(spark, sf_dir, 3), 39.0, -106.0)
    top, wall = F.col("kind") == "top", F.col("kind") == "wall"
    return faces.groupBy("h3_cell").agg(F.count_if(top).alias("tops"), (F.count_if(wall) == F.max(F.when(top, F.size("face")))).alias("walled"), F.round(F.max(F.when(top, F.col("shade"))), 9).alias("shade"))


# ---- lookups and joins -------------------------------------------------------------------------------------------

_CELLS9 = f"{PX}, {synth.cells_sql(9, 'cells')}"


@query(f"WITH {_CELLS9}, k AS (SELECT min(h3_cell) AS c FROM cells) SELECT cells.* FROM cells JOIN k ON h3_cell = c")
def point_lookup(spark, sf_dir):
    cells = synth.cells(spark, sf_dir, 9)
    return cells.join(F.broadcast(cells.agg(F.min("h3_cell").alias("h3_cell"))), "h3_cell")


@query(f"WITH {_CELLS9}, {synth.POINTS} SELECT id, h3_cell, h_ellipsoidal, elevation_mean, pixel_count FROM points JOIN cells USING (h3_cell)")
def bulk_join(spark, sf_dir):
    return joins.bulk_join(synth.points(spark, sf_dir), synth.cells(spark, sf_dir, 9).select("h3_cell", "elevation_mean", "pixel_count"))


@query(f"WITH {_CELLS9}, {synth.POINTS} SELECT id, h3_cell, h_ellipsoidal, CAST(coalesce(elevation_mean, 0) AS FLOAT) AS elevation_mean FROM points LEFT JOIN cells USING (h3_cell)")
def ocean_default(spark, sf_dir):
    return joins.with_ocean(synth.points(spark, sf_dir), synth.cells(spark, sf_dir, 9))


@query(f"WITH {_CELLS9}, {synth.POINTS} SELECT id, h_ellipsoidal - CAST(elevation_mean AS DOUBLE) - CAST(geoid_undulation AS DOUBLE) AS agl FROM points JOIN cells USING (h3_cell)")
def agl(spark, sf_dir):
    return joins.above_ground(synth.points(spark, sf_dir), synth.cells(spark, sf_dir, 9)).select("id", "agl")


@query(f"WITH {_CELLS9} SELECT h3_cell, elevation_mean FROM cells WHERE elevation_mean > 3000")
def high_terrain(spark, sf_dir):
    return synth.cells(spark, sf_dir, 9).filter("elevation_mean > 3000").select("h3_cell", "elevation_mean")


@query(f"WITH {PX} SELECT l_orderkey, l_linenumber, lat, lon, elev FROM px WHERE lat BETWEEN 30 AND 45 AND lon BETWEEN -20 AND 40")
def bbox_filter(spark, sf_dir):
    return synth.pixels(spark, sf_dir).filter("lat BETWEEN 30 AND 45 AND lon BETWEEN -20 AND 40").select("l_orderkey", "l_linenumber", "lat", "lon", "elev")


@query(f"""WITH {PX}, m AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN 'nan'::DOUBLE WHEN l_orderkey % 11 = 0 THEN 'inf'::DOUBLE WHEN l_orderkey % 13 = 0 THEN -9999.0 ELSE elev END AS elev FROM px)
  SELECT * FROM m WHERE isfinite(elev) AND elev <> -9999.0""")
def nodata_mask(spark, sf_dir):
    odd = F.expr("CASE WHEN l_orderkey % 7 = 0 THEN double('NaN') WHEN l_orderkey % 11 = 0 THEN double('Infinity') WHEN l_orderkey % 13 = 0 THEN -9999.0D ELSE elev END")
    return synth.pixels(spark, sf_dir).select("l_orderkey", "l_linenumber", odd.alias("elev")).filter(geo.valid_elevation(F.col("elev"), -9999.0))


_MARKS = "marks AS (SELECT n_name AS name, n_nationkey * 7 - 84 + 0.5 AS lat, n_nationkey * 13 - 160 + 0.25 AS lon, n_nationkey * 100 AS lo, n_nationkey * 100 + 2000 AS hi FROM nation)"
_AT = "at_ AS (SELECT CAST(elev AS FLOAT) AS elevation_mean, CAST(l_linenumber % 4 AS BIGINT) AS pixel_count, lat, lon FROM px)"


@query(f"""WITH {PX}, {_MARKS}, {_AT}, f AS (SELECT name, sum(CAST(elevation_mean AS DOUBLE) * pixel_count) AS ew, sum(CAST(pixel_count AS DOUBLE)) AS w, avg(CAST(elevation_mean AS DOUBLE)) AS plain, count(*) AS cells
  FROM at_ a JOIN marks m ON abs(a.lat - m.lat) < 0.4 AND abs(a.lon - m.lon) < 0.4 GROUP BY name),
  v AS (SELECT m.name, lo, hi, coalesce(cells, 0) AS cells, CASE WHEN w > 0 THEN ew / w ELSE plain END AS value FROM marks m LEFT JOIN f USING (name))
  SELECT name, lo, hi, cells, round(value, 6) AS value, CASE WHEN value IS NULL THEN 'not yet processed' WHEN value >= lo - 250 AND value <= hi + 400 THEN 'OK' ELSE 'CHECK' END AS verdict FROM v""")
def weighted_region_mean(spark, sf_dir):
    marks = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_name AS name", "n_nationkey * 7 - 84 + 0.5D AS lat", "n_nationkey * 13 - 160 + 0.25D AS lon", "n_nationkey * 100 AS lo", "n_nationkey * 100 + 2000 AS hi")
    cells = synth.pixels(spark, sf_dir).selectExpr("CAST(elev AS float) AS elevation_mean", "CAST(l_linenumber % 4 AS bigint) AS pixel_count", "lat", "lon")
    return joins.weighted_regions(marks, cells).withColumn("value", F.round("value", 6))


_TAPS = """t AS (SELECT l_orderkey, l_linenumber, lat, lon, greatest(0.0, least(18.0, (lat - 95.0) / -10.0 - 0.5)) AS r, greatest(0.0, least(36.0, (lon + 185.0) / 10.0 - 0.5)) AS c FROM px),
  u AS (SELECT *, CAST(floor(r) AS INT) AS r0, CAST(floor(c) AS INT) AS c0, CAST(least(floor(r) + 1, 18) AS INT) AS r1, CAST(least(floor(c) + 1, 36) AS INT) AS c1, r - floor(r) AS fr, c - floor(c) AS fc FROM t)"""


@query(f"""WITH {PX}, {synth.GEOID_GRID}, {_TAPS} SELECT l_orderkey, l_linenumber,
  round((a.n * (1 - fc) + b.n * fc) * (1 - fr) + (d.n * (1 - fc) + e.n * fc) * fr, 6) AS n FROM u JOIN grid a ON a.row = r0 AND a.col = c0 JOIN grid b ON b.row = r0 AND b.col = c1 JOIN grid d ON d.row = r1 AND d.col = c0 JOIN grid e ON e.row = r1 AND e.col = c1""")
def geoid_bilinear(spark, sf_dir):
    out = joins.bilinear(synth.pixels(spark, sf_dir).select("l_orderkey", "l_linenumber", "lat", "lon"), synth.geoid_grid(spark), synth.GEOID_ORIGIN, 19, 37)
    return out.select("l_orderkey", "l_linenumber", F.round("value", 6).alias("n"))


@query(f"""WITH {PX}, {synth.GEOID_GRID}, {_TAPS} SELECT l_orderkey, l_linenumber,
  round(CAST(CAST((a.n * (1 - fc) + b.n * fc) * (1 - fr) + (d.n * (1 - fc) + e.n * fc) * fr AS FLOAT) AS DOUBLE), 3) + 0.0 AS n FROM u JOIN grid a ON a.row = r0 AND a.col = c0 JOIN grid b ON b.row = r0 AND b.col = c1 JOIN grid d ON d.row = r1 AND d.col = c0 JOIN grid e ON e.row = r1 AND e.col = c1""")
def geoid_sampled(spark, sf_dir):
    import numpy as np

    raster = np.array([[((r * 37 + c * 11) % 200) * 0.5 - 50.0 for c in range(37)] for r in range(19)])
    out = joins.sample_raster(synth.pixels(spark, sf_dir).select("l_orderkey", "l_linenumber", "lat", "lon"), raster, synth.GEOID_ORIGIN)
    return out.select("l_orderkey", "l_linenumber", (F.round(F.col("geoid_undulation").cast("double"), 3) + 0.0).alias("n"))


# Ids in the sixth that a pentagon of resolution 4 lacks aren't among its descendants.
@query(f"WITH {PX}, {synth.cells_sql(6, 'cells')} SELECT h3_cell, elevation_mean FROM cells WHERE NOT ((h3_cell >> 45) & 127 IN {bits.PENTAGON_BASES} AND {_LEAD} = 1 AND (h3_cell >> 33) & 4095 = 0)")
def descendants(spark, sf_dir):
    parents = at_res(spark, sf_dir, 4).select("h3_cell").distinct()
    return products.descendants(parents, synth.cells(spark, sf_dir, 6), 4, 6)


# ---- checks ------------------------------------------------------------------------------------------------------


def _all_cells(spark, sf_dir, resolutions=(2, 5, 9)) -> DataFrame:
    fanned = stats.fan_out(synth.pixels(spark, sf_dir).select("h3_cell", "elev"), resolutions)
    return synth.with_geoid(stats.aggregate(fanned, "res", "h3_cell"))


_ALL = f"{PX}, " + ", ".join(synth.cells_sql(r, f"c{r}") for r in (2, 5, 9)) + ", cells AS (" + " UNION ALL ".join(f"SELECT {r} AS res, * FROM c{r}" for r in (2, 5, 9)) + ")"


@query(f"""WITH {_ALL} SELECT res, count(*) AS cells, count(*) FILTER (WHERE CAST(elevation_min AS DOUBLE) > elevation_mean + 0.01 OR elevation_mean > CAST(elevation_max AS DOUBLE) + 0.01) AS bad_order,
  count(*) FILTER (WHERE elevation_stddev < 0 OR pixel_count < 1) AS bad_sign, count(*) FILTER (WHERE NOT isfinite(elevation_mean) OR NOT isfinite(geoid_undulation)) AS bad_value,
  count(*) FILTER (WHERE elevation_max > 8849 OR elevation_min < -432) AS bad_elevation, count(*) FILTER (WHERE geoid_undulation < -110 OR geoid_undulation > 90) AS bad_geoid,
  CAST(sum(pixel_count) AS BIGINT) AS pixels, min(elevation_min) AS lowest, max(elevation_max) AS highest FROM cells GROUP BY res""")
def invariants(spark, sf_dir):
    return checks.invariants(_all_cells(spark, sf_dir))


@query(f"WITH {_ALL} SELECT h3_cell, res FROM cells WHERE geoid_undulation > 80 OR elevation_max > 8800")
def violations(spark, sf_dir):
    cells = _all_cells(spark, sf_dir)
    shifted = cells.withColumn("elevation_max", F.when((F.col("geoid_undulation") > 80) | (F.col("elevation_max") > 8800), F.lit(9000.0)).otherwise(F.col("elevation_max")))
    return checks.violations(shifted).select("h3_cell", "res")


@query(f"WITH {_ALL}, t AS (SELECT res, CAST(sum(pixel_count) AS BIGINT) AS pixels FROM cells GROUP BY res) SELECT res, pixels, abs(pixels - b) / b::DOUBLE AS spread, true AS ok FROM t CROSS JOIN (SELECT pixels AS b FROM t WHERE res = 9)")
def conservation(spark, sf_dir):
    return checks.conservation(_all_cells(spark, sf_dir))


_SHARDED = f"{PX}, s AS (SELECT h3_cell, CASE WHEN h3_cell % 97 = 0 THEN 7 ELSE (h3_cell >> 45) & 127 END AS base FROM px)"


def _sharded(spark, sf_dir):
    return synth.pixels(spark, sf_dir).select("h3_cell", F.when(F.col("h3_cell") % 97 == 0, 7).otherwise(bits.base_cell(F.col("h3_cell"))).alias("base"))


@query(f"WITH {_SHARDED}, k AS (SELECT base FROM (SELECT base, row_number() OVER (ORDER BY CAST(base AS VARCHAR)) - 1 AS r FROM (SELECT DISTINCT base FROM s)) WHERE r % 10 = 0 AND r < 120) SELECT base, count(*) AS cells, count(*) FILTER (WHERE (h3_cell >> 45) & 127 <> base) AS misfiled FROM s JOIN k USING (base) GROUP BY base")
def systematic_sample(spark, sf_dir):
    return checks.shard_integrity(_sharded(spark, sf_dir))


@query(f"WITH {_SHARDED} SELECT base, count(*) AS cells, count(*) FILTER (WHERE (h3_cell >> 45) & 127 <> base) AS misfiled FROM s GROUP BY base")
def shard_integrity(spark, sf_dir):
    return checks.misfiled(_sharded(spark, sf_dir))


@query(f"WITH {PX}, u AS (SELECT 1 + l_linenumber % 3 AS res, h3_cell, count(*) AS n FROM px GROUP BY 1, 2) SELECT res, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS repeated FROM u GROUP BY res")
def uniqueness(spark, sf_dir):
    return checks.uniqueness(synth.pixels(spark, sf_dir).select(F.col("lat_band").alias("res"), "h3_cell"))


@query(f"WITH {PX} SELECT 9 AS res, count(*) AS cells, count(*) FILTER (WHERE (h3_cell >> 45) & 127 IN {bits.PENTAGON_BASES} AND {_LEAD} = 1) AS invalid, CAST(0 AS BIGINT) AS other_resolution FROM px")
def cell_validity(spark, sf_dir):
    return checks.cell_validity(synth.pixels(spark, sf_dir).select(F.lit(9).alias("res"), "h3_cell"))


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT round(avg(CAST(elevation_mean AS DOUBLE)), 6) AS mean, round(avg(CASE WHEN elevation_mean < 200 THEN 1.0 ELSE 0.0 END), 9) AS below_200, round(avg(CASE WHEN elevation_mean > 1000 THEN 1.0 ELSE 0.0 END), 9) AS above_1000, avg(CAST(elevation_mean AS DOUBLE)) BETWEEN 600 AND 1100 AS ok FROM cells")
def hypsographic(spark, sf_dir):
    out = checks.hypsographic(synth.cells(spark, sf_dir, 5))
    return out.select(F.round("mean", 6).alias("mean"), F.round("below_200", 9).alias("below_200"), F.round("above_1000", 9).alias("above_1000"), "ok")


@query(f"""WITH {PX}, {synth.cells_sql(5, 'cells')}, h AS (SELECT elevation_mean, count(*) AS cells FROM cells GROUP BY 1), n AS (SELECT sum(cells) AS n FROM h)
  SELECT elevation_mean, cells, round((sum(cells) OVER (ORDER BY elevation_mean DESC) - cells) * 100.0 / (n - 1), 9)::DOUBLE AS area_percent FROM h CROSS JOIN n""")
def hypsographic_curve(spark, sf_dir):
    return stats.hypsographic_curve(synth.cells(spark, sf_dir, 5)).withColumn("area_percent", F.round("area_percent", 9))


@query(f"""WITH {PX}, {synth.cells_sql(3, 'cells')}, k AS (SELECT n_name AS name, {synth._HEAD - (9 << 52) + (3 << 52) - ((1 << 18) - 1) + (1 << 36) - 1} + (n_nationkey * 5 % 122) * {1 << 45} AS c, n_nationkey * 300.0 AS expected, CASE WHEN n_nationkey % 2 = 0 THEN 'elevation_mean' ELSE 'elevation_max' END AS col FROM nation),
  v AS (SELECT name, col AS "column", CASE WHEN col = 'elevation_mean' THEN CAST(elevation_mean AS DOUBLE) ELSE CAST(elevation_max AS DOUBLE) END AS value, CAST(expected AS DOUBLE) AS expected, 2000.0::DOUBLE AS tol FROM k LEFT JOIN cells ON c = h3_cell)
  SELECT *, coalesce(abs(value - expected) <= tol, false) AS ok FROM v""")
def landmarks(spark, sf_dir):
    cell = synth._HEAD - (9 << 52) + (3 << 52) - ((1 << 18) - 1) + (1 << 36) - 1
    marks = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_name AS name", f"{cell} + (n_nationkey * 5 % 122) * {1 << 45} AS h3_cell", "n_nationkey * 300.0D AS expected", "if(n_nationkey % 2 = 0, 'elevation_mean', 'elevation_max') AS column", "2000.0D AS tol")
    return checks.landmarks(marks, synth.cells(spark, sf_dir, 3))


@query(f"""WITH {PX}, {synth.LAND}, own AS (SELECT CAST(floor(lat) AS INTEGER) AS lat, count(*) AS cells FROM px GROUP BY 1)
  SELECT lat, coalesce(cells, 0) AS cells, coalesce(cells, 0) * 0.5::DOUBLE AS cell_km2, coalesce(land_km2, 0.0) AS land_km2 FROM own FULL JOIN (SELECT lat_south AS lat, land_km2 FROM land) USING (lat)""")
def coverage(spark, sf_dir):
    land = synth.land(spark, sf_dir).select(F.col("lat_south").alias("lat"), "land_km2")
    return checks.coverage(synth.pixels(spark, sf_dir).select("lat"), land, 0.5)


@query(f"WITH {PX}, {synth.cells_sql(2, 'cells')} SELECT round(quantile_cont(CAST(elevation_mean AS DOUBLE), 0.05), 6) AS p5, round(median(CAST(elevation_mean AS DOUBLE)), 6) AS middle, min(elevation_mean) AS low, max(elevation_mean) AS high FROM cells")
def elevation_range(spark, sf_dir):
    e = F.col("elevation_mean").cast("double")
    return synth.cells(spark, sf_dir, 2).agg(F.round(F.percentile(e, F.lit(0.05)), 6).alias("p5"), F.round(F.median(e), 6).alias("middle"), F.min("elevation_mean").alias("low"), F.max("elevation_mean").alias("high"))


@query(f"""WITH {PX}, {synth.cells_sql(7, 'cells')}, own AS (SELECT {P('h3_cell', 7)} AS h3_cell, sum(elev) / count(*) AS m, count(*) AS n FROM px GROUP BY 1)
  SELECT h3_cell, round(abs(CAST(elevation_mean AS DOUBLE) - m), 6) AS difference, pixel_count = n AS same_count FROM cells JOIN own USING (h3_cell)""")
def ground_truth(spark, sf_dir):
    return checks.ground_truth(synth.cells(spark, sf_dir, 7), at_res(spark, sf_dir, 7)).withColumn("difference", F.round("difference", 6))


@query(f"WITH {_CELLS9} SELECT * FROM cells ORDER BY md5('0 ' || h3_cell), h3_cell LIMIT 100")
def random_cells(spark, sf_dir):
    return checks.random_cells(synth.cells(spark, sf_dir, 9), 100)


_BAD = ("bad_order", "bad_sign", "bad_value", "bad_elevation", "bad_geoid")
_SUITE = f"""{_ALL}, inv AS (SELECT res, count(*) AS cells, count(*) FILTER (WHERE CAST(elevation_min AS DOUBLE) > elevation_mean + 0.01 OR elevation_mean > CAST(elevation_max AS DOUBLE) + 0.01) AS bad_order,
    count(*) FILTER (WHERE elevation_stddev < 0 OR pixel_count < 1) AS bad_sign, count(*) FILTER (WHERE NOT isfinite(elevation_mean) OR NOT isfinite(geoid_undulation)) AS bad_value,
    count(*) FILTER (WHERE elevation_max > 8849 OR elevation_min < -432) AS bad_elevation, count(*) FILTER (WHERE geoid_undulation < -110 OR geoid_undulation > 90) AS bad_geoid, CAST(sum(pixel_count) AS BIGINT) AS pixels,
    count(*) FILTER (WHERE (h3_cell >> 45) & 127 IN {bits.PENTAGON_BASES} AND {_LEAD} = 1) AS invalid, count(*) - count(DISTINCT h3_cell) AS repeated FROM cells GROUP BY res),
  spread AS (SELECT res, pixels, abs(pixels - b) / b::DOUBLE AS spread FROM inv CROSS JOIN (SELECT pixels AS b FROM inv WHERE res = 9)),
  mean AS (SELECT avg(CAST(elevation_mean AS DOUBLE)) AS m FROM cells WHERE res = 5),
  suite AS (SELECT 'invariants' AS section, 'res' || res AS "check", format('{{:,}}', cells) || ' rows; {" ".join(f"{b}=' || {b} || '" for b in _BAD)}' AS detail, {" + ".join(_BAD)} = 0 AS ok FROM inv
    UNION ALL SELECT 'conservation', 'res' || res, pixels || ' pixels, spread ' || spread, spread <= 0.001 FROM spread
    UNION ALL SELECT 'cells', 'res' || res || ' validity', invalid || ' of ' || cells, invalid = 0 FROM inv
    UNION ALL SELECT 'cells', 'res' || res || ' uniqueness', repeated || ' repeated', repeated = 0 FROM inv
    UNION ALL SELECT 'hypsographic', 'mean land elevation', round(m, 0) || ' m', m BETWEEN 600 AND 1100 FROM mean)"""


@query(f"WITH {_SUITE} SELECT * FROM suite")
def validation_suite(spark, sf_dir):
    return checks.suite(_all_cells(spark, sf_dir))


@query(f"""WITH {_SUITE}, lines AS (SELECT '| ' || CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END || ' | ' || section || ' | ' || "check" || ' | ' || detail || ' |' AS line FROM suite)
  SELECT line FROM lines UNION ALL SELECT count(*) FILTER (WHERE ok) || ' of ' || count(*) || ' checks pass' FROM suite UNION ALL SELECT unnest(['', '| | section | check | detail |', '|-|-|-|-|'])""")
def report(spark, sf_dir):
    text = checks.report(checks.suite(_all_cells(spark, sf_dir)))
    return spark.createDataFrame([(line,) for line in text.rstrip("\n").split("\n")], "line string")


@query(f"WITH {_ALL} SELECT CAST(n_nationkey AS INT) AS res, CAST(n_nationkey * 100 AS BIGINT) AS expected, coalesce(cells, 0) AS cells, n_nationkey * 100 = coalesce(cells, 0) AS ok FROM nation LEFT JOIN (SELECT res, count(*) AS cells FROM cells GROUP BY 1) ON res = n_nationkey")
def row_counts(spark, sf_dir):
    expected = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("CAST(n_nationkey AS int) AS res", "CAST(n_nationkey * 100 AS bigint) AS expected")
    return checks.row_counts(_all_cells(spark, sf_dir), expected)


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT h3_cell FROM cells WHERE h3_cell % 7 = 0 OR h3_cell % 11 = 0")
def golden_cells(spark, sf_dir):
    cells = synth.cells(spark, sf_dir, 5)
    golden = cells.select("h3_cell", F.expr("CAST(elevation_mean + if(h3_cell % 7 = 0, 1, 0) AS float)").alias("elevation_mean"), F.expr("pixel_count + if(h3_cell % 11 = 0, 1, 0)").alias("pixel_count"))
    return checks.regressions(cells, golden).select("h3_cell")


_CELL3 = f"{synth._HEAD - (9 << 52) + (3 << 52) - ((1 << 18) - 1) + (1 << 36) - 1} + (n_nationkey * 5 % 122) * {1 << 45}"


@query(f"""WITH {PX}, {synth.cells_sql(3, 'cells')} SELECT n_name AS name, 'geoid_undulation' AS "column", CAST(geoid_undulation AS DOUBLE) AS value, CAST(n_nationkey - 10 AS DOUBLE) AS expected, 2.0::DOUBLE AS tol,
  coalesce(abs(CAST(geoid_undulation AS DOUBLE) - (n_nationkey - 10)) <= 2.0, false) AS ok FROM nation LEFT JOIN cells ON h3_cell = {_CELL3}""")
def geoid_points(spark, sf_dir):
    points = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_name AS name", f"{_CELL3} AS h3_cell", "n_nationkey - 10.0D AS expected", "'geoid_undulation' AS column", "2.0D AS tol")
    return checks.landmarks(points, synth.cells(spark, sf_dir, 3))


@query(f"WITH {_CELLS9}, {synth.POINTS}, a AS (SELECT id, h_ellipsoidal - CAST(elevation_mean AS DOUBLE) - CAST(geoid_undulation AS DOUBLE) AS agl FROM points JOIN cells USING (h3_cell)) SELECT CAST(id AS VARCHAR) AS name, agl, abs(agl) < 8 AS ok FROM a")
def agl_check(spark, sf_dir):
    return checks.agl_check(synth.points(spark, sf_dir).withColumn("name", F.col("id").cast("string")), synth.cells(spark, sf_dir, 9))


@query(f"WITH {_CELLS9}, {synth.POINTS} SELECT id, h_ellipsoidal - CAST(elevation_mean AS DOUBLE) AS n FROM points JOIN cells USING (h3_cell)")
def undulation(spark, sf_dir):
    both = joins.bulk_join(synth.points(spark, sf_dir), synth.cells(spark, sf_dir, 9).select("h3_cell", "elevation_mean"))
    return both.select("id", geo.undulation(F.col("h_ellipsoidal"), F.col("elevation_mean").cast("double")).alias("n"))


# ---- planning ----------------------------------------------------------------------------------------------------

_SECONDS = f"{synth.COMMITS}, d AS (SELECT band, completed_at, (epoch_us(completed_at) - lag(epoch_us(completed_at)) OVER (ORDER BY completed_at, band)) / 1e6 AS seconds FROM commits)"


@query(f"WITH {_SECONDS} SELECT band, seconds FROM d")
def band_deltas(spark, sf_dir):
    return planning.band_seconds(synth.commits(spark, sf_dir)).select("band", "seconds")


@query(f"""WITH {_SECONDS}, {synth.TILES}, seen AS (SELECT d.*, tiles, seconds / tiles AS rate FROM d JOIN tiles USING (band) WHERE seconds > 0 AND tiles > 0),
  recent AS (SELECT * FROM seen ORDER BY completed_at DESC, band DESC LIMIT 12), m AS (SELECT median(rate) AS w, count(*) AS observed FROM recent),
  k AS (SELECT median(rate) AS r, count(*) AS kept FROM recent CROSS JOIN m WHERE rate >= 0.25 * w AND rate <= 4 * w), o AS (SELECT median(rate) AS overall_rate FROM seen),
  t AS (SELECT count(*) AS bands, count(c.band) AS bands_done, CAST(sum(tiles) AS BIGINT) AS tiles, CAST(sum(CASE WHEN c.band IS NULL THEN tiles ELSE 0 END) AS BIGINT) AS tiles_left FROM tiles LEFT JOIN commits c USING (band))
  SELECT bands, bands_done, tiles, tiles_left, observed, kept, round(r, 6) AS seconds_per_tile, round(overall_rate, 6) AS overall_rate, round(r * tiles_left, 3) AS seconds_left,
  CASE WHEN overall_rate / r > 1.3 THEN 'faster' WHEN overall_rate / r < 0.77 THEN 'slower' ELSE 'steady' END AS note FROM t, m, k, o""")
def eta(spark, sf_dir):
    out = planning.eta(synth.commits(spark, sf_dir), synth.tile_counts(spark, sf_dir))
    return out.withColumn("seconds_per_tile", F.round("seconds_per_tile", 6)).withColumn("overall_rate", F.round("overall_rate", 6)).withColumn("seconds_left", F.round("seconds_left", 3))


@query(f"WITH {synth.TILE_ROWS} SELECT lat, count(*) AS tiles FROM tile_rows GROUP BY lat")
def band_tile_counts(spark, sf_dir):
    return synth.tile_rows(spark, sf_dir).groupBy("lat").agg(F.count(F.lit(1)).alias("tiles"))


@query(f"WITH {synth.COMMITS}, {synth.TILES} SELECT band, tiles, lat FROM tiles WHERE band NOT IN (SELECT band FROM commits) ORDER BY tiles DESC, band LIMIT 5")
def heavy_bands(spark, sf_dir):
    return planning.heaviest(synth.tile_counts(spark, sf_dir), synth.commits(spark, sf_dir))


@query(f"WITH {synth.COMMITS}, {synth.TILES} SELECT band, lat FROM tiles WHERE band NOT IN (SELECT band FROM commits)")
def todo_bands(spark, sf_dir):
    return planning.todo(synth.tile_counts(spark, sf_dir).select("band", "lat"), synth.commits(spark, sf_dir))


@query(f"WITH {synth.COMMITS}, {synth.TILES} SELECT band, tiles, lat FROM tiles WHERE band IN (SELECT band FROM commits)")
def completed_bands(spark, sf_dir):
    return synth.tile_counts(spark, sf_dir).join(synth.commits(spark, sf_dir), "band", "left_semi")


@query(f"WITH {synth.COMMITS}, {synth.TILES} SELECT band FROM tiles EXCEPT SELECT band FROM commits")
def completeness(spark, sf_dir):
    return checks.completeness(synth.tile_counts(spark, sf_dir), synth.commits(spark, sf_dir))


@query(f"WITH {synth.TILES}, m AS (SELECT median(tiles) AS m FROM tiles) SELECT band, tiles FROM tiles CROSS JOIN m WHERE tiles >= 0.25 * m AND tiles <= 4 * m")
def outlier_trim(spark, sf_dir):
    return planning.outliers_trimmed(synth.tile_counts(spark, sf_dir).select("band", "tiles"), "tiles")


@query(f"WITH {synth.LAND} SELECT lat_north, lat_south, land_km2, sum(land_km2) OVER (ORDER BY lat_north DESC) AS cum_km2 FROM land")
def cumulative_land(spark, sf_dir):
    return planning.cumulative_land(synth.land(spark, sf_dir))


@query(f"""WITH RECURSIVE {synth.LAND}, c AS (SELECT lat_south AS s, land_km2 AS l, sum(land_km2) OVER (ORDER BY lat_north DESC) AS cum FROM land),
  g AS (SELECT s, coalesce(lead(cum) OVER (ORDER BY s DESC) - cum, 0.0) AS nxt FROM c WHERE s % 5 = 0 OR s = -90),
  x AS (SELECT c.s, c.l, c.cum, g.nxt, g.s IS NOT NULL AS legal FROM c LEFT JOIN g USING (s)),
  f AS (SELECT 90 AS s, 0.0::DOUBLE AS acc, 90 AS north, -1 AS band, 0 AS cut_n, 0.0::DOUBLE AS cut_l, false AS cut
    UNION ALL SELECT x.s, CASE WHEN k THEN 0.0 ELSE a END, CASE WHEN k THEN x.s ELSE north END, CASE WHEN k THEN band + 1 ELSE band END, north, a, k
    FROM (SELECT x.*, f.north, f.band, f.acc + x.l AS a, x.legal AND (x.s = -90 OR f.acc + x.l >= 12333333.333333334 - x.nxt / 2) AS k FROM f JOIN x ON x.s = f.s - 1) x)
  SELECT band, cut_n AS lat_north, s AS lat_south, cut_l AS land_km2, round(cut_l / 0.74, 3) AS est_rows, round(cut_l / 0.74 * 30 / 1e6, 6) AS est_mb FROM f WHERE cut""")
def band_plan(spark, sf_dir):
    return planning.band_plan(synth.land(spark, sf_dir), 8, 5).withColumn("est_rows", F.round("est_rows", 3)).withColumn("est_mb", F.round("est_mb", 6))


@query("""WITH f AS (SELECT 'p' || p_partkey AS path, p_size AS size, CAST(p_partkey * 7919 % 10007 AS BIGINT) AS atime FROM part), b AS (SELECT *, coalesce(sum(size) OVER (ORDER BY atime, size, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER () AS total FROM f)
  SELECT path, size, atime FROM b WHERE total - before > 20000""")
def lru_evict(spark, sf_dir):
    files = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("concat('p', p_partkey) AS path", "p_size AS size", "p_partkey * 7919 % 10007 AS atime")
    return planning.evictions(files, 20000)


@query("SELECT event_id, floor(value) + 1 AS tiles, (floor(value) + 1) / value AS tiles_per_s, 26450 * value / (floor(value) + 1) / 3600 AS hours_in_all FROM events WHERE value > 0")
def throughput(spark, sf_dir):
    runs = spark.read.parquet(f"{sf_dir}/events.parquet").filter("value > 0").selectExpr("event_id", "double(floor(value) + 1) AS tiles", "1.0D AS pixels", "1.0D AS bytes", "value AS seconds")
    return planning.throughput(runs).select("event_id", "tiles", "tiles_per_s", "hours_in_all")


# ---- names and tiles ---------------------------------------------------------------------------------------------


@query(f"WITH {synth.TILE_ROWS} SELECT name, lat, lon FROM tile_rows")
def tile_names(spark, sf_dir):
    return tiles.located(synth.tile_rows(spark, sf_dir).select("name")).select("name", "lat", "lon")


@query("SELECT n_nationkey * 7 - 84 AS lat, 'lat_' || CASE WHEN n_nationkey * 7 - 83 >= 0 THEN '+' ELSE '-' END || abs(n_nationkey * 7 - 83) || '_' || CASE WHEN n_nationkey * 7 - 84 >= 0 THEN '+' ELSE '-' END || abs(n_nationkey * 7 - 84) AS band FROM nation")
def band_labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey * 7 - 84 AS lat").withColumn("band", names.band_label(F.col("lat")))


@query(f"WITH {synth.TILE_ROWS} SELECT lat, array_to_string(list(name ORDER BY lon, name), ' ') AS names FROM (SELECT DISTINCT * FROM tile_rows) GROUP BY lat")
def tile_manifest(spark, sf_dir):
    return tiles.manifest(synth.tile_rows(spark, sf_dir)).withColumn("names", F.array_join("names", " "))


@query(f"WITH {synth.TILE_ROWS} SELECT count(*) AS tiles, count(DISTINCT lat) AS bands, min(lat) AS min_lat, max(lat) AS max_lat FROM tile_rows")
def tile_summary(spark, sf_dir):
    return tiles.summary(synth.tile_rows(spark, sf_dir))


@query(f"WITH {synth.TILE_ROWS} SELECT name FROM tile_rows WHERE lat >= -14 AND lat < 42 AND lon >= -90 AND lon < 30")
def tiles_in_box(spark, sf_dir):
    return tiles.in_box(synth.tile_rows(spark, sf_dir), -14, -90, 42, 30).select("name")


_RASTER = "SELECT s_suppkey, k.range AS k, CASE WHEN (s_suppkey * 31 + k.range * 17) % 23 = 0 THEN -9999.0 ELSE (s_suppkey * 31 + k.range * 17) % 4000 * 0.25 END AS e FROM supplier CROSS JOIN range(48) k"


@query(f"WITH r AS ({_RASTER}) SELECT 't' || s_suppkey AS tile, CAST(s_suppkey % 80 + 1.0 + (k // 8 + 0.5) * (-0.125) AS DOUBLE) AS lat, CAST(s_suppkey % 170 + (k % 8 + 0.5) * 0.125 AS DOUBLE) AS lon, CAST(e AS DOUBLE) AS elev FROM r WHERE e <> -9999.0")
def pixel_centres(spark, sf_dir):
    value = "transform(sequence(0, 47), k -> CAST(if((s_suppkey * 31 + k * 17) % 23 = 0, -9999.0D, (s_suppkey * 31 + k * 17) % 4000 * 0.25D) AS float)) AS data"
    rasters = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("concat('t', s_suppkey) AS name", "8 AS width", "6 AS height", "double(s_suppkey % 170) AS x0", "0.125D AS dx", "s_suppkey % 80 + 1.0D AS y0", "-0.125D AS dy", "-9999.0D AS nodata", value)
    return tiles.pixels_of_arrays(rasters)


# ---- products ----------------------------------------------------------------------------------------------------

_SQUARE = "SELECT n_nationkey AS k, n_nationkey * 2.0 AS x, n_nationkey * 3.0 AS y FROM nation"


@query(f"""WITH s AS ({_SQUARE}), c AS (SELECT k, i, x + CASE WHEN i IN (1, 2) THEN 1 ELSE 0 END AS px, y + CASE WHEN i IN (2, 3) THEN 1 ELSE 0 END AS py FROM s CROSS JOIN (SELECT range AS i FROM range(4)))
  SELECT a.k, CAST(a.px AS DOUBLE) AS ax, CAST(a.py AS DOUBLE) AS ay, CAST(b.px AS DOUBLE) AS bx, CAST(b.py AS DOUBLE) AS by_ FROM c a JOIN c b ON a.k = b.k AND b.i = (a.i + 1) % 4""")
def polygon_edges(spark, sf_dir):
    corner = "array(struct(x AS x, y AS y), struct(x + 1 AS x, y AS y), struct(x + 1 AS x, y + 1 AS y), struct(x AS x, y + 1 AS y)) AS p"
    squares = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey AS k", "n_nationkey * 2.0D AS x", "n_nationkey * 3.0D AS y").selectExpr("k", corner)
    return squares.select("k", F.explode(geo.edges(F.col("p"))).alias("e")).selectExpr("k", "e.a.x AS ax", "e.a.y AS ay", "e.b.x AS bx", "e.b.y AS by_")


@query("""WITH g AS (SELECT n_nationkey * 7 - 84 AS lat, n_nationkey * 13 - 160 AS lon, 1.0 + (n_nationkey - 12) * 4.0 * 8000.0 / 6371000.0 AS r FROM nation)
  SELECT lat, lon, round(r * cos(radians(lat)) * cos(radians(lon)), 9) AS x, round(r * cos(radians(lat)) * sin(radians(lon)), 9) AS y, round(r * sin(radians(lat)), 9) AS z FROM g""")
def sphere_coords(spark, sf_dir):
    at = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey * 7 - 84 AS lat", "n_nationkey * 13 - 160 AS lon", "(n_nationkey - 12) * 4.0D AS value")
    return products.geoid_sphere(at).select("lat", "lon", *[F.round(c, 9).alias(c) for c in "xyz"])


@query(f"""WITH {synth.GEOID_GRID}, px AS (SELECT i.range AS l_orderkey, j.range AS l_linenumber, i.range * 10.0 - 89.5 AS lat, j.range * 10.0 - 180.0 AS lon FROM range(18) i CROSS JOIN range(37) j), {_TAPS}
  SELECT CAST(l_orderkey AS INT) AS i, CAST(l_linenumber AS INT) AS j, round((a.n * (1 - fc) + b.n * fc) * (1 - fr) + (d.n * (1 - fc) + e.n * fc) * fr, 6) AS n
  FROM u JOIN grid a ON a.row = r0 AND a.col = c0 JOIN grid b ON b.row = r0 AND b.col = c1 JOIN grid d ON d.row = r1 AND d.col = c0 JOIN grid e ON e.row = r1 AND e.col = c1""")
def geoid_grid(spark, sf_dir):
    return joins.bilinear(products.regular_grid(spark, 10.0), synth.geoid_grid(spark), synth.GEOID_ORIGIN, 19, 37).select("i", "j", F.round("value", 6).alias("n"))


@query()
def extruded_columns(spark, sf_dir):
    return products.columns_3d(_few_cells(spark, sf_dir, 5), 39.0, -106.0).select("h3_cell", "kind", "shade", F.size("face").alias("corners"))


# ---- tables and streams ------------------------------------------------------------------------------------------


def _folder(spark) -> str:
    """A folder that driver and executors share; in local mode a temporary one will do."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{base.rstrip('/')}/cells-{spark.sparkContext.applicationId}-{next(_count)}" if base else "file://" + tempfile.mkdtemp(prefix="stratagrid-cells-") + "/t"


def _put(spark, path: str, data: bytes) -> str:
    """Writes a small file."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(data))
    out.close()
    return path


_count = iter(range(1 << 30))


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')}, k AS (SELECT min(h3_cell) AS a, max(h3_cell) AS b FROM cells) SELECT cells.* FROM cells, k WHERE h3_cell IN (a, b)")
def table_lookup(spark, sf_dir):
    cells = synth.cells(spark, sf_dir, 5)
    stored = table.CellTable(spark, _folder(spark))
    stored.write(cells, {"source": "synthetic"})
    ends = stored.read().agg(F.min("h3_cell").alias("a"), F.max("h3_cell").alias("b")).first()
    return stored.lookup_many([ends["a"], ends["b"]])


@query(f"WITH {PX} SELECT h3_cell, {synth.STATS_SQL} FROM (SELECT {P('h3_cell', 5)} AS h3_cell, {synth.AGG_SQL} FROM px GROUP BY 1)")
def sweep_flush(spark, sf_dir):
    """Bands as a stream; a cell's southern extent is taken as its band's edge, so that SQL can follow."""
    from .streaming import sweep

    folder = _folder(spark)
    px = at_res(spark, sf_dir, 5).select("h3_cell", "elev").withColumn("south", bits.base_cell(F.col("h3_cell")).cast("double") % 3 * -1.0)
    for k in range(3):
        band = px.filter(F.col("south") == -float(k)).withColumn("lat_band", F.concat(F.lit("b"), F.lit(k)))
        band.select("lat_band", "south", "h3_cell", "elev").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    own = sweep.Sweep(spark, f"{folder}/out", lambda c: bits.base_cell(c).cast("double") % 3 * -1.0)
    own.run(sweep.band_stream(spark, f"{folder}/in"))
    return own.close()


def _bands(spark, sf_dir, folder: str, res: int = 5) -> DataFrame:
    """Cells of each of three bands, written as band files."""
    cells = stats.aggregate(at_res(spark, sf_dir, res), "lat_band", "h3_cell")
    for b in (1, 2, 3):
        table.write_band(cells.filter(F.col("lat_band") == b).drop("lat_band"), folder, f"b{b}", res)
    return cells


_BAND5 = f"{PX}, bands AS (SELECT 'b' || lat_band AS lat_band, {P('h3_cell', 5)} AS h3_cell, count(*) AS pixel_count FROM px GROUP BY 1, 2)"


@query(f"WITH {_BAND5} SELECT * FROM bands WHERE lat_band IN ('b1', 'b3')")
def bands_scanned(spark, sf_dir):
    _bands(spark, sf_dir, folder := _folder(spark))
    return table.read_bands(spark, folder, 5, ["b1", "b3", "b9"]).select("lat_band", "h3_cell", "pixel_count")


@query(f"WITH {_BAND5} SELECT 'b2' AS band, true AS there, count(*) AS cells FROM bands WHERE lat_band = 'b2' UNION ALL SELECT 'b9', false, NULL")
def band_read(spark, sf_dir):
    _bands(spark, sf_dir, folder := _folder(spark))
    found = {b: table.read_band(spark, folder, b, 5) for b in ("b2", "b9")}
    return spark.createDataFrame([(b, df is not None, df.count() if df is not None else None) for b, df in found.items()], "band string, there boolean, cells long")


@query(f"WITH {_BAND5} SELECT *, {_VALID} AS placed FROM bands WHERE lat_band <> 'b2'")
def completed_cells(spark, sf_dir):
    _bands(spark, sf_dir, folder := _folder(spark))
    commits = spark.createDataFrame([("b1",), ("b3",), ("b3",), ("b7",)], "band string")
    return table.completed_cells(spark, folder, 5, commits).select("lat_band", "h3_cell", "pixel_count", (F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)).alias("placed")).na.fill(False)


@query(f"WITH {PX} SELECT 'b' || lat_band AS lat_band, res, count(DISTINCT CASE res WHEN 4 THEN {P('h3_cell', 4)} ELSE {P('h3_cell', 5)} END) AS cells FROM px CROSS JOIN (VALUES (4), (5)) r(res) WHERE lat_band <> 3 GROUP BY 1, 2")
def bands_published(spark, sf_dir):
    """A band counts once its marker is there, which is written last."""
    folder = _folder(spark)
    by_res = {r: stats.aggregate(at_res(spark, sf_dir, r), "lat_band", "h3_cell") for r in (4, 5)}
    for b in (1, 2):
        table.publish_band(spark, {r: c.filter(F.col("lat_band") == b).drop("lat_band") for r, c in by_res.items()}, folder, f"b{b}", {"source": "synthetic"})
    table.write_band(by_res[5].filter("lat_band = 3").drop("lat_band"), folder, "b3", 5)
    done = table.published_bands(spark, folder).withColumnRenamed("band", "lat_band")
    counts = [table.read_bands(spark, folder, r).groupBy("lat_band").agg(F.count(F.lit(1)).alias("cells")).withColumn("res", F.lit(r)) for r in (4, 5)]
    return counts[0].unionByName(counts[1]).join(done, "lat_band", "left_semi").select("lat_band", "res", "cells")


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT {P('h3_cell', 1)} AS r1, count(*) AS cells FROM cells GROUP BY 1")
def hive_partitions(spark, sf_dir):
    cells = synth.cells(spark, sf_dir, 5)
    folder = _folder(spark)
    table.write_partitioned(cells, folder)
    table.write_partitioned(cells.filter(bits.base_cell(F.col("h3_cell")) < 9), folder)  # replaces what it has, and nothing else
    own = spark.read.parquet(folder).select("h3_cell", names.res1_of_path(F.col("_metadata.file_path")).alias("r1"))
    return own.groupBy("r1").agg(F.count(F.lit(1)).alias("cells"))


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT h3_cell, row_number() OVER (ORDER BY h3_cell) - 1 AS place FROM cells")
def sorted_file(spark, sf_dir):
    table.write_band(synth.cells(spark, sf_dir, 5), folder := _folder(spark), "all", 5)
    return spark.read.parquet(f"{folder}/all/res5").select("h3_cell", F.col("_metadata.row_index").alias("place"))


def _stored(spark, cells: DataFrame, provenance: dict[str, str] | None = None) -> table.CellTable:
    stored = table.CellTable(spark, _folder(spark))
    stored.write(cells, provenance)
    return stored


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT h3_cell, elevation_mean, pixel_count FROM cells")
def published_read(spark, sf_dir):
    return table.read_published(spark, _stored(spark, synth.cells(spark, sf_dir, 5)).where()).select("h3_cell", "elevation_mean", "pixel_count")


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT h3_cell, elevation_max FROM cells")
def projected_read(spark, sf_dir):
    return _stored(spark, synth.cells(spark, sf_dir, 5)).read(["h3_cell", "elevation_max"])


@query(f"WITH {PX} SELECT 4 AS res, count(DISTINCT {P('h3_cell', 4)}) AS cells FROM px UNION ALL SELECT 5, count(DISTINCT {P('h3_cell', 5)}) FROM px UNION ALL SELECT 6, count(DISTINCT {P('h3_cell', 6)}) FROM px")
def read_layouts(spark, sf_dir):
    """A resolution in one file, one in shards, and one in a table."""
    folder = _folder(spark)
    synth.cells(spark, sf_dir, 4).coalesce(1).write.parquet(f"{folder}/res4.parquet")
    synth.cells(spark, sf_dir, 5).withColumn("base", bits.base_cell(F.col("h3_cell"))).repartition("base").write.partitionBy("base").parquet(f"{folder}/res5")
    table.CellTable(spark, f"{folder}/res6").write(synth.cells(spark, sf_dir, 6))
    counts = [table.read_cells(spark, folder, r).agg(F.lit(r).alias("res"), F.count(F.lit(1)).alias("cells")) for r in (4, 5, 6)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("""SELECT 'schema' AS section, 'columns and types' AS "check", true AS ok""")
def schema_probe(spark, sf_dir):
    return checks.schema(_stored(spark, synth.cells(spark, sf_dir, 5)).scan()).select("section", "check", "ok")


@query("SELECT * FROM (VALUES ('pass', '2'), ('restamped', 'True'), ('restamped again', 'False'), ('schema', '1'), ('source', 'later')) t(name, value)")
def provenance(spark, sf_dir):
    """Entries put together, the later ones winning; stamping a table with what it has does nothing."""
    stored = _stored(spark, synth.cells(spark, sf_dir, 4), {"source": "synthetic", "schema": "1"})
    own = table.merged_provenance(stored.provenance(), {"source": "later", "pass": "2"})
    done = {"restamped": str(stored.restamp(own)), "restamped again": str(stored.restamp(own))}
    return spark.createDataFrame(sorted({**stored.provenance(), **done}.items()), "name string, value string")


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT count(*) AS rows, count(DISTINCT (h3_cell >> 45) & 127) AS files, true AS measured FROM cells")
def recompressed(spark, sf_dir):
    stored = _stored(spark, synth.cells(spark, sf_dir, 5))
    done = stored.recompress()
    return stored.sizes().agg(F.lit(done["rows"]).cast("long").alias("rows"), F.count(F.lit(1)).alias("files"), (F.sum("length") == done["bytes_after"]).alias("measured"))


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT h3_cell, CAST(elevation_mean AS DOUBLE) * 2 AS twice, true AS added, false AS again FROM cells")
def columns_added(spark, sf_dir):
    stored = _stored(spark, synth.cells(spark, sf_dir, 5))
    twice = lambda d: d.withColumn("twice", F.col("elevation_mean").cast("double") * 2)
    added, again = stored.add_column("twice", twice), stored.add_column("twice", twice)
    return stored.read(["h3_cell", "twice"]).withColumn("added", F.lit(added)).withColumn("again", F.lit(again))


@query(f"WITH {PX}, {synth.cells_sql(4, 'cells')} SELECT count(*) AS rows, true AS refused, CAST(2 AS BIGINT) AS versions FROM cells")
def replaced_table(spark, sf_dir):
    """A write whose count isn't the expected one leaves the table; of those that replaced it the last two stay."""
    cells = synth.cells(spark, sf_dir, 4)
    stored = _stored(spark, cells.limit(3))
    for _ in range(2):
        stored.write(cells)
    try:
        stored.write(cells.limit(5), expected_rows=6)
        refused = False
    except ValueError:
        refused = True
    return stored.read().agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"), F.lit(len(stored._versions())).cast("long").alias("versions"))


@query("""SELECT * FROM (VALUES ('performance', 'lookup of one cell', true), ('performance', 'full count', true)) t(section, "check", ok)""")
def timed_checks(spark, sf_dir):
    stored = _stored(spark, synth.cells(spark, sf_dir, 5))
    return checks.performance(stored, stored.read(["h3_cell"]).first()["h3_cell"]).select("section", "check", "ok")


@query(f"WITH {synth.LAND} SELECT * FROM land")
def land_csv(spark, sf_dir):
    land, folder = synth.land(spark, sf_dir), _folder(spark)
    table.append_csv(land.filter("lat_south >= 0"), folder)
    table.append_csv(land.filter("lat_south < 0"), folder)
    return planning.read_land(spark, folder)


@query(SQL["band_plan"].replace("round(cut_l / 0.74, 3)", "CAST(round(cut_l / 0.74, 0) AS BIGINT)").replace("round(cut_l / 0.74 * 30 / 1e6, 6)", "round(cut_l / 0.74 * 30 / 1e6, 1)"))
def plan_csv(spark, sf_dir):
    planning.write_plan(planning.band_plan(synth.land(spark, sf_dir), 8, 5), folder := _folder(spark))
    return spark.read.option("header", True).schema("band int, lat_north int, lat_south int, land_km2 double, est_rows long, est_mb double").csv(folder)


@query("""WITH parts AS (SELECT n_nationkey AS k, range AS part FROM nation CROSS JOIN range(2) WHERE n_nationkey % 3 <> 2 AND (n_nationkey % 3 = 1 OR range = 0))
  SELECT CAST(k AS INT) AS feature, CAST(part AS INT) AS part, 0 AS ring, 4 AS corners, CAST(k + part * 100 AS DOUBLE) AS west, false AS absent FROM parts UNION ALL SELECT NULL, NULL, NULL, 0, NULL, true""")
def rings(spark, sf_dir):
    """Polygons, multi-polygons and points of a file, and a file that isn't there."""
    import json

    keys = sorted(r["n_nationkey"] for r in spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey").collect())
    ring = lambda x: [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1]]
    shape = lambda k: {"type": "Polygon", "coordinates": [ring(k)]} if k % 3 == 0 else {"type": "MultiPolygon", "coordinates": [[ring(k)], [ring(k + 100)]]} if k % 3 == 1 else {"type": "Point", "coordinates": [k, 0]}
    path = _put(spark, f"{_folder(spark)}/x.json", json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": shape(k)} for k in keys]}).encode())
    own = tiles.geojson_rings(spark, path).select("feature", "part", "ring", F.size("points").alias("corners"), F.col("points")[0][0].alias("west"), F.lit(False).alias("absent"))
    none = tiles.geojson_rings(spark, path + ".not").agg(F.lit(None).cast("int").alias("feature"), F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("ring"), F.count(F.lit(1)).cast("int").alias("corners"), F.lit(None).cast("double").alias("west"), F.lit(True).alias("absent"))
    return own.unionByName(none)


@query(SQL["geoid_sampled"])
def geoid_file(spark, sf_dir):
    """As geoid_sampled, of a grid that is read from a file."""
    import numpy as np

    grid = np.array([[((r * 37 + c * 11) % 200) * 0.5 - 50.0 for c in range(37)] for r in range(19)])
    raster, origin = tiles.load_raster(spark, _put(spark, f"{_folder(spark)}/geoid.tif", synth.geotiff(grid, synth.GEOID_ORIGIN)))
    out = joins.sample_raster(synth.pixels(spark, sf_dir).select("l_orderkey", "l_linenumber", "lat", "lon"), raster, origin)
    return out.select("l_orderkey", "l_linenumber", (F.round(F.col("geoid_undulation").cast("double"), 3) + 0.0).alias("n"))


@query(f"WITH {synth.TILE_ROWS} SELECT DISTINCT name, lat, lon FROM tile_rows")
def listed_tiles(spark, sf_dir):
    folder = _folder(spark)
    synth.tile_rows(spark, sf_dir).select("name", F.col("name").alias("value")).repartition("name").write.partitionBy("name").text(folder)
    _put(spark, f"{folder}/name=other/part-0.txt", b"not a tile")
    return tiles.list_tiles(spark, folder, "*.txt").select("name", "lat", "lon")


@query(SQL["tile_manifest"])
def manifest_cached(spark, sf_dir):
    """Built once; the second call reads what is stored."""
    path = _folder(spark)
    tiles.cached_manifest(spark, path, lambda: tiles.manifest(synth.tile_rows(spark, sf_dir)))
    return tiles.cached_manifest(spark, path, lambda: 1 / 0).withColumn("names", F.array_join("names", " "))


@query(f"WITH {synth.TILE_ROWS} SELECT name, CASE WHEN lat >= 0 THEN '/cache/' || name || '.tif' ELSE 's3a://tiles/' || name || '/' || name || '.tif' END AS source FROM tile_rows")
def tile_sources(spark, sf_dir):
    cached = F.when(F.col("lat") >= 0, F.concat(F.lit("/cache/"), F.col("name"), F.lit(".tif")))
    return synth.tile_rows(spark, sf_dir).select("name", tiles.source_of(F.col("name"), "s3a://tiles/", cached).alias("source"))


_FIRST = f"{synth.TILE_ROWS}, firsts AS (SELECT name, lat, lon FROM tile_rows ORDER BY lat DESC, lon, name LIMIT 6)"


@query(f"WITH {_FIRST} SELECT * FROM firsts")
def first_tiles(spark, sf_dir):
    return tiles.first_tiles(synth.tile_rows(spark, sf_dir).select("name", "lat", "lon"), 6)


@query(f"WITH {_FIRST}, m AS (SELECT max(name) AS m FROM firsts) SELECT name, CASE WHEN name <> m THEN length(name) END AS length, again AND name <> m AS cached, again FROM firsts, m, (VALUES (false), (true)) t(again)")
def fetched_tiles(spark, sf_dir):
    """Copied at the first call and found at the second; one of the files isn't there."""
    firsts = tiles.first_tiles(synth.tile_rows(spark, sf_dir).select("name", "lat", "lon"), 6)
    found, folder = sorted(r["name"] for r in firsts.collect()), _folder(spark)
    for name in found[:-1]:
        _put(spark, f"{folder}/source/{name}/{name}.tif", name.encode())
    rows = [(r["name"], r["length"], r["cached"], again) for again in (False, True) for r in tiles.fetch(spark, firsts, f"{folder}/source", f"{folder}/cache").collect()]
    return spark.createDataFrame(rows, "name string, length long, cached boolean, again boolean")


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'lat_' || n_nationkey END AS band FROM nation")
def key_bands(spark, sf_dir):
    key = F.expr("concat(if(n_nationkey % 3 = 0, 'v2/lat_', 'v1/lat_'), n_nationkey, '/res5/part-0.parquet')")
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("k"), names.band_of_key(key).alias("band"))


@query("""WITH g AS (SELECT n_nationkey AS k, n_nationkey * 7 - 84.0::DOUBLE AS lat, n_nationkey * 13 - 160.0::DOUBLE AS lon, n_nationkey / 24.0::DOUBLE AS t FROM nation),
  p AS (SELECT *, cos(radians(lat)) * cos(radians(lon)) AS x, cos(radians(lat)) * sin(radians(lon)) AS y, sin(radians(lat)) AS z, least(floor(t * 2), 1) AS i, sqrt(0.55 * 0.55 + 0.3 * 0.3 + 0.78 * 0.78) AS n FROM g)
  SELECT k, round(greatest(0, least(1, x * 0.55 / n + y * 0.3 / n + z * 0.78 / n)), 9) AS light, round((lon - 5) * 111320.0 * cos(radians(40.0)), 6) AS east, round((lat - 40) * 110540.0, 6) AS north,
  round(CASE WHEN i = 0 THEN 0.0 + t * 2 * 0.5 ELSE 0.5 + (t * 2 - 1) * 0.5 END, 9) AS red, round(degrees(asin(z)), 6) + 0.0 AS camera_lat, round(degrees(atan2(y, x)), 6) + 0.0 AS camera_lng FROM p""")
def shading(spark, sf_dir):
    """Light, local metres, a colour ramp and camera angles."""
    at = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey AS k", "n_nationkey * 7 - 84.0D AS lat", "n_nationkey * 13 - 160.0D AS lon", "n_nationkey / 24.0D AS t")
    p = at.withColumn("p", geo.sphere(F.col("lat"), F.col("lon"), F.lit(1.0))).withColumn("m", geo.local_metres(F.col("lat"), F.col("lon"), F.lit(40.0), F.lit(5.0)))
    p = p.withColumn("c", geo.colour_ramp(F.col("t"), [(0.0, 0.0, 1.0), (0.5, 1.0, 0.5), (1.0, 0.0, 0.0)])).withColumn("a", geo.camera_angles(F.col("p.x"), F.col("p.y"), F.col("p.z")))
    return p.select("k", F.round(geo.illumination(F.col("p.x"), F.col("p.y"), F.col("p.z")), 9).alias("light"), F.round("m.x", 6).alias("east"), F.round("m.y", 6).alias("north"), F.round(F.col("c")[0], 9).alias("red"), (F.round("a.lat", 6) + 0.0).alias("camera_lat"), (F.round("a.lng", 6) + 0.0).alias("camera_lng"))


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')} SELECT h3_cell, geoid_undulation AS value FROM cells")
def geoid_map(spark, sf_dir):
    return products.cell_map(synth.cells(spark, sf_dir, 5), "geoid_undulation").select("h3_cell", "value")


@query("SELECT row_number() OVER () - 1 AS place, f AS frame FROM (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 5, 4, 3, 2, 1]) AS f)")
def frame_order(spark, sf_dir):
    return spark.createDataFrame(list(enumerate(products.boomerang(7))), "place long, frame int")


@query(f"WITH {PX}, {synth.cells_sql(4, 'cells')} SELECT h3_cell, elevation_mean, {_VALID} AS placed, round((greatest(-200.0, least(3500.0, CAST(elevation_mean AS DOUBLE))) + 200.0) / 3700.0, 9) AS shade FROM cells")
def relief_points(spark, sf_dir):
    sites = spark.createDataFrame([], "name string, lat double, lon double, lo double, hi double")
    points, _ = products.relief(synth.cells(spark, sf_dir, 4), sites)
    return points.select("h3_cell", "elevation_mean", F.col("lat").isNotNull().alias("placed"), F.round("shade", 9).alias("shade"))


@query(SQL["weighted_region_mean"])
def relief_spots(spark, sf_dir):
    marks = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_name AS name", "n_nationkey * 7 - 84 + 0.5D AS lat", "n_nationkey * 13 - 160 + 0.25D AS lon", "n_nationkey * 100 AS lo", "n_nationkey * 100 + 2000 AS hi")
    cells = synth.pixels(spark, sf_dir).selectExpr("h3_cell", "CAST(elev AS float) AS elevation_mean", "CAST(l_linenumber % 4 AS bigint) AS pixel_count", "lat", "lon")
    return products.relief(cells, marks)[1].withColumn("value", F.round("value", 6))


@query("WITH g AS (" + SQL["geoid_grid"] + ") SELECT '[' || string_agg(CAST(round_even(n, 0) AS INT), ',' ORDER BY i, j) || ']' AS json, CAST(trunc(min(n)) AS INT) AS low, CAST(trunc(max(n)) AS INT) AS high FROM g")
def geoid_export(spark, sf_dir):
    sampled = joins.bilinear(products.regular_grid(spark, 10.0), synth.geoid_grid(spark), synth.GEOID_ORIGIN, 19, 37).withColumn("value", F.round("value", 6))
    return products.geoid_json(sampled)


@query()
def region(spark, sf_dir):
    cells = stats.aggregate(stats.located(synth.pixels(spark, sf_dir).select("lat", "lon", "elev"), (5,)), "h3_cell")
    stored = table.CellTable(spark, _folder(spark))
    stored.write(cells)
    return stored.region(30.0, -20.0, 45.0, 40.0, 5)


@query("SELECT k AS box, CAST(0 AS BIGINT) AS missed, CAST(0 AS BIGINT) AS wrong, true AS some FROM range(4) t(k)")
def regions_exact(spark, sf_dir):
    """Rows of a region against a filter of all rows, for small, large and polar boxes."""
    cells = stats.aggregate(stats.located(synth.pixels(spark, sf_dir).select("lat", "lon", "elev"), (5,)), "h3_cell")
    stored = _stored(spark, cells)
    every = stored.read(["h3_cell"]).withColumn("at", grid_udfs.cell_to_latlng(F.col("h3_cell"))).persist()
    out = []
    for box in ((30.0, -20.0, 45.0, 40.0), (-60.0, -179.0, 70.0, 179.0), (60.0, -180.0, 90.0, 180.0), (-5.0, 100.0, 8.0, 125.0)):
        got = stored.region(*box, 5).select("h3_cell")
        want = every.filter(F.col("at.lat").between(box[0], box[2]) & F.col("at.lng").between(box[1], box[3])).select("h3_cell")
        out.append((len(out), want.exceptAll(got).count(), got.exceptAll(want).count(), want.count() > 0))
    every.unpersist()
    return spark.createDataFrame(out, "box long, missed long, wrong long, some boolean")


@query(f"WITH {PX}, {synth.cells_sql(5, 'cells')}, k AS (SELECT min(h3_cell) AS a, max(h3_cell) AS b FROM cells) SELECT h3_cell, elevation_mean, pixel_count FROM cells, k WHERE h3_cell IN (a, b) UNION ALL SELECT 5, NULL, NULL")
def cell_got(spark, sf_dir):
    """Single rows read on the driver, and one that the table lacks."""
    stored = _stored(spark, synth.cells(spark, sf_dir, 5))
    ends = stored.read().agg(F.min("h3_cell").alias("a"), F.max("h3_cell").alias("b")).first()
    found = {c: stored.get(c, ["elevation_mean", "pixel_count"]) for c in (ends["a"], ends["b"], 5)}
    return spark.createDataFrame([(c, *(row or {"e": None, "n": None}).values()) for c, row in found.items()], "h3_cell long, elevation_mean float, pixel_count long")


def _band_files(spark, sf_dir, folder: str, bands: tuple[int, ...]) -> None:
    px = at_res(spark, sf_dir, 5).select("h3_cell", "elev").withColumn("south", bits.base_cell(F.col("h3_cell")).cast("double") % 3 * -1.0)
    for k in bands:
        band = px.filter(F.col("south") == -float(k)).withColumn("lat_band", F.concat(F.lit("b"), F.lit(k)))
        band.select("lat_band", "south", "h3_cell", "elev").coalesce(1).write.mode("append").parquet(f"{folder}/in")


@query(SQL["sweep_flush"])
def sweep_resumed(spark, sf_dir):
    """A sweep that stops after a band and goes on in another run; a batch that is done twice counts once."""
    from .streaming import sweep

    folder, south = _folder(spark), lambda c: bits.base_cell(c).cast("double") % 3 * -1.0
    _band_files(spark, sf_dir, folder, (0,))
    sweep.Sweep(spark, f"{folder}/out", south).run(sweep.band_stream(spark, f"{folder}/in"))
    _band_files(spark, sf_dir, folder, (1, 2))
    own = sweep.Sweep(spark, f"{folder}/out", south)
    own.run(sweep.band_stream(spark, f"{folder}/in"))
    last = spark.read.schema(sweep.PIXELS).parquet(f"{folder}/in").filter("south = -2.0")
    own.apply(last, own.commits().agg(F.max("batch").alias("b")).first()["b"])
    return own.close()


@query("SELECT true AS refused, CAST(0 AS BIGINT) AS changed, CAST(2 AS BIGINT) AS bands")
def late_data(spark, sf_dir):
    """Pixels of a cell that is final are an error, and what was written for it stays as it was."""
    from .streaming import sweep

    folder = _folder(spark)
    _band_files(spark, sf_dir, folder, (0, 1))
    own = sweep.Sweep(spark, f"{folder}/out", lambda c: bits.base_cell(c).cast("double") % 3 * -1.0)
    px = spark.read.schema(sweep.PIXELS).parquet(f"{folder}/in")
    own.apply(px.filter("south > -0.5"), 0)  # 0.0 may be stored as -0.0
    before = own.flushed().select("h3_cell", "elevation_mean", "pixel_count").collect()
    own.apply(px.filter("south < -0.5"), 1)
    try:
        own.apply(px.filter("south > -0.5").limit(1).withColumn("south", F.lit(-2.0)), 2)
        refused = False
    except sweep.LateData:
        refused = True
    kept = spark.createDataFrame(before, "h3_cell long, elevation_mean float, pixel_count long")
    changed = kept.exceptAll(own.flushed().select("h3_cell", "elevation_mean", "pixel_count")).count()
    return spark.createDataFrame([(refused, changed, own.commits().count())], "refused boolean, changed long, bands long")


@query(SQL["partial_res9"])
def running_stats(spark, sf_dir):
    """Partials of a stream in Spark's state store."""
    from .streaming import sweep

    folder = _folder(spark)
    synth.pixels(spark, sf_dir).select("h3_cell", "elev", "lat_band").write.partitionBy("lat_band").parquet(f"{folder}/in")
    files = len(spark.read.parquet(f"{folder}/in").inputFiles())
    stream = spark.readStream.schema("h3_cell long, elev double").option("maxFilesPerTrigger", max(1, -(-files // 3))).parquet(f"{folder}/in/lat_band=*")
    return sweep.kept_stats(stream, f"{folder}/at", "h3_cell")
