"""Grid inputs made from the general test tables by whole-number arithmetic, in Spark and as the same thing in SQL.

Elevations are quarter metres, so sums and sums of squares are exact in doubles whatever their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import bits, names

_DIGITS = "+".join(f"((h DIV {7 ** (9 - i)}) % 7) * {1 << (45 - 3 * i)}" for i in range(1, 10))
_HEAD = (1 << 59) + (9 << 52) + (1 << 18) - 1


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, lat_band, lat, lon, h3_cell (resolution 9), elev: a pixel a line item."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    return items.withColumn("h", F.expr("(l_partkey * 521) % 40353607")).selectExpr(
        "l_orderkey", "l_linenumber", "1 + l_linenumber % 3 AS lat_band",
        "(l_orderkey * 7919 % 168000) / 1000.0D - 84.0D AS lat", "(l_partkey * 6151 % 360000) / 1000.0D - 180.0D AS lon",
        f"{_HEAD} + (l_suppkey % 122) * {1 << 45} + {_DIGITS} AS h3_cell",
        "(CAST(round(l_extendedprice * 100) AS bigint) % 37112) * 0.25D - 430.0D AS elev")


PX = f"""px AS (SELECT l_orderkey, l_linenumber, 1 + l_linenumber % 3 AS lat_band, (l_orderkey * 7919 % 168000) / 1000.0::DOUBLE - 84.0 AS lat,
  (l_partkey * 6151 % 360000) / 1000.0::DOUBLE - 180.0 AS lon, CAST({_HEAD} + (l_suppkey % 122) * {1 << 45} + {_DIGITS.replace("DIV", "//")} AS BIGINT) AS h3_cell,
  (CAST(round(l_extendedprice * 100) AS BIGINT) % 37112) * 0.25::DOUBLE - 430.0 AS elev
  FROM (SELECT *, (l_partkey * 521) % 40353607 AS h FROM lineitem))"""


def sql_parent(cell: str, res: int) -> str:
    unused = (1 << (45 - 3 * res)) - 1
    return f"(({cell} & {~((15 << 52) | unused)}) | {(res << 52) | unused})"


#: Published columns from count, sum, sumsq, min and max, as SQL.
STATS_SQL = """CAST(avg_ AS FLOAT) AS elevation_mean, CAST(max_ AS FLOAT) AS elevation_max, CAST(min_ AS FLOAT) AS elevation_min,
  CAST(sqrt(greatest(sq_ / n_ - pow(avg_, 2), 0.0)) AS FLOAT) AS elevation_stddev, n_ AS pixel_count"""
AGG_SQL = "count(*) AS n_, sum(elev) / count(*) AS avg_, sum(elev * elev) AS sq_, min(elev) AS min_, max(elev) AS max_"


def cells_sql(res: int, name: str) -> str:
    """A CTE of published cells of one resolution, with a geoid column from the id."""
    return f"""{name} AS (SELECT h3_cell, {STATS_SQL}, CAST(((h3_cell >> 19) % 800) * 0.25 - 110.0 AS FLOAT) AS geoid_undulation
  FROM (SELECT {sql_parent("h3_cell", res)} AS h3_cell, {AGG_SQL} FROM px GROUP BY 1))"""


def with_geoid(cells: DataFrame) -> DataFrame:
    return cells.withColumn("geoid_undulation", (F.shiftright("h3_cell", 19) % 800 * 0.25 - 110.0).cast("float"))


def cells(spark: SparkSession, sf_dir: str, res: int) -> DataFrame:
    from .operators import stats

    own = pixels(spark, sf_dir).withColumn("h3_cell", bits.parent(F.col("h3_cell"), res))
    return with_geoid(stats.aggregate(own, "h3_cell"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User points: a cell of resolution 9 that the table may lack, and an ellipsoidal height."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("h", F.expr("(o_custkey * 521) % 40353607")).selectExpr(
        "o_orderkey AS id", f"{_HEAD} + (o_custkey % 122) * {1 << 45} + {_DIGITS} AS h3_cell", "CAST(round(o_totalprice * 4) AS bigint) % 40000 * 0.25D AS h_ellipsoidal")


POINTS = f"""points AS (SELECT o_orderkey AS id, CAST({_HEAD} + (o_custkey % 122) * {1 << 45} + {_DIGITS.replace("DIV", "//")} AS BIGINT) AS h3_cell,
  CAST(round(o_totalprice * 4) AS BIGINT) % 40000 * 0.25::DOUBLE AS h_ellipsoidal FROM (SELECT *, (o_custkey * 521) % 40353607 AS h FROM orders))"""


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands done: the purchases of the event table, by time."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type = 'purchase'").selectExpr("concat('b', event_id) AS band", "ts AS completed_at")


def tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of all bands."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type IN ('purchase', 'view')").selectExpr("concat('b', event_id) AS band", "CAST(floor(value) AS bigint) + 1 AS tiles", "event_id AS lat")


COMMITS = "commits AS (SELECT 'b' || event_id AS band, ts AS completed_at FROM events WHERE event_type = 'purchase')"
TILES = "tiles AS (SELECT 'b' || event_id AS band, CAST(floor(value) AS BIGINT) + 1 AS tiles, event_id AS lat FROM events WHERE event_type IN ('purchase', 'view'))"


def tile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named tiles on a coarse raster of corners."""
    n, r = spark.read.parquet(f"{sf_dir}/nation.parquet"), spark.read.parquet(f"{sf_dir}/region.parquet")
    at = n.crossJoin(r).selectExpr("n_nationkey * 7 - 84 AS lat", "r_regionkey * 60 - 150 AS lon")
    return at.withColumn("name", names.tile_name(F.col("lat").cast("double"), F.col("lon").cast("double")))


TILE_ROWS = """tile_rows AS (SELECT lat, lon, 'Copernicus_DSM_COG_10_' || CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END || lpad(CAST(abs(lat) AS VARCHAR), 2, '0') || '_00_'
  || CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END || lpad(CAST(abs(lon) AS VARCHAR), 3, '0') || '_00_DEM' AS name
  FROM (SELECT n_nationkey * 7 - 84 AS lat, r_regionkey * 60 - 150 AS lon FROM nation CROSS JOIN region))"""


def geoid_grid(spark: SparkSession, rows: int = 19, cols: int = 37) -> DataFrame:
    """A small raster (row, col, n) of 10-degree steps from 95 N, 185 W."""
    return spark.range(rows * cols).selectExpr(f"CAST(id DIV {cols} AS int) AS row", f"CAST(id % {cols} AS int) AS col").withColumn("n", F.expr("((row * 37 + col * 11) % 200) * 0.5D - 50.0D"))


GEOID_ORIGIN = (-185.0, 10.0, 95.0, -10.0)
GEOID_GRID = "grid AS (SELECT r.range AS row, c.range AS col, ((r.range * 37 + c.range * 11) % 200) * 0.5::DOUBLE - 50.0 AS n FROM range(19) r CROSS JOIN range(37) c)"


def land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land by degree of latitude, whole square kilometres made from the parts table."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("CAST(p_partkey % 180 AS int) AS k", "p_size")
    sums = part.groupBy("k").agg(F.sum("p_size").alias("s"))
    return spark.range(180).selectExpr("CAST(id AS int) AS k").join(sums, "k", "left").selectExpr("90 - k AS lat_north", "89 - k AS lat_south", "CAST(coalesce(s, 0) * 5000 + (k * 7919 % 1000) * 100 AS double) AS land_km2")


LAND = """land AS (SELECT CAST(90 - k AS INTEGER) AS lat_north, CAST(89 - k AS INTEGER) AS lat_south, CAST(coalesce(s, 0) * 5000 + (k * 7919 % 1000) * 100 AS DOUBLE) AS land_km2
  FROM (SELECT range AS k FROM range(180)) LEFT JOIN (SELECT p_partkey % 180 AS k, sum(p_size) AS s FROM part GROUP BY 1) USING (k))"""


def geotiff(data, origin: tuple[float, float, float, float]) -> bytes:
    """A GeoTIFF file of one uncompressed strip of doubles."""
    import struct

    h, w = data.shape
    x0, dx, y0, dy = origin
    body = data.astype("<f8").tobytes()
    tags = [(256, 3, [w]), (257, 3, [h]), (258, 3, [64]), (259, 3, [1]), (273, 4, [8]), (278, 3, [h]), (279, 4, [len(body)]), (339, 3, [3]), (33550, 12, [dx, -dy, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x0, y0, 0.0])]
    at, entries, more = 8 + len(body) + 2 + 12 * len(tags) + 4, b"", b""
    for tag, kind, values in tags:
        raw = struct.pack("<" + str(len(values)) + {3: "H", 4: "I", 12: "d"}[kind], *values)
        entries += struct.pack("<HHI", tag, kind, len(values)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", at + len(more)))
        more += raw if len(raw) > 4 else b""
    return b"II" + struct.pack("<HI", 42, 8 + len(body)) + body + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + more
