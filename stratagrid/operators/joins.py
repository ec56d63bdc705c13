"""Joins of points with cells and grids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bits, geo


def bulk_join(points: DataFrame, cells: DataFrame, how: str = "inner", cell: str = "h3_cell") -> DataFrame:
    """Points (with a cell) joined to a cell table on shard and cell. The shard of the points is bit arithmetic, so a
    table partitioned by it is pruned at run time to the shards that points fall in; Spark broadcasts the points while
    they are few and shuffles both sides beyond that, splitting skewed cells."""
    routed = points.withColumn("base", bits.base_cell(F.col(cell)).cast("int"))
    sharded = cells if "base" in cells.columns else cells.withColumn("base", bits.base_cell(F.col(cell)))
    return routed.join(sharded.withColumn("base", F.col("base").cast("int")), ["base", cell], how).drop("base")


def with_ocean(points: DataFrame, cells: DataFrame, cell: str = "h3_cell", column: str = "elevation_mean") -> DataFrame:
    """As a left join: cells that the table lacks are open ocean, at 0 m."""
    return bulk_join(points, cells.select(cell, column, *(["base"] if "base" in cells.columns else [])), "left", cell).withColumn(column, F.coalesce(F.col(column), F.lit(0).cast("float")))


def above_ground(points: DataFrame, cells: DataFrame, cell: str = "h3_cell", height: str = "h_ellipsoidal") -> DataFrame:
    """Adds agl, the height above ground of points with an ellipsoidal height, for those whose cell the table has."""
    keep = [cell, "elevation_mean", "geoid_undulation", *(["base"] if "base" in cells.columns else [])]
    return bulk_join(points, cells.select(*keep), "inner", cell).withColumn("agl", geo.above_ground(F.col(height), F.col("elevation_mean").cast("double"), F.col("geoid_undulation").cast("double")))


def weighted_regions(landmarks: DataFrame, cells: DataFrame, half: float = 0.4, bin_degrees: float = 1.0) -> DataFrame:
    """Pixel-weighted mean elevation of the cells within ``half`` degrees of each landmark (name, lat, lon, lo, hi), or
    their plain mean where no cell has pixels. Landmarks without cells stay, with nulls.

    The range condition is met by an equi-join of bins: a landmark goes to the few bins that its window touches, so no
    pair outside of them is looked at. The landmarks' weights are summed per cell before they are joined back."""
    bin_of = lambda c: F.floor(c / bin_degrees)
    spread = lambda c: F.explode(F.sequence(bin_of(F.col(c) - half), bin_of(F.col(c) + half)))
    asked = landmarks.withColumn("_by", spread("lat")).withColumn("_bx", spread("lon"))
    placed = cells.withColumn("_by", bin_of(F.col("lat"))).withColumn("_bx", bin_of(F.col("lon")))
    near = (F.abs(F.col("c.lat") - F.col("l.lat")) < half) & (F.abs(F.col("c.lon") - F.col("l.lon")) < half)
    e, w = F.col("c.elevation_mean").cast("double"), F.col("c.pixel_count").cast("double")
    found = placed.alias("c").join(asked.alias("l"), (F.col("c._by") == F.col("l._by")) & (F.col("c._bx") == F.col("l._bx")) & near).groupBy("l.name").agg(
        F.sum(e * w).alias("ew"), F.sum(w).alias("w"), F.avg(e).alias("plain"), F.count(F.lit(1)).alias("cells"))
    value = F.when(F.col("w") > 0, F.col("ew") / F.col("w")).otherwise(F.col("plain"))
    out = landmarks.join(found, "name", "left").withColumn("value", value)
    verdict = F.when(F.col("value").isNull(), "not yet processed").when((F.col("value") >= F.col("lo") - 250) & (F.col("value") <= F.col("hi") + 400), "OK").otherwise("CHECK")
    return out.select("name", "lo", "hi", F.coalesce("cells", F.lit(0)).alias("cells"), "value", verdict.alias("verdict"))


# ---- sampling of a raster grid -----------------------------------------------------------------------------------


def _taps(lat: Column, lon: Column, origin: tuple[float, float, float, float], rows: int, cols: int) -> dict[str, Column]:
    x0, dx, y0, dy = origin
    r = F.greatest(F.lit(0.0), F.least(F.lit(rows - 1.0), (lat - y0) / dy - 0.5))
    c = F.greatest(F.lit(0.0), F.least(F.lit(cols - 1.0), (lon - x0) / dx - 0.5))
    r0, c0 = F.floor(r), F.floor(c)
    return {"r0": r0.cast("int"), "c0": c0.cast("int"), "r1": F.least(r0 + 1, F.lit(rows - 1)).cast("int"), "c1": F.least(c0 + 1, F.lit(cols - 1)).cast("int"), "fr": r - r0, "fc": c - c0}


def bilinear(points: DataFrame, grid: DataFrame, origin: tuple[float, float, float, float], rows: int, cols: int, lat: str = "lat", lon: str = "lon", name: str = "value") -> DataFrame:
    """Samples a grid table (row, col, n) at points, bilinear between pixel centres, held at the grid's edges.
    origin: (x0, dx, y0, dy) of the grid. A join for each of four taps; Spark broadcasts a small grid.

    Points outside are held at the edge, also across the date line. Points without coordinates get null."""
    taps = _taps(F.col(lat), F.col(lon), origin, rows, cols)
    out = points.select("*", *[c.alias(f"_{k}") for k, c in taps.items()])
    for i, (r, c) in enumerate((("r0", "c0"), ("r0", "c1"), ("r1", "c0"), ("r1", "c1"))):
        own = grid.select(F.col("row").alias(f"_{r}"), F.col("col").alias(f"_{c}"), F.col("n").alias(f"_n{i}"))
        out = out.join(own, [f"_{r}", f"_{c}"], "left")
    top = F.col("_n0") * (1 - F.col("_fc")) + F.col("_n1") * F.col("_fc")
    low = F.col("_n2") * (1 - F.col("_fc")) + F.col("_n3") * F.col("_fc")
    return out.select(*points.columns, (top * (1 - F.col("_fr")) + low * F.col("_fr")).alias(name))


#: A raster that is broadcast whole: the largest published geoid grid (2.5 minutes) has 4321 x 8640 doubles.
BROADCAST_BYTES = 320 << 20


def sample_raster(points: DataFrame, raster, origin: tuple[float, float, float, float], lat: str = "lat", lon: str = "lon", name: str = "geoid_undulation") -> DataFrame:
    """As bilinear(), over a numpy array of checked size in the workers' memory; for many points. Gives floats."""
    raster = np.ascontiguousarray(raster, dtype=np.float64)
    if raster.nbytes > BROADCAST_BYTES:
        raise ValueError("the raster is too large to broadcast; write it as a table and use bilinear()")
    held, (x0, dx, y0, dy), (rows, cols) = points.sparkSession.sparkContext.broadcast(raster.ravel()), origin, raster.shape

    def along(at: pa.Array, zero: float, step: float, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pixel centre at or before each coordinate, how far beyond it, in pixels, and which have no coordinate."""
        f = np.array(at.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float)
        f -= zero + step / 2
        f /= step
        missing = np.isnan(f)
        if missing.any():
            f[missing] = 0
        np.clip(f, 0, n - 1, out=f)
        first = f.astype(np.int64)
        np.minimum(first, max(n - 2, 0), out=first)  # the last centre is the second of its pair
        f -= first
        return first, f, missing

    @F.arrow_udf(T.FloatType())
    def sample(lat: pa.Array, lon: pa.Array) -> pa.Array:
        g = held.value
        r, fr, no_lat = along(lat, y0, dy, rows)
        c, fc, no_lon = along(lon, x0, dx, cols)
        r *= cols
        r += c
        right, down = (1 if cols > 1 else 0), (cols if rows > 1 else 0)
        low = g[r]
        top = low + (g[r + right] - low) * fc
        r += down
        low = g[r]
        low += (g[r + right] - low) * fc
        low -= top
        low *= fr
        low += top
        return pa.array(low.astype(np.float32), mask=no_lat | no_lon)

    return points.withColumn(name, sample(F.col(lat), F.col(lon)))
