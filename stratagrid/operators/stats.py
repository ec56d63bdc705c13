"""Mergeable statistics of cells: partial, merge, finalize, and what is built on them.

A partial is (keys..., count, sum, sumsq, min, max) in doubles and longs. All are plain aggregates, so Spark combines on
the map side, spills, and merges tiles and bands in one shuffle on the cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import bits, geo

STATES = ("count", "sum", "sumsq", "min", "max")
CELL_COLUMNS = ("h3_cell", "elevation_mean", "elevation_max", "elevation_min", "elevation_stddev", "pixel_count")


def partial(pixels: DataFrame, *keys: str, elev: str = "elev") -> DataFrame:
    """Folds pixels into partials by the given keys."""
    e = F.col(elev).cast("double")
    return pixels.groupBy(*keys).agg(F.count(e).alias("count"), F.sum(e).alias("sum"), F.sum(e * e).alias("sumsq"), F.min(e).alias("min"), F.max(e).alias("max"))


def merge(parts: list[DataFrame] | DataFrame, *keys: str) -> DataFrame:
    """Composes partials of the same keys; the order and grouping of parts don't matter."""
    together = parts if isinstance(parts, DataFrame) else reduce(DataFrame.unionByName, parts)
    return together.groupBy(*keys).agg(*[{"min": F.min, "max": F.max}.get(s, F.sum)(s).alias(s) for s in STATES])


def _deviation(total: Column, squares: Column, n: Column) -> Column:
    """Population standard deviation; rounding can't make it the root of a negative number. Null of no pixels."""
    return F.when(n > 0, F.sqrt(F.greatest(squares / n - F.pow(total / n, F.lit(2.0)), F.lit(0.0))))


def finalize(partials: DataFrame, *keys: str) -> DataFrame:
    """Partials to published statistics: computed in doubles, narrowed last."""
    n = F.col("count")
    return partials.select(
        *keys, (F.col("sum") / n).cast("float").alias("elevation_mean"), F.col("max").cast("float").alias("elevation_max"), F.col("min").cast("float").alias("elevation_min"),
        _deviation(F.col("sum"), F.col("sumsq"), n).cast("float").alias("elevation_stddev"), n.cast("long").alias("pixel_count"))


def aggregate(pixels: DataFrame, *keys: str, elev: str = "elev") -> DataFrame:
    """Pixels to published statistics in one step."""
    return finalize(partial(pixels, *keys, elev=elev), *keys)


def boundary_merge(cells: DataFrame, *keys: str) -> DataFrame:
    """Merges published statistics of the same cell, of which only mean, deviation, extremes and count are left."""
    n, mean, std = F.col("pixel_count").cast("double"), F.col("elevation_mean").cast("double"), F.col("elevation_stddev").cast("double")
    total, squares, count = F.sum(mean * n), F.sum((std * std + mean * mean) * n), F.sum("pixel_count")
    return cells.groupBy(*keys).agg(
        (total / count).cast("float").alias("elevation_mean"), F.max("elevation_max").alias("elevation_max"), F.min("elevation_min").alias("elevation_min"),
        _deviation(total, squares, count).cast("float").alias("elevation_stddev"), count.cast("long").alias("pixel_count"))


def merged_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many rows a boundary merge took away."""
    return before.agg(F.count(F.lit(1)).alias("rows_in")).crossJoin(after.agg(F.count(F.lit(1)).alias("rows_out"))).withColumn("merged", F.col("rows_in") - F.col("rows_out"))


def fan_out(pixels: DataFrame, resolutions: tuple[int, ...], cell: str = "h3_cell") -> DataFrame:
    """A row per pixel and resolution, by the ancestors of the pixel's cell; one scan serves all resolutions."""
    each = F.array(*[F.struct(F.lit(r).alias("res"), bits.parent(F.col(cell), r).alias("h3_cell")) for r in resolutions])
    return pixels.withColumn("_at", F.explode(each)).select(*[c for c in pixels.columns if c not in (cell, "res")], "_at.res", "_at.h3_cell")


def pyramid(pixels: DataFrame, resolutions: tuple[int, ...], cell: str = "h3_cell") -> DataFrame:
    """Statistics (res, h3_cell, ...) of the ancestors of the pixels' cells at several resolutions. Pixels are folded at the
    finest of them first; the others get partials of cells, not pixels."""
    finest = max(resolutions)
    own = pixels.select(bits.parent(F.col(cell), finest).alias(cell), "elev")
    return finalize(merge(fan_out(partial(own, cell), resolutions, cell), "res", "h3_cell"), "res", "h3_cell")


def located(pixels: DataFrame, resolutions: tuple[int, ...], lat: str = "lat", lon: str = "lon", nodata: float | None = None) -> DataFrame:
    """Valid pixels with their cell at each resolution, found from the point itself; pixels whose coordinates are missing
    or not finite are left out. The mask stands before the Python function, so that it isn't called on pixels that are
    dropped."""
    from ..functions.grid_udfs import latlng_to_cells

    good = pixels.filter(geo.valid_elevation(F.col("elev"), nodata) & geo.valid_elevation(F.col(lat)) & geo.valid_elevation(F.col(lon)))
    return good.withColumn("_at", F.explode(latlng_to_cells(F.col(lat), F.col(lon), resolutions))).select(*pixels.columns, "_at.res", "_at.h3_cell")


def rollup(partials: DataFrame, res: int, cell: str = "h3_cell") -> DataFrame:
    """Partials of the ancestors at a coarser resolution; exact in every state."""
    return merge(partials.withColumn(cell, bits.parent(F.col(cell), res)), cell)


def straddling(partials: DataFrame, part: str, cell: str = "h3_cell") -> DataFrame:
    """Cells that more than one part (tile, band) has."""
    return partials.groupBy(cell).agg(F.count_distinct(part).alias("parts")).filter("parts > 1")


def differences(a: DataFrame, b: DataFrame, *keys: str, tolerance: float = 1e-3) -> DataFrame:
    """Rows on which two sets of partials differ: keys in one only; count, min or max not equal; sums further apart
    than the tolerance. None: the sets are the same."""
    both = a.alias("a").join(b.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{s}").eqNullSafe(F.col(f"b.{s}")) for s in ("count", "min", "max")])
    close = F.coalesce(F.abs(F.col("a.sum") - F.col("b.sum")) <= tolerance, F.lit(False))
    return both.filter(~(same & close)).select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], F.col("a.count").alias("count_a"), F.col("b.count").alias("count_b"))


def aligned(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Of the keys of a: how many b has, and the largest differences of count and sum there."""
    joined = a.alias("a").join(b.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "left")
    return joined.agg(
        F.count(F.lit(1)).alias("keys"), F.count("b.count").alias("found"), F.max(F.abs(F.col("a.count") - F.col("b.count"))).alias("max_count_diff"),
        F.max(F.abs(F.col("a.sum") - F.col("b.sum"))).alias("max_sum_diff"), F.count_if(F.col("b.count") > F.col("a.count")).alias("gained"))


def hypsographic_curve(cells: DataFrame) -> DataFrame:
    """Share of cells (percent) at or above each elevation, over cells of about equal area: 0 at the highest, 100 at the
    lowest. Equal elevations count once. The ranking is a running sum in two levels: within each whole metre, and over
    the metres, of which there are some thousands; NaN ranks highest."""
    e = F.col("elevation_mean")
    metre = F.when(F.isnan(e), F.lit((1 << 63) - 1)).otherwise(F.floor(e).cast("long"))
    heights = cells.filter(e.isNotNull()).groupBy("elevation_mean").agg(F.count(F.lit(1)).alias("cells")).withColumn("metre", metre)
    metres = heights.groupBy("metre").agg(F.sum("cells").alias("size"))
    down = Window.orderBy(F.desc("metre")).rowsBetween(Window.unboundedPreceding, 0)
    before = metres.select("metre", (F.sum("size").over(down) - F.col("size")).alias("before"))
    inner = F.sum("cells").over(Window.partitionBy("metre").orderBy(F.desc("elevation_mean")).rowsBetween(Window.unboundedPreceding, 0)) - F.col("cells")
    n = metres.agg(F.sum("size").alias("n"))
    ranked = heights.withColumn("inner", inner).join(before, "metre").crossJoin(n)
    above = F.col("before") + F.col("inner")
    return ranked.select("elevation_mean", "cells", F.when(F.col("n") > 1, above * 100.0 / (F.col("n") - 1)).otherwise(F.lit(0.0)).alias("area_percent"))
