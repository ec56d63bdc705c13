"""Validation as DataFrames: each check is a row (section, check, detail, ok)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import bits
from . import stats

ELEVATION = (-432.0, 8849.0)
GEOID = (-110.0, 90.0)
COLUMNS = (("h3_cell", "bigint"), ("elevation_mean", "float"), ("elevation_max", "float"), ("elevation_min", "float"), ("elevation_stddev", "float"), ("pixel_count", "bigint"), ("geoid_undulation", "float"))


def _check(section: str, check: Column | str, detail: Column, ok: Column) -> list[Column]:
    name = F.lit(check) if isinstance(check, str) else check
    return [F.lit(section).alias("section"), name.alias("check"), detail.alias("detail"), F.coalesce(ok, F.lit(False)).alias("ok")]


def invariants(cells: DataFrame, tolerance: float = 0.01, strict: bool = False) -> DataFrame:
    """Counts of violations by resolution, in one scan: order of min, mean and max; negative deviations or counts below
    1; NaN and infinite values (of mean and geoid; of all columns if strict); elevations and geoid out of range."""
    low, mean, high, geoid = (F.col(c).cast("double") for c in ("elevation_min", "elevation_mean", "elevation_max", "geoid_undulation"))
    watched = ["elevation_mean", "geoid_undulation", *(["elevation_max", "elevation_min", "elevation_stddev"] if strict else [])]
    odd = reduce(lambda a, b: a | b, [F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in watched])
    return cells.groupBy("res").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if((low > mean + tolerance) | (mean > high + tolerance)).alias("bad_order"),
        F.count_if((F.col("elevation_stddev") < 0) | (F.col("pixel_count") < 1)).alias("bad_sign"), F.count_if(odd).alias("bad_value"),
        F.count_if((high > ELEVATION[1]) | (low < ELEVATION[0])).alias("bad_elevation"), F.count_if((geoid < GEOID[0]) | (geoid > GEOID[1])).alias("bad_geoid"),
        F.sum("pixel_count").alias("pixels"), F.min("elevation_min").alias("lowest"), F.max("elevation_max").alias("highest"))


def invariant_checks(cells: DataFrame, tolerance: float = 0.01, strict: bool = False) -> DataFrame:
    bad = ("bad_order", "bad_sign", "bad_value", "bad_elevation", "bad_geoid")
    detail = F.concat(F.format_number("cells", 0), F.lit(" rows; "), F.concat_ws(" ", *[F.concat(F.lit(f"{b}="), F.col(b)) for b in bad]))
    return invariants(cells, tolerance, strict).select(*_check("invariants", F.concat(F.lit("res"), F.col("res")), detail, sum(F.col(b) for b in bad) == 0))


def violations(cells: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """The rows that break an invariant."""
    fine = F.expr(f"elevation_min <= elevation_mean + {tolerance} AND elevation_mean <= elevation_max + {tolerance} AND elevation_stddev >= 0 AND pixel_count >= 1 AND elevation_min >= {ELEVATION[0]} AND elevation_max <= {ELEVATION[1]}")
    return cells.filter(~fine)


def conservation(cells: DataFrame, reference_res: int = 9, tolerance: float = 0.0) -> DataFrame:
    """Pixels by resolution against those of the reference: all resolutions count the same pixels."""
    totals = cells.groupBy("res").agg(F.sum("pixel_count").alias("pixels"))
    base = totals.filter(F.col("res") == reference_res).select(F.col("pixels").alias("base"))
    spread = F.abs(F.col("pixels") - F.col("base")) / F.col("base")
    return totals.crossJoin(base).select("res", "pixels", spread.alias("spread"), (spread <= tolerance).alias("ok"))


def landmarks(points: DataFrame, cells: DataFrame) -> DataFrame:
    """points: (name, h3_cell, column, expected, tol). The column's value in the cell is within the tolerance; a cell that
    the table lacks fails."""
    held = [c for c, _ in COLUMNS if c != "h3_cell" and c in cells.columns]
    value = reduce(lambda a, c: F.when(F.col("column") == c, F.col(c).cast("double")).otherwise(a), held, F.lit(None).cast("double"))
    found = points.join(cells.select("h3_cell", *held), "h3_cell", "left").withColumn("value", value)
    return found.select("name", "column", "value", "expected", "tol", F.coalesce(F.abs(F.col("value") - F.col("expected")) <= F.col("tol"), F.lit(False)).alias("ok"))


def shard_integrity(sharded: DataFrame, every: int = 10, most: int = 12) -> DataFrame:
    """Cells whose bits differ from their shard, in every tenth shard in string order, twelve at most. The sample of
    shards is the check's definition; misfiled(sharded) covers all."""
    shards = sharded.select("base").distinct()
    rank = F.row_number().over(Window.orderBy(F.col("base").cast("string"))) - 1
    chosen = shards.withColumn("rank", rank).filter((F.col("rank") % every == 0) & (F.col("rank") < every * most)).select("base")
    return misfiled(sharded.join(F.broadcast(chosen), "base"))


def misfiled(sharded: DataFrame) -> DataFrame:
    """By shard: cells, and cells whose bits say another one."""
    return sharded.groupBy("base").agg(F.count(F.lit(1)).alias("cells"), F.count_if(bits.base_cell(F.col("h3_cell")) != F.col("base")).alias("misfiled"))


def hypsographic(cells: DataFrame, low: float = 600.0, high: float = 1100.0) -> DataFrame:
    """Mean elevation of cells of about equal area, and shares below 200 m and above 1000 m."""
    mean = F.avg(F.col("elevation_mean").cast("double"))
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return cells.agg(mean.alias("mean"), share(F.col("elevation_mean") < 200).alias("below_200"), share(F.col("elevation_mean") > 1000).alias("above_1000")).withColumn("ok", F.col("mean").between(low, high))


def uniqueness(cells: DataFrame) -> DataFrame:
    """By resolution: rows, and rows beyond one a cell."""
    return cells.groupBy("res", "h3_cell").agg(F.count(F.lit(1)).alias("n")).groupBy("res").agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("repeated"))


def cell_validity(cells: DataFrame) -> DataFrame:
    """By resolution: ids that aren't cells, or are cells of another resolution."""
    cell = F.col("h3_cell")
    return cells.groupBy("res").agg(F.count(F.lit(1)).alias("cells"), F.count_if(~bits.is_valid(cell)).alias("invalid"), F.count_if(bits.resolution(cell) != F.col("res")).alias("other_resolution"))


def schema(cells: DataFrame) -> DataFrame:
    """Columns and types in their order."""
    have = [(f, t) for f, t in cells.dtypes if f != "base"]
    ok = have == list(COLUMNS)
    return cells.sparkSession.createDataFrame([("schema", "columns and types", str(have), ok)], "section string, check string, detail string, ok boolean")


def completeness(expected: DataFrame, done: DataFrame, key: str = "band") -> DataFrame:
    """Expected bands that aren't there: land that would read as ocean."""
    return expected.select(key).distinct().join(done.select(key).distinct(), key, "left_anti")


def cross_resolution(fine: DataFrame, coarse: DataFrame, coarse_res: int) -> DataFrame:
    """Partials of a resolution rolled up, against those found directly there: by cell, counts and sums of both."""
    up = stats.rollup(fine, coarse_res)
    a, b = up.select("h3_cell", F.col("count").alias("up_count"), F.col("sum").alias("up_sum")), coarse.select("h3_cell", "count", "sum")
    return a.join(b, "h3_cell", "full_outer").select("h3_cell", "up_count", "count", "up_sum", "sum", (F.col("up_count").eqNullSafe(F.col("count"))).alias("same_count"))


def coverage(cells: DataFrame, land: DataFrame, cell_area: float) -> DataFrame:
    """By whole latitude: area of the cells against that of land (lat, land_km2)."""
    own = cells.groupBy(F.floor("lat").cast("int").alias("lat")).agg(F.count(F.lit(1)).alias("cells"))
    both = own.join(land, "lat", "full_outer")
    return both.select("lat", F.coalesce("cells", F.lit(0)).alias("cells"), (F.coalesce("cells", F.lit(0)) * cell_area).alias("cell_km2"), F.coalesce("land_km2", F.lit(0.0)).alias("land_km2"))


def agl_check(fix: DataFrame, cells: DataFrame, limit: float = 8.0) -> DataFrame:
    """A fix on the ground is at a height of about nothing."""
    from .joins import above_ground

    return above_ground(fix, cells).select("name", "agl", (F.abs("agl") < limit).alias("ok"))


def row_counts(cells: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows by resolution against expected ones (res, expected)."""
    have = cells.groupBy("res").agg(F.count(F.lit(1)).alias("cells"))
    return expected.join(have, "res", "full_outer").select("res", "expected", F.coalesce("cells", F.lit(0)).alias("cells"), F.col("expected").eqNullSafe(F.coalesce("cells", F.lit(0))).alias("ok"))


def regressions(cells: DataFrame, golden: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Golden rows (h3_cell, elevation_mean, pixel_count) that the table no longer has."""
    g = golden.select("h3_cell", F.col("elevation_mean").alias("was_mean"), F.col("pixel_count").alias("was_count"))
    same = (F.abs(F.col("elevation_mean") - F.col("was_mean")) <= tolerance) & (F.col("pixel_count") == F.col("was_count"))
    return g.join(cells.select("h3_cell", "elevation_mean", "pixel_count"), "h3_cell", "left").filter(~F.coalesce(same, F.lit(False)))


def ground_truth(cells: DataFrame, pixels: DataFrame) -> DataFrame:
    """Published cells (h3_cell, elevation_mean, pixel_count) against the pixels (h3_cell, elev) that fall in them: the
    difference of means, and whether counts agree."""
    own = pixels.groupBy("h3_cell").agg(F.avg(F.col("elev").cast("double")).alias("pixel_mean"), F.count("elev").alias("pixels"))
    return cells.join(own, "h3_cell", "left").select("h3_cell", F.abs(F.col("elevation_mean").cast("double") - F.col("pixel_mean")).alias("difference"), F.col("pixel_count").eqNullSafe(F.col("pixels")).alias("same_count"))


def random_cells(cells: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n cells that don't depend on how they are stored: those with the smallest hashes of their ids."""
    return cells.orderBy(F.md5(F.concat_ws(" ", F.lit(str(seed)), F.col("h3_cell").cast("string"))), "h3_cell").limit(n)


def performance(table, cell: int) -> DataFrame:
    """How long a lookup and a full count take; always passes."""
    import time

    rows = []
    for name, action in (("lookup of one cell", lambda: table.lookup(cell).count()), ("full count", lambda: table.read().count())):
        start = time.perf_counter()
        n = action()
        rows.append(("performance", name, f"{n} rows in {(time.perf_counter() - start) * 1000:.0f} ms", True))
    return table.spark.createDataFrame(rows, "section string, check string, detail string, ok boolean")


def suite(cells: DataFrame, points: DataFrame | None = None, reference_res: int = 9, curve_res: int = 5, spread: float = 1e-3) -> DataFrame:
    """The checks of a whole table (res and the published columns) as one report: invariants, conservation, validity,
    uniqueness, the distribution of elevations, and landmarks (see landmarks()) if given."""
    at = F.concat(F.lit("res"), F.col("res"))
    parts = [
        invariant_checks(cells),
        conservation(cells, reference_res, spread).select(*_check("conservation", at, F.concat(F.col("pixels"), F.lit(" pixels, spread "), F.col("spread")), F.col("ok"))),
        cell_validity(cells).select(*_check("cells", F.concat(at, F.lit(" validity")), F.concat(F.col("invalid") + F.col("other_resolution"), F.lit(" of "), F.col("cells")), F.col("invalid") + F.col("other_resolution") == 0)),
        uniqueness(cells).select(*_check("cells", F.concat(at, F.lit(" uniqueness")), F.concat(F.col("repeated"), F.lit(" repeated")), F.col("repeated") == 0)),
        hypsographic(cells.filter(F.col("res") == curve_res)).select(*_check("hypsographic", "mean land elevation", F.concat(F.round("mean", 0), F.lit(" m")), F.col("ok"))),
    ]
    if points is not None:
        parts.append(landmarks(points, cells).select(*_check("landmarks", F.col("name"), F.concat(F.col("column"), F.lit("="), F.coalesce(F.col("value").cast("string"), F.lit("not found"))), F.col("ok"))))
    return reduce(DataFrame.unionByName, parts)


def report(checks: DataFrame) -> str:
    """Checks as Markdown; they are a handful of rows."""
    rows = checks.orderBy("section", "check").collect()
    head = f"{sum(r['ok'] for r in rows)} of {len(rows)} checks pass\n\n| | section | check | detail |\n|-|-|-|-|\n"
    return head + "".join(f"| {'PASS' if r['ok'] else 'FAIL'} | {r['section']} | {r['check']} | {r['detail']} |\n" for r in rows)
