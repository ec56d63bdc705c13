"""Planning and progress: bands of latitude, time to completion, caches, throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LAND_SCHEMA = "lat_north int, lat_south int, land_km2 double"
BYTES_PER_ROW = 30
#: Mean area of a cell in km2 by resolution.
CELL_AREA_KM2 = {2: 86746.0, 3: 12393.0, 4: 1770.0, 5: 253.0, 6: 36.0, 7: 5.16, 8: 0.74, 9: 0.105}


def read_land(spark: SparkSession, path: str) -> DataFrame:
    """Land area by degree of latitude, a CSV with a header."""
    return spark.read.schema(LAND_SCHEMA).option("header", True).csv(path)


def cumulative_land(land: DataFrame) -> DataFrame:
    """Adds the land from the pole down to each southern edge. The table has a row a degree, 180 at most."""
    down = Window.orderBy(F.desc("lat_north")).rowsBetween(Window.unboundedPreceding, 0)
    return land.withColumn("cum_km2", F.sum("land_km2").over(down))


def next_cut(land: DataFrame, step: int) -> DataFrame:
    """Adds legal (whether a band may end at the southern edge) and the land of the step that would follow."""
    legal = (F.pmod(F.col("lat_south"), F.lit(step)) == 0) | (F.col("lat_south") == -90)
    run = cumulative_land(land).withColumn("legal", legal)
    cuts = run.filter("legal").withColumn("next_km2", F.coalesce(F.lead("cum_km2").over(Window.orderBy(F.desc("lat_north"))) - F.col("cum_km2"), F.lit(0.0)))
    return run.join(cuts.select("lat_south", "next_km2"), "lat_south", "left")


def band_plan(land: DataFrame, res: int, step: int, fixed_cuts: list[int] | None = None, target_mb: float = 500.0) -> DataFrame:
    """Bands from north to south whose files come close to a size: band, lat_north, lat_south, land_km2, est_rows, est_mb.

    A band ends at a legal latitude (a multiple of step, or the south pole) when what it has is nearer to the target than
    it would be with the next step. The rule resets as it cuts, so it is a fold over the ordered steps, of which there
    are 180 at most; fixed_cuts gives the cuts instead."""
    cell = CELL_AREA_KM2[res]
    target = target_mb * 1e6 / BYTES_PER_ROW * cell
    if fixed_cuts is not None:
        edges = land.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(fixed_cuts, fixed_cuts[1:]))], "band int, lat_north int, lat_south int")
        inside = (F.col("l.lat_south") >= F.col("e.lat_south")) & (F.col("l.lat_north") <= F.col("e.lat_north"))
        bands = edges.alias("e").join(land.alias("l"), inside, "left").groupBy("band", "e.lat_north", "e.lat_south").agg(F.coalesce(F.sum("land_km2"), F.lit(0.0)).alias("land_km2"))
    else:
        rows = F.array_sort(F.collect_list(F.struct((-F.col("lat_north")).alias("o"), "lat_south", "land_km2", "legal", F.coalesce("next_km2", F.lit(0.0)).alias("next_km2"))))
        start = F.struct(F.lit(0.0).alias("acc"), F.lit(90).alias("north"), F.array().cast("array<struct<lat_north:int,lat_south:int,land_km2:double>>").alias("bands"))

        def step_(s: Column, x: Column) -> Column:
            acc = s["acc"] + x["land_km2"]
            cut = x["legal"] & ((x["lat_south"] == -90) | (acc >= target - x["next_km2"] / 2))
            more = F.concat(s["bands"], F.array(F.struct(s["north"].alias("lat_north"), x["lat_south"].alias("lat_south"), acc.alias("land_km2"))))
            return F.struct(F.when(cut, 0.0).otherwise(acc).alias("acc"), F.when(cut, x["lat_south"]).otherwise(s["north"]).alias("north"), F.when(cut, more).otherwise(s["bands"]).alias("bands"))

        folded = next_cut(land, step).agg(rows.alias("rows")).select(F.aggregate("rows", start, step_)["bands"].alias("bands"))
        bands = folded.select(F.posexplode("bands").alias("band", "b")).select("band", "b.*")
    return bands.select("band", "lat_north", "lat_south", "land_km2", (F.col("land_km2") / cell).alias("est_rows"), (F.col("land_km2") / cell * BYTES_PER_ROW / 1e6).alias("est_mb"))


def write_plan(plan: DataFrame, path: str) -> None:
    rounded = plan.orderBy("band").select("band", "lat_north", "lat_south", F.round("land_km2", 1).alias("land_km2"), F.round("est_rows", 0).cast("long").alias("est_rows"), F.round("est_mb", 1).alias("est_mb"))
    rounded.coalesce(1).write.option("header", True).mode("overwrite").csv(path)


# ---- progress ----------------------------------------------------------------------------------------------------


def band_seconds(commits: DataFrame) -> DataFrame:
    """Adds to commits (band, completed_at) the seconds since the one before it, in order of completion: the time that
    the band took, bands being done one after another."""
    order = Window.orderBy("completed_at", "band")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return commits.withColumn("seconds", (micros("completed_at") - F.lag(micros("completed_at")).over(order)) / 1e6)


def eta(commits: DataFrame, tiles: DataFrame, window: int = 12) -> DataFrame:
    """Progress of a sweep over bands of known tile counts (band, tiles), one row.

    The rate is the median of seconds per tile over the latest ``window`` bands (0: all), after those off the window's
    median by more than a factor of four are dropped. Bands without tiles, or without time, say nothing. With fewer than
    two observations the rate is null."""
    seen = band_seconds(commits).join(tiles, "band").filter("seconds > 0 AND tiles > 0").withColumn("rate", F.col("seconds") / F.col("tiles"))
    recent = seen.withColumn("back", F.row_number().over(Window.orderBy(F.desc("completed_at"), F.desc("band"))))
    recent = recent.filter(F.col("back") <= window) if window > 0 else recent
    middle = recent.agg(F.median("rate").alias("window_rate"), F.count(F.lit(1)).alias("observed"))
    kept = recent.crossJoin(middle).filter((F.col("rate") >= 0.25 * F.col("window_rate")) & (F.col("rate") <= 4 * F.col("window_rate")))
    rate = kept.agg(F.median("rate").alias("kept_rate"), F.count(F.lit(1)).alias("kept"))
    overall = seen.agg(F.median("rate").alias("overall_rate"))
    all_ = tiles.join(commits.select("band", F.lit(1).alias("done")), "band", "left")
    totals = all_.agg(
        F.count(F.lit(1)).alias("bands"), F.count("done").alias("bands_done"), F.sum("tiles").alias("tiles"), F.sum(F.when(F.col("done").isNull(), F.col("tiles")).otherwise(0)).alias("tiles_left"))
    one = totals.crossJoin(middle).crossJoin(rate).crossJoin(overall)
    enough = F.col("observed") >= 2
    speed = F.when(enough, F.coalesce("kept_rate", "window_rate"))
    shift = F.col("overall_rate") / speed
    note = F.when(shift > 1.3, "faster").when(shift < 0.77, "slower").otherwise("steady")
    return one.select("bands", "bands_done", "tiles", "tiles_left", "observed", "kept", speed.alias("seconds_per_tile"), "overall_rate", (speed * F.col("tiles_left")).alias("seconds_left"), F.when(enough, note).alias("note"))


def todo(bands: DataFrame, commits: DataFrame) -> DataFrame:
    """Bands without a commit, from north to south."""
    return bands.join(commits, "band", "left_anti").orderBy(F.desc("lat"))


def heaviest(tiles: DataFrame, commits: DataFrame, n: int = 5) -> DataFrame:
    """The n bands left that have most tiles."""
    return tiles.join(commits, "band", "left_anti").orderBy(F.desc("tiles"), "band").limit(n)


def outliers_trimmed(df: DataFrame, column: str, low: float = 0.25, high: float = 4.0) -> DataFrame:
    """Rows whose value is within factors of the median."""
    return df.crossJoin(df.agg(F.median(column).alias("_median"))).filter((F.col(column) >= low * F.col("_median")) & (F.col(column) <= high * F.col("_median"))).drop("_median")


def evictions(files: DataFrame, cap: int) -> DataFrame:
    """Of a cache's files (path, size, atime) those to remove, the least recently used first, until the rest is within
    the cap. A running sum over one cache's files: a local folder's, not a dataset's."""
    order = Window.orderBy("atime", "size", "path").rowsBetween(Window.unboundedPreceding, -1)
    total = files.agg(F.sum("size").alias("total"))
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    return files.withColumn("before", before).crossJoin(total).filter(F.col("total") - F.col("before") > cap).select("path", "size", "atime")


def throughput(runs: DataFrame) -> DataFrame:
    """Runs (tiles, pixels, bytes, seconds): rates, and hours for a whole sweep of 26,450 tiles."""
    s = F.col("seconds")
    return runs.select("*", (F.col("tiles") / s).alias("tiles_per_s"), (F.col("pixels") / s / 1e6).alias("mpx_per_s"), (F.col("bytes") / s / 1e6).alias("mb_per_s"), (26450 * s / F.col("tiles") / 3600).alias("hours_in_all"))
