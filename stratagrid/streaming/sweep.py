"""A resumable sweep of latitude bands, from north to south, as a stream.

Each micro-batch is a band of pixels. Its partials are merged into the state; cells whose southern extent is at or above
the band's southern edge can't be touched by what follows, so they are finalized, written out and leave the state. The
state therefore stays as large as one band's seam, whatever has been swept. A batch is applied once: states and outputs
are written under the batch's number and replaced if the batch is repeated, and a commit is appended last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import stats

#: State on the executors' disks, with memory that doesn't grow with the number of keys or partitions. Shuffle files of a
#: batch go when it ends, by the setting that kept_stats adds.
_STORE = {"providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "rocksdb.boundedMemoryUsage": "true", "rocksdb.trackTotalNumberOfRows": "false", "rocksdb.compression": "zstd", "rocksdb.blockSizeKB": "16"}
PIXELS = "lat_band string, south double, h3_cell long, elev double"


class LateData(RuntimeError):
    """A band has pixels of a cell that ends above what was committed, so is final: the input isn't in order."""


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class Sweep:
    """State and results below a path: state/v<batch>, cells/batch=<batch>, commits/batch=<batch>."""

    def __init__(self, spark: SparkSession, path: str, south: Callable[[Column], Column]):
        """south: the southern extent of a cell, as a Column function."""
        self.spark, self.path, self.south = spark, path.rstrip("/"), south

    def _exists(self, path: str) -> bool:
        return _exists(self.spark, path)

    def state(self, batch: int) -> DataFrame | None:
        path = f"{self.path}/state/v{batch}"
        return self.spark.read.parquet(path) if batch >= 0 and self._exists(path) else None

    def apply(self, pixels: DataFrame, batch: int) -> None:
        """foreachBatch function."""
        pixels = pixels.persist()
        try:
            edge = pixels.agg(F.min("south").alias("edge"), F.count(F.lit(1)).alias("n")).first()
            before = self.state(batch - 1)
            if not edge["n"]:
                if before is not None:
                    before.write.mode("overwrite").parquet(f"{self.path}/state/v{batch}")
                return
            own = stats.partial(pixels, "h3_cell").withColumn("south", self.south(F.col("h3_cell"))).persist()
            last = self.edge(before_batch=batch)
            if last is not None and (late := own.filter(F.col("south") >= F.lit(last)).count()):
                raise LateData(f"batch {batch} has pixels of {late} cells that were finalized")
            merged = stats.merge([own.drop("south"), before], "h3_cell") if before is not None else own.drop("south")
            done = self.south(F.col("h3_cell")) >= F.lit(float(edge["edge"]))
            marked = merged.withColumn("done", done).persist()
            stats.finalize(marked.filter("done"), "h3_cell").write.mode("overwrite").parquet(f"{self.path}/cells/batch={batch}")
            marked.filter(~F.col("done")).drop("done").write.mode("overwrite").parquet(f"{self.path}/state/v{batch}")
            marked.unpersist()
            own.unpersist()
            commits = pixels.select("lat_band").distinct().withColumn("completed_at", F.current_timestamp()).withColumn("edge", F.lit(float(edge["edge"])))
            commits.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        finally:
            pixels.unpersist()

    def flushed(self, before_batch: int | None = None) -> DataFrame | None:
        """Finalized cells, of earlier batches only if one is given."""
        if not self._exists(f"{self.path}/cells"):
            return None
        cells = self.spark.read.parquet(f"{self.path}/cells")
        return cells if before_batch is None else cells.filter(F.col("batch") < before_batch)

    def edge(self, before_batch: int) -> float | None:
        """The southern edge of what earlier batches committed: cells that end at or above it are final."""
        return self.commits().filter(F.col("batch") < before_batch).agg(F.min("edge").alias("e")).first()["e"]

    def commits(self) -> DataFrame:
        if not self._exists(f"{self.path}/commits"):
            return self.spark.createDataFrame([], "lat_band string, completed_at timestamp, edge double, batch int")
        return self.spark.read.parquet(f"{self.path}/commits")

    def run(self, pixels: DataFrame, checkpoint: str | None = None) -> None:
        """Runs a streaming DataFrame of PIXELS to its present end; a later run goes on where this one stopped."""
        query = pixels.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint or f"{self.path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()

    def close(self) -> DataFrame:
        """All cells: those that were flushed, and what the last state holds."""
        last = self.commits().agg(F.max("batch").alias("b")).first()["b"]
        tail = self.state(int(last)) if last is not None else None
        parts = [p for p in (self.flushed(), stats.finalize(tail, "h3_cell") if tail is not None else None) if p is not None]
        parts = [p.select(*stats.CELL_COLUMNS) for p in parts]
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def band_stream(spark: SparkSession, path: str, bands_per_batch: int = 1) -> DataFrame:
    """A stream of band files (one Parquet file a band, in order of their modification), so many a micro-batch."""
    return spark.readStream.schema(PIXELS).option("maxFilesPerTrigger", bands_per_batch).parquet(path)


def running_stats(pixels: DataFrame, *keys: str) -> DataFrame:
    """Partials of a stream, kept by Spark's own state store (complete or update mode)."""
    return stats.partial(pixels, *keys)


def kept_stats(pixels: DataFrame, checkpoint: str, *keys: str) -> DataFrame:
    """Runs a streaming DataFrame of pixels to its present end; a later run with the same checkpoint goes on where this one
    stopped. Returns the partials of all runs, read by tasks from the state store: no batch gives out or collects them."""
    spark, own = pixels.sparkSession, running_stats(pixels, *keys)
    conf = {f"spark.sql.streaming.stateStore.{k}": v for k, v in _STORE.items()} | {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        query = own.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:  # the stream has a copy of its own
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    query.awaitTermination()
    if not _exists(spark, f"{checkpoint}/state/0"):  # nothing has come yet
        return spark.createDataFrame([], own.schema)
    kept = "struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in own.schema.fields[len(keys):]) + ">"  # by position: sums have one name there
    return spark.read.format("statestore").load(checkpoint).select("key.*", F.col("value").cast(kept).alias("value")).select(*keys, "value.*")
