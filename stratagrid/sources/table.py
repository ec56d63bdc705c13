"""Cell tables on disk: sorted Parquet, one directory per shard (the base-cell bits of the id)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import bits

SCHEMA = "h3_cell long, elevation_mean float, elevation_max float, elevation_min float, elevation_stddev float, pixel_count long, geoid_undulation float"
#: Delta-coded integers and plain floats in zstd pages; no dictionaries, which ids and floats don't repay.
WRITE_OPTIONS = {"compression": "zstd", "parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"}

#: Base cells, so shards at most, and bytes of one file by Spark's estimate.
SHARDS, FILE_BYTES = 122, 512 << 20


class CellTable:
    """A table of cells below a path, partitioned by ``base`` and sorted by cell within files.

    Each write is a folder of its own, v-<id>, and the file _current names the one that is read; it is replaced by a
    rename, so readers see the old table or the new one, and a write that breaks off leaves the old one. The version
    before the current one stays until the next write, for readers that have begun. A path without _current is read as
    it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._scan: DataFrame | None = None
        self._at, self._files = None, {}

    # -- writing

    def write(self, cells: DataFrame, provenance: dict[str, str] | None = None, expected_rows: int | None = None, files_per_shard: int | None = None) -> int:
        """Replaces the table. The rows written are counted before the new version is switched to; a count other than
        expected (of the input, if not given) leaves the old table in place and raises.

        files_per_shard deals a shard's rows, sorted ranges of cells, over as many tasks; by default so many that a file
        has FILE_BYTES of Spark's estimate of the input."""
        marked = cells.drop("base")
        if provenance:
            marked = marked.withMetadata("h3_cell", {"provenance": dict(provenance)})
        if files_per_shard is None:
            estimate = int(str(cells._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            files_per_shard = min(512, max(1, estimate // (SHARDS * FILE_BYTES)))
        seen = Observation()
        sharded = marked.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("base", bits.base_cell(F.col("h3_cell")).cast("int"))
        # the next digits of a cell follow its base in the id, so ranges of them keep files sorted against each other
        part = F.floor(F.shiftright("h3_cell", 36).bitwiseAND(511) * files_per_shard / 512)
        dealt = sharded.repartition("base", part) if files_per_shard > 1 else sharded.repartition("base")
        version = f"v-{uuid.uuid4().hex}"
        temporary = f"{self.path}/{version}"
        dealt.sortWithinPartitions("base", "h3_cell").write.options(**WRITE_OPTIONS).partitionBy("base").parquet(temporary)
        rows = self.spark.read.parquet(temporary).count() if self._has_files(temporary) else 0
        if rows != (seen.get["rows"] if expected_rows is None else expected_rows):
            # a task that ran twice is observed twice, so the input is counted itself before the write is given up
            expected = cells.count() if expected_rows is None else expected_rows
            if rows != expected:
                self._fs().delete(self._hadoop(temporary), True)
                raise ValueError(f"{rows} rows were written where {expected} were expected")
        if provenance:
            self._put(f"{temporary}/_PROVENANCE.json", json.dumps(provenance, sort_keys=True))
        before = self._version()
        self._switch(version)
        for old in self._versions():
            if old not in (version, before):
                self._fs().delete(self._hadoop(f"{self.path}/{old}"), True)
        self._scan, self._at = None, None
        return rows

    def _put(self, path: str, text: str) -> None:
        out = self._fs().create(self._hadoop(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def _switch(self, version: str) -> None:
        jvm = self.spark.sparkContext._jvm
        temporary = f"{self.path}/_next.{uuid.uuid4().hex}"
        self._put(temporary, version)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._hadoop(self.path).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        qualified = lambda p: self._fs().makeQualified(self._hadoop(p))
        context.rename(qualified(temporary), qualified(f"{self.path}/_current"), how)

    def _version(self) -> str | None:
        """The version that _current names; None where there is no such file."""
        fs, at = self._fs(), self._hadoop(f"{self.path}/_current")
        if not fs.exists(at):
            return None
        return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(fs.open(at), "UTF-8").strip()

    def _versions(self) -> list[str]:
        return [f.getPath().getName() for f in self._fs().listStatus(self._hadoop(self.path)) if f.getPath().getName().startswith("v-")]

    def _has_files(self, path: str) -> bool:
        return any(f.isDirectory() for f in self._fs().listStatus(self._hadoop(path)))

    def where(self) -> str:
        """The folder that is read."""
        version = self._version()
        return f"{self.path}/{version}" if version else self.path

    def restamp(self, provenance: dict[str, str]) -> bool:
        """Rewrites the table with this provenance, unless it has it already; tells whether it did."""
        if self.provenance() == provenance:
            return False
        self.write(self.read(), provenance)
        return True

    def add_column(self, name: str, values) -> bool:
        """Adds a column computed from the table (a function of DataFrame), unless the table has it."""
        if name in self.read().columns:
            return False
        self.write(values(self.read()), self.provenance() or None)
        return True

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    # -- reading

    def read(self, columns: list[str] | None = None) -> DataFrame:
        """The table's rows without the shard column, which is a directory and not part of the schema."""
        out = self.scan().drop("base")
        return out.select(*columns) if columns else out

    def scan(self) -> DataFrame:
        """With the shard column, for joins that prune by it. Files are listed once per table object and write."""
        if self._scan is None:
            self._scan = self.spark.read.parquet(self.where())
        return self._scan

    def provenance(self) -> dict[str, str]:
        field = self.scan().schema["h3_cell"]
        return dict(field.metadata.get("provenance", {}))

    def recompress(self) -> dict[str, int]:
        """Writes the table anew with the options of this module; gives bytes and rows before and after."""
        measure = lambda: self.sizes().agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()["b"]
        before, rows = measure(), self.read().count()
        self.write(self.read(), self.provenance() or None, expected_rows=rows)
        after = measure()
        return {"bytes_before": before, "bytes_after": after, "rows": rows, "bytes_per_row": after // max(rows, 1)}

    def sizes(self) -> DataFrame:
        """(path, length) of the table's files."""
        return self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(self.where()).select("path", "length")

    def lookup(self, cell: int) -> DataFrame:
        """A cell's row: one shard, and there the row groups whose range holds the id."""
        return self.scan().filter((F.col("base") == bits.base_of(cell)) & (F.col("h3_cell") == cell)).drop("base")

    def get(self, cell: int, columns: list[str] | None = None) -> dict | None:
        """A cell's row as a dict, or None where the table lacks it: the row groups of one shard that can hold it are read on
        the driver, since for a single row a job takes longer than the read. lookup() gives the same as a DataFrame."""
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        if self._at is None:
            where = self.where()
            self._at = pafs.FileSystem.from_uri(where if "://" in where else where.replace("file:", "file://", 1) if where.startswith("file:/") else f"file://{where}")
            self._files = {}
        fs, root = self._at
        shard = f"{root}/base={bits.base_of(cell)}"
        if shard not in self._files:
            listed = fs.get_file_info(pafs.FileSelector(shard, allow_not_found=True))
            self._files[shard] = [pq.ParquetFile(fs.open_input_file(f.path)) for f in listed if f.path.endswith(".parquet")]
        for file in self._files[shard]:
            at = file.schema_arrow.get_field_index("h3_cell")
            for g in range(file.num_row_groups):
                known = file.metadata.row_group(g).column(at).statistics
                if known is not None and known.has_min_max and not known.min <= cell <= known.max:
                    continue
                ids = file.read_row_group(g, ["h3_cell"])["h3_cell"]
                if (place := pc.index(ids, cell).as_py()) >= 0:
                    return file.read_row_group(g, columns).slice(place, 1).to_pylist()[0]
        return None

    def lookup_many(self, cells: list[int]) -> DataFrame:
        """The rows of some cells; the shards are given as literals, which an IN list of cells alone wouldn't prune."""
        shards = sorted({bits.base_of(c) for c in cells})
        return self.scan().filter(F.col("base").isin(shards) & F.col("h3_cell").isin(cells)).drop("base")

    def descendants(self, parents: list[int], res: int) -> DataFrame:
        """The rows of the parents' descendants, which are ranges of ids at one resolution."""
        ranges = [(_first(p, res), _last(p, res)) for p in parents]
        within = F.lit(False)
        for low, high in ranges:
            within = within | F.col("h3_cell").between(low, high)
        return self.scan().filter(F.col("base").isin(sorted({bits.base_of(p) for p in parents})) & within).drop("base")

    def region(self, south: float, west: float, north: float, east: float, res: int) -> DataFrame:
        """Rows whose centre lies in a box (degrees, ends included), with lat and lon. Shards come from a cover of the box
        by coarse cells, widened by one ring, so none is missed however large the box is."""
        from ..functions.grid_udfs import cell_to_latlng

        shards = sorted(cover_shards(south, west, north, east))
        located = self.scan().filter(F.col("base").isin(shards)).drop("base").withColumn("_at", cell_to_latlng(F.col("h3_cell")))
        lat, lon = F.col("_at.lat"), F.col("_at.lng")
        return located.filter(lat.between(south, north) & lon.between(west, east)).withColumn("lat", lat).withColumn("lon", lon).drop("_at")


def _first(parent: int, res: int) -> int:
    own = (parent >> 52) & 15
    stem = (parent & ~((15 << 52) | ((1 << (45 - 3 * own)) - 1))) | (res << 52)
    return stem | ((1 << (45 - 3 * res)) - 1)


def _last(parent: int, res: int) -> int:
    own = (parent >> 52) & 15
    sixes = sum(6 << (45 - 3 * r) for r in range(own + 1, res + 1))
    return _first(parent, res) | sixes


def cover_shards(south: float, west: float, north: float, east: float) -> set[int]:
    """Base cells that a box touches, and their neighbours."""
    import numpy as np

    from ..functions import grid

    lat = np.linspace(south, north, max(2, int((north - south) / 2) + 2))
    lng = np.linspace(west, east, max(2, int((east - west) / 2) + 2))
    at = np.stack(np.meshgrid(lat, lng), axis=-1).reshape(-1, 2)
    own = {int(c) for c in grid.latlng_to_cell(at[:, 0], at[:, 1], 0)}
    around = {n for ns in grid.neighbours(sorted(own)) for n in ns}
    return {bits.base_of(c) for c in own | around}


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Files with unsigned ids and byte-stream-split floats, which the vectorized reader refuses: read row by row in a
    session of its own, so that other tables keep the fast reader. Partition directories don't become columns."""
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.enableVectorizedReader", "false")
    return own.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def read_cells(spark: SparkSession, path: str, res: int) -> DataFrame:
    """The cells of a resolution below a path, whichever layout they have: a table of this module, res<R>.parquet in one
    file or folder, or shards res<R>/base=<b>/. Partition directories don't become columns."""
    at = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at(f"{path}/res{res}.parquet")):
        return spark.read.parquet(f"{path}/res{res}.parquet")
    return CellTable(spark, f"{path}/res{res}").read()


def read_bands(spark: SparkSession, path: str, res: int, bands: list[str] | None = None) -> DataFrame:
    """Per-band files <path>/<band>/res<R>/part-*.parquet of one resolution, of some bands or all, with lat_band."""
    out = spark.read.parquet(f"{path}/*/res{res}").withColumn("lat_band", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/res\d+/[^/]+$", 1))
    return out.filter(F.col("lat_band").isin(bands)) if bands is not None else out


def publish_band(spark: SparkSession, by_res: dict[int, DataFrame], path: str, band: str, provenance: dict[str, str] | None = None) -> None:
    """All resolutions of a band, and then its marker, <path>/<band>/_DONE.json: a band without it isn't finished. Doing it
    again replaces the band."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{band}/_DONE.json")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(marker, False)
    for res, cells in sorted(by_res.items()):
        write_band(cells.withMetadata("h3_cell", {"provenance": dict(provenance)}) if provenance else cells, path, band, res)
    out = fs.create(marker, True)
    out.write(bytearray(json.dumps({"band": band, "resolutions": sorted(by_res), **(provenance or {})}, sort_keys=True).encode()))
    out.close()


def published_bands(spark: SparkSession, path: str) -> DataFrame:
    """(band) of the bands that have their marker."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_DONE.json")
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return spark.createDataFrame([(f.getPath().getParent().getName(),) for f in found or []], "band string")


def write_band(cells: DataFrame, path: str, band: str, res: int) -> None:
    """One band's file of one resolution, sorted."""
    cells.coalesce(1).sortWithinPartitions("h3_cell").write.options(**WRITE_OPTIONS).mode("overwrite").parquet(f"{path}/{band}/res{res}")


def write_partitioned(cells: DataFrame, path: str, res: int = 1) -> None:
    """Files by an ancestor (r1=<cell>), replacing only the partitions that the rows fall in."""
    marked = cells.withColumn("r1", bits.parent(F.col("h3_cell"), res))
    marked.repartition("r1").sortWithinPartitions("r1", "h3_cell").write.options(**WRITE_OPTIONS).option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("r1").parquet(path)


def completed_cells(spark: SparkSession, path: str, res: int, commits: DataFrame) -> DataFrame:
    """Cells of one resolution of all committed bands (band), with lat and lon; files of other bands aren't looked at."""
    from ..functions.grid_udfs import cell_to_latlng

    done = read_bands(spark, path, res).join(commits.select(F.col("band").alias("lat_band")).distinct(), "lat_band", "left_semi")
    return done.withColumn("_at", cell_to_latlng(F.col("h3_cell"))).withColumn("lat", F.col("_at.lat")).withColumn("lon", F.col("_at.lng")).drop("_at")


def read_band(spark: SparkSession, path: str, band: str, res: int) -> DataFrame | None:
    """A band's cells, or None where the band isn't there; any other failure is raised."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{band}/res{res}")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.parquet(f"{path}/{band}/res{res}")


def append_csv(rows: DataFrame, path: str) -> None:
    """Adds rows to a folder of CSV files, each with a header."""
    rows.coalesce(1).write.option("header", True).mode("append").csv(path)


def merged_provenance(*parts: dict[str, str]) -> dict[str, str]:
    """Provenance entries put together; later ones win."""
    return {k: v for p in parts for k, v in p.items()}
