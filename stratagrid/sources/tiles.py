"""Tiles: listing, manifests, raster files and their pixels."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, names

PIXELS = "tile string, lat double, lon double, elev double"


def list_tiles(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """(name, lat, lon, path, length) of the raster files below a path; names that aren't a tile's are skipped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "length")
    name = F.regexp_extract("path", names.TILE, 0)
    return located(files.withColumn("name", name)).select("name", "lat", "lon", "path", "length")


def located(tiles: DataFrame) -> DataFrame:
    """Tiles (name) with their corners; unparsable names are left out."""
    return tiles.withColumn("_c", names.tile_corner(F.col("name"))).filter("_c IS NOT NULL").withColumn("lat", F.col("_c.lat")).withColumn("lon", F.col("_c.lon")).drop("_c")


def manifest(tiles: DataFrame) -> DataFrame:
    """Tiles (name, lat, lon) by latitude, from west to east: (lat, names). At most 360 tiles a latitude."""
    return tiles.groupBy("lat").agg(F.array_sort(F.collect_set(F.struct("lon", "name")))["name"].alias("names"))


def summary(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.count(F.lit(1)).alias("tiles"), F.count_distinct("lat").alias("bands"), F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"))


def cached_manifest(spark: SparkSession, path: str, build, rebuild: bool = False) -> DataFrame:
    """The stored manifest, or the built one (a function without arguments), stored."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if rebuild or not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        build().write.mode("overwrite").json(path)
    return spark.read.schema("lat int, names array<string>").json(path)


def in_box(tiles: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """Tiles whose corner lies in a box, the far ends not included."""
    return tiles.filter((F.col("lat") >= south) & (F.col("lat") < north) & (F.col("lon") >= west) & (F.col("lon") < east))


def first_tiles(tiles: DataFrame, n: int) -> DataFrame:
    """The first n tiles (name, lat, lon), from north to south and there from west to east."""
    return tiles.orderBy(F.desc("lat"), "lon", "name").limit(n)


def fetch(spark: SparkSession, tiles: DataFrame, root: str, folder: str) -> DataFrame:
    """Copies the tiles' files (name) from <root>/<name>/<name>.tif into a shared folder, a file a row of a task: (name,
    path, length, cached). Each is written as <name>.tif.part and renamed when whole, so a file that is there is whole;
    tiles that the folder has are left as they are. A missing source gives a null path."""

    def copy(batches):
        from pyarrow import fs as pafs

        source, base = pafs.FileSystem.from_uri(root.rstrip("/"))
        target, to = pafs.FileSystem.from_uri(folder.rstrip("/"))
        target.create_dir(to, recursive=True)
        for batch in batches:
            out = []
            for name in batch["name"]:
                path, length, cached = f"{to}/{name}.tif", None, True
                if target.get_file_info(path).type == pafs.FileType.NotFound:
                    cached = False
                    if source.get_file_info(f"{base}/{name}/{name}.tif").type == pafs.FileType.NotFound:
                        out.append((name, None, None, False))
                        continue
                    part = f"{path}.{uuid.uuid4().hex}.part"
                    with source.open_input_stream(f"{base}/{name}/{name}.tif") as src, target.open_output_stream(part, compression=None) as dst:
                        while block := src.read(1 << 22):
                            dst.write(block)
                    target.move(part, path)
                length = target.get_file_info(path).size
                out.append((name, f"{folder.rstrip('/')}/{name}.tif", length, cached))
            yield pd.DataFrame(out, columns=["name", "path", "length", "cached"])

    return tiles.select("name").distinct().mapInPandas(copy, "name string, path string, length long, cached boolean")


def source_of(name: Column, root: str, cached: Column | None = None) -> Column:
    """Where a tile is read: a cached path if there is one, else <root>/<name>/<name>.tif."""
    address = F.concat(F.lit(root.rstrip("/") + "/"), name, F.lit("/"), name, F.lit(".tif"))
    return address if cached is None else F.coalesce(cached, address)


def pixels_of_arrays(tiles: DataFrame) -> DataFrame:
    """Pixels of tiles given as rows: (name, width, height, x0, dx, y0, dy, nodata, data), data row by row. Coordinates
    are of pixel centres; values that aren't finite, or are the tile's nodata, are left out."""
    each = tiles.select("name", "width", "x0", "dx", "y0", "dy", "nodata", F.posexplode("data").alias("k", "elev"))
    row, col = F.floor(F.col("k") / F.col("width")), F.col("k") % F.col("width")
    placed = each.select(
        F.col("name").alias("tile"), geo.pixel_centre(F.col("y0"), F.col("dy"), row).alias("lat"), geo.pixel_centre(F.col("x0"), F.col("dx"), col).alias("lon"),
        F.col("elev").cast("double").alias("elev"), F.col("nodata").cast("double").alias("nodata"))
    return placed.filter(geo.valid_elevation(F.col("elev"), F.col("nodata"))).drop("nodata")


def pixels_of_files(spark: SparkSession, path: str, pattern: str = "*.tif", rows: int = 64) -> DataFrame:
    """Pixels of GeoTIFF files, read on executors a file a row; a batch holds so many raster rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                tile = p.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                data, (x0, dx, y0, dy), nodata = read_geotiff(content)
                lon = x0 + (np.arange(data.shape[1]) + 0.5) * dx
                for at in range(0, data.shape[0], rows):
                    part = data[at : at + rows].astype(float)
                    lat = y0 + (np.arange(at, at + len(part)) + 0.5) * dy
                    good = np.isfinite(part) & ((part != nodata) if nodata is not None else True)
                    r, c = np.nonzero(good)
                    yield pd.DataFrame({"tile": tile, "lat": lat[r], "lon": lon[c], "elev": part[r, c]})

    return files.mapInPandas(explode, PIXELS)


# ---- GeoTIFF -----------------------------------------------------------------------------------------------------

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 16: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def _tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}[bytes(data[:2])]
    if struct.unpack(order + "H", data[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack(order + "I", data[4:8])[0]
    tags = {}
    for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        entry = data[at + 2 + 12 * i : at + 14 + 12 * i]
        tag, kind, count = struct.unpack(order + "HHI", entry[:8])
        size = _SIZES.get(kind, 1) * count
        raw = entry[8 : 8 + size] if size <= 4 else data[(p := struct.unpack(order + "I", entry[8:12])[0]) : p + size]
        tags[tag] = (bytes(raw).rstrip(b"\0").decode("ascii", "replace"),) if kind == 2 else struct.unpack(order + str(count) + _CODES[kind], raw) if kind in _CODES else (raw,)
    return order, tags


def read_geotiff(data: bytes) -> tuple[np.ndarray, tuple[float, float, float, float], float | None]:
    """The first band of a GeoTIFF in strips or tiles, uncompressed or deflated, with either predictor or none; its
    (x0, dx, y0, dy) and its nodata value."""
    order, t = _tags(data)
    width, height, bits, kind = t[256][0], t[257][0], t.get(258, (8,))[0], t.get(339, (1,))[0]
    compression, predictor, samples = t.get(259, (1,))[0], t.get(317, (1,))[0], t.get(277, (1,))[0]
    if compression not in (1, 8, 32946):
        raise ValueError(f"compression {compression} isn't supported")
    if samples != 1:
        raise ValueError("rasters of one band are supported")
    dtype = np.dtype(order + {1: "u", 2: "i", 3: "f"}[kind] + str(bits // 8))
    tiled = 322 in t
    w, h = (t[322][0], t[323][0]) if tiled else (width, min(height, t.get(278, (height,))[0]))
    offsets, counts = (t[324], t[325]) if tiled else (t[273], t[279])
    out = np.zeros((height, width), dtype=dtype.newbyteorder("="))
    across = -(-width // w)
    for k, (offset, count) in enumerate(zip(offsets, counts, strict=True)):
        top, left = k // across * h, k % across * w
        rows = h if tiled else min(h, height - top)
        raw = data[offset : offset + count]
        raw = zlib.decompress(raw) if compression != 1 else bytes(raw)
        if predictor == 3:
            planes = np.cumsum(np.frombuffer(raw, np.uint8)[: rows * w * dtype.itemsize].reshape(rows, -1), axis=1, dtype=np.uint8)
            block = np.ascontiguousarray(planes.reshape(rows, dtype.itemsize, w).transpose(0, 2, 1)).view(dtype.newbyteorder(">")).reshape(rows, w)
        else:
            block = np.frombuffer(raw, dtype)[: rows * w].reshape(rows, w)
            if predictor == 2:
                block = np.cumsum(block, axis=1, dtype=block.dtype)
        y, x = min(rows, height - top), min(w, width - left)
        out[top : top + y, left : left + x] = block[:y, :x]
    dx, dy = t[33550][0], t[33550][1]
    i, j, _, x, y = t[33922][:5]
    nodata = float(t[42113][0]) if 42113 in t and t[42113][0].strip() else None
    return out, (x - i * dx, dx, y + j * dy, -dy), nodata


RINGS = "feature int, part int, ring int, points array<array<double>>"


def load_raster(spark: SparkSession, path: str) -> tuple[np.ndarray, tuple[float, float, float, float]]:
    """The grid of one GeoTIFF file and its (x0, dx, y0, dy), for joins.sample_raster; nodata becomes NaN."""
    rows = spark.read.format("binaryFile").load(path).select("content").limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} isn't one file")
    data, origin, nodata = read_geotiff(bytes(rows[0]["content"]))
    data = data.astype(np.float64)
    return np.where(data == nodata, np.nan, data) if nodata is not None else data, origin


def geojson_rings(spark: SparkSession, path: str) -> DataFrame:
    """Outlines of a GeoJSON file's polygons and multi-polygons: (feature, part, ring, points). Other shapes are left out; a
    file that isn't there, or isn't GeoJSON, has no outlines."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], RINGS)
    # coordinates are one level deeper in a MultiPolygon, so they are read as text and parsed by type
    shape = "features array<struct<geometry: struct<type: string, coordinates: string>>>"
    features = spark.read.schema(shape).option("multiLine", True).json(path).select(F.posexplode("features").alias("feature", "f")).select("feature", "f.geometry.*")
    nested = "array<array<array<array<double>>>>"
    polys = F.when(F.col("type") == "Polygon", F.array(F.from_json("coordinates", "array<array<array<double>>>"))).when(F.col("type") == "MultiPolygon", F.from_json("coordinates", nested))
    parts = features.select("feature", F.posexplode(polys).alias("part", "rings"))
    return parts.select("feature", "part", F.posexplode("rings").alias("ring", "points"))
