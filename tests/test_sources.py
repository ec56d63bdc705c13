import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratagrid import synth
from stratagrid.functions import bits
from stratagrid.operators import checks, stats
from stratagrid.sources import table, tiles
from stratagrid.streaming import sweep


def geotiff(data, x0, dx, y0, dy, tiled=False, predictor=1, deflate=True, nodata=None):
    """A small GeoTIFF writer."""
    h, w = data.shape
    bw, bh = (16, 16) if tiled else (w, 4)
    blocks = []
    for top in range(0, h, bh):
        for left in range(0, w, bw):
            b = data[top : top + bh, left : left + bw]
            if tiled:
                b = np.pad(b, ((0, bh - b.shape[0]), (0, bw - b.shape[1])))
            if predictor == 3:
                planes = b.astype(">f4").view(np.uint8).reshape(b.shape[0], b.shape[1], 4).transpose(0, 2, 1).reshape(b.shape[0], -1)
                raw = np.diff(planes, axis=1, prepend=np.zeros((len(planes), 1), np.uint8)).astype(np.uint8).tobytes()
            elif predictor == 2:
                raw = np.diff(b, axis=1, prepend=np.zeros((len(b), 1), b.dtype)).astype(b.dtype).tobytes()
            else:
                raw = b.tobytes()
            blocks.append(zlib.compress(raw) if deflate else raw)
    tags = [(256, 3, [w]), (257, 3, [h]), (258, 3, [data.dtype.itemsize * 8]), (259, 3, [8 if deflate else 1]), (317, 3, [predictor]), (339, 3, [{"f": 3, "i": 2, "u": 1}[data.dtype.kind]]), (33550, 12, [dx, -dy, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x0, y0, 0.0])]
    tags += [(322, 3, [bw]), (323, 3, [bh])] if tiled else [(278, 3, [bh])]
    tags += [(42113, 2, [f"{nodata}\0".encode()])] if nodata is not None else []
    first, body = 8, b"".join(blocks)
    offsets = [first + sum(map(len, blocks[:i])) for i in range(len(blocks))]
    tags += [(324 if tiled else 273, 4, offsets), (325 if tiled else 279, 4, [len(b) for b in blocks])]
    extra, at, entries = b"", first + len(body) + 2 + 12 * len(tags) + 4, b""
    for tag, kind, values in sorted(tags):
        raw = values[0] if kind == 2 else struct.pack("<" + str(len(values)) + {3: "H", 4: "I", 12: "d"}[kind], *values)
        count = len(raw) if kind == 2 else len(values)
        entries += struct.pack("<HHI", tag, kind, count) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", at + len(extra)))
        extra += raw if len(raw) > 4 else b""
    return b"II" + struct.pack("<HI", 42, first + len(body)) + body + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra


@pytest.mark.parametrize("tiled", [False, True])
@pytest.mark.parametrize(("predictor", "kind"), [(1, "f4"), (3, "f4"), (2, "i2"), (1, "u2")])
def test_geotiff(tiled, predictor, kind):
    data = (np.arange(21 * 37).reshape(21, 37) % 251).astype(kind)
    got, origin, nodata = tiles.read_geotiff(geotiff(data, 10.0, 0.5, 50.0, -0.25, tiled, predictor, nodata=-9999))
    assert (got == data).all() and origin == (10.0, 0.5, 50.0, -0.25) and nodata == -9999


def test_pixels_of_files(spark, tmp_path):
    data = np.array([[1.0, np.nan], [-9999.0, 4.0]], dtype="f4")
    (tmp_path / "Copernicus_DSM_COG_10_N33_00_W119_00_DEM.tif").write_bytes(geotiff(data, -119.0, 0.5, 34.0, -0.5, nodata=-9999))
    (tmp_path / "other.tif.txt").write_text("no")
    px = sorted(tuple(r)[1:] for r in tiles.pixels_of_files(spark, str(tmp_path)).collect())
    assert px == [(33.25, -118.25, 4.0), (33.75, -118.75, 1.0)]
    row = tiles.list_tiles(spark, str(tmp_path)).first()
    assert (row["lat"], row["lon"]) == (33, -119)
    stored = tiles.cached_manifest(spark, f"{tmp_path}/manifest", lambda: tiles.manifest(tiles.list_tiles(spark, str(tmp_path))))
    assert stored.first()["names"] == ["Copernicus_DSM_COG_10_N33_00_W119_00_DEM"]


def test_source_of(spark):
    df = spark.createDataFrame([("t1", None), ("t2", "/cache/t2.tif")], "name string, cached string")
    got = [r[0] for r in df.select(tiles.source_of(F.col("name"), "s3a://tiles/", F.col("cached"))).collect()]
    assert got == ["s3a://tiles/t1/t1.tif", "/cache/t2.tif"]


def test_geojson(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"type":"FeatureCollection","features":[{"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}},{"geometry":{"type":"MultiPolygon","coordinates":[[[[2,2],[3,2]]],[[[4,4]]]]}},{"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    got = [(r["feature"], r["part"], len(r["points"])) for r in tiles.geojson_rings(spark, str(tmp_path / "x.json")).orderBy("feature", "part").collect()]
    assert got == [(0, 0, 3), (1, 0, 2), (1, 1, 1)]


def test_cell_table(spark, sf_dir, tmp_path):
    cells = synth.cells(spark, sf_dir, 5)
    stored = table.CellTable(spark, f"{tmp_path}/cells")
    n = stored.write(cells, {"source": "synthetic", "schema_version": "1"})
    assert n == cells.count() and stored.provenance()["source"] == "synthetic"
    assert not stored.restamp({"source": "synthetic", "schema_version": "1"}) and stored.restamp({"source": "other"})
    some = [r["h3_cell"] for r in stored.read().orderBy("h3_cell").limit(3).collect()]
    assert [r["h3_cell"] for r in stored.lookup(some[1]).collect()] == [some[1]]
    plan = stored.lookup_many(some)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "base" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError, match="expected"):
        stored.write(cells, expected_rows=n + 1)
    assert stored.read().count() == n and "base" not in stored.read().columns
    parent = spark.createDataFrame([(some[0],)], "c long").select(bits.parent(F.col("c"), 3)).first()[0]
    below = {r["h3_cell"] for r in stored.descendants([parent], 5).collect()}
    assert below == {r["h3_cell"] for r in cells.filter(bits.parent(F.col("h3_cell"), 3) == parent).collect()}
    assert not stored.add_column("geoid_undulation", lambda d: d) and stored.add_column("twice", lambda d: d.withColumn("twice", F.col("elevation_mean") * 2))
    done = stored.recompress()
    assert done["rows"] == n and done["bytes_after"] > 0 and checks.performance(stored, some[0]).filter("NOT ok").count() == 0
    assert stored.sizes().count() == cells.select(bits.base_cell(F.col("h3_cell"))).distinct().count()


def test_published_files(spark, tmp_path):
    t = pa.table({"h3_cell": pa.array([1 << 59, 5], pa.uint64()), **{c: pa.array([1.5, 2.5], pa.float32()) for c in ("elevation_mean", "elevation_max", "elevation_min", "elevation_stddev")}, "pixel_count": pa.array([3, 4], pa.uint32()), "geoid_undulation": pa.array([0.5, 1.0], pa.float32())})
    (tmp_path / "base=0").mkdir()
    pq.write_table(t, tmp_path / "base=0" / "part-000.parquet", use_dictionary=False, column_encoding={c: "BYTE_STREAM_SPLIT" for c in t.column_names if t.schema.field(c).type == pa.float32()} | {"h3_cell": "DELTA_BINARY_PACKED", "pixel_count": "PLAIN"})
    got = table.read_published(spark, str(tmp_path))
    assert sorted(r["h3_cell"] for r in got.collect()) == [5, 1 << 59] and "base" not in got.columns
    assert got.filter("h3_cell = 5").first()["elevation_mean"] == 2.5


def test_band_files(spark, tmp_path):
    cells = stats.aggregate(spark.createDataFrame([(1, 2.0)], "h3_cell long, elev double"), "h3_cell")
    for band in ("lat_+1_+0", "lat_+0_-1"):
        table.write_band(cells, str(tmp_path), band, 5)
    assert table.read_bands(spark, str(tmp_path), 5).count() == 2
    assert table.read_bands(spark, str(tmp_path), 5, ["lat_+1_+0"]).first()["lat_band"] == "lat_+1_+0"
    assert table.read_band(spark, str(tmp_path), "lat_+9_+8", 5) is None and table.read_band(spark, str(tmp_path), "lat_+1_+0", 5).count() == 1
    cell = 0x85283473FFFFFFF
    table.write_band(cells.withColumn("h3_cell", F.lit(cell)), f"{tmp_path}/b", "lat_+38_+37", 5)
    table.write_band(cells.withColumn("h3_cell", F.lit(cell)), f"{tmp_path}/b", "lat_+39_+38", 5)
    done = table.completed_cells(spark, f"{tmp_path}/b", 5, spark.createDataFrame([("lat_+38_+37",)], "band string")).collect()
    assert [r["lat_band"] for r in done] == ["lat_+38_+37"] and abs(done[0]["lat"] - 37.35) < 0.1
    for _ in range(2):
        table.append_csv(cells.select("h3_cell"), f"{tmp_path}/log")
    assert spark.read.option("header", True).csv(f"{tmp_path}/log").count() == 2
    assert table.merged_provenance({"a": "1", "b": "1"}, {"b": "2"}) == {"a": "1", "b": "2"}
    table.write_partitioned(cells, f"{tmp_path}/r1")
    table.write_partitioned(cells, f"{tmp_path}/r1")
    assert spark.read.parquet(f"{tmp_path}/r1").count() == 1


def band(spark, path, name, south, rows):
    df = spark.createDataFrame([(name, south, c, e) for c, e in rows], sweep.PIXELS)
    df.coalesce(1).write.mode("append").parquet(path)


SOUTH = {1: 2.0, 2: 1.0, 3: 0.0}


def south(cell):
    return F.create_map(*[x for k, v in SOUTH.items() for x in (F.lit(k).cast("long"), F.lit(v))])[cell]


def test_sweep(spark, tmp_path):
    """Cells 1, 2, 3 end at latitudes 2, 1, 0; pixels come in bands 2, 1, 0, and the run is resumed in between."""
    own = sweep.Sweep(spark, f"{tmp_path}/out", south)
    rows = {2.0: [(1, 10.0), (2, 1.0)], 1.0: [(2, 3.0), (3, 5.0)], 0.0: [(3, 7.0)]}
    for k, (edge, px) in enumerate(rows.items()):
        band(spark, f"{tmp_path}/in", f"b{k}", edge, px)
        own.run(sweep.band_stream(spark, f"{tmp_path}/in"))
        assert own.flushed().count() == k + 1
    assert sorted(r["lat_band"] for r in own.commits().collect()) == ["b0", "b1", "b2"]
    got = {r["h3_cell"]: (r["elevation_mean"], r["pixel_count"]) for r in own.close().collect()}
    assert got == {1: (10.0, 1), 2: (2.0, 2), 3: (6.0, 2)}
    late = spark.createDataFrame([("b3", -1.0, 1, 1.0)], sweep.PIXELS)
    with pytest.raises(sweep.LateData):
        own.apply(late, 3)
