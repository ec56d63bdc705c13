import numpy as np
import pytest
from pyspark.sql import functions as F

from stratagrid.functions import bits, grid, grid_udfs


def sphere(n, seed=0):
    rng = np.random.default_rng(seed)
    return np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)


@pytest.mark.parametrize(("lat", "lng", "res", "cell"), [(37.3615593, -122.0553238, 5, 0x85283473FFFFFFF), (37.3615593, -122.0553238, 7, 0x87283472BFFFFFF), (37.775938728915946, -122.41795063018799, 9, 0x8928308280FFFFF)])
def test_published_vectors(lat, lng, res, cell):
    assert grid.latlng_to_cell([lat], [lng], res)[0] == cell


@pytest.mark.parametrize("res", [0, 1, 2])
def test_all_cells(res):
    cells = np.unique(grid.latlng_to_cell(*sphere(200_000), res))
    assert len(cells) == 2 + 120 * 7**res
    assert grid.is_pentagon(cells).sum() == 12
    around = dict(zip(cells.tolist(), map(set, grid.neighbours(cells)), strict=True))
    assert sorted({len(n) for n in around.values()}) == [5, 6]
    assert all(c in around[n] for c, ns in around.items() for n in ns)


@pytest.mark.parametrize("res", [3, 6, 9, 12, 15])
def test_centre_lies_in_its_cell(res):
    cells = np.unique(grid.latlng_to_cell(*sphere(20_000, res), res))
    assert (grid.latlng_to_cell(*grid.cell_to_latlng(cells), res) == cells).all()


def area(outline):
    p = grid.to_xyz(*np.radians(np.array(outline)).T)
    c = p.mean(axis=0) / np.linalg.norm(p.mean(axis=0))
    return sum(2 * np.arctan2(c @ np.cross(a, b), 1 + c @ a + a @ b + b @ c) for a, b in zip(p, np.roll(p, -1, axis=0), strict=True))


@pytest.mark.parametrize(("res", "corners"), [(0, 5), (1, 10), (2, 5)])
def test_outlines_cover_the_sphere(res, corners):
    cells = np.unique(grid.latlng_to_cell(*sphere(200_000), res))
    outlines = grid.cell_to_boundary(cells)
    assert sum(map(area, outlines)) == pytest.approx(4 * np.pi, abs=1e-9)
    assert {len(o) for o, five in zip(outlines, grid.is_pentagon(cells), strict=True) if five} == {corners}


def test_points_inside_an_outline_map_to_it():
    cells = np.unique(grid.latlng_to_cell(*sphere(300), 7))
    lat, lng = grid.cell_to_latlng(cells)
    for c, o, a, b in zip(cells, grid.cell_to_boundary(cells), lat, lng, strict=True):
        p = 0.97 * grid.to_xyz(*np.radians(np.array(o)).T) + 0.03 * grid.to_xyz(np.radians(a), np.radians(b))
        p /= np.linalg.norm(p, axis=1)[:, None]
        assert (grid.latlng_to_cell(np.degrees(np.arcsin(p[:, 2])), np.degrees(np.arctan2(p[:, 1], p[:, 0])), 7) == c).all()


def test_disk_and_bounds():
    cell = int(grid.latlng_to_cell([39.2], [-106.8], 8)[0])
    assert [len(grid.grid_disk(cell, k)) for k in (0, 1, 2, 3)] == [1, 7, 19, 37]
    south, west, north, east = grid.cell_bounds([cell])
    lat, lng = grid.cell_to_latlng([cell])
    assert south < lat < north and west < lng < east


def test_bits(spark):
    lat, lng = sphere(500)
    cells = grid.latlng_to_cell(lat, lng, 7)
    df = spark.createDataFrame([(int(c), int(p)) for c, p in zip(cells, grid.latlng_to_cell(*grid.cell_to_latlng(cells), 7), strict=True)], "c long, p long")
    out = df.select(bits.is_valid(F.col("c")).alias("v"), bits.resolution(F.col("c")).alias("r"), bits.from_hex(bits.to_hex(F.col("c"))).alias("h"), "c", F.size(bits.children(bits.parent(F.col("c"), 4), 4, 6)).alias("n"), F.array_contains(bits.children(bits.parent(F.col("c"), 5), 5, 7), F.col("c")).alias("in")).collect()
    assert all(r["v"] and r["r"] == 7 and r["h"] == r["c"] and r["n"] in (49, 41) and r["in"] for r in out)
    bad = [0, -1, (1 << 59), int(cells[0]) ^ (1 << 45 << 6), (int(cells[0]) & ~(127 << 45)) | (122 << 45), int(cells[0]) & ~7]
    assert not any(r[0] for r in spark.createDataFrame([(b,) for b in bad[:1] + bad[4:]], "c long").select(bits.is_valid(F.col("c"))).collect())


def test_pentagon_children(spark):
    pent = int(grid.latlng_to_cell(*grid.cell_to_latlng([(1 << 59) | (4 << 45) | ((1 << 45) - 1)]), 0)[0])
    kids = spark.createDataFrame([(pent,)], "c long").select(bits.children(F.col("c"), 0, 1)).first()[0]
    assert len(kids) == 6 and all(bool(x) for x in [set(grid.latlng_to_cell(*grid.cell_to_latlng(kids), 0)) == {pent}])


def test_udfs(spark):
    df = spark.createDataFrame([(37.3615593, -122.0553238), (None, 1.0), (float("nan"), 2.0)], "lat double, lon double")
    got = [r[0] for r in df.select(grid_udfs.latlng_to_cell(F.col("lat"), F.col("lon"), 5)).collect()]
    assert got == [0x85283473FFFFFFF, None, None]
    grid_udfs.register(spark)
    assert spark.sql("SELECT cell_of(37.3615593D, -122.0553238D, 5)").first()[0] == 0x85283473FFFFFFF
    assert len(spark.sql(f"SELECT cell_disk({0x85283473FFFFFFF}L, 1)").first()[0]) == 7


def test_rows_that_have_no_cell(spark):
    """Nulls, NaN, infinities and ids that aren't cells give null, and don't disturb the rows beside them."""
    cell = 0x85283473FFFFFFF
    at = [(37.3615593, -122.0553238), (None, 1.0), (1.0, None), (float("nan"), 2.0), (2.0, float("inf")), (float("-inf"), 2.0)]
    points = spark.createDataFrame(at, "lat double, lon double").coalesce(1)
    many = [r[0] for r in points.select(grid_udfs.latlng_to_cells(F.col("lat"), F.col("lon"), (4, 5))).collect()]
    assert many[0][1]["h3_cell"] == cell and all(m is None or all(x["h3_cell"] is None for x in m) for m in many[1:])
    grid_udfs.register(spark)
    points.createOrReplaceTempView("odd_points")
    assert [r[0] for r in spark.sql("SELECT cell_of(lat, lon, 5) FROM odd_points").collect()] == [cell] + [None] * 5
    assert [r[0] for r in spark.sql("SELECT cell_of(37.0D, -122.0D, r) FROM VALUES (CAST(NULL AS INT)), (-1), (16) AS t(r)").collect()] == [None] * 3
    cells = spark.createDataFrame([(cell,), (None,), (5,), (-1,), ((cell & ~(127 << 45)) | (122 << 45),), (0x8928308280FFFFF,)], "c long").coalesce(1)
    c = F.col("c")
    got = cells.select(grid_udfs.cell_to_latlng(c).alias("at"), grid_udfs.cell_to_boundary(c).alias("o"), grid_udfs.cell_south(c).alias("s"), grid_udfs.grid_disk(c, 1).alias("d")).collect()
    assert [r["at"] is None for r in got] == [r["o"] is None for r in got] == [r["s"] is None for r in got] == [r["d"] is None for r in got] == [False, True, True, True, True, False]
    assert got[0]["s"] == pytest.approx(min(p["lat"] for p in got[0]["o"])) and cell in got[0]["d"] and len(got[5]["d"]) == 7
    cells.createOrReplaceTempView("odd_cells")
    named = spark.sql("SELECT cell_centre(c) AS at, cell_outline(c) AS o, cell_disk(c, 1) AS d, cell_disk(c, CAST(NULL AS INT)) AS n FROM odd_cells").collect()
    assert [(r["at"], r["o"], r["d"]) for r in named] == [(r["at"], r["o"], r["d"]) for r in got] and all(r["n"] is None for r in named)


def test_mixed_cells_and_disks():
    """Resolutions mixed, pentagons among them: outlines and disks are those of the cells one by one."""
    cells = np.concatenate([np.unique(grid.latlng_to_cell(*sphere(200, r), r)) for r in (0, 1, 4, 7)] + [[(1 << 59) | (r << 52) | (4 << 45) | ((1 << (45 - 3 * r)) - 1) for r in (0, 3)]])
    for together, c in zip(grid.cell_to_boundary(cells), cells, strict=True):
        assert np.allclose(sorted(together), sorted(grid.cell_to_boundary([c])[0]), atol=1e-9)  # where two faces meet, either one's first corner
    held, starts = grid.disks(cells, 2)
    for c, lo, hi in zip(cells.tolist(), starts[:-1], starts[1:]):
        step = {n for around in grid.neighbours([c]) for n in around}
        want = {c} | step | {n for around in grid.neighbours(sorted(step)) for n in around}
        assert held[lo:hi].tolist() == sorted(want)
    assert grid.cell_to_boundary([]) == [] and grid.neighbours([]) == [] and len(grid.disks([], 1)[0]) == 0


def test_cells_of_an_aggregate_go_to_python_once(spark):
    """Each time that a function's argument names a cell is a column of the rows that wait for Python."""
    cells = spark.range(5).select((F.lit(0x8928308280FFFFF) + F.col("id") % 2).alias("c")).distinct()
    cell = F.col("c")
    for f in (grid_udfs.cell_to_latlng(cell), grid_udfs.cell_to_boundary(cell), grid_udfs.cell_south(cell), grid_udfs.grid_disk(cell, 1)):
        plan = cells.select("c", f.alias("f"))._jdf.queryExecution().optimizedPlan().toString()
        rows = next(line for line in plan.splitlines() if "Aggregate [" in line).rsplit("], [", 1)[1]
        assert rows.count("c#") <= 3


def test_cells_of_fewer_bits(spark):
    got = spark.sql("SELECT CAST(7 AS INT) AS c").select(grid_udfs.cell_to_latlng(F.col("c")).alias("at"), grid_udfs.grid_disk(F.col("c"), 1).alias("d")).first()
    assert got["at"] is None and got["d"] is None
