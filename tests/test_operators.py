import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratagrid.operators import checks, joins, stats
from stratagrid.plans import planning, products

PIX = "part string, h3_cell long, elev double"


def test_composition(spark):
    """Three pixels and two, merged, are the five of them."""
    px = spark.createDataFrame([("a", 1, 10.0), ("a", 1, 20.0), ("a", 1, 30.0), ("b", 1, 40.0), ("b", 1, 50.0)], PIX)
    merged = stats.merge(stats.partial(px, "part", "h3_cell"), "h3_cell")
    assert stats.differences(merged, stats.partial(px, "h3_cell"), "h3_cell").count() == 0
    row = stats.finalize(merged, "h3_cell").first()
    assert (row["elevation_mean"], row["elevation_max"], row["elevation_min"], row["pixel_count"]) == (30.0, 50.0, 10.0, 5)
    assert row["elevation_stddev"] == pytest.approx(200**0.5, rel=1e-6)


def test_boundary_merge(spark):
    rows = [(1, 430.0, 440.0, 420.0, 1.0, 41), (1, 456.0, 460.0, 450.0, 2.0, 89), (2, 5.0, 5.0, 5.0, 0.0, 1)]
    cells = spark.createDataFrame(rows, "h3_cell long, elevation_mean float, elevation_max float, elevation_min float, elevation_stddev float, pixel_count long")
    out = {r["h3_cell"]: r for r in stats.boundary_merge(cells, "h3_cell").collect()}
    assert out[1]["pixel_count"] == 130 and out[1]["elevation_mean"] == pytest.approx(447.8, abs=0.01) and out[1]["elevation_min"] == 420.0
    assert out[2]["elevation_stddev"] == 0.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(-1720, 35396)), min_size=1, max_size=60))
def test_merge_of_any_split(spark, pixels):
    px = spark.createDataFrame([(f"p{p}", c, e / 4) for p, c, e in pixels], PIX)
    merged = stats.merge(stats.partial(px, "part", "h3_cell"), "h3_cell")
    assert stats.differences(merged, stats.partial(px, "h3_cell"), "h3_cell", tolerance=0.0).count() == 0


def test_differences_finds_each_kind(spark):
    a = stats.partial(spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0)], PIX), "h3_cell")
    b = stats.partial(spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.5), ("a", 4, 3.0)], PIX), "h3_cell")
    assert sorted(r["h3_cell"] for r in stats.differences(a, b, "h3_cell").collect()) == [2, 3, 4]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], PIX)
    assert stats.aggregate(none, "h3_cell").count() == 0
    assert stats.finalize(stats.partial(spark.createDataFrame([("a", 1, None)], PIX), "h3_cell"), "h3_cell").first()["pixel_count"] == 0


def test_checks(spark):
    cells = spark.createDataFrame([(9, 1, 10.0, 20.0, 5.0, 1.0, 2, 1.0), (9, 2, 30.0, 20.0, 5.0, -1.0, 0, 200.0), (8, 3, float("nan"), 9000.0, 5.0, 1.0, 1, 1.0)], "res int, h3_cell long, elevation_mean float, elevation_max float, elevation_min float, elevation_stddev float, pixel_count long, geoid_undulation float")
    out = {r["res"]: r for r in checks.invariants(cells).collect()}
    assert (out[9]["bad_order"], out[9]["bad_sign"], out[9]["bad_geoid"], out[9]["bad_value"]) == (1, 1, 1, 0)
    assert (out[8]["bad_value"], out[8]["bad_elevation"]) == (1, 1)
    rows = checks.invariant_checks(cells)
    assert rows.filter("NOT ok").count() == 2 and "FAIL" in checks.report(rows)
    assert checks.violations(cells).count() == 2
    assert checks.schema(cells.drop("res")).first()["ok"] and not checks.schema(cells).first()["ok"]
    assert checks.conservation(cells).filter("NOT ok").count() == 1
    assert {r["res"]: r["ok"] for r in checks.row_counts(cells, spark.createDataFrame([(9, 2), (8, 7)], "res int, expected long")).collect()} == {9: True, 8: False}
    golden = cells.filter("res = 9").select("h3_cell", (F.col("elevation_mean") + F.when(F.col("h3_cell") == 2, 1).otherwise(0)).alias("elevation_mean"), "pixel_count")
    assert [r["h3_cell"] for r in checks.regressions(cells, golden).collect()] == [2]


def test_above_ground(spark):
    pts = spark.createDataFrame([("KTEB", 7, -29.0)], "name string, h3_cell long, h_ellipsoidal double")
    cells = spark.createDataFrame([(7, 1.0, -32.0)], "h3_cell long, elevation_mean float, geoid_undulation float")
    row = checks.agl_check(pts, cells).first()
    assert row["agl"] == 2.0 and row["ok"]
    assert joins.with_ocean(spark.createDataFrame([(8,)], "h3_cell long"), cells).first()["elevation_mean"] == 0.0


def plan_by_hand(land, step, target):
    cum, acc, north, out = {90: 0.0}, 0.0, 90, []
    for n, s, a in land:
        cum[s] = cum[n] + a
    legal = [s for _, s, _ in land if s % step == 0 or s == -90]
    for _, s, a in land:
        acc += a
        if s in legal:
            after = [x for x in legal if x < s]
            nxt = cum[after[0]] - cum[s] if after else 0.0
            if s == -90 or acc >= target - nxt / 2:
                out.append((north, s, acc))
                north, acc = s, 0.0
    return out


@pytest.mark.parametrize(("res", "step"), [(8, 5), (9, 1), (8, 7)])
def test_band_plan(spark, res, step):
    rng = random.Random(res + step)
    land = [(90 - k, 89 - k, float(rng.randint(0, 3_000_000))) for k in range(180)]
    target = 500e6 / planning.BYTES_PER_ROW * planning.CELL_AREA_KM2[res]
    got = planning.band_plan(spark.createDataFrame(land, planning.LAND_SCHEMA), res, step).orderBy("band").collect()
    assert [(r["lat_north"], r["lat_south"]) for r in got] == [(a, b) for a, b, _ in plan_by_hand(land, step, target)]
    fixed = planning.band_plan(spark.createDataFrame(land, planning.LAND_SCHEMA), 7, 5, [90, 0, -90]).orderBy("band").collect()
    assert [r["land_km2"] for r in fixed] == [sum(a for n, _, a in land if n > 0), sum(a for n, _, a in land if n <= 0)]


def test_eta_needs_two_observations(spark):
    import datetime as dt

    tiles = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4), ("d", 10)], "band string, tiles long")
    t0 = dt.datetime(2024, 1, 1)
    done = lambda n: spark.createDataFrame([(b, t0 + dt.timedelta(seconds=10 * i)) for i, b in enumerate("abc"[:n])], "band string, completed_at timestamp")
    assert planning.eta(done(2), tiles).first()["seconds_per_tile"] is None
    row = planning.eta(done(3), tiles).first()
    assert (row["tiles_left"], row["seconds_per_tile"], row["seconds_left"]) == (10, 3.75, 37.5)


def test_products(spark):
    cells = spark.createDataFrame([(0x8928308280FFFFF, 12.25)], "h3_cell long, elevation_mean float")
    poly = products.polygons(cells).first()
    assert len(poly["p"]) == 6 and poly["e"] == 12.2
    assert products.polygons_json(products.polygons(cells)).first()["json"].startswith('[{"p":[[-122.')
    kinds = [r["kind"] for r in products.columns_3d(cells, 37.7, -122.4).collect()]
    assert sorted(kinds) == ["top"] + ["wall"] * 6
    assert products.regular_grid(spark).count() == 180 * 361
    assert products.boomerang(4) == [0, 1, 2, 3, 2, 1]
    assert products.ring_descendants(spark, 37.77, -122.41, cells, from_res=8, res=9).count() <= 1


def test_suite(spark, sf_dir):
    from stratagrid import queries

    rows = queries.QUERIES["validation_suite"](spark, sf_dir).collect()
    assert {r["section"] for r in rows} == {"invariants", "conservation", "cells", "hypsographic"}
    assert [r["ok"] for r in rows if r["section"] == "conservation"] == [True] * 3
    cells = spark.createDataFrame([(k, float(k)) for k in range(50)], "h3_cell long, elevation_mean float")
    a = checks.random_cells(cells.repartition(7), 10).collect()
    assert a == checks.random_cells(cells.coalesce(1), 10).collect() and len(a) == 10


def test_sampling_at_edges_and_without_coordinates(spark):
    import numpy as np

    raster = np.array([[1.0, 2.0, 4.0], [8.0, 16.0, 32.0]])
    at = [(9.0, 1.0), (10.5, 0.5), (9.75, 1.25), (99.0, -99.0), (-99.0, 99.0), (None, 1.0), (1.0, None), (float("nan"), 1.0), (8.5, 2.5)]
    points = spark.createDataFrame(at, "lat double, lon double").coalesce(1)
    got = [r["geoid_undulation"] for r in joins.sample_raster(points, raster, (0.0, 1.0, 11.0, -1.0)).collect()]
    by_hand = lambda r, c: (lambda r0, c0: (raster[r0, c0] * (1 - (c - c0)) + raster[r0, c0 + 1] * (c - c0)) * (1 - (r - r0)) + (raster[r0 + 1, c0] * (1 - (c - c0)) + raster[r0 + 1, c0 + 1] * (c - c0)) * (r - r0))(min(int(r), 0), min(int(c), 1))
    clip = lambda lat, lon: (min(max((lat - 11) / -1 - 0.5, 0), 1), min(max(lon - 0.5, 0), 2))
    want = [None if a is None or b is None or a != a else by_hand(*clip(a, b)) for a, b in at]
    assert got == pytest.approx(want)
    one = joins.sample_raster(points.limit(1), np.array([[7.0]]), (0.0, 1.0, 11.0, -1.0)).first()
    assert one["geoid_undulation"] == 7.0


def test_views_are_bounded(spark, tmp_path):
    cells = spark.createDataFrame([(0x8928308280FFFFF, 12.25), (0x85283473FFFFFFF, 1.0)], "h3_cell long, elevation_mean float")
    polys = products.polygons(cells)
    with pytest.raises(ValueError, match="more than 1"):
        products.polygons_json(polys, at_most=1)
    products.write_polygons(polys, f"{tmp_path}/p")
    assert spark.read.json(f"{tmp_path}/p").count() == 2
    with pytest.raises(ValueError, match="more than 3"):
        products.geoid_json(products.regular_grid(spark, 90.0).withColumn("value", F.lit(1.0)), at_most=3)


def test_curve_of_odd_values(spark):
    rows = [(5.5,), (5.5,), (5.25,), (-3.0,), (None,), (float("nan"),), (900.0,)]
    got = [(str(r["elevation_mean"]), r["cells"], r["area_percent"]) for r in stats.hypsographic_curve(spark.createDataFrame(rows, "elevation_mean double")).orderBy("area_percent").collect()]
    assert got == [("nan", 1, 0.0), ("900.0", 1, 20.0), ("5.5", 2, 40.0), ("5.25", 1, 80.0), ("-3.0", 1, 100.0)]
    assert stats.hypsographic_curve(spark.createDataFrame([], "elevation_mean double")).count() == 0


def test_pixels_without_a_place(spark):
    px = spark.createDataFrame([(1.0, 2.0, 3.0), (float("nan"), 2.0, 3.0), (1.0, float("inf"), 3.0), (None, 2.0, 3.0), (1.0, 2.0, float("nan"))], "lat double, lon double, elev double")
    assert stats.located(px, (4, 5)).count() == 2
