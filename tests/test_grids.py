import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import crs
from cellweave.operators import grids


def ids(spark, grid, points):
    rows = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double")
    return [r[0] for r in rows.select(grid.index(F.col("x"), F.col("y"))).collect()]


def test_known_ids(spark):
    eea = grids.grid("EEA_1km")
    corners = [(0, 0), (1000, 0), (0, 1000), (1000, 1000), (-1000, 0), (0, -1000), (1000, -1000)]
    assert ids(spark, eea, [(x + 500, y + 500) for x, y in corners]) == [21994000, 21994001, 21990000, 21990001, 21993999, 21998000, 21998001]
    assert ids(spark, grids.grid("EEA_10km"), [(4005000, 3005000), (4015000, 3005000), (4005000, 2995000), (4500000, 3500000)]) == [99800, 99801, 100200, 80250]


def test_ties_go_north_west(spark):
    t = grids.grid("EEA_1km").template((-1000, -1000, 2000, 2000))
    rows = spark.createDataFrame([(500.0, 500.0), (1000.0, 500.0), (1000.0, 1000.0), (900.0, 500.0), (-1000.0, 0.5), (2001.0, 0.0)], "x double, y double")
    assert [r[0] for r in rows.select(t.intersect(F.col("x"), F.col("y"))).collect()] == [21994000, 21994000, 21990000, 21994000, 21993999, None]


@pytest.mark.parametrize("key", ["EEA_1km", "EEA_250m", "Global_EqualArea_1km", "Global_EqualArea_10km", "Global_WGS84_30sec"])
def test_closed_forms_equal_a_mesh(spark, key):
    g = grids.grid(key)
    r = g.resolution
    t = g.template((g.minx + 40.3 * r, g.miny + 70.7 * r, g.minx + 47.2 * r, g.miny + 75.1 * r))
    mesh = t.cells(spark).toPandas().sort_values("grid_idx").reset_index(drop=True)
    assert len(mesh) == t.width * t.height and mesh.grid_idx.is_unique
    rng = np.random.default_rng(1)
    x0, y0, x1, y1 = t.bounds
    x, y = rng.uniform(x0 - r, x1 + r, 400), rng.uniform(y0 - r, y1 + r, 400)
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = rows.select(t.intersect(F.col("x"), F.col("y")).alias("i"), t.nearest(F.col("x"), F.col("y")).alias("n"), g.index(F.col("x"), F.col("y")).alias("direct")).collect()
    for a, b, row in zip(x, y, got):
        hit = mesh[(mesh.minx <= a) & (a <= mesh.maxx) & (mesh.miny <= b) & (b <= mesh.maxy)]
        assert row["i"] == (int(hit.grid_idx.min()) if len(hit) else None)
        assert row["n"] == int(mesh.grid_idx[((mesh.x - a) ** 2 + (mesh.y - b) ** 2).idxmin()])


def test_inverse(spark):
    g = grids.grid("EEA_1km")
    t = g.template((3800000, 3000000, 3803000, 3002000))
    cells = t.cells(spark)
    back = cells.select("grid_idx", t.intersect(F.col("x"), F.col("y")).alias("b")).collect()
    assert all(r[0] == r[1] for r in back) and len(back) == 6


def test_registry_and_resolution():
    assert len(grids.registry()) == 18
    with pytest.raises(ValueError):
        grids.grid("EEA", "3km")
    assert grids.resolve_vector_grid({}).key == "Global_WGS84_30sec"
    assert grids.resolve_vector_grid({"grid": "EEA", "resolution": "10km"}).key == "EEA_10km"
    with pytest.raises(KeyError):
        grids.resolve_vector_grid({"grid": "nowhere"})
    assert grids.resolve_climate_grid({"grid": "GEA", "resolution": "10m"}).key == "Global_EqualArea_1km"
    assert grids.resolve_climate_grid({"grid": "WGS84", "resolution": "3sec"}).key == "Global_WGS84_15sec"
    assert grids.resolve_climate_grid({"grid": "Global_WGS84_30sec"}).key == "Global_WGS84_30sec"
    assert grids.resolve_climate_grid({}).key == "EEA_1km"
    names = ["10m", "20m", "100m"]
    assert [grids.pick_resolution(names, w) for w in ("highest", "lowest", "20m", "5m")] == ["10m", "100m", "20m", "10m"]
    assert grids.resolve_cover_grid({"grid": "EEA_1km", "dataset_resolution": "100m"}, names).key == "EEA_100m"
    assert grids.metres("1km") == 1000 and grids.metres("3sec") == 999999
    with pytest.raises(NotImplementedError):
        grids.grid_size_metres("MGRS", 1)
    assert grids.bounds_wkt((0, 1, 2, 3)) == "POLYGON ((2 1, 2 3, 0 3, 0 1, 2 1))"


def test_snapped_bounds_reproduce_a_known_extent():
    t = grids.grid("Global_WGS84_30sec").bounds_template((3.376891, 50.583876, 4.804775, 51.386124))
    assert np.allclose(t.bounds, (3.366666666, 50.575, 4.816666666, 51.4), atol=1e-8)


def test_projections():
    assert np.allclose(crs.transform_bounds((3.376891, 50.583876, 4.804775, 51.386124), 4326, 6933), (325823.65, 5662017.18, 463594.87, 5726969.44), atol=0.01)
    assert np.allclose(crs.transform_bounds((5.4, 47.207754, 15.17857, 54.814383), 4326, 3035), (3972483.99, 2677143.47, 4713273.83, 3535124.06), atol=0.01)
    rng = np.random.default_rng(2)
    lon, lat = rng.uniform(-25, 45, 500), rng.uniform(30, 75, 500)
    for p in (crs.Laea, crs.Cea):
        back = p.inverse(*p.forward(lon, lat, crs.ARRAYS))
        assert np.allclose(back, (lon, lat), atol=1e-11)
    assert crs.Laea.forward(10.0, 52.0, crs.ARRAYS) == pytest.approx((4321000, 3210000), abs=1e-6)
    zone, south = np.floor((lon + 180) / 6) + 1, lat < 0
    assert np.allclose(crs.utm_inverse(*crs.utm_forward(lon, lat, zone, south), zone, south), (lon, lat), atol=1e-11)
    with pytest.raises(ValueError):
        crs.projection(2154)


def test_columns_equal_arrays(spark):
    rows = spark.createDataFrame([(5.1, 50.2), (-9.0, 38.7), (24.9, 60.1)], "lon double, lat double")
    for code in (3035, 6933):
        x, y = crs.project(F.col("lon"), F.col("lat"), code)
        for r in rows.select("lon", "lat", x.alias("x"), y.alias("y")).collect():
            assert crs.projection(code).forward(r["lon"], r["lat"], crs.ARRAYS) == pytest.approx((r["x"], r["y"]), abs=1e-6)


def test_envelope():
    x0, y0, x1, y1 = crs.fetch_envelope((170, 80, 179.999, 89.999), 4326, 4326)
    assert x1 == 180 and y1 == 90 and x0 == pytest.approx(170 - 60 / 3600) and y0 == pytest.approx(80 - 60 / 3600)
    with pytest.raises(ValueError):
        crs.fetch_envelope((math.inf,) * 4, 6933, 4326)
