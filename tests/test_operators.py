import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import crs
from cellweave.operators import aggregate, boxes, catalog, cellcodes, clouds, filters, points, quality, raster, temporal, texture
from cellweave.operators.grids import Grid, grid

EEA = grid("EEA_1km")
FLAT = Grid("flat", 3035, 10.0, 0.0, 0.0, 1000.0, 1000.0)


def test_aggregate_null_rules(spark):
    rows = spark.createDataFrame([(1, "a", None, "2", 0.5), (1, "a", None, "x", 0.5), (None, None, 3.0, None, 1.0)], "grid_idx long, dim string, v double, t string, fraction double")
    spec = [{"column": "v", "method": "sum"}, {"column": "v"}, {"column": "t", "method": "sum", "weighted": True, "rename": "ws"}, {"column": "t", "method": "mean", "weighted": True, "rename": "wm"}, {"column": "gone"}, {"column": "v", "method": "count"}]
    got = {r["grid_idx"]: r.asDict() for r in aggregate.aggregate_cube(rows, ["dim", "absent"], spec).collect()}
    assert got[1] == {"grid_idx": 1, "dim": "a", "v_sum": 0.0, "v_nunique": 0, "ws": 0.5 * 2 + 0.5 * 1, "wm": (0.5 * 2 + 0.0) / 2, "v_count": 0}
    assert got[None]["v_sum"] == 3.0 and got[None]["ws"] == 1.0 and got[None]["wm"] == 0.0
    with pytest.raises(ValueError):
        aggregate.aggregate_cube(rows, [], [{"column": "v", "method": "nonsense"}])


def test_cloud_radii_and_spread(spark):
    one = spark.createDataFrame([(1, 500.0, 500.0, 500.0), (2, 500.0, 500.0, None), (3, 500.0, 500.0, -4.0)], "src_uid long, x double, y double, u double")
    for portable in (True, False):
        flat = clouds.cloud(one, 500, "uniform", portable=portable).toPandas()
        d = np.hypot(flat.x - 500, flat.y - 500)
        assert d[flat.src_uid == 1].max() <= 500 and d[flat.src_uid != 1].max() == 0
        assert abs((d[flat.src_uid == 1] < 500 / math.sqrt(2)).mean() - 0.5) < 0.08
    bell = clouds.cloud(one.where("src_uid = 1"), 500, "gaussian").toPandas()
    assert abs(bell.x.std() - 500 / 3) < 25 and abs(bell.y.std() - 500 / 3) < 25
    for bad in ({"passes": 0}, {"distribution": "even"}):
        with pytest.raises(ValueError):
            clouds.cloud(one, **bad)
    with pytest.raises(ValueError):
        clouds.map_cloud(one, EEA.template((0, 0, 2000, 2000)), "other")


def test_cloud_on_a_lattice_line_counts_twice(spark):
    t = EEA.template((-1000, -1000, 3000, 3000))
    still = spark.createDataFrame([(1, 1000.0, 500.0, 0.0), (2, 1000.0, 1000.0, 0.0)], "src_uid long, x double, y double, u double")
    got = clouds.fractional(clouds.cloud(still, 4), t, 4).groupBy("src_uid").agg(F.count("*").alias("n"), F.sum("fraction").alias("f")).orderBy("src_uid").collect()
    assert [(r["n"], r["f"]) for r in got] == [(2, 2.0), (4, 4.0)]


def _ring_mass(px, py, t):
    return sum(a for _, _, a in boxes.ring_cells(np.array(px, float), np.array(py, float), t))


def test_rings_keep_their_area():
    t = FLAT.template((0, 0, 1000, 1000))
    rng = np.random.default_rng(0)
    for _ in range(50):
        angles = (np.arange(9) + rng.uniform(0, 0.8, 9)) * (2 * math.pi / 9)
        radius = rng.uniform(5, 80, 9)  # star-shaped, not convex
        px, py = 300 + radius * np.cos(angles), 400 + radius * np.sin(angles)
        assert _ring_mass(px, py, t) == pytest.approx(abs(boxes.ring_area(px, py)), rel=1e-9)
        assert _ring_mass(px[::-1], py[::-1], t) == pytest.approx(abs(boxes.ring_area(px, py)), rel=1e-9)
    cells = {(c, k): a for c, k, a in boxes.ring_cells(np.array([5.0, 25, 25, 5]), np.array([5.0, 5, 15, 15]), t)}
    assert {k: round(v, 9) for k, v in cells.items()} == {(0, 0): 25, (1, 0): 50, (2, 0): 25, (0, 1): 25, (1, 1): 50, (2, 1): 25}


def test_rings_in_frames(spark):
    ring = "array<struct<x:double,y:double>>"
    rows = spark.createDataFrame([(1, [(5.0, 5.0), (25.0, 5.0), (25.0, 15.0)]), (2, None), (3, [(1.0, 1.0), (2.0, 2.0)]), (4, [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)])], f"src_uid long, ring {ring}")
    got = boxes.shatter_rings(rows, FLAT.template((0, 0, 1000, 1000))).toPandas()
    assert set(got.src_uid) == {1} and got.areal_fraction.sum() == pytest.approx(1)


def test_utm_buffers_have_their_radius(spark):
    rows = spark.createDataFrame([(1, 4.3, 50.8, 1000.0), (2, -70.0, -33.0, 250.0), (3, 10.0, 89.0, 5.0), (4, 4.3, 50.8, None)], "src_uid long, lon double, lat double, u double")
    got = {r["src_uid"]: r["ring"] for r in boxes.geographic_rings(rows, "lon", "lat", "u").collect()}
    assert got[3] is None and len(got[1]) == 32
    for uid, lon, lat, u in ((1, 4.3, 50.8, 1000), (2, -70.0, -33.0, 250), (4, 4.3, 50.8, 0)):
        zone, south = math.floor((lon + 180) / 6) + 1, lat < 0
        cx, cy = crs.utm_forward(lon, lat, zone, south)
        for p in got[uid]:
            x, y = crs.utm_forward(p["x"], p["y"], zone, south)
            assert math.hypot(x - cx, y - cy) == pytest.approx(u, abs=1e-5)


def test_cell_codes(spark):
    rows = spark.createDataFrame([("100KME51N29",), ("250ME510500N293350",), ("CRS3035RES10000MN2480000E4850000",), ("W175S21",), (None,), ("1kmE3900N3100",)], "c string")
    got = [None if r[0] is None else tuple(r[0]) for r in rows.select(cellcodes.parse_box(F.col("c"))).collect()]
    assert got == [(5100000, 2900000, 5200000, 3000000), (5105000, 2933500, 5105250, 2933750), (4850000, 2480000, 4860000, 2490000), None, None, (3900000, 3100000, 3901000, 3101000)]
    with pytest.raises(Exception, match="not a cell code"):
        rows.select(cellcodes.parse_box(F.col("c"), strict=True)).collect()
    with pytest.raises(ValueError):
        cellcodes.eea_code(F.col("c"), F.col("c"), 3)


def test_points(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0), (1.0, 2.0)], "x double, y double")
    assert points.sanitize_points(rows).count() == 2 and points.sanitize_points(rows, deduplicate=True).count() == 1
    with pytest.raises(ValueError):
        points.require_points(rows, "x", "y")
    with pytest.raises(ValueError):
        points.require_points(rows.limit(0), "x", "y")
    with pytest.raises(ValueError):
        points.to_grid_crs(rows, EEA, "x", "y", source_epsg=None)
    with pytest.raises(ValueError):
        points.map_points(rows, EEA.template((0, 0, 1, 1)), "guess")
    assert points.find_column(spark.createDataFrame([(1,)], "DecimalLongitude int"), "lon") == "DecimalLongitude"


def test_filters(spark):
    for bad in (((2001, 2000), None), (None, (0, 3)), (None, (5, 4))):
        with pytest.raises(ValueError):
            filters.year_month(*bad)
    with pytest.raises(ValueError):
        filters.max_uncertainty("auto")
    assert filters.rank_slice("genus") == ["genuskey", "specieskey"] and filters.rank_slice() == ["specieskey"]
    with pytest.raises(ValueError):
        filters.rank_slice("tribe")
    assert filters.quoted("Order") == "`order`" and filters.quoted("GenusKey") == "genuskey"
    rows = spark.createDataFrame([(1,)], "SpeciesKey int")
    assert filters.check_columns(rows, ["specieskey"]) == ["SpeciesKey"]
    with pytest.raises(ValueError):
        filters.check_columns(rows, ["nope"])
    matches = spark.createDataFrame([("a", "EXACT"), ("b", "FUZZY"), ("c", "HIGHERRANK"), ("d", None)], "name string, matchtype string")
    good, bad = filters.split_matches(matches, fuzzy_ok=True)
    assert {r["name"] for r in good.collect()} == {"a", "b"} and {r["name"] for r in bad.collect()} == {"c", "d"}


def test_temporal(spark):
    assert temporal.month_range(1, 12, 2000, 2000) == [f"{m:02d}_2000" for m in range(1, 13)]
    assert temporal.month_range(2, 3, 2000, 2001) == ["02_2000", "03_2000", "02_2001", "03_2001"]
    assert temporal.month_range(3, 3, 2000, 2001) == ["03_2000", "03_2001"]
    rows = spark.createDataFrame([("2018", 2, 30), ("2018", 2, 3), ("2018.0", 2, 3), (None, 1, 1)], "year string, month int, day int")
    assert [None if r[0] is None else str(r[0]) for r in temporal.cf_datetime(rows).select("datetime").collect()] == [None, "2018-02-03", None, None]
    assert temporal.cf_datetime(rows.drop("year")).columns == ["month", "day"]


def test_window_of_a_known_raster(spark):
    # 512 x 384 pixels of size 1 from (1000, 2000): value (x + y) % 256
    rows, cols = raster.window_of((1000, 1995, 1005, 2000), 1000.0, 2000.0, 1.0)
    assert (rows, cols) == ((0, 4), (0, 4))
    pixels = spark.range(512 * 384).select(F.floor(F.col("id") / 512).cast("long").alias("row"), (F.col("id") % 512).alias("col")).withColumn("value", (F.col("row") + F.col("col")) % 256)
    got = raster.clip(pixels, rows, cols).toPandas().pivot(index="row", columns="col", values="value").to_numpy()
    assert (got == np.add.outer(np.arange(5), np.arange(5))).all()


def test_kernels(spark):
    assert texture.sobel_kernel(3).tolist() == [[-0.125, 0, 0.125], [-0.25, 0, 0.25], [-0.125, 0, 0.125]]
    assert abs(texture.log_kernel(7).sum()) < 1e-12
    gx, gy = texture.savitzky_golay(7)
    y, x = np.mgrid[-3:4, -3:4]
    plane = 2.0 * x - 5.0 * y + 1 + 0.3 * x * x
    assert (gx * plane).sum() == pytest.approx(2) and (gy * plane).sum() == pytest.approx(-5)
    with pytest.raises(ValueError):
        raster.coarsen(spark.range(1), 2, "bilinear")
    with pytest.raises(ValueError):
        raster.check_cell_area(spark.createDataFrame([(0.0, 0.0, 10.0, 10.0)], "minx double, miny double, maxx double, maxy double"), 4.0)


def test_quality_report(spark):
    b = (0.0, 0.0, 100.0, 100.0)
    rows = spark.createDataFrame([(1, 50.0, 50.0, 10.0), (2, 98.0, 50.0, 10.0), (3, 300.0, 50.0, 10.0)], "src_uid long, x double, y double, u double")
    zoned = rows.withColumn("zone", quality.zone(F.col("x"), F.col("y"), F.col("u"), b))
    assert [r["zone"] for r in zoned.orderBy("src_uid").collect()] == ["Interior", "Boundary", "Exterior"]
    mapping = spark.createDataFrame([(1, 5, 0.5), (2, 6, 0.6)], "src_uid long, grid_idx long, w double")
    mass = quality.masses(zoned, mapping, "w")
    drifted = spark.createDataFrame([(9, False)], "src_uid long, drift_ok boolean")
    failed = quality.failures(mass, drifted, b)
    assert sorted(map(tuple, failed.collect())) == [("drift_failures", 9), ("interior_mass_failures", 1)]
    assert quality.failure_report(failed, "t") == {"interior_mass_failures": 1, "boundary_mass_failures": 0, "drift_failures": 1, "table": "t"}


def test_catalog_keys(spark):
    rows = spark.createDataFrame([("s/global/climatologies/clt/1981-2010/file_clt_01_1981-2010_V.2.1.tif",), ("s/global/annual/tas/1601/file_tas_1601_V.tif",), ("odd",)], "key string")
    got = [r.asDict() for r in catalog.parse_keys(rows).collect()]
    assert (got[0]["level"], got[0]["variable"], got[0]["time_range"], got[0]["month"]) == ("climatologies", "clt", "1981-2010", 1)
    assert str(got[1]["date"]) == "1981-01-01" and got[2]["level"] is None


@pytest.mark.parametrize("name, kernel, reach", [("nearest", "nearest", 1), ("bilinear", "bilinear", 2), ("cubic", "cubic", 4), ("cubic_spline", "cubicSpline", 4), ("lanczos", "lanczos", 6)])
def test_interpolation_of_every_order(spark, tmp_path, name, kernel, reach):
    """All orders are targets, whatever their ids: against weights over all pixels."""
    from cellweave.registry import queries

    keys = [0, 5, 1999, 2000, 2001, 31337, 10**6, 10**9 + 7]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, k % 7, 900.0 + k % 13) for k in range(64 * 37)], "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")

    def weight(t):
        a = abs(t)
        if kernel == "nearest":
            return float(-0.5 <= t < 0.5)
        if kernel == "bilinear":
            return max(1 - a, 0)
        if kernel == "cubic":
            return 1.5 * a**3 - 2.5 * a**2 + 1 if a <= 1 else -0.5 * a**3 + 2.5 * a**2 - 4 * a + 2 if a < 2 else 0
        if kernel == "cubicSpline":
            return 0.5 * a**3 - a**2 + 2 / 3 if a <= 1 else (2 - a) ** 3 / 6 if a < 2 else 0
        return np.sinc(t) * np.sinc(t / 3) if a < 3 else 0

    want = {}
    for k in keys:
        r, c = (k % 97) * 0.37, (k % 211) * 0.37 + 2
        met = [(weight(r - row) * weight(c - col), 900.0 + (row * 64 + col) % 13) for row in range(37) for col in range(64) if abs(r - row) <= reach and abs(c - col) <= reach]
        if abs(total := sum(w for w, _ in met)) > 1e-6:
            want[k] = sum(w * v for w, v in met) / total
    got = {r["id"]: r["value"] for r in queries()[f"resample_{name}"](spark, str(tmp_path)).collect()}
    assert max(want) > 2000 and set(want) <= set(got)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-5)


def _calls(df, name):
    return df._jdf.queryExecution().optimizedPlan().toString().upper().count(f"{name}(")


def test_projections_are_computed_once(spark, sf):
    """Whatever filters, aggregates and joins stand above, no plan holds the formula more often than a bare projection does."""
    from cellweave import registry

    queries = registry.queries()
    bare = _calls(queries["project_laea"](spark, sf), "ASIN")
    assert bare == 1
    for name in [n for n in queries if n.startswith("cube_")] + ["points_to_grid", "api_cube_sql", "sparse_cube", "cell_wkt"]:
        assert _calls(queries[name](spark, sf), "ASIN") <= bare, name


def test_rings_of_all_kinds_in_one_batch():
    """Many rings at once give what each gives by itself; those without an area give nothing."""
    rng = np.random.default_rng(5)
    t = FLAT.template((0, 0, 1000, 1000))
    rings = []
    for i in range(60):
        n = int(rng.integers(3, 40))
        angle, radius = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(0.1, 60, n)
        x, y = rng.uniform(-20, 1020, 2)
        rings.append((x + radius * np.cos(angle), y + radius * np.sin(angle)))
    rings += [(np.array([1.0, 2]), np.array([1.0, 2])), (np.array([1.0, 2, 3]), np.array([1.0, 2, 3])), (np.array([]), np.array([])), (np.array([-5.0, 1005, 1005, -5]), np.array([-5.0, -5, 1005, 1005]))]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x, _ in rings])])
    flat = [np.concatenate([r[i] for r in rings]) for i in (0, 1)]
    got = {}
    for ring, cell, share, _ in zip(*boxes.cut_rings(*flat, offsets, t)):
        got[ring, cell] = share
    g, want = t.grid, {}
    top = math.floor((g.maxy - g.miny) / g.resolution - 0.5)
    for i, (px, py) in enumerate(rings):
        whole = abs(boxes.ring_area(px, py))
        for c, k, area in boxes.ring_cells(px, py, t) if whole > 1e-9 else []:
            if area / whole > boxes.SLIVER:
                want[i, (top - k) * g.columns + c] = area / whole
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    most, boxes.AT_ONCE = boxes.AT_ONCE, 50  # every ring alone, large ones by their rows
    try:
        alone = {(r, c): s for r, c, s, _ in zip(*boxes.cut_rings(*flat, offsets, t))}
    finally:
        boxes.AT_ONCE = most
    assert set(alone) == set(got) and all(abs(alone[k] - got[k]) < 1e-9 for k in got)
