import json
import zipfile

import pytest
from pyspark.sql import functions as F

from cellweave import pipeline, recipe
from cellweave.plans.views import occurrences
from cellweave.sources import readers, sinks
from cellweave.streaming.cubes import stream_to_parquet, windowed_counts
from cellweave.operators.grids import Grid

AGG = {"group_by_columns": ["year", "month", "absent"], "metrics": [{"column": "specieskey", "rename": "species"}, {"column": "individualcount", "method": "sum", "weighted": True}]}


@pytest.fixture(scope="module")
def records(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "occ.parquet")
    occurrences(spark, sf).select(F.col("src_uid").alias("gbifid"), "specieskey", "year", "month", "decimallongitude", "decimallatitude", F.col("u").alias("coordinateUncertaintyInMeters"), F.lit(2.0).alias("individualcount")).write.parquet(path)
    return path


@pytest.mark.parametrize("kind", ["point", "point_cloud", "polygon"])
@pytest.mark.parametrize("grid", [{"grid": "EEA_1km"}, {"grid": "Global_EqualArea", "resolution": "1km"}, {}])
def test_vector_cube(spark, records, kind, grid):
    made = recipe.parse({"base_dir": "x", "spatial": {"bbox": [2.9, 50.3, 5.2, 51.7]}, "aggregate": AGG})
    spec = {"path": records, "target": grid, "output_type": kind, "point_cloud_config": {"n_passes": 5, "random_seed": 3, "mode": "fractional"}}
    out = pipeline.vector_pipeline(spark, spec, made)
    total = out["aggregated"].agg(F.sum("individualcount_sum")).first()[0]
    assert total == pytest.approx(2.0 * spark.read.parquet(records).where("coordinateUncertaintyInMeters > 0" if kind == "polygon" else "true").count(), rel=1e-3)
    assert out["aggregated"].columns[:2] == ["grid_idx", "species"] and "datetime" in out["aggregated"].columns
    assert out["dimension_table"].count() == out["aggregated"].select("grid_idx").distinct().count()


@pytest.mark.parametrize("kind", ["point", "point_cloud", "polygon"])
@pytest.mark.parametrize("grid", [{"grid": "EEA_1km"}, {}])
def test_repeated_and_null_ids_keep_their_totals(spark, kind, grid):
    """Three records worth 2 each, one id twice and one null: 6 on every way."""
    rows = [(1, 3.5, 50.9, 300.0, 7, 2.0), (1, 4.5, 51.1, 900.0, 8, 2.0), (None, 4.0, 51.0, 500.0, 9, 2.0)]
    df = spark.createDataFrame(rows, "gbifid long, decimallongitude double, decimallatitude double, coordinateUncertaintyInMeters double, specieskey int, individualcount double")
    made = recipe.parse({"base_dir": "x", "spatial": {"bbox": [2.9, 50.3, 5.2, 51.7]}, "aggregate": AGG})
    spec = {"target": grid, "output_type": kind, "point_cloud_config": {"n_passes": 6, "mode": "fractional"}}
    out = pipeline.vector_pipeline(spark, spec, made, df)
    assert out["aggregated"].agg(F.sum("individualcount_sum")).first()[0] == pytest.approx(6.0, rel=1e-6)
    assert out["unaggregated"].groupBy("specieskey").agg(F.sum("individualcount")).count() == 3


def test_run_writes_a_star_schema(spark, records, tmp_path):
    made = recipe.parse({"base_dir": str(tmp_path), "cube_name": "c", "spatial": {"bbox": [2.9, 50.3, 5.2, 51.7]}, "aggregate": AGG, "sources": {"occurrences": {"path": records, "target": {"grid": "EEA_1km"}}, "climate": {"catalog": "nowhere"}}})
    found = pipeline.run(spark, made)
    assert [link["href"] for link in found["links"]] == ["./c_occurrences.json"]
    fact = spark.read.parquet(f"{tmp_path}/c/occurrences/aggregated")
    dim = spark.read.parquet(f"{tmp_path}/c/occurrences/dimension_table")
    assert fact.join(dim, "grid_idx").count() == fact.count() > 0
    assert json.loads((tmp_path / "c/meta/provenance.json").read_text())["recipe_sha256"]
    with pytest.raises(ValueError):
        recipe.parse({"spatial": {}})


def test_raw_mode(spark, records):
    made = recipe.parse({"base_dir": "x", "spatial": {"bbox": [0, 0, 1, 1]}})
    assert set(pipeline.vector_pipeline(spark, {"path": records, "processing_mode": "raw"}, made)) == {"raw"}


def test_pregridded_records(spark):
    made = recipe.parse({"base_dir": "x", "spatial": {"bbox": [2.9, 50.3, 5.2, 51.7]}})
    df = spark.createDataFrame([("1kmE3900N3100", 5), ("W1", 2)], "eeacellcode string, n long")
    out = pipeline.vector_pipeline(spark, {"target": {"grid": "EEA_1km"}}, made, df)
    assert [(r["grid_idx"], r["n"]) for r in out["unaggregated"].collect()] == [((4499 - 2100) * 4000 + 1900, 5)]


def test_raster_cube(spark, tmp_path):
    path = str(tmp_path / "catalog")
    spark.createDataFrame([("bioclim", "bio12", "1981-2010", None, None, None, None, "a"), ("bioclim", "bio01", "1981-2010", None, None, None, None, "b")], "level string, variable string, time_range string, model string, scenario string, month int, date date, href string").write.parquet(path)
    made = recipe.parse({"base_dir": "x", "spatial": {"bbox": [3.0, 50.5, 3.2, 50.7]}})
    from cellweave.functions.crs import ARRAYS, Laea

    x, y = Laea.forward(3.1, 50.6, ARRAYS)
    pixels = spark.createDataFrame([("a", float(x), float(y), 1.0), ("a", float(x), float(y), 3.0), ("b", 0.0, 0.0, 7.0)], "href string, x double, y double, value double")
    got = pipeline.raster_pipeline(spark, {"catalog": path, "target": {"grid": "EEA_1km"}, "select": {"variable": ["bio12"]}}, made, pixels).collect()
    assert [(r["variable"], r["z"], r["value"]) for r in got] == [("bio12", "1981-2010", 2.0)]


def test_land_cover_cube(spark, tmp_path):
    """Pixels in degrees on a metre grid: shares are averaged, classes and aggregates keep their own kernels."""
    path = str(tmp_path / "catalog")
    rows = [("GRA", "grass", 2018, "coverage", "", "a"), ("GRA", "grass", 2018, "max", "", "b"), ("GRA", "grass", 2018, "rms", "", "c"), ("GRA", "grass", 2018, "class", "dense", "d"), ("GRA", "grass", 2012, "coverage", "", "e")]
    spark.createDataFrame(rows, "level string, variable string, year int, aggregation string, layer_class string, href string").write.parquet(path)
    made = recipe.parse({"base_dir": "x", "spatial": {"bbox": [3.0, 50.5, 3.05, 50.53]}, "temporal": {"start": "2015-01-01", "end": [2020, 12]}})
    step = 1 / 200
    pixels = spark.createDataFrame([(h, 2.9 + (i + 0.5) * step, 50.4 + (j + 0.5) * step, float((i * 7 + j * 3) % 5)) for h in "abcde" for i in range(60) for j in range(50)], "href string, x double, y double, value double")
    spec = {"type": "land_cover", "catalog": path, "target": {"grid": "EEA", "resolution": "1km"}, "resolutions": ["1km"], "pixels_epsg": 4326}
    got = pipeline.raster_pipeline(spark, spec, made, pixels).toPandas()
    assert set(got.layer) == {"grass__coverage", "grass__max", "grass__rms", "grass__class__dense"} and set(got.z) == {"2018-01-01"}
    from cellweave.functions.crs import ARRAYS, Laea

    grid = pipeline.LandCover().grid(spec)
    t = grid.bounds_template((3.0, 50.5, 3.05, 50.53))
    one = pixels.where("href = 'a'").toPandas()
    x, y = Laea.forward(one.x.to_numpy(), one.y.to_numpy(), ARRAYS)
    top = round((grid.maxy - grid.miny) / grid.resolution) - 1
    one["cell"] = [(top - int((b - grid.miny) // 1000)) * grid.columns + int((a - grid.minx) // 1000) for a, b in zip(x, y)]
    inside = set(r["grid_idx"] for r in t.cells(spark).collect())
    by = {c: g.value.to_numpy() for c, g in one.groupby("cell") if c in inside}
    for layer, how in (("grass__coverage", lambda v: v.mean()), ("grass__max", lambda v: v.max()), ("grass__rms", lambda v: (v * v).mean() ** 0.5)):
        assert {r.grid_idx: round(r.value, 9) for r in got[got.layer == layer].itertuples()} == {c: round(how(v), 9) for c, v in by.items()}
    near = got[got.layer == "grass__class__dense"]
    cells = {r["grid_idx"]: r for r in t.cells(spark).collect()}
    assert set(near.grid_idx) == inside
    for r in near.itertuples():
        lon, lat = Laea.inverse(cells[r.grid_idx]["x"], cells[r.grid_idx]["y"])
        assert r.value == (int((lon - 2.9) // step) * 7 + int((lat - 50.4) // step) * 3) % 5


def test_run_checks_masses_and_names_its_inputs(spark, records, tmp_path):
    made = recipe.parse({"base_dir": str(tmp_path), "cube_name": "c", "digests": True, "spatial": {"bbox": [3.5, 50.7, 4.2, 51.2]}, "aggregate": AGG, "sources": {"occurrences": {"path": records, "target": {"grid": "EEA_1km"}, "output_type": "polygon"}}})
    pipeline.run(spark, made)
    item = json.loads((tmp_path / "c/meta/c_occurrences.json").read_text())["properties"]
    assert item["proj:epsg"] == 3035 and item["cube:dimensions"]["x"]["step"] == 1000.0 and item["cube:dimensions"]["year"]["type"] == "ordinal"
    report = json.loads((tmp_path / "c/meta/c_occurrences_quality.json").read_text())
    masses = spark.read.parquet(f"{tmp_path}/c/occurrences/masses")
    assert masses.count() == spark.read.parquet(records).count() and {r[0] for r in masses.select("zone").distinct().collect()} == {"Interior", "Boundary", "Exterior"}
    whole = spark.read.parquet(records).where("coordinateUncertaintyInMeters > 0").count()
    assert report["interior_mass_failures"] == masses.where("zone = 'Interior' and u = 0").count() < whole  # points without an extent have no area
    inputs = json.loads((tmp_path / "c/meta/provenance.json").read_text())["inputs"]
    assert inputs and all(len(i["sha256"]) == 64 and i["size"] > 0 for i in inputs)
    bad = spark.createDataFrame([(1, None, 50.9, 7)], "gbifid long, decimallongitude double, decimallatitude double, specieskey int")
    with pytest.raises(ValueError, match="lack a coordinate"):
        pipeline.vector_pipeline(spark, {"target": {"grid": "EEA_1km"}, "strict": True}, made, bad)


def test_raster_cube_interpolates_on_a_finer_grid(spark, tmp_path):
    """A bilinear variable, 30 arc-second pixels on 15 second cells: a plane comes back, with a value in every cell."""
    path = str(tmp_path / "catalog")
    spark.createDataFrame([("bioclim", "bio01", "1981-2010", None, None, None, None, "a")], "level string, variable string, time_range string, model string, scenario string, month int, date date, href string").write.parquet(path)
    made = recipe.parse({"base_dir": "x", "spatial": {"bbox": [3.0, 50.5, 3.1, 50.6]}})
    step = 1 / 120
    rows = [("a", 2.9 + (i + 0.5) * step, 50.4 + (j + 0.5) * step, 5.0 * i + 3.0 * j) for i in range(36) for j in range(36)]
    pixels = spark.createDataFrame(rows, "href string, x double, y double, value double")
    spec = {"catalog": path, "target": {"grid": "Global_WGS84_15sec"}}
    grid = pipeline.Climate().grid(spec)
    assert abs(grid.resolution - step / 2) < 1e-9
    cells = {r["grid_idx"]: r for r in grid.bounds_template((3.0, 50.5, 3.1, 50.6)).cells(spark).collect()}
    got = {r["grid_idx"]: r["value"] for r in pipeline.raster_pipeline(spark, spec, made, pixels).collect()}
    assert set(got) == set(cells)
    for k, v in got.items():
        want = 5.0 * ((cells[k]["x"] - 2.9) / step - 0.5) + 3.0 * ((cells[k]["y"] - 50.4) / step - 0.5)
        assert abs(v - want) < 1e-4


def test_readers(spark, tmp_path):
    text = "gbifid\tspecieskey\tdecimalLatitude\n1\t7\t50.5\n2\t\t51.0\n"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", text)
        z.writestr("notes.txt", "no")
    got = readers.read_occurrences(spark, str(tmp_path / "a.zip")).orderBy("gbifid").collect()
    assert [(r["gbifid"], r["specieskey"], r["decimallatitude"]) for r in got] == [(1, 7, 50.5), (2, None, 51.0)]
    (tmp_path / "b.csv").write_text('a,b\n1,"x\n')
    assert readers.sniff_separator(spark, str(tmp_path / "b.csv")) == ","
    assert readers.read_occurrences(spark, str(tmp_path / "b.csv")).first()["b"] == '"x'
    assert readers.read_catalog(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "r.yaml").write_text("base_dir: d\nspatial: {bbox: [0, 0, 1, 1]}\nsources: {occurrences: {}, climate: {}}\n")
    made = recipe.load(str(tmp_path / "r.yaml"))
    assert list(recipe.enabled(made)) == ["occurrences"]
    assert recipe.topology({"topology_config": {"mode": "classification", "random_state": 5}})["mode"] == "classify"


def test_assets_survive_failures(spark):
    def fetch(href):
        if href == "bad":
            raise OSError("gone")
        return [(0, 0, 1.0), (0, 1, 2.0)] if href == "good" else [(0, 0, None)]

    plan = spark.createDataFrame([("good",), ("bad",), ("void",)], "href string")
    got = readers.read_assets(plan, fetch).groupBy("href", "status").count().collect()
    assert {(r["href"], r["status"], r["count"]) for r in got} == {("good", "ok", 2), ("bad", "failed", 1), ("void", "empty", 1)}


def test_digests(spark, tmp_path):
    (tmp_path / "f").write_text("abc")
    assert sinks.file_digests(spark, [str(tmp_path / "f")]).first()["sha256"].startswith("ba7816bf")


def test_stream_equals_batch(spark, sf, tmp_path):
    flat = Grid("g", 3035, 1.0, 0.0, 0.0, 50.0, 1.0).template((0.0, 0.0, 50.0, 1.0))
    rows = spark.read.parquet(f"{sf}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), ((F.col("user_id") % 50) + 0.5).alias("x"), F.lit(0.5).alias("y"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = stream_to_parquet(stream, flat, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    got = {(r["start"], r["grid_idx"], r["occurrences"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r["start"], r["grid_idx"], r["occurrences"]) for r in windowed_counts(rows, flat).collect()}
    assert got <= want and len(got) >= 0.8 * len(want)  # the last windows stay open
