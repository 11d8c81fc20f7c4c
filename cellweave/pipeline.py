"""Cube pipelines: a source's rows to a mapping, an aggregate, dimensions, checks and files.

Sources are classes with two or five hooks, found by name in a registry. Plans stay lazy; each sink is one action.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave import recipe as recipes
from cellweave.operators import aggregate, boxes, catalog, clouds, filters, points, quality, raster, temporal
from cellweave.operators.grids import Grid, Template, resolve_climate_grid, resolve_cover_grid, resolve_vector_grid
from cellweave.sources import readers, sinks


class VectorSource(Protocol):
    def fetch(self, spark: SparkSession, spec: dict) -> DataFrame: ...

    def grid(self, spec: dict) -> Grid: ...


class RasterSource(Protocol):
    def grid(self, spec: dict) -> Grid: ...

    def plan(self, spark: SparkSession, spec: dict, recipe: recipes.Recipe) -> DataFrame: ...

    def label(self, pixels: DataFrame) -> DataFrame: ...

    def rule(self, assets: DataFrame): ...

    def keys(self) -> tuple[str, ...]: ...


SOURCES: dict[str, type] = {}


def source(name: str):
    """Register a source class for recipe blocks of this name."""

    def put(cls: type) -> type:
        SOURCES[name] = cls
        return cls

    return put


@source("occurrences")
class Occurrences:
    """Point records with uncertainty, or records that come with a cell code."""

    def fetch(self, spark: SparkSession, spec: dict) -> DataFrame:
        df = readers.read_occurrences(spark, spec["path"])
        df = filters.align_case(df, spec.get("columns") or [])
        return filters.request(df, spec.get("filters") or {})

    def grid(self, spec: dict) -> Grid:
        return resolve_vector_grid(spec.get("target") or {})


class Assets:
    """What sources of raster assets share."""

    def grid(self, spec: dict) -> Grid:
        return resolve_climate_grid(spec.get("target") or {})

    def rule(self, assets: DataFrame):
        return catalog.climate_rule(F.col("variable"))


@source("land_cover")
class LandCover(Assets):
    """Layers of a land-cover catalog (level, variable, year, aggregation, layer_class, href), one for each year and class."""

    def grid(self, spec: dict) -> Grid:
        return resolve_cover_grid(spec.get("target") or {}, spec.get("resolutions") or ["100m"])

    def plan(self, spark: SparkSession, spec: dict, recipe: recipes.Recipe) -> DataFrame:
        found = readers.read_catalog(spark, spec["catalog"], "level string, variable string, year int, aggregation string, layer_class string, href string")
        t = recipe.temporal
        end = t.get("end")
        years = (int(str(t["start"])[:4]) if t.get("start") else None, int(end[0] if isinstance(end, (list, tuple)) else str(end)[:4]) if end else None)
        return catalog.cover_plan(found, spec.get("select") or {}, years)

    def label(self, assets: DataFrame) -> DataFrame:
        return assets.withColumns({"z": catalog.cover_label(F.col("year")), "layer": catalog.packed(F.col("variable"), F.col("aggregation"), F.col("layer_class"))})

    def rule(self, assets: DataFrame):
        return catalog.cover_rule(F.col("aggregation"))

    def keys(self) -> tuple[str, ...]:
        return ("level", "variable", "aggregation", "layer_class", "layer", "z")


@source("climate")
class Climate(Assets):
    """Assets of a catalog, in long form at ``pixels`` (a table keyed by href)."""

    def plan(self, spark: SparkSession, spec: dict, recipe: recipes.Recipe) -> DataFrame:
        found = readers.read_catalog(spark, spec["catalog"], "level string, variable string, time_range string, model string, scenario string, month int, date date, href string")
        t = recipe.temporal
        return catalog.execution_plan(found, spec.get("select") or {}, t.get("start"), tuple(t["end"]) if t.get("end") else None)

    def label(self, pixels: DataFrame) -> DataFrame:
        c = F.col
        return pixels.withColumn("z", catalog.z_label(c("level"), c("scenario"), c("model"), c("time_range"), c("month"), c("date"), F.lit(0)))

    def keys(self) -> tuple[str, ...]:
        return ("level", "variable", "z")


def map_source(df: DataFrame, grid: Grid, template: Template, topology: dict, uid: str, strict: bool = False) -> tuple[DataFrame, str]:
    """The mapping of a source's rows, and the name of its weight column ('' for none).

    ``strict``: ValueError if there are no rows or a coordinate is missing; otherwise such rows are left out. Rows
    that share their weight out carry ``source_row``, a number of their own, for checks.
    """
    lower = {c.lower(): c for c in df.columns}
    if "cellcode" in lower or "eeacellcode" in lower:
        code = lower.get("cellcode", lower.get("eeacellcode"))
        from cellweave.operators.cellcodes import parse_box

        boxed = df.withColumn("b_", parse_box(F.col(code))).where("b_ is not null").select("*", "b_.*").drop("b_")
        return points.map_cells(boxed, grid, "minx", "miny", "maxx", "maxy").drop("minx", "miny", "maxx", "maxy"), ""
    u = points.find_column(df, "uncertainty", required=False)
    if strict:
        points.require_points(df, points.find_column(df, "lon"), points.find_column(df, "lat"))
    placed = points.sanitize_points(points.to_grid_crs(df, grid)).withColumn("u", points.uncertainty(df, u))
    placed = placed.withColumnRenamed(uid, "src_uid") if uid != "src_uid" else placed
    kind = topology["kind"] if u else "point"  # without an uncertainty every area is a point
    if kind != "point":
        placed = placed.withColumn("source_row", F.monotonically_increasing_id())
    if kind == "point":
        return points.map_points(placed, template, topology["method"]), ""
    if kind == "point_cloud":
        geographic = grid.epsg == 4326
        found = clouds.map_cloud(placed, template, topology["mode"], topology["method"], topology["passes"], topology["distribution"], topology["seed"], geographic=geographic, portable=False)
        return found, "fraction" if topology["mode"] == "fractional" else ""
    if kind == "polygon":
        if grid.epsg == 4326:
            lon, lat = points.find_column(df, "lon"), points.find_column(df, "lat")
            ringed = boxes.geographic_rings(placed, lon, lat, "u", topology["quad_segs"])
        else:
            ringed = boxes.buffer_rings(placed, quad_segs=topology["quad_segs"])
        return boxes.shatter(ringed, template), "areal_fraction"
    raise ValueError(f"no output type {kind!r}")


def vector_pipeline(spark: SparkSession, spec: dict, recipe: recipes.Recipe, df: DataFrame | None = None) -> dict[str, DataFrame]:
    """Lazy tables of a vector source: raw, or unaggregated, aggregated, dimension and (where asked) drift."""
    maker = SOURCES[spec.get("type", "occurrences")]()
    df = maker.fetch(spark, spec) if df is None else df
    if spec.get("processing_mode") == "raw":
        return {"raw": temporal.cf_datetime(df)}
    grid = maker.grid(spec)
    bounds = recipe.spatial.get("bbox")
    if bounds:
        template = grid.bounds_template(tuple(bounds))
    else:
        template = Template(grid, 0, 0, grid.columns, round((grid.maxy - grid.miny) / grid.resolution))
    mapping, weight = map_source(df, grid, template, recipes.topology(spec), spec.get("uid", "gbifid"), spec.get("strict", False))
    out = {"unaggregated": mapping.where("grid_idx is not null")}
    block = spec.get("aggregate") or recipe.aggregate
    if block and spec.get("processing_mode", "vector") == "vector":
        cube = aggregate.aggregate_cube(mapping, block.get("group_by_columns") or [], block.get("metrics") or []).where("grid_idx is not null")
        out["aggregated"] = temporal.cf_datetime(cube)
    out["dimension_table"] = aggregate.dimension_table(out.get("aggregated", out["unaggregated"]), grid)
    if "x" in mapping.columns and "u" in mapping.columns:
        out["drift"] = quality.drift(out["unaggregated"], grid)
        if weight:
            out["masses"] = quality.source_masses(mapping, weight, template.bounds)
    return out


def check_vectors(spark: SparkSession, tables: dict[str, str], template: Template, path: str) -> dict:
    """Checks over the written tables ``masses`` and ``drift``: all failing sources under ``path``, their counts returned."""
    read = {t: spark.read.parquet(p) for t, p in tables.items() if t in ("masses", "drift")}
    if set(read) != {"masses", "drift"}:
        return {}
    # drift is a matter of whole records: shares of an area lie apart from its centre
    drifted = read["drift"].where(F.lit(False))
    sinks.write_fact(quality.failures(read["masses"], drifted, template.bounds), path)
    return quality.failure_report(spark.read.parquet(path), path)


def raster_pipeline(spark: SparkSession, spec: dict, recipe: recipes.Recipe, pixels: DataFrame) -> DataFrame:
    """Long-form pixels (href, x, y, value) of the planned assets on the master grid.

    x, y are in the grid's CRS, or in degrees with ``pixels_epsg`` 4326.

    Labels travel with the pixels, so an asset that failed leaves no gap that could shift others.
    """
    maker = SOURCES[spec.get("type", "climate")]()
    grid = maker.grid(spec)
    template = grid.bounds_template(tuple(recipe.spatial["bbox"]))
    planned = maker.plan(spark, spec, recipe)
    chosen = maker.label(planned.withColumn("rule", maker.rule(planned)))
    epsg = int(spec.get("pixels_epsg") or grid.epsg)
    own, cells = pixels, template.cells(spark)
    if epsg != grid.epsg:  # aggregating kernels bring pixels to the grid, interpolating ones the grid's cells to the pixels
        pixels = points.to_grid_crs(pixels, grid, "x", "y", epsg)
        cells = raster.centres_in(cells, grid.epsg, epsg)
    rules = {r[0] for r in chosen.select("rule").distinct().collect()}
    labels = chosen.select("href", "rule", *maker.keys())
    placed = pixels.join(labels.where(F.col("rule").isin(*raster.KERNELS)), "href").withColumn("grid_idx", template.nearest(F.col("x"), F.col("y")) if spec.get("snap") else template.intersect(F.col("x"), F.col("y"))).where("grid_idx is not null")
    v = raster.masked(F.col("value"), spec.get("nodata"))
    value = F.coalesce(*[raster.KERNELS[k](F.when(F.col("rule") == k, v)) for k in sorted(rules & set(raster.KERNELS))], F.lit(None).cast("double"))
    out = [placed.groupBy(*maker.keys(), "grid_idx").agg(value.alias("value"))] if rules & set(raster.KERNELS) or not rules else []
    for rule in sorted(rules - set(raster.KERNELS)):  # interpolated at the cells' centres
        ruled = labels.where(F.col("rule") == rule)
        size = grid.resolution if epsg == grid.epsg else grid.resolution / 111320.0
        found = raster.warp(own.join(ruled.select("href").distinct(), "href", "left_semi"), cells, size, rule, nodata=spec.get("nodata"))
        out.append(found.join(ruled, "href").select(*maker.keys(), "grid_idx", "value"))
    return raster.stack(out)


def run(spark: SparkSession, recipe: recipes.Recipe) -> dict:
    """All sources of a recipe written under its base folder; returns the catalog."""
    root = f"{recipe.base_dir}/{recipe.name}"
    paths = [s[k] for s in recipes.enabled(recipe).values() for k in ("path", "catalog", "pixels") if s.get(k) and readers.exists(spark, s[k])]
    sinks.write_json(spark, sinks.provenance(recipe.__dict__, sinks.input_files(spark, paths, recipe.digests)), f"{root}/meta/provenance.json")
    items = []
    for name, spec in recipes.enabled(recipe).items():
        if spec.get("type", name) not in SOURCES:
            raise ValueError(f"no source {spec.get('type', name)!r}; there are {', '.join(SOURCES)}")
        spec = {"type": name} | spec
        if hasattr(SOURCES[spec["type"]], "fetch"):
            tables = vector_pipeline(spark, spec, recipe)
        else:
            tables = {"cube": raster_pipeline(spark, spec, recipe, spark.read.parquet(spec["pixels"]))}
        for table, df in tables.items():
            parts = ["level", "variable"] if table == "cube" else None
            sinks.write_fact(df, f"{root}/{name}/{table}", parts)
        box = recipe.spatial.get("bbox") or [-180.0, -90.0, 180.0, 90.0]
        grid = SOURCES[spec["type"]]().grid(spec)
        written = {t: f"{root}/{name}/{t}" for t in tables}
        told = {"proj:epsg": grid.epsg, "grid": grid.key, "resolution": grid.resolution, "cube:dimensions": sinks.dimensions(grid, list(box), {t: df.columns for t, df in tables.items()}, recipe.temporal)}
        if "masses" in tables:
            failed = check_vectors(spark, written, grid.bounds_template(tuple(box)), f"{root}/{name}/failures")
            sinks.write_json(spark, failed, f"{root}/meta/{recipe.name}_{name}_quality.json")
            told["quality"] = failed
        entry = sinks.item(f"{recipe.name}_{name}", list(box), recipe.temporal.get("start"), str(recipe.temporal.get("end") or "") or None, written, told)
        sinks.write_json(spark, entry, f"{root}/meta/{entry['id']}.json")
        items.append(entry)
    found = sinks.catalog(recipe.name, items)
    sinks.write_json(spark, found, f"{root}/meta/catalog.json")
    return found
