"""Writers: the star schema, reports, catalog items, provenance."""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import platform
import subprocess
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_fact(df: DataFrame, path: str, partition_by: list[str] | None = None, cell: str = "grid_idx") -> None:
    """Parquet sorted by cell inside files, so that row groups can be skipped by cell."""
    out = df.sortWithinPartitions(cell) if cell in df.columns else df
    writer = out.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    """A document to any file system that Spark can write."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, default=str).encode()))
    finally:
        out.close()


def item(name: str, bbox: list[float], start: str | None, end: str | None, assets: dict[str, str], properties: dict | None = None) -> dict:
    """A STAC item."""
    x0, y0, x1, y1 = bbox
    times = {"datetime": None, "start_datetime": start, "end_datetime": end} if start else {"datetime": datetime.now(timezone.utc).isoformat()}
    return {
        "type": "Feature", "stac_version": "1.0.0", "id": name, "bbox": bbox, "properties": times | (properties or {}), "links": [],
        "geometry": {"type": "Polygon", "coordinates": [[[x1, y0], [x1, y1], [x0, y1], [x0, y0], [x1, y0]]]},
        "assets": {k: {"href": v, "type": "application/x-parquet"} for k, v in assets.items()},
    }


def catalog(name: str, items: list[dict]) -> dict:
    """A STAC catalog over items."""
    return {"type": "Catalog", "stac_version": "1.0.0", "id": name, "description": name, "links": [{"rel": "item", "href": f"./{i['id']}.json"} for i in items]}


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256, size) of input files."""
    return spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def input_files(spark: SparkSession, paths: list[str], digests: bool = False) -> list[dict]:
    """Path, size and time of every input file, as listed; with ``digests`` their SHA-256 too, which reads them."""
    if not paths:
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", F.col("length").alias("size"), F.col("modificationTime").cast("string").alias("modified"), *([F.sha2("content", 256).alias("sha256")] if digests else []))
    return [r.asDict() for r in files.orderBy("path").collect()]  # a row for each input file


def dimensions(grid, bbox: list[float], columns: dict[str, list[str]], times: dict) -> dict:
    """The cube's dimensions as STAC's datacube extension names them: space, time, and further columns of its tables."""
    x0, y0, x1, y1 = grid.bounds_template(tuple(bbox)).bounds
    space = lambda axis, low, high: {"type": "spatial", "axis": axis, "extent": [low, high], "step": grid.resolution, "reference_system": grid.epsg}
    more = sorted({c for names in columns.values() for c in names if c in ("level", "variable", "z", "aggregation", "layer_class", "year", "month", "specieskey")})
    return {"x": space("x", x0, x1), "y": space("y", y0, y1), "t": {"type": "temporal", "extent": [times.get("start"), str(times.get("end") or "") or None]}} | {c: {"type": "ordinal" if c in ("year", "month") else "nominal"} for c in more}


def provenance(recipe: dict, inputs: list[dict] | None = None) -> dict:
    """What a run was made with: recipe and its digest, platform, packages, revision of the working directory."""
    def git(*args: str) -> str | None:
        try:
            return subprocess.run(["git", *args], capture_output=True, text=True, timeout=10, check=True).stdout.strip()
        except (OSError, subprocess.SubprocessError):
            return None

    text = json.dumps(recipe, sort_keys=True, default=str)
    packages = {}
    for p in ("pyspark", "pyarrow", "numpy", "pandas"):
        try:
            packages[p] = importlib.metadata.version(p)
        except importlib.metadata.PackageNotFoundError:
            continue
    return {"created": datetime.now(timezone.utc).isoformat(), "recipe": recipe, "recipe_sha256": hashlib.sha256(text.encode()).hexdigest(), "python": platform.python_version(), "system": platform.platform(), "packages": packages, "revision": git("rev-parse", "HEAD"), "dirty": bool(git("status", "--porcelain")), "inputs": inputs or []}
