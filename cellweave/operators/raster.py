"""Rasters in long form: a row for each pixel, (row, col, value) or (grid_idx, value), beside z columns.

A template's mesh is never filled in: pixels that have no value have no row. Aggregating kernels assign a
source pixel to the target cell that holds its centre: exact when target cells are whole multiples of source
pixels on one lattice, and the centre rule elsewhere. Interpolating kernels look up the neighbours of each
target centre by integer keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.crs import transform_points
from cellweave.runtime import ship

#: Kernels that aggregate the pixels of a target cell. Of equally frequent values ``mode`` takes the smallest.
KERNELS = {
    "average": F.avg, "sum": F.sum, "min": F.min, "max": F.max,
    "med": lambda v: F.percentile(v, 0.5), "q1": lambda v: F.percentile(v, 0.25), "q3": lambda v: F.percentile(v, 0.75),
    "mode": lambda v: F.mode(v, True), "rms": lambda v: F.sqrt(F.avg(v * v)),
}
INTERPOLATING = {"nearestNeighbour": 1, "nearest": 1, "bilinear": 2, "cubic": 4, "cubicSpline": 4, "lanczos": 6}


def masked(value: Column, nodata) -> Column:
    """Null where the value is nodata or not a number."""
    v = value.cast("double")
    return F.when(~F.isnan(v) & (v != float(nodata) if nodata is not None else F.lit(True)), v)


def coarsen(pixels: DataFrame, factor: int, kernel: str, keys: tuple[str, ...] = (), value: str = "value", nodata=None) -> DataFrame:
    """Down-sample by a whole factor: (keys..., row, col, value) with the target's row and col."""
    if kernel not in KERNELS:
        raise ValueError(f"{kernel!r} does not aggregate; kernels: {', '.join(KERNELS)}")
    v = masked(F.col(value), nodata)
    return pixels.groupBy(*keys, F.floor(F.col("row") / factor).cast("long").alias("row"), F.floor(F.col("col") / factor).cast("long").alias("col")).agg(KERNELS[kernel](v).alias(value))


def to_cells(pixels: DataFrame, template, x: str, y: str, kernel: str, keys: tuple[str, ...] = (), value: str = "value", nodata=None) -> DataFrame:
    """Pixels with projected centres onto a master grid: (keys..., grid_idx, value)."""
    v = masked(F.col(value), nodata)
    return pixels.withColumn("grid_idx", template.intersect(F.col(x), F.col(y))).where("grid_idx is not null").groupBy(*keys, "grid_idx").agg(KERNELS[kernel](v).alias(value))


def _weights(kernel: str, t: Column) -> Column:
    """The weight of a neighbour at distance t (in pixels) along one axis."""
    a = F.abs(t)
    if kernel in ("nearestNeighbour", "nearest"):
        return F.lit(1.0)
    if kernel == "bilinear":
        return F.greatest(F.lit(1.0) - a, F.lit(0.0))
    if kernel == "cubic":  # Keys, a = -1/2
        return F.when(a <= 1, a * a * a * 1.5 - a * a * 2.5 + 1.0).when(a < 2, a * a * a * -0.5 + a * a * 2.5 - a * 4.0 + 2.0).otherwise(0.0)
    if kernel == "cubicSpline":  # uniform cubic B-spline
        return F.when(a <= 1, a * a * a * 0.5 - a * a + 2.0 / 3).when(a < 2, F.pow(F.lit(2.0) - a, F.lit(3.0)) / 6.0).otherwise(0.0)
    pi = math.pi
    return F.when(a < 1e-9, 1.0).when(a < 3, F.sin(a * pi) * F.sin(a * (pi / 3)) * 3.0 / (a * a * (pi * pi))).otherwise(0.0)


def interpolate(pixels: DataFrame, targets: DataFrame, kernel: str, value: str = "value") -> DataFrame:
    """Values at ``targets``, rows (id, r, c) at fractional source places (pixel centres are whole numbers).

    Missing neighbours are left out and the weights of the others rescaled; unknown kernels mean bilinear.
    """
    kernel = kernel if kernel in INTERPOLATING else "bilinear"
    n = INTERPOLATING[kernel]
    first = (lambda v: F.floor(v + 0.5)) if n == 1 else (lambda v: F.floor(v) - (n // 2 - 1))
    steps = F.sequence(F.lit(0), F.lit(n - 1))
    t = targets.withColumn("r_", F.explode(steps)).withColumn("c_", F.explode(steps))
    t = t.withColumn("row", (first(F.col("r")) + F.col("r_")).cast("long")).withColumn("col", (first(F.col("c")) + F.col("c_")).cast("long"))
    t = t.withColumn("w", _weights(kernel, F.col("r") - F.col("row")) * _weights(kernel, F.col("c") - F.col("col")))
    met = t.join(pixels.select("row", "col", F.col(value).cast("double").alias("v")).where("v is not null"), ["row", "col"])
    return met.groupBy("id").agg((F.sum(F.col("w") * F.col("v")) / F.nullif(F.sum("w"), F.lit(0.0))).alias(value))


def _axis(pixels: DataFrame, key: str, c: str) -> DataFrame:
    """(key, first, last and step of the pixel centres along one axis); the step is null where there is one only."""
    at = pixels.select(key, F.round(c, 9).alias("at")).distinct()
    gap = F.col("at") - F.lag("at").over(Window.partitionBy(key).orderBy("at"))
    per = at.withColumn("gap", gap).groupBy(key).agg(F.min("at").alias(f"{c}0"), F.max("at").alias(f"{c}1"), F.min(F.when(F.col("gap") > 1e-7, F.col("gap"))).alias("gap"))
    span = F.col(f"{c}1") - F.col(f"{c}0")
    return per.select(key, f"{c}0", f"{c}1", (span / F.round(span / F.col("gap"))).alias(f"{c}d"))


def warp(pixels: DataFrame, cells: DataFrame, resolution: float, kernel: str, key: str = "href", nodata=None) -> DataFrame:
    """Values (key, grid_idx, value) interpolated at the centres of ``cells(grid_idx, x, y)`` inside each asset.

    ``pixels`` (key, x, y, value) lie on a lattice of their own for each key, in the cells' CRS. Where cells are
    larger than pixels the kernel is stretched to them (except nearest); otherwise as ``interpolate``.
    """
    kernel = kernel if kernel in INTERPOLATING else "bilinear"
    n = INTERPOLATING[kernel]
    own = F.lit(float(resolution))
    lattice = _axis(pixels, key, "x").join(_axis(pixels, key, "y"), key).withColumns({"xd": F.coalesce("xd", own), "yd": F.coalesce("yd", own)})
    lattice = lattice.withColumns({"xs": F.greatest(F.lit(1.0), own / F.col("xd")), "ys": F.greatest(F.lit(1.0), own / F.col("yd"))})
    place = lambda c: (F.col(c) - F.col(f"{c}0")) / F.col(f"{c}d")
    inside = lambda c: F.col(c).between(F.col(f"{c}0") - F.col(f"{c}d") / 2, F.col(f"{c}1") + F.col(f"{c}d") / 2)
    t = cells.select("grid_idx", "x", "y").join(F.broadcast(lattice), inside("x") & inside("y")).select(key, "grid_idx", place("y").alias("r"), place("x").alias("c"), "xs", "ys")
    if n == 1:
        near = lambda v, s: F.array(F.floor(F.col(v) + 0.5))
    else:
        near = lambda v, s: F.sequence(F.ceil(F.col(v) - F.col(s) * (n // 2)), F.floor(F.col(v) + F.col(s) * (n // 2)))
    t = t.withColumn("row", F.explode(near("r", "ys"))).withColumn("col", F.explode(near("c", "xs")))
    t = t.withColumn("w", _weights(kernel, (F.col("r") - F.col("row")) / F.col("ys")) * _weights(kernel, (F.col("c") - F.col("col")) / F.col("xs")))
    v = masked(F.col("value"), nodata)
    p = pixels.select(key, "x", "y", v.alias("v")).where("v is not null").join(F.broadcast(lattice), key).select(key, F.round(place("y")).cast("long").alias("row"), F.round(place("x")).cast("long").alias("col"), "v")
    found = t.join(p, [key, "row", "col"]).groupBy(key, "grid_idx").agg((F.sum(F.col("w") * F.col("v")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("value"))
    return found.where("value is not null")


def centres_in(cells: DataFrame, source: int, target: int) -> DataFrame:
    """``cells(grid_idx, x, y)`` with their centres in another CRS."""
    ship(cells.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = transform_points(batch.column(1).to_numpy(), batch.column(2).to_numpy(), source, target)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x), pa.array(y)], names=["grid_idx", "x", "y"])

    return cells.select("grid_idx", "x", "y").mapInArrow(run, "grid_idx long, x double, y double")


def class_fraction(pixels: DataFrame, wanted: int, factor: int, nodata: int, value: str = "value") -> DataFrame:
    """Share of a class among a cell's pixels that have data."""
    flag = F.when(F.col(value) != nodata, (F.col(value) == wanted).cast("double"))
    return pixels.groupBy(F.floor(F.col("row") / factor).cast("long").alias("row"), F.floor(F.col("col") / factor).cast("long").alias("col")).agg(F.avg(flag).alias("fraction"))


def class_fractions(pixels: DataFrame, classes: dict[int, str], factor: int, nodata_like: tuple[int, ...] = (48, 128, 254, 255), value: str = "value") -> DataFrame:
    """Shares of all classes in one pass, a column for each name."""
    has = ~F.col(value).isin(*nodata_like)
    aggs = [F.avg(F.when(has, (F.col(value) == c).cast("double"))).alias(name) for c, name in classes.items()]
    return pixels.groupBy(F.floor(F.col("row") / factor).cast("long").alias("row"), F.floor(F.col("col") / factor).cast("long").alias("col")).agg(*aggs)


def zonal_mean(pixels: DataFrame, zones: DataFrame, on: list[str], by: list[str], values: list[str]) -> DataFrame:
    """Mean of each variable over the pixels of a zone."""
    return pixels.join(zones, on).groupBy(*by).agg(*[F.avg(v).alias(v) for v in values])


def rasterize_add(cells: DataFrame, mesh: DataFrame, value: str, time: str) -> DataFrame:
    """Values added up on a mesh for each time, 0 where a cell of the mesh has none."""
    times = cells.select(time).distinct()
    return mesh.select("grid_idx").crossJoin(times).join(cells.groupBy("grid_idx", time).agg(F.sum(value).alias(value)), ["grid_idx", time], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def check_cell_area(cells: DataFrame, pixel_area: float, tolerance: float = 1.5) -> None:
    """ValueError if cells are typically larger than pixels: they would need sharing out, not adding up."""
    middle = cells.agg(F.median((F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny")))).first()[0]
    if middle is not None and middle > tolerance * pixel_area:
        raise ValueError(f"median cell area {middle:g} is above {tolerance:g} x {pixel_area:g}")


def clip(pixels: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Pixels whose row and column lie in inclusive ranges."""
    return pixels.where(F.col("row").between(*rows) & F.col("col").between(*cols))


def window_of(bounds: tuple[float, float, float, float], left: float, top: float, size: float) -> tuple[tuple[int, int], tuple[int, int]]:
    """Inclusive (rows, cols) of the pixels that a box touches; rows run south from ``top``."""
    x0, y0, x1, y1 = bounds
    return (math.floor((top - y1) / size), math.ceil((top - y0) / size) - 1), (math.floor((x0 - left) / size), math.ceil((x1 - left) / size) - 1)


def integrity(pixels: DataFrame, value: str = "value") -> DataFrame:
    """One row: pixels, pixels with a value, whether the slice is usable."""
    good = F.count_if(masked(F.col(value), None).isNotNull())
    return pixels.agg(F.count("*").alias("pixels"), good.alias("valid"), (good > 0).alias("usable"))


def stack(slices: list[DataFrame]) -> DataFrame:
    """Slices, tiles or layers as one table; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices)


def merge_bands(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Bands side by side; a pixel of either side stays."""
    return left.join(right, on, "full_outer")


def temporal_max(pixels: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """The largest value of each month."""
    return pixels.groupBy(*keys, F.trunc(F.col(time), "month").alias("month")).agg(F.max(value).alias(value))


def gap_fill(series: DataFrame, keys: list[str], t: str, value: str) -> DataFrame:
    """Fill nulls between two values by the straight line over time ``t`` (a number); ends stay null."""
    order = Window.partitionBy(*keys).orderBy(t)
    back, ahead = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(t))
    v0, v1 = F.last(value, True).over(back), F.first(value, True).over(ahead)
    t0, t1 = F.last(at, True).over(back), F.first(at, True).over(ahead)
    wide = series.select("*", v0.alias("v0_"), v1.alias("v1_"), t0.alias("t0_"), t1.alias("t1_"))
    line = F.col("v0_") + (F.col("v1_") - F.col("v0_")) * (F.col(t) - F.col("t0_")) / F.nullif(F.col("t1_") - F.col("t0_"), F.lit(0))
    return wide.withColumn(value, F.coalesce(F.col(value), line)).drop("v0_", "v1_", "t0_", "t1_")
