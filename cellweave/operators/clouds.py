"""Uncertain points as clouds: draws around a point, counted by cell.

``map_cloud`` draws and counts inside each row: no draw is ever a row, nothing is shuffled or joined, and rows need
no identity of their own (ids may be null or repeated). ``cloud`` gives the draws as rows for those who want them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.crs import degrees_east, degrees_north, wrap_longitude
from cellweave.functions.rng import fast_uniform, normal_pair, uniform
from cellweave.operators.grids import Template


def check_cloud(passes: int, distribution: str) -> None:
    if passes < 1:
        raise ValueError("a cloud needs a pass")
    if distribution not in ("uniform", "gaussian"):
        raise ValueError(f"distribution {distribution!r} is neither uniform nor gaussian")


def cloud(df: DataFrame, passes: int = 30, distribution: str = "uniform", seed: int = 42, *, uid: str = "src_uid", x: str = "x", y: str = "y", u: str = "u", geographic: bool = False, portable: bool = True) -> DataFrame:
    """A row for each draw: (src_uid, pass, x, y, weight_per_point).

    ``uniform``: evenly over the disc of radius u. ``gaussian``: u is three standard deviations on each axis.
    Null u counts as 0, negative u too. ``portable`` draws by md5, else by xxhash64.
    """
    check_cloud(passes, distribution)
    draw = uniform if portable else fast_uniform
    rows = df.select(F.col(uid).alias("src_uid"), F.col(x).alias("x0"), F.col(y).alias("y0"), F.greatest(F.coalesce(F.col(u).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("u0"))
    rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    a, b = draw(seed, "src_uid", "pass", F.lit("a")), draw(seed, "src_uid", "pass", F.lit("b"))
    if distribution == "uniform":
        rows = rows.withColumns({"r": F.col("u0") * F.sqrt(a), "t": b * (2 * math.pi)})
        dx, dy = F.col("r") * F.cos("t"), F.col("r") * F.sin("t")
    else:
        nx, ny = normal_pair(a, b)
        dx, dy = nx * F.col("u0") / 3.0, ny * F.col("u0") / 3.0
    if geographic:
        return rows.select("src_uid", "pass", wrap_longitude(F.col("x0") + degrees_east(dx, F.col("y0"))).alias("x"), (F.col("y0") + degrees_north(dy)).alias("y"), F.lit(1.0 / passes).alias("weight_per_point"))
    return rows.select("src_uid", "pass", (F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"), F.lit(1.0 / passes).alias("weight_per_point"))


def cell_counts(points: DataFrame, template: Template) -> DataFrame:
    """(src_uid, grid_idx, n): draws in each cell; a draw on a border counts in every cell that it touches."""
    return points.select("src_uid", F.explode(template.touched(F.col("x"), F.col("y"))).alias("grid_idx")).groupBy("src_uid", "grid_idx").agg(F.count("*").alias("n"))


def fractional(points: DataFrame, template: Template, passes: int) -> DataFrame:
    """(src_uid, grid_idx, fraction): draws in a cell, of all draws; what falls outside is missing from the sum."""
    return cell_counts(points, template).select("src_uid", "grid_idx", (F.col("n") / F.lit(float(passes))).alias("fraction"))


def classify(points: DataFrame, template: Template, sources: DataFrame) -> DataFrame:
    """(src_uid, grid_idx): the cell with most draws, of equals the smaller id; null if none is inside."""
    counts = cell_counts(points, template)
    best = counts.groupBy("src_uid").agg(F.max(F.struct("n", (-F.col("grid_idx")).alias("neg"))).alias("m")).select("src_uid", (-F.col("m.neg")).alias("grid_idx"))
    return sources.select("src_uid").join(best, "src_uid", "left")


def classify_centroid(points: DataFrame, template: Template) -> DataFrame:
    """(src_uid, grid_idx): the cell nearest to the cloud's centre of mass."""
    return points.groupBy("src_uid").agg(F.avg("x").alias("x"), F.avg("y").alias("y")).select("src_uid", template.home(F.col("x"), F.col("y")).alias("grid_idx"))


MODES = {"fractional": "fractional", "classify": "classify", "classification": "classify"}


def drawn(passes: int, distribution: str, seed: int, uid: str, x: str, y: str, u: str, geographic: bool, portable: bool) -> Column:
    """The draws of ``cloud`` as an array of (x, y) in their point's row. A null id draws by its place."""
    draw = uniform if portable else fast_uniform
    place_ = F.concat_ws(",", F.col(x).cast("string"), F.col(y).cast("string"))
    key = F.coalesce(F.col(uid).cast("string"), place_) if portable else F.when(F.col(uid).isNotNull(), F.xxhash64(uid)).otherwise(F.xxhash64(place_))
    radius = F.greatest(F.coalesce(F.col(u).cast("double"), F.lit(0.0)), F.lit(0.0))
    pairs = F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), lambda p: F.struct(draw(seed, key, p, F.lit("a")).alias("a"), draw(seed, key, p, F.lit("b")).alias("b")))
    if distribution == "uniform":
        polar = F.transform(pairs, lambda d: F.struct((radius * F.sqrt(d["a"])).alias("r"), (d["b"] * (2 * math.pi)).alias("t")))
    else:
        polar = F.transform(pairs, lambda d: F.struct((F.sqrt(F.log(d["a"]) * -2.0) * radius / 3.0).alias("r"), (d["b"] * (2 * math.pi)).alias("t")))

    def place(d: Column) -> Column:
        dx, dy = d["r"] * F.cos(d["t"]), d["r"] * F.sin(d["t"])
        if geographic:
            return F.struct(wrap_longitude(F.col(x) + degrees_east(dx, F.col(y))).alias("x"), (F.col(y) + degrees_north(dy)).alias("y"))
        return F.struct((F.col(x) + dx).alias("x"), (F.col(y) + dy).alias("y"))

    return F.transform(polar, place)


def map_cloud(df: DataFrame, template: Template, mode: str = "fractional", method: str = "intersect", passes: int = 30, distribution: str = "uniform", seed: int = 42, *, uid: str = "src_uid", x: str = "x", y: str = "y", u: str = "u", geographic: bool = False, portable: bool = True) -> DataFrame:
    """The columns of ``df`` with the mapping: fractional (a row for each cell, with ``fraction`` and ``src_grid_idx``,
    the point's own cell) or classified. A row whose draws all fall outside stays, with a null ``grid_idx``."""
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {', '.join(MODES)}")
    check_cloud(passes, distribution)
    rows = df.withColumn("draws_", drawn(passes, distribution, seed, uid, x, y, u, geographic, portable))
    if MODES[mode] == "classify" and method == "kdtree":
        mean = lambda c: F.aggregate(F.col("draws_"), F.lit(0.0), lambda sum_, d: sum_ + d[c]) / float(passes)
        return rows.withColumn("mean_", F.struct(mean("x").alias("x"), mean("y").alias("y"))).withColumn("grid_idx", template.home(F.col("mean_.x"), F.col("mean_.y"))).drop("draws_", "mean_")
    inside = lambda d: F.coalesce(template.cells_of(d["x"], d["y"]), F.array().cast("array<long>"))
    rows = rows.withColumn("cells_", F.flatten(F.transform("draws_", inside))).drop("draws_")
    rows = rows.withColumn("counts_", F.transform(F.array_distinct("cells_"), lambda c: F.struct(F.size(F.filter("cells_", lambda e: e == c)).alias("n"), (-c).alias("neg")))).drop("cells_")
    if MODES[mode] == "classify":  # of equally frequent cells the smaller id
        return rows.withColumn("grid_idx", -F.array_max("counts_")["neg"]).drop("counts_")
    home = rows.withColumn("src_grid_idx", template.intersect(F.col(x), F.col(y)))
    return home.withColumn("one_", F.explode_outer("counts_")).withColumns({"grid_idx": -F.col("one_.neg"), "fraction": F.col("one_.n") / F.lit(float(passes))}).drop("counts_", "one_")


def first_per_source(mapping: DataFrame, order: list[Column], uid: str = "src_uid") -> DataFrame:
    """One row of each source, the first in ``order``."""
    return mapping.withColumn("r_", F.row_number().over(Window.partitionBy(uid).orderBy(*order))).where("r_ = 1").drop("r_")
