"""Validation of mappings and layers, as counts and flags over columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.boxes import overlap
from cellweave.operators.grids import Bounds

RTOL = 1e-5


def close(a: Column, b: Column | float, atol: float) -> Column:
    """|a - b| <= atol + 1e-5 |b|."""
    other = b if isinstance(b, Column) else F.lit(float(b))
    return F.abs(a - other) <= F.abs(other) * RTOL + atol


def border_distance(x: Column, y: Column, b: Bounds) -> Column:
    """Distance to the edge of a rectangle, from inside or outside."""
    dx = F.greatest(F.lit(b[0]) - x, x - b[2], F.lit(0.0))
    dy = F.greatest(F.lit(b[1]) - y, y - b[3], F.lit(0.0))
    inner = F.least(x - b[0], F.lit(b[2]) - x, y - b[1], F.lit(b[3]) - y)
    return F.when(inner >= 0, inner).otherwise(F.sqrt(dx * dx + dy * dy))


def zone(x: Column, y: Column, u: Column, b: Bounds, default: float = 1000.0) -> Column:
    """Interior (inside, farther from the edge than the uncertainty), Boundary (nearer), Exterior. In the grid's CRS."""
    r, d = F.coalesce(u.cast("double"), F.lit(default)), border_distance(x, y, b)
    inside = x.between(b[0], b[2]) & y.between(b[1], b[3])
    return F.when(inside & (d > r), "Interior").when(d <= r, "Boundary").otherwise("Exterior")


def masses(sources: DataFrame, mapping: DataFrame, weight: str, uid: str = "src_uid") -> DataFrame:
    """Each source with the weight it has in the mapping; 0 if it has none."""
    out = mapping.where("grid_idx is not null").groupBy(uid).agg(F.sum(weight).alias("mass"))
    return sources.join(out, uid, "left").withColumn("mass", F.coalesce("mass", F.lit(0.0)))


def interior_failures(with_mass: DataFrame, atol: float = 0.01) -> DataFrame:
    """Interior sources whose weight is not 1."""
    return with_mass.where((F.col("zone") == "Interior") & ~close(F.col("mass"), 1.0, atol))


def boundary_failures(with_mass: DataFrame, b: Bounds, x: str = "x", y: str = "y", u: str = "u", atol: float = 0.02, default: float = 1000.0) -> DataFrame:
    """Boundary sources whose weight is not the share of their square neighbourhood inside the bounds."""
    r = F.coalesce(F.col(u).cast("double"), F.lit(default))
    share = overlap(F.col(x) - r, F.col(x) + r, F.lit(b[0]), F.lit(b[2])) * overlap(F.col(y) - r, F.col(y) + r, F.lit(b[1]), F.lit(b[3])) / F.nullif(r * r * 4.0, F.lit(0.0))
    return with_mass.where(F.col("zone") == "Boundary").withColumn("expected", F.coalesce(share, F.lit(1.0))).where(~close(F.col("mass"), F.col("expected"), atol))


def drift(mapped: DataFrame, grid, x: str = "x", y: str = "y", u: str = "u", default: float = 1000.0) -> DataFrame:
    """Rows with the distance to their cell's centre, and whether it stays within uncertainty and a cell's diagonal."""
    cx, cy = grid.centre(F.col("grid_idx"))
    d = F.sqrt((F.col(x) - cx) * (F.col(x) - cx) + (F.col(y) - cy) * (F.col(y) - cy))
    allowed = F.coalesce(F.col(u).cast("double"), F.lit(default)) + math.sqrt(2) * grid.resolution
    return mapped.withColumn("drift", d).withColumn("drift_ok", F.coalesce(d <= allowed, F.lit(True)))


FAILURES = ("interior_mass_failures", "boundary_mass_failures", "drift_failures")


def failures(with_mass: DataFrame, drifted: DataFrame, b: Bounds, uid: str = "src_uid") -> DataFrame:
    """(kind, uid): every failing source of each kind of ``FAILURES``."""
    found = (interior_failures(with_mass), boundary_failures(with_mass, b), drifted.where("not drift_ok"))
    parts = [df.select(F.lit(kind).alias("kind"), F.col(uid)).distinct() for kind, df in zip(FAILURES, found)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def failure_report(failed: DataFrame, table: str | None = None) -> dict:
    """Counts of each kind for a JSON report, beside a pointer to the table that lists them all."""
    counts = {r["kind"]: r["n"] for r in failed.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    return {kind: counts.get(kind, 0) for kind in FAILURES} | {"table": table}


def source_masses(mapping: DataFrame, weight: str, b: Bounds, row: str = "source_row", uid: str = "src_uid") -> DataFrame:
    """One row for each source row of a mapping that carries ``row``: uid, x, y, u, mass, zone. No join: the mapping has them all."""
    share = F.when(F.col("grid_idx").isNotNull(), F.col(weight))
    per = mapping.groupBy(row).agg(*[F.first(c).alias(c) for c in (uid, "x", "y", "u")], F.coalesce(F.sum(share), F.lit(0.0)).alias("mass"))
    return per.withColumn("zone", zone(F.col("x"), F.col("y"), F.col("u"), b))


def layer_checks(layers: DataFrame, tol: float = 1e-6) -> DataFrame:
    """One row of violation counts over layers (grid_idx, min, avg, rms, max, and class shares f_*)."""
    shares = [c for c in layers.columns if c.startswith("f_")]
    values = [F.col(c) for c in shares]
    total = sum(values[1:], values[0]) if values else F.lit(0.0)
    below = [F.count_if(v < -tol) for v in values] or [F.lit(0)]
    above = [F.count_if(v > 1 + tol) for v in values] or [F.lit(0)]
    return layers.agg(
        sum(below[1:], below[0]).alias("below_zero"), sum(above[1:], above[0]).alias("above_one"), F.count_if(total > 1 + tol).alias("sum_above_one"),
        F.count_if(F.col("min") > F.col("avg") + tol).alias("min_above_avg"), F.count_if(F.col("avg") > F.col("rms") + tol).alias("avg_above_rms"), F.count_if(F.col("rms") > F.col("max") + tol).alias("rms_above_max"),
    )
