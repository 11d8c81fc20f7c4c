"""Areas on the lattice: axis-aligned boxes by arithmetic, simple polygons by sums over their edges in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.crs import utm_forward, utm_inverse
from cellweave.operators.grids import Template
from cellweave.runtime import ship

SLIVER = 1e-6


def overlap(low1: Column, high1: Column, low2: Column, high2: Column) -> Column:
    return F.greatest(F.least(high1, high2) - F.greatest(low1, low2), F.lit(0.0))


def shatter_boxes(df: DataFrame, template: Template, minx: str = "minx", miny: str = "miny", maxx: str = "maxx", maxy: str = "maxy") -> DataFrame:
    """A row for each box and template cell that share area: the columns of ``df``, grid_idx and areal_fraction.

    Candidate cells come from the box's own corners, so no join is needed. Boxes without area give no rows.
    """
    g, r = template.grid, template.grid.resolution
    area = (F.col(maxx) - F.col(minx)) * (F.col(maxy) - F.col(miny))
    first = lambda v, o, low, high: F.least(F.greatest(F.floor((v - o) / r).cast("long"), F.lit(low).cast("long")), F.lit(high - 1).cast("long"))
    span = lambda a, b, o, low, high: F.sequence(first(F.col(a), o, low, high), first(F.col(b), o, low, high))
    rows = df.where(area > 0).withColumn("c_", F.explode(span(minx, maxx, g.minx, template.c0, template.c1))).withColumn("k_", F.explode(span(miny, maxy, g.miny, template.k0, template.k1)))
    x0, y0 = F.col("c_") * r + g.minx, F.col("k_") * r + g.miny
    part = overlap(F.col(minx), F.col(maxx), x0, x0 + r) * overlap(F.col(miny), F.col(maxy), y0, y0 + r) / area
    return rows.withColumn("grid_idx", g.id_of(F.col("c_"), F.col("k_"))).withColumn("areal_fraction", part).drop("c_", "k_").where(F.col("areal_fraction") > SLIVER)


def transform_cells(df: DataFrame, template: Template, value: str, kind: str = "continuous", method: str = "intersect", keep: list[str] | None = None, uid: str = "src_uid", minx: str = "minx", miny: str = "miny", maxx: str = "maxx", maxy: str = "maxy") -> DataFrame:
    """A collection of cells (boxes with a value) on another grid: (grid_idx, keep..., value).

    ``continuous`` + ``intersect``: values shared by area. ``discrete`` + ``intersect``: to the cell of largest
    overlap (of equals the smaller id). ``discrete`` + ``kdtree``: to the cell nearest to the box's centre.
    """
    keep = keep or []
    if method == "kdtree":
        if kind == "continuous":
            raise ValueError("continuous values need method intersect")
        found = df.withColumn("grid_idx", template.nearest((F.col(minx) + F.col(maxx)) / 2, (F.col(miny) + F.col(maxy)) / 2))
        return found.groupBy("grid_idx", *keep).agg(F.sum(value).alias(value))
    parts = shatter_boxes(df, template, minx, miny, maxx, maxy)
    if kind == "continuous":
        return parts.groupBy("grid_idx", *keep).agg(F.sum(F.col(value) * F.col("areal_fraction")).alias(value))
    best = parts.withColumn("r_", F.row_number().over(Window.partitionBy(uid).orderBy(F.round("areal_fraction", 9).desc(), "grid_idx"))).where("r_ = 1")
    return best.groupBy("grid_idx", *keep).agg(F.sum(value).alias(value))


def buffer_rings(df: DataFrame, x: str = "x", y: str = "y", u: str = "u", quad_segs: int = 8) -> DataFrame:
    """Add ``ring``: a polygon of 4 x quad_segs corners around each point, in the points' own units."""
    n = 4 * quad_segs
    radius = F.greatest(F.coalesce(F.col(u).cast("double"), F.lit(0.0)), F.lit(0.0))
    corner = lambda i: F.struct((F.col(x) + radius * F.cos(i * (2 * math.pi / n))).alias("x"), (F.col(y) + radius * F.sin(i * (2 * math.pi / n))).alias("y"))
    return df.withColumn("ring", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), corner))


RING = "array<struct<x:double,y:double>>"


def geographic_rings(df: DataFrame, lon: str, lat: str, u: str, quad_segs: int = 8) -> DataFrame:
    """Add ``ring`` in degrees: the buffer is drawn in each point's own UTM zone. Null beyond the zones' latitudes."""
    ship(df.sparkSession)
    n = 4 * quad_segs
    angle = np.arange(n) * (2 * math.pi / n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {f: batch.column(batch.schema.get_field_index(f)).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in (lon, lat, u)}
            ok = np.isfinite(at[lon]) & (at[lat] < 84) & (at[lat] >= -80)
            x0, y0 = np.where(ok, at[lon], 0), np.where(ok, at[lat], 0)
            radius = np.maximum(np.nan_to_num(at[u]), 0)
            zone, south = np.clip(np.floor((x0 + 180) / 6) + 1, 1, 60), y0 < 0
            e, m = utm_forward(x0, y0, zone, south)
            rx, ry = utm_inverse(e[:, None] + radius[:, None] * np.cos(angle), m[:, None] + radius[:, None] * np.sin(angle), zone[:, None], south[:, None])
            points = pa.StructArray.from_arrays([pa.array(rx.ravel()), pa.array(ry.ravel())], names=["x", "y"])
            offsets = pa.array([None if not o else i * n for i, o in enumerate(ok)] + [len(ok) * n], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, points)], names=[*batch.schema.names, "ring"])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), f"ring {RING}"]))


def shoelace(ring: Column) -> Column:
    """The signed area of a ring column."""
    n = F.size(ring)
    turn = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(ring, i + 1)["x"] * F.element_at(ring, F.pmod(i + 1, n) + 1)["y"] - F.element_at(ring, F.pmod(i + 1, n) + 1)["x"] * F.element_at(ring, i + 1)["y"])
    return F.aggregate(turn, F.lit(0.0), lambda a, b: a + b) / 2.0


def ring_area(px: np.ndarray, py: np.ndarray) -> float:
    return 0.5 * float(np.dot(px, np.roll(py, -1)) - np.dot(py, np.roll(px, -1))) if len(px) > 2 else 0.0


def corner_areas(px: np.ndarray, py: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Area (signed by the ring's direction) of a simple polygon west of each x and south of each y: (ys, xs).

    Green's theorem: each edge, as far as it lies west of x, adds the area between it, cut at y, and the axis.
    """
    nx, ny = np.roll(px, -1), np.roll(py, -1)
    out = np.zeros((len(ys), len(xs)))
    slope = np.where(nx != px, (ny - py) / np.where(nx != px, nx - px, 1), 0)
    for at in range(0, len(px), 4096):  # edges of very long rings in parts
        x0, y0, x1, k = (v[at : at + 4096, None] for v in (px, py, nx, slope))
        a, b = np.minimum(x0, xs), np.minimum(x1, xs)
        ya, yb = (y0 + (a - x0) * k)[:, None, :], (y0 + (b - x0) * k)[:, None, :]
        cut = ys[None, :, None]
        low, high = np.minimum(ya, yb), np.maximum(ya, yb)
        share = np.clip((cut - low) / np.where(high > low, high - low, 1), 0, 1)  # of the edge, below the cut
        mean = np.where(high <= cut, (low + high) / 2, np.where(low >= cut, cut, share * (low + cut) / 2 + (1 - share) * cut))
        out -= ((b - a)[:, None, :] * mean).sum(axis=0)
    return out


def ring_cells(px: np.ndarray, py: np.ndarray, template: Template) -> list[tuple[int, int, float]]:
    """(column, row from the south, area) of each template cell that a ring shares area with."""
    g, r = template.grid, template.grid.resolution
    place = lambda v, o, low, high: min(max(math.floor((v - o) / r), low), high - 1)
    c0, c1 = (place(v, g.minx, template.c0, template.c1) for v in (px.min(), px.max()))
    k0, k1 = (place(v, g.miny, template.k0, template.k1) for v in (py.min(), py.max()))
    ox, oy = g.minx + c0 * r, g.miny + k0 * r  # near the ring, for precision
    xs = np.arange(c1 - c0 + 2) * r
    out = []
    for lo in range(k0, k1 + 1, 64):
        hi = min(lo + 63, k1)
        sums = corner_areas(px - ox, py - oy, xs, (np.arange(lo, hi + 2) - k0) * r)
        cells = np.abs(np.diff(np.diff(sums, axis=0), axis=1))
        for i, j in zip(*np.nonzero(cells > 0)):
            out.append((c0 + int(j), lo + int(i), float(cells[i, j])))
    return out


def _sums(px: np.ndarray, py: np.ndarray, nx: np.ndarray, ny: np.ndarray, first: np.ndarray, sizes: np.ndarray, xs: np.ndarray, ys: np.ndarray, corner_first: np.ndarray, corners: np.ndarray) -> np.ndarray:
    """``corner_areas`` of many rings at once, each at corners of its own (flat): every edge with every corner of its ring."""
    n = sizes * corners
    ring = np.repeat(np.arange(len(sizes)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    e, c = first[ring] + k // corners[ring], corner_first[ring] + k % corners[ring]
    x0, y0, x1 = px[e], py[e], nx[e]
    run = x1 - x0
    slope = np.where(run != 0, (ny[e] - y0) / np.where(run != 0, run, 1), 0)
    x, y = xs[c], ys[c]
    a, b = np.minimum(x0, x), np.minimum(x1, x)
    ya, yb = y0 + (a - x0) * slope, y0 + (b - x0) * slope
    low, high = np.minimum(ya, yb), np.maximum(ya, yb)
    share = np.clip((y - low) / np.where(high > low, high - low, 1), 0, 1)  # of the edge, below the cut
    mean = np.where(high <= y, (low + high) / 2, np.where(low >= y, y, share * (low + y) / 2 + (1 - share) * y))
    return -np.bincount(c, (b - a) * mean, minlength=len(xs))


#: Edges times corners that are worked through at once; a ring with more goes through ``ring_cells`` by itself.
AT_ONCE = 2_000_000


def cut_rings(px: np.ndarray, py: np.ndarray, offsets: np.ndarray, template: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rings (corners from ``offsets[i]`` to ``offsets[i + 1]``) as (ring, grid_idx, areal_fraction, centroid's cell)."""
    g, r = template.grid, template.grid.resolution
    top = math.floor((g.maxy - g.miny) / r - 0.5)
    sizes = np.diff(offsets)
    good = np.flatnonzero(sizes > 2)
    out: list[tuple] = []
    if not len(good):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64, np.int64))
    first, sizes = offsets[:-1][good], sizes[good]
    pick = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
    px, py, first = px[pick], py[pick], np.cumsum(sizes) - sizes
    follow = np.arange(len(px)) + 1
    follow[first + sizes - 1] = first
    # sums over far-off coordinates would lose digits: relative to the south-west corner of the ring's first cell
    span = lambda v, how: how.reduceat(v, first)
    place = lambda v, o, low, high: np.minimum(np.maximum(np.floor((v - o) / r), low), high - 1).astype(np.int64)
    c0, c1 = place(span(px, np.minimum), g.minx, template.c0, template.c1), place(span(px, np.maximum), g.minx, template.c0, template.c1)
    k0, k1 = place(span(py, np.minimum), g.miny, template.k0, template.k1), place(span(py, np.maximum), g.miny, template.k0, template.k1)
    ox, oy = g.minx + c0 * r, g.miny + k0 * r
    lx, ly = px - np.repeat(ox, sizes), py - np.repeat(oy, sizes)
    nx, ny = lx[follow], ly[follow]
    cross = lx * ny - nx * ly
    whole = np.add.reduceat(cross, first) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        cx, cy = (np.add.reduceat((v + w) * cross, first) / (6 * whole) for v, w in ((lx, nx), (ly, ny)))
    area_of = np.abs(whole)
    usable = np.isfinite(whole) & (whole != 0)
    nudge = r * 1e-6
    home_c = place(np.where(usable, ox + cx + nudge, g.minx), g.minx, template.c0, template.c1)
    home_k = place(np.where(usable, oy + cy + nudge, g.miny), g.miny, template.k0, template.k1)
    home = (top - home_k) * g.columns + home_c
    wide, high = c1 - c0 + 2, k1 - k0 + 2  # corners along both axes
    work = sizes * wide * high
    small = np.flatnonzero(usable & (work <= AT_ONCE))
    edges = np.searchsorted(np.cumsum(work[small]), np.arange(0, int(work[small].sum()) + AT_ONCE, AT_ONCE), side="right")
    for lo, hi in zip(edges[:-1], edges[1:]):
        some = small[lo:hi]
        if not len(some):
            continue
        m = wide[some] * high[some]
        at = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        column, row = at % np.repeat(wide[some], m), at // np.repeat(wide[some], m)
        mine = np.cumsum(m) - m
        sums = _sums(lx, ly, nx, ny, first[some], sizes[some], column * r, row * r, mine, m)
        # a cell's area from its four corners
        w = np.repeat(wide[some], m)
        inner = np.flatnonzero((column < w - 1) & (row < np.repeat(high[some], m) - 1))
        step = w[inner]
        area = np.abs(sums[inner + step + 1] - sums[inner + step] - sums[inner + 1] + sums[inner])
        ring = np.repeat(some, m)[inner]
        out.append((ring, (top - k0[ring] - row[inner]) * g.columns + c0[ring] + column[inner], area / area_of[ring]))
    for i in np.flatnonzero(usable & (work > AT_ONCE)):
        part = slice(first[i], first[i] + sizes[i])
        cells = np.array(ring_cells(px[part], py[part], template)).reshape(-1, 3)
        out.append((np.full(len(cells), i), ((top - cells[:, 1]) * g.columns + cells[:, 0]).astype(np.int64), cells[:, 2] / area_of[i]))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64, np.int64))
    ring, cell, share = (np.concatenate([o[i] for o in out]) for i in range(3))
    keep = share > SLIVER
    ring, cell, share = ring[keep], cell[keep], share[keep]
    order = np.argsort(ring, kind="stable")
    return good[ring[order]], cell[order], share[order], home[ring[order]]


def shatter(df: DataFrame, template: Template, ring: str = "ring") -> DataFrame:
    """The columns of ``df`` but ``ring``, with grid_idx, areal_fraction and centroid_grid_idx: a row for each cell of a ring.

    Rings are in the grid's CRS, whatever their corners' order. A ring that is null, has under 3 corners or no area,
    or meets no cell, gives one row with nulls. Columns travel along: rows need no identity, nothing is joined.
    """
    ship(df.sparkSession)
    others = [c for c in df.columns if c not in (ring, "grid_idx", "areal_fraction", "centroid_grid_idx")]
    source = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(others)], F.col(ring).alias("ring"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = batch.column(len(others))
            flat = rings.flatten().flatten()
            px, py = (f.to_numpy(zero_copy_only=False) for f in flat)
            offsets = np.concatenate([[0], np.cumsum(np.nan_to_num(np.asarray(rings.value_lengths().to_numpy(zero_copy_only=False), float)))]).astype(np.int64)
            row, cell, share, home = cut_rings(px, py, offsets, template)
            lone = np.setdiff1d(np.arange(batch.num_rows), row)
            pick, none = pa.array(np.concatenate([row, lone])), len(lone)
            add = lambda v, t: pa.concat_arrays([pa.array(v, t), pa.nulls(none, t)])
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pick) for i in range(len(others))), add(cell, pa.int64()), add(share, pa.float64()), add(home, pa.int64())], names=[*(f"k{i}" for i in range(len(others))), "cell", "share", "home"])

    made = source.mapInArrow(run, ", ".join([*(f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(others))), "cell long, share double, home long"]))
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(others)], F.col("cell").alias("grid_idx"), F.col("share").alias("areal_fraction"), F.col("home").alias("centroid_grid_idx"))


def shatter_rings(df: DataFrame, template: Template, uid: str = "src_uid", ring: str = "ring", centroid: bool = True) -> DataFrame:
    """(src_uid, grid_idx, areal_fraction, centroid_grid_idx) of rings in the grid's CRS; rings without a cell give no rows."""
    made = shatter(df.select(F.col(uid).alias("src_uid"), F.col(ring).alias("ring")), template).where("grid_idx is not null")
    return made if centroid else made.drop("centroid_grid_idx")


def in_ring(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Whether points lie in a polygon given as literals: crossings of a ray to the east."""
    odd = F.lit(False)
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if y0 != y1:
            crosses = ((F.lit(y0) > y) != (F.lit(y1) > y)) & (x < (y - y0) * ((x1 - x0) / (y1 - y0)) + x0)
            odd = odd != crosses
    return odd
