"""Master grids: axis-aligned lattices with one 64-bit id for each cell, as arithmetic on columns.

No mesh is ever built. Rows are numbered from the north-west corner of a grid's extent, ids run east, then
south. Templates (the part of a grid that a query covers) are anchored at the south-west corner; where the
extent is no multiple of the resolution, a cell's id is that of the row in which its centre lies.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.crs import transform_bounds

Bounds = tuple[float, float, float, float]

#: Families as (EPSG, extent, resolutions by name).
FAMILIES = {
    "EEA": (3035, (2000000.0, 1000000.0, 6000000.0, 5500000.0), {"10m": 10.0, "100m": 100.0, "250m": 250.0, "500m": 500.0, "1km": 1000.0, "10km": 10000.0}),
    "Global_EqualArea": (6933, (-17367530.0, -7314540.0, 17367530.0, 7314540.0), {"10m": 10.0, "100m": 100.0, "250m": 250.0, "500m": 500.0, "1km": 1000.0, "10km": 10000.0}),
    "Global_WGS84": (4326, (-180.0, -90.0, 180.0, 90.0), {"0_3sec": 0.3 / 3600, "3sec": 3 / 3600, "7_5sec": 7.5 / 3600, "15sec": 15 / 3600, "30sec": 30 / 3600, "5min": 5 / 60}),
}
DEFAULT = "Global_WGS84_30sec"


@dataclass(frozen=True)
class Grid:
    key: str
    epsg: int
    resolution: float
    minx: float
    miny: float
    maxx: float
    maxy: float

    @property
    def columns(self) -> int:
        return round((self.maxx - self.minx) / self.resolution)

    def template(self, bounds: Bounds) -> Template:
        """The cells that cover ``bounds``: snapped outward on the lattice, one cell at least."""
        r = self.resolution
        c0, k0 = math.floor((bounds[0] - self.minx) / r), math.floor((bounds[1] - self.miny) / r)
        c1, k1 = math.ceil((bounds[2] - self.minx) / r), math.ceil((bounds[3] - self.miny) / r)
        return Template(self, c0, k0, max(c0 + 1, c1), max(k0 + 1, k1))

    def bounds_template(self, lonlat: Bounds, pad: int = 1) -> Template:
        """The template of an area in degrees: its projected bounds and ``pad`` cells more."""
        x0, y0, x1, y1 = transform_bounds(lonlat, 4326, self.epsg)
        p = self.resolution * pad
        return self.template((x0 - p, y0 - p, x1 + p, y1 + p))

    def index(self, x: Column, y: Column) -> Column:
        """The id straight from coordinates, rows counted from the north. For cell centres; unchecked outside the extent."""
        col = F.floor((x - self.minx) / self.resolution).cast("long")
        row = F.floor((F.lit(self.maxy) - y) / self.resolution).cast("long")
        return row * F.lit(self.columns).cast("long") + col

    def id_of(self, col: Column, k: Column) -> Column:
        """The id of a template cell: column from the west, row from the south."""
        top = math.floor((self.maxy - self.miny) / self.resolution - 0.5)
        return (F.lit(top).cast("long") - k) * F.lit(self.columns).cast("long") + col

    def col_of(self, grid_idx: Column) -> Column:
        return F.pmod(grid_idx, F.lit(self.columns).cast("long"))

    def k_of(self, grid_idx: Column) -> Column:
        top = math.floor((self.maxy - self.miny) / self.resolution - 0.5)
        return F.lit(top).cast("long") - F.floor(grid_idx / F.lit(self.columns)).cast("long")

    def box(self, grid_idx: Column) -> dict[str, Column]:
        """minx, miny, maxx, maxy of the cell that points were mapped to (the template's lattice)."""
        x0 = self.col_of(grid_idx) * self.resolution + self.minx
        y0 = self.k_of(grid_idx) * self.resolution + self.miny
        return {"minx": x0, "miny": y0, "maxx": x0 + self.resolution, "maxy": y0 + self.resolution}

    def centre(self, grid_idx: Column) -> tuple[Column, Column]:
        half = self.resolution / 2
        b = self.box(grid_idx)
        return b["minx"] + half, b["miny"] + half


@dataclass(frozen=True)
class Template:
    """Cells c0 <= column < c1 and k0 <= row from the south < k1 of a grid."""

    grid: Grid
    c0: int
    k0: int
    c1: int
    k1: int

    @property
    def bounds(self) -> Bounds:
        g, r = self.grid, self.grid.resolution
        return g.minx + self.c0 * r, g.miny + self.k0 * r, g.minx + self.c1 * r, g.miny + self.k1 * r

    @property
    def width(self) -> int:
        return self.c1 - self.c0

    @property
    def height(self) -> int:
        return self.k1 - self.k0

    def places(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Coordinates in cells from the grid's south-west corner."""
        g = self.grid
        return (x - g.minx) / g.resolution, (y - g.miny) / g.resolution

    def intersect(self, x: Column, y: Column) -> Column:
        """The cell that holds a point; null outside. On a shared border the smaller id: the cell west and north."""
        px, py = self.places(x, y)
        col = F.greatest(F.ceil(px).cast("long") - 1, F.lit(self.c0).cast("long"))
        k = F.least(F.floor(py).cast("long"), F.lit(self.k1 - 1).cast("long"))
        inside = (px >= self.c0) & (px <= self.c1) & (py >= self.k0) & (py <= self.k1)
        return F.when(inside, self.grid.id_of(col, k))

    def nearest(self, x: Column, y: Column) -> Column:
        """The cell whose centre is nearest; points outside go to the border cells. On a border: north-east."""
        px, py = self.places(x, y)
        return self.grid.id_of(self._clamp(F.floor(px), self.c0, self.c1), self._clamp(F.floor(py), self.k0, self.k1))

    def home(self, x: Column, y: Column) -> Column:
        """The home cell: nearest centre of the point moved a millionth of a cell north-east."""
        nudge = self.grid.resolution * 1e-6
        return self.nearest(x + nudge, y + nudge)

    @staticmethod
    def _clamp(v: Column, low: int, high: int) -> Column:
        return F.least(F.greatest(v.cast("long"), F.lit(low).cast("long")), F.lit(high - 1).cast("long"))

    def touched(self, x: Column, y: Column) -> Column:
        """All cells that hold a point, as an array: 2 on a border, 4 on a corner, none outside."""
        px, py = self.places(x, y)
        span = lambda p, low, high: F.sequence(F.greatest(F.ceil(p).cast("long") - 1, F.lit(low).cast("long")), F.least(F.floor(p).cast("long"), F.lit(high - 1).cast("long")))
        inside = (px >= self.c0) & (px <= self.c1) & (py >= self.k0) & (py <= self.k1)
        return F.when(inside, F.flatten(F.transform(span(px, self.c0, self.c1), lambda c: F.transform(span(py, self.k0, self.k1), lambda k: self.grid.id_of(c, k)))))

    def cells_of(self, x: Column, y: Column) -> Column:
        """As ``touched``, with little work for points that are not on a border."""
        px, py = self.places(x, y)
        border = (px == F.floor(px)) | (py == F.floor(py))
        found = self.intersect(x, y)
        return F.when(border, self.touched(x, y)).when(found.isNotNull(), F.array(found))

    def cells(self, spark: SparkSession) -> DataFrame:
        """The mesh, for those who ask for it: (grid_idx, minx, miny, maxx, maxy, x, y), made in parallel."""
        mesh = spark.range(self.width * self.height).select((F.col("id") % self.width + self.c0).alias("c"), (F.floor(F.col("id") / self.width) + self.k0).cast("long").alias("k"))
        mesh = mesh.select(self.grid.id_of(F.col("c"), F.col("k")).alias("grid_idx"))
        x, y = self.grid.centre(F.col("grid_idx"))
        return mesh.select("grid_idx", *[v.alias(n) for n, v in self.grid.box(F.col("grid_idx")).items()], x.alias("x"), y.alias("y"))


def registry() -> dict[str, Grid]:
    return {f"{family}_{name}": Grid(f"{family}_{name}", epsg, r, *extent) for family, (epsg, extent, names) in FAMILIES.items() for name, r in names.items()}


def registry_table(spark: SparkSession) -> DataFrame:
    rows = [(g.key, f"EPSG:{g.epsg}", g.resolution, g.minx, g.miny, g.maxx, g.maxy) for g in registry().values()]
    return spark.createDataFrame(rows, "grid_key string, crs string, resolution double, minx double, miny double, maxx double, maxy double")


def grid(family: str, resolution: str | None = None) -> Grid:
    """By family and resolution, or by a full key. ValueError if there is none."""
    key = family if resolution is None else f"{family}_{resolution}"
    if key not in registry():
        raise ValueError(f"no grid {key!r}; there are {', '.join(registry())}")
    return registry()[key]


def resolve_vector_grid(spec: dict) -> Grid:
    """For occurrence sources: none given means 30 arc-seconds; ``grid`` is a key or a family with ``resolution``."""
    name, res = spec.get("grid"), spec.get("resolution")
    if not name:
        return grid(DEFAULT)
    for key in (name, f"{name}_{res}"):
        if key in registry():
            return grid(key)
    raise KeyError(f"no grid {name!r} at {res!r}")


def resolve_climate_grid(spec: dict) -> Grid:
    """For climate rasters of about 1 km: short family names, and resolutions no finer than the data."""
    name = {"GEA": "Global_EqualArea", "WGS84": "Global_WGS84"}.get(spec.get("grid") or "", spec.get("grid"))
    res = spec.get("resolution")
    if name in registry():
        name, res = name.rsplit("_", 1) if not name.startswith("Global_WGS84") else ("Global_WGS84", name[len("Global_WGS84_") :])
    if name == "Global_WGS84":
        res = {"0_3sec": "15sec", "3sec": "15sec", "7_5sec": "15sec"}.get(res, res)
        return grid(name, res if res in FAMILIES[name][2] else "30sec")
    if name in FAMILIES:
        return grid(name, res if res in ("1km", "10km") else "1km")
    return grid("EEA_1km")


def metres(resolution: str) -> float:
    """'10m' or '1km' in metres; anything else (degrees, years) counts as 999999."""
    text = resolution.strip().lower()
    for unit, scale in (("km", 1000.0), ("m", 1.0)):
        number = text.removesuffix(unit)
        if number != text and number.replace(".", "", 1).isdigit():
            return float(number) * scale
    return 999999.0


def pick_resolution(available: list[str], wanted: str) -> str:
    """``highest`` (finest), ``lowest`` or a name; a name that is not there falls back to the finest."""
    by = sorted(available, key=metres)
    return by[-1] if wanted == "lowest" else wanted if wanted in available else by[0]


def resolve_cover_grid(spec: dict, available: list[str]) -> Grid:
    """For land cover: the dataset's own resolution (``dataset_resolution``) decides, inside the wanted family."""
    family = (spec.get("grid") or "EEA").split("_" if not (spec.get("grid") or "").startswith("Global") else "\0")[0]
    family = family if family in FAMILIES else next((f for f in FAMILIES if (spec.get("grid") or "").startswith(f)), "EEA")
    res = pick_resolution(available, spec.get("dataset_resolution", spec.get("resolution", "highest")))
    return grid(family, res) if res in FAMILIES[family][2] else grid(family, "1km" if family != "Global_WGS84" else "30sec")


def grid_size_metres(grid_type: str, resolution: float) -> float:
    """The size of a cell of a coded reference grid: metres as given, arc-seconds, or halvings of a degree."""
    kind = grid_type.upper()
    if kind in ("EEA", "EUROSTAT"):
        return float(resolution)
    if kind == "DMSG":
        return resolution * 111320.0 / 3600.0
    if kind == "EQDG":
        return 111320.0 / 2**resolution
    raise NotImplementedError(f"no cell size for grid type {grid_type!r}")


def bounds_wkt(b: Bounds) -> str:
    """Counter-clockwise ring from the south-east corner."""
    x0, y0, x1, y1 = b
    return "POLYGON ((" + ", ".join(f"{x:g} {y:g}" for x, y in ((x1, y0), (x1, y1), (x0, y1), (x0, y0), (x1, y0))) + "))"


def box_wkt(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """The same ring as a column."""
    p = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", p(maxx, miny), p(maxx, maxy), p(minx, maxy), p(minx, miny), p(maxx, miny)), F.lit("))"))


def total_bounds(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row: minx, miny, maxx, maxy of all points."""
    return df.agg(F.min(x).alias("minx"), F.min(y).alias("miny"), F.max(x).alias("maxx"), F.max(y).alias("maxy"))


def extent_template(df: DataFrame, g: Grid, x: str = "x", y: str = "y") -> Template:
    """The template of the data's own extent (one small aggregate is run for it)."""
    row = total_bounds(df, x, y).first()
    if row["minx"] is None:
        raise ValueError("no point to take an extent from")
    return g.template(tuple(row))
