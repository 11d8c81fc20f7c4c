"""Points: validation, cleaning, projection and mapping to cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.crs import add_projected
from cellweave.operators.grids import Grid, Template

#: Names under which coordinates and uncertainty are looked for, in lower case.
ALIASES = {"lon": ("decimallongitude", "longitude", "lon", "long", "x"), "lat": ("decimallatitude", "latitude", "lat", "y"), "uncertainty": ("coordinateuncertaintyinmeters", "uncertainty")}


def find_column(df: DataFrame, what: str, required: bool = True) -> str | None:
    """The column that holds ``lon``, ``lat`` or ``uncertainty``, whatever its case."""
    lower = {c.lower(): c for c in df.columns}
    for alias in ALIASES[what]:
        if alias in lower:
            return lower[alias]
    if required:
        raise ValueError(f"no {what} column; looked for {', '.join(ALIASES[what])}")
    return None


def check_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: rows, rows without a coordinate, rows that are not finite."""
    bad = F.col(x).isNull() | F.col(y).isNull()
    odd = ~bad & (F.isnan(F.col(x).cast("double")) | F.isnan(F.col(y).cast("double")))
    return df.agg(F.count("*").alias("n"), F.count_if(bad).alias("missing"), F.count_if(odd).alias("not_a_number"))


def require_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """The frame itself; ValueError if it is empty or a coordinate is missing."""
    row = check_points(df, x, y).first()
    if not row["n"]:
        raise ValueError("no rows")
    if row["missing"] or row["not_a_number"]:
        raise ValueError(f"{row['missing'] + row['not_a_number']} rows lack a coordinate")
    return df


def sanitize_points(df: DataFrame, x: str = "x", y: str = "y", deduplicate: bool = False) -> DataFrame:
    """Rows with finite coordinates; one row for each place if ``deduplicate``."""
    good = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y) & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf")))
    return good.dropDuplicates([x, y]) if deduplicate else good


def to_grid_crs(df: DataFrame, grid: Grid, lon: str | None = None, lat: str | None = None, source_epsg: int | None = 4326) -> DataFrame:
    """Add x, y in the grid's CRS. ValueError if the source has no CRS; nothing is computed if it is the grid's."""
    if source_epsg is None:
        raise ValueError("the points have no CRS")
    lon, lat = lon or find_column(df, "lon"), lat or find_column(df, "lat")
    if source_epsg == grid.epsg:
        return df.withColumns({"x": F.col(lon).cast("double"), "y": F.col(lat).cast("double")})
    if source_epsg != 4326:
        raise ValueError(f"EPSG:{source_epsg} points must come in degrees or in the grid's CRS")
    return add_projected(df, F.col(lon).cast("double"), F.col(lat).cast("double"), grid.epsg)


METHODS = {"intersect": Template.intersect, "kdtree": Template.nearest, "home": Template.home}


def map_points(df: DataFrame, template: Template, method: str = "intersect", x: str = "x", y: str = "y") -> DataFrame:
    """Add ``grid_idx``: no join, no shuffle."""
    if method not in METHODS:
        raise ValueError(f"method {method!r} is not one of {', '.join(METHODS)}")
    return df.withColumn("grid_idx", METHODS[method](template, F.col(x), F.col(y)))


def map_cells(df: DataFrame, grid: Grid, minx: str, miny: str, maxx: str, maxy: str) -> DataFrame:
    """Pre-gridded cells: the id of the cell that holds their centre."""
    return df.withColumn("grid_idx", grid.index((F.col(minx) + F.col(maxx)) / 2, (F.col(miny) + F.col(maxy)) / 2))


def uncertainty(df: DataFrame, column: str | None, default: float = 0.0) -> Column:
    """Metres, never null nor negative."""
    return F.greatest(F.coalesce(F.col(column).cast("double"), F.lit(float(default))), F.lit(0.0)) if column else F.lit(float(default))
