"""Map projections as column expressions, and their numpy twins for bounds that the driver folds into literals.

Formulas: Snyder, Map Projections - A Working Manual (USGS 1395): Lambert azimuthal equal area (EPSG:3035),
cylindrical equal area (EPSG:6933); Krueger series for UTM. No CRS is kept per row: it is a property of a plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

A = 6378137.0
WGS84_F, GRS80_F = 1 / 298.257223563, 1 / 298.257222101


@dataclass(frozen=True)
class Maths:
    """The elementary functions that a formula is written in: Spark columns or numpy."""

    sin: object
    cos: object
    asin: object
    atan2: object
    log: object
    sqrt: object
    radians: object


COLUMNS = Maths(F.sin, F.cos, F.asin, F.atan2, F.log, F.sqrt, F.radians)
ARRAYS = Maths(np.sin, np.cos, np.arcsin, np.arctan2, np.log, np.sqrt, np.radians)


def _authalic(sin_lat, e, m: Maths):
    """q of Snyder (3-12)."""
    e2 = e * e
    return (sin_lat / (sin_lat * sin_lat * -e2 + 1.0) - m.log((sin_lat * -e + 1.0) / (sin_lat * e + 1.0)) * (1 / (2 * e))) * (1 - e2)


class Laea:
    """EPSG:3035, ETRS89-extended / LAEA Europe."""

    code = 3035
    e = math.sqrt(GRS80_F * (2 - GRS80_F))
    lat0, lon0, fe, fn = math.radians(52), math.radians(10), 4321000.0, 3210000.0
    qp = float(_authalic(1.0, e, ARRAYS))
    q0 = float(_authalic(math.sin(lat0), e, ARRAYS))
    beta0 = math.asin(q0 / qp)
    rq = A * math.sqrt(qp / 2)
    d = A * math.cos(lat0) / math.sqrt(1 - (e * math.sin(lat0)) ** 2) / (rq * math.cos(beta0))

    @classmethod
    def forward(cls, lon, lat, m: Maths = COLUMNS):
        beta = m.asin(_authalic(m.sin(m.radians(lat)), cls.e, m) / cls.qp)
        away = m.radians(lon) - cls.lon0
        return cls.from_parts(m.sin(beta), m.cos(beta), m.sin(away), m.cos(away), m)

    @classmethod
    def from_parts(cls, sin_beta, cos_beta, sin_away, cos_away, m: Maths):
        s0, c0 = math.sin(cls.beta0), math.cos(cls.beta0)
        b = m.sqrt((sin_beta * s0 + cos_beta * cos_away * c0 + 1.0) ** -1.0 * 2.0) * cls.rq
        x = b * cls.d * cos_beta * sin_away + cls.fe
        y = b / cls.d * (sin_beta * c0 - cos_beta * cos_away * s0) + cls.fn
        return x, y

    @classmethod
    def inverse(cls, x, y):
        x, y = np.asarray(x, float) - cls.fe, np.asarray(y, float) - cls.fn
        rho = np.hypot(x / cls.d, cls.d * y)
        c = 2 * np.arcsin(rho / (2 * cls.rq))
        safe = np.where(rho == 0, 1, rho)
        s0, c0 = math.sin(cls.beta0), math.cos(cls.beta0)
        sin_beta = np.where(rho == 0, s0, np.cos(c) * s0 + cls.d * y * np.sin(c) * c0 / safe)
        lon = cls.lon0 + np.arctan2(x * np.sin(c), cls.d * rho * c0 * np.cos(c) - cls.d**2 * y * s0 * np.sin(c))
        return np.degrees(np.where(rho == 0, cls.lon0, lon)), np.degrees(_latitude(cls.qp * sin_beta, cls.e))


class Cea:
    """EPSG:6933, WGS 84 / NSIDC EASE-Grid 2.0 Global: true scale at 30 degrees."""

    code = 6933
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    k0 = math.cos(math.radians(30)) / math.sqrt(1 - (e * 0.5) ** 2)

    @classmethod
    def forward(cls, lon, lat, m: Maths = COLUMNS):
        return m.radians(lon) * (A * cls.k0), _authalic(m.sin(m.radians(lat)), cls.e, m) * (A / (2 * cls.k0))

    @classmethod
    def inverse(cls, x, y):
        return np.degrees(np.asarray(x, float) / (A * cls.k0)), np.degrees(_latitude(2 * cls.k0 * np.asarray(y, float) / A, cls.e))


class Geographic:
    """EPSG:4326: degrees as they are."""

    code = 4326

    @classmethod
    def forward(cls, lon, lat, m: Maths = COLUMNS):
        return lon, lat

    @classmethod
    def inverse(cls, x, y):
        return np.asarray(x, float), np.asarray(y, float)


def _latitude(q, e):
    """Latitude of an authalic q, by Newton's method."""
    phi = np.arcsin(np.clip(q / 2, -1, 1))
    e2 = e * e
    for _ in range(8):
        s = np.sin(phi)
        phi = phi + (1 - e2 * s * s) ** 2 / (2 * np.cos(phi)) * (q / (1 - e2) - s / (1 - e2 * s * s) + np.log((1 - e * s) / (1 + e * s)) / (2 * e))
    return phi


CRS = {c.code: c for c in (Laea, Cea, Geographic)}


def projection(code: int):
    """ValueError for a CRS that has no closed form here."""
    if code not in CRS:
        raise ValueError(f"EPSG:{code} is not supported; use one of {sorted(CRS)}")
    return CRS[code]


def project(lon: Column, lat: Column, code: int) -> tuple[Column, Column]:
    """Columns x, y of points in degrees. No work at all if the target is geographic."""
    return projection(code).forward(lon, lat)


def add_projected(df: DataFrame, lon: Column, lat: Column, code: int) -> DataFrame:
    """``df`` with columns x, y of points in degrees, each intermediate value computed once for each row.

    What filters and expressions above use is the result: it comes out of a generator, through which the optimiser
    does not copy the formula into them.
    """
    others = [c for c in df.columns if c not in ("x", "y")]
    t = df.withColumns({"__lon": lon, "__lat": lat})
    if code == Laea.code:
        t = t.withColumn("__s", F.sin(F.radians("__lat"))).withColumn("__beta", F.asin(_authalic(F.col("__s"), Laea.e, COLUMNS) / Laea.qp)).withColumn("__away", F.radians("__lon") - Laea.lon0)
        t = t.withColumns({"__sb": F.sin("__beta"), "__cb": F.cos("__beta"), "__sa": F.sin("__away"), "__ca": F.cos("__away")})
        x, y = Laea.from_parts(*(F.col(c) for c in ("__sb", "__cb", "__sa", "__ca")), COLUMNS)
    else:
        x, y = projection(code).forward(F.col("__lon"), F.col("__lat"))
    return t.select(*others, F.inline(F.array(F.struct(x.alias("x"), y.alias("y")))))


def transform_points(x, y, source: int, target: int):
    """numpy: from one CRS to another by way of degrees."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    if source == target:
        return x, y
    return projection(target).forward(*projection(source).inverse(x, y), ARRAYS)


def edge_points(bounds: tuple[float, float, float, float], per_edge: int) -> tuple[np.ndarray, np.ndarray]:
    """Points along the four edges, ``per_edge`` equal steps on each, corners included."""
    x0, y0, x1, y1 = bounds
    t = np.linspace(0, 1, per_edge + 1)
    xs = np.concatenate([x0 + (x1 - x0) * t, np.full_like(t, x1), x0 + (x1 - x0) * t, np.full_like(t, x0)])
    ys = np.concatenate([np.full_like(t, y0), y0 + (y1 - y0) * t, np.full_like(t, y1), y0 + (y1 - y0) * t])
    return xs, ys


def transform_bounds(bounds: tuple[float, float, float, float], source: int, target: int, densify: int = 21) -> tuple[float, float, float, float]:
    """Bounds in another CRS: edges get ``densify`` points between their corners before they are transformed."""
    x, y = transform_points(*edge_points(bounds, densify + 1), source, target)
    ok = np.isfinite(x) & np.isfinite(y)
    return float(x[ok].min()), float(y[ok].min()), float(x[ok].max()), float(y[ok].max())


def fetch_envelope(bounds: tuple[float, float, float, float], source: int, target: int, resolution: float = 30 / 3600, pixels: int = 2) -> tuple[float, float, float, float]:
    """Bounds to read so that nothing of ``bounds`` is missed: 100 points an edge, then a margin of some pixels.

    In degrees the result ends at the poles and the antimeridian.
    """
    x, y = transform_points(*edge_points(bounds, 99), source, target)
    ok = np.isfinite(x) & np.isfinite(y)
    if not ok.any():
        raise ValueError("no point of the bounds has a place in the target CRS")
    pad = resolution * pixels
    found = [float(x[ok].min()) - pad, float(y[ok].min()) - pad, float(x[ok].max()) + pad, float(y[ok].max()) + pad]
    if target == 4326:
        found = [max(found[0], -180.0), max(found[1], -90.0), min(found[2], 180.0), min(found[3], 90.0)]
    return tuple(found)


def utm_zone(lon: Column) -> Column:
    """1 to 60."""
    return F.least(F.greatest(F.floor((lon + 180.0) / 6.0) + 1, F.lit(1)), F.lit(60)).cast("int")


def utm_epsg(lon: Column, lat: Column) -> Column:
    """326xx north, 327xx south; null where UTM ends (84 degrees north, 80 south)."""
    return F.when((lat < 84.0) & (lat >= -80.0), F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + utm_zone(lon))


_N = WGS84_F / (2 - WGS84_F)
_RECT = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
#: Krueger series in the third flattening, to its sixth power.
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288 + 7891 * _N**6 / 37800,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630 - 1983433 * _N**6 / 1935360,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880 + 167603 * _N**6 / 181440,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168 + 6601661 * _N**6 / 7257600,
    34729 * _N**5 / 80640 - 3418889 * _N**6 / 1995840,
    212378941 * _N**6 / 319334400,
]
_BETA = [
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360 - 81 * _N**5 / 512 + 96199 * _N**6 / 604800,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440 + 46 * _N**5 / 105 - 1118711 * _N**6 / 3870720,
    17 * _N**3 / 480 - 37 * _N**4 / 840 - 209 * _N**5 / 4480 + 5569 * _N**6 / 90720,
    4397 * _N**4 / 161280 - 11 * _N**5 / 504 - 830251 * _N**6 / 7257600,
    4583 * _N**5 / 161280 - 108847 * _N**6 / 3991680,
    20648693 * _N**6 / 638668800,
]


def utm_forward(lon, lat, zone, south):
    """numpy: easting, northing."""
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (np.asarray(zone) * 6 - 183))
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arcsinh(np.sin(lam) / np.hypot(t, np.cos(lam)))
    x = eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    y = xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    return 500000 + 0.9996 * _RECT * x, 0.9996 * _RECT * y + np.where(south, 1e7, 0)


def utm_inverse(x, y, zone, south):
    """numpy: longitude, latitude."""
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    xi, eta = (np.asarray(y) - np.where(south, 1e7, 0)) / (0.9996 * _RECT), (np.asarray(x) - 500000) / (0.9996 * _RECT)
    u = xi - sum(b * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    v = eta - sum(b * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    tau = np.sin(u) / np.hypot(np.sinh(v), np.cos(u))
    t = tau
    for _ in range(6):
        sigma = np.sinh(e * np.arctanh(e * t / np.hypot(1, t)))
        f = t * np.hypot(1, sigma) - sigma * np.hypot(1, t) - tau
        slope = (np.hypot(1, sigma) * np.hypot(1, t) - sigma * t) * (1 - e * e) * np.hypot(1, t) / (1 + (1 - e * e) * t * t)
        t = t - f / slope
    return np.degrees(np.arctan2(np.sinh(v), np.cos(u))) + np.asarray(zone) * 6 - 183, np.degrees(np.arctan(t))


def wrap_longitude(lon: Column) -> Column:
    """Into [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def degrees_east(metres: Column, lat: Column) -> Column:
    """Metres along a parallel in degrees; the latitude is kept off the poles."""
    return metres / (F.cos(F.radians(F.least(F.greatest(lat, F.lit(-89.9)), F.lit(89.9)))) * 111320.0)


def degrees_north(metres: Column) -> Column:
    return metres / 111320.0
