"""Cell codes of public reference grids: encoders and parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweave.functions.crs import Laea

#: Resolutions that each code allows.
RESOLUTIONS = {"EEARG": (25, 100, 250, 1000, 10000, 100000), "EUROSTAT": (1000, 5000, 10000, 100000), "EQDG": (0, 1, 2, 3, 4, 5, 6), "DMSG": (1, 30, 60, 300, 600, 1800, 3600)}


def _check(kind: str, resolution: int) -> None:
    if resolution not in RESOLUTIONS[kind]:
        raise ValueError(f"{kind} has no resolution {resolution}; allowed: {RESOLUTIONS[kind]}")


def _size(metres: int) -> str:
    return f"{metres // 1000}km" if metres % 1000 == 0 else f"{metres}m"


def eea_code(lon: Column, lat: Column, resolution: int = 1000) -> Column:
    """EEA reference grid, e.g. 1kmE3900N3100: corner coordinates without the zeros that the size implies."""
    return eea_code_of(*Laea.forward(lon, lat), resolution)


def eea_code_of(x: Column, y: Column, resolution: int = 1000) -> Column:
    """``eea_code`` of points that are projected already."""
    _check("EEARG", resolution)
    zeros = len(str(resolution)) - len(str(resolution).rstrip("0"))
    cell = lambda v: (F.floor(v / float(resolution)).cast("long") * resolution / 10**zeros).cast("long").cast("string")
    return F.concat(F.lit(f"{_size(resolution)}E"), cell(x), F.lit("N"), cell(y))


def eurostat_code(lon: Column, lat: Column, resolution: int = 1000) -> Column:
    """Statistical grid, e.g. CRS3035RES1000mN3100000E3900000."""
    _check("EUROSTAT", resolution)
    x, y = Laea.forward(lon, lat)
    cell = lambda v: (F.floor(v / float(resolution)).cast("long") * resolution).cast("string")
    return F.concat(F.lit(f"CRS3035RES{resolution}mN"), cell(y), F.lit("E"), cell(x))


def dmsg_code(lon: Column, lat: Column, seconds: int = 30) -> Column:
    """Degree-minute-second grid: the south-west corner of a cell of so many arc-seconds, e.g. E004-30-00N50-30-30."""
    _check("DMSG", seconds)

    def part(v: Column, positive: str, negative: str, digits: int) -> Column:
        corner = F.floor(v * 3600.0 / seconds).cast("long") * seconds
        size = F.abs(corner)
        degree, minute, second = F.floor(size / 3600).cast("long"), F.floor(size % 3600 / 60).cast("long"), size % 60
        return F.concat(F.when(corner >= 0, positive).otherwise(negative), F.lpad(degree.cast("string"), digits, "0"), F.lit("-"), F.lpad(minute.cast("string"), 2, "0"), F.lit("-"), F.lpad(second.cast("string"), 2, "0"))

    return F.concat(part(lon, "E", "W", 3), part(lat, "N", "S", 2))


def eqdg_code(lon: Column, lat: Column, level: int = 2) -> Column:
    """Extended quarter-degree grid: whole degrees, then a letter A to D for each halving (A north-west)."""
    _check("EQDG", level)
    x0, y0 = F.floor(lon), F.floor(lat)
    code = F.concat(F.when(lon >= 0, "E").otherwise("W"), F.lpad(F.abs(F.when(lon >= 0, x0).otherwise(x0 + 1)).cast("long").cast("string"), 3, "0"), F.when(lat >= 0, "N").otherwise("S"), F.lpad(F.abs(F.when(lat >= 0, y0).otherwise(y0 + 1)).cast("long").cast("string"), 2, "0"))
    fx, fy = lon - x0, lat - y0
    for i in range(1, level + 1):
        east = F.floor(fx * 2.0**i).cast("long") % 2 == 1
        north = F.floor(fy * 2.0**i).cast("long") % 2 == 1
        code = F.concat(code, F.when(north & ~east, "A").when(north, "B").when(~east, "C").otherwise("D"))
    return code


def parse_box(code: Column, strict: bool = False) -> Column:
    """struct(minx, miny, maxx, maxy) of an EEA or statistical code in any case; null (or an error) for others."""
    text = F.upper(F.trim(code))
    short, long_ = r"^(\d+)(KM|M)E(\d+)N(\d+)$", r"^CRS(\d+)RES(\d+)MN(\d+)E(\d+)$"
    group = lambda pattern, i: F.regexp_extract(text, pattern, i).try_cast("long")
    size = group(short, 1) * F.when(F.regexp_extract(text, short, 2) == "KM", 1000).otherwise(1)
    digits = size.cast("string")
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    scale = F.pow(F.lit(10.0), zeros)
    box = lambda x, y, r: F.struct(x.cast("double").alias("minx"), y.cast("double").alias("miny"), (x + r).cast("double").alias("maxx"), (y + r).cast("double").alias("maxy"))
    other = F.raise_error(F.concat(F.lit("not a cell code: "), F.coalesce(code, F.lit("null")))) if strict else F.lit(None)
    return F.when(text.rlike(short), box(group(short, 3) * scale, group(short, 4) * scale, size)).when(text.rlike(long_), box(group(long_, 4), group(long_, 3), group(long_, 2))).otherwise(other)


def mine_crs(codes: Column) -> Column:
    """Aggregate: the EPSG code that the first code of a table speaks of; 4326 if none does."""
    first = F.upper(F.first(codes, ignorenulls=True))
    return F.when(first.startswith("CRS3035"), 3035).when(first.startswith("CRS4326"), 4326).when(first.contains("ME"), 3035).when(first.rlike("^[WE].*[SN]"), 4326).otherwise(4326)
