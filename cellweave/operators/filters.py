"""Predicates of an occurrence request, and its columns. All are conjuncts that the scan can push down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.crs import fetch_envelope
from cellweave.operators.grids import grid_size_metres

#: Ranks from the broadest to the narrowest; quality flags that exclude a record by default.
RANKS = ("kingdom", "phylum", "class", "order", "family", "genus", "species")
BAD_ISSUES = ("ZERO_COORDINATE", "COORDINATE_OUT_OF_RANGE", "COORDINATE_INVALID", "COUNTRY_COORDINATE_MISMATCH")
STATUS = {"occurrence": ("PRESENT",), "absence": ("ABSENT",), "frequency": ("PRESENT", "ABSENT"), "all": ("PRESENT", "ABSENT", "UNKNOWN")}
RECORD_TYPES = {"presence": "occurrence"}
RESERVED = ("year", "month", "day", "order", "class", "group")


def between(column: str, low=None, high=None) -> Column:
    """Equality if both ends are one; open where an end is None."""
    c, out = F.col(column), F.lit(True)
    if low is not None and low == high:
        return c == low
    if low is not None:
        out = out & (c >= low)
    if high is not None:
        out = out & (c <= high)
    return out


def year_month(years: tuple[int | None, int | None] | None = None, months: tuple[int | None, int | None] | None = None, year: str = "year", month: str = "month") -> Column:
    """Years and months by inclusive ranges. ValueError if a range runs backwards or a month is none."""
    for what, pair in (("year", years), ("month", months)):
        if pair and None not in pair and pair[0] > pair[1]:
            raise ValueError(f"{what} range {pair} runs backwards")
    for m in months or ():
        if m is not None and not 1 <= m <= 12:
            raise ValueError(f"{m} is not a month")
    out = F.lit(True)
    if years:
        out = out & between(year, *years)
    if months:
        out = out & between(month, *months)
    return out


def members(wanted: dict[str, list]) -> Column:
    """Every column in its list; an empty list does not constrain."""
    return reduce(lambda a, b: a & b, (F.col(c).isin(list(v)) for c, v in wanted.items() if v), F.lit(True))


def in_bounds(bounds: tuple[float, float, float, float], x: str, y: str) -> Column:
    return F.col(x).between(bounds[0], bounds[2]) & F.col(y).between(bounds[1], bounds[3])


def scan_bounds(df: DataFrame, bounds: tuple[float, float, float, float], epsg: int, lon: str, lat: str) -> DataFrame:
    """Rows inside the safe envelope of an area given in any CRS: a range filter that reaches the row groups."""
    return df.where(in_bounds(fetch_envelope(bounds, epsg, 4326), lon, lat))


def max_uncertainty(limit: float | str, column: str = "coordinateuncertaintyinmeters", default: float = 1000.0, grid_type: str | None = None, resolution: float | None = None) -> Column:
    """At most so many metres, unknown counting as ``default``; ``auto`` means a cell of the given grid."""
    if limit == "auto":
        if grid_type is None:
            raise ValueError("an automatic limit needs a grid")
        limit = int(grid_size_metres(grid_type, resolution))
    return F.coalesce(F.col(column), F.lit(float(default))) <= float(limit)


def without_issues(issues: tuple[str, ...] = BAD_ISSUES, column: str = "issue") -> Column:
    return reduce(lambda a, b: a & b, (~F.array_contains(column, i) for i in issues), F.lit(True))


def status_of(record_type: str, column: str = "occurrencestatus") -> Column:
    kind = RECORD_TYPES.get(record_type, record_type)
    if kind not in STATUS:
        raise ValueError(f"no record type {record_type!r}")
    return F.col(column).isin(*STATUS[kind])


def taxa(keys: dict[str, list], backbone: str | None = None) -> Column:
    """Records of any of the taxa: OR over rank columns. With a backbone id the keys are strings in a nested map."""
    parts = []
    for rank, values in keys.items():
        if rank not in RANKS:
            raise ValueError(f"no rank {rank!r}")
        if values:
            column = F.col("classificationdetails")[backbone][f"{rank}key"] if backbone else F.col(f"{rank}key")
            parts.append(column.isin([str(v) for v in values] if backbone else list(values)))
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(True)


def rank_slice(level: str = "") -> list[str]:
    """Key columns from a rank down to species: always the named rank and species."""
    if not level:
        return ["specieskey"]
    if level not in RANKS:
        raise ValueError(f"no rank {level!r}")
    return ["specieskey"] if level == "species" else [f"{level}key", "specieskey"]


def quoted(name: str) -> str:
    """Reserved words in backquotes, all in lower case."""
    low = name.lower()
    return f"`{low}`" if low in RESERVED else low


def check_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """The table's own spelling of each column. ValueError for those it lacks."""
    lower = {c.lower(): c for c in df.columns}
    if missing := [w for w in wanted if w.lower() not in lower]:
        raise ValueError(f"no columns {', '.join(missing)}")
    return [lower[w.lower()] for w in wanted]


def align_case(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Rename columns to the spelling a recipe uses."""
    lower = {c.lower(): c for c in df.columns}
    return df.withColumnsRenamed({lower[w.lower()]: w for w in wanted if w.lower() in lower and lower[w.lower()] != w})


def request(df: DataFrame, spec: dict) -> DataFrame:
    """All filters of a request: years, months, bounds, ring, record_type, issues, max_uncertainty, taxa, require."""
    from cellweave.operators.boxes import in_ring

    out = F.lit(True)
    if "hascoordinate" in df.columns:
        out = out & F.col("hascoordinate")
    if spec.get("years") or spec.get("months"):
        out = out & year_month(spec.get("years"), spec.get("months"))
    for column in spec.get("require", ()):
        out = out & F.col(column).isNotNull()
    if spec.get("bounds"):
        out = out & in_bounds(spec["bounds"], "decimallongitude", "decimallatitude")
    if spec.get("ring"):
        ring = spec["ring"]
        box = (min(p[0] for p in ring), min(p[1] for p in ring), max(p[0] for p in ring), max(p[1] for p in ring))
        out = out & in_bounds(box, "decimallongitude", "decimallatitude") & in_ring(F.col("decimallongitude"), F.col("decimallatitude"), ring)
    if spec.get("record_type"):
        out = out & status_of(spec["record_type"])
    if spec.get("issues") is not None:
        out = out & without_issues(tuple(spec["issues"]))
    if spec.get("max_uncertainty") is not None:
        out = out & max_uncertainty(spec["max_uncertainty"], default=spec.get("default_uncertainty", 1000.0), grid_type=spec.get("grid_type"), resolution=spec.get("grid_resolution"))
    if spec.get("taxa"):
        out = out & taxa(spec["taxa"], spec.get("backbone"))
    return df.where(out)


def split_matches(matches: DataFrame, fuzzy_ok: bool = False, higher_ok: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid, mismatched) name lookups: no match never is valid, loose and higher-rank ones only if asked for."""
    bad = ["NONE", *([] if fuzzy_ok else ["FUZZY", "VARIANT"]), *([] if higher_ok else ["HIGHERRANK"])]
    wrong = F.coalesce(F.col("matchtype"), F.lit("NONE")).isin(bad)
    return matches.where(~wrong), matches.where(wrong)


def keys_by_rank(valid: DataFrame) -> DataFrame:
    """(rank, keys): distinct usage keys of each rank, sorted."""
    return valid.groupBy(F.lower("rank").alias("rank")).agg(F.sort_array(F.collect_set("usagekey")).alias("keys"))
